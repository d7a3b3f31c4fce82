"""Part of the bondlake engine."""
