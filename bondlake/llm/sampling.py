"""A bounded sample for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F


def smallest_hashes(df: DataFrame, column: str, rows: int, seed: int, total: int | None = None) -> list[Row]:
    """One row for each of the ``rows`` distinct values of ``column`` with the smallest hashes: the same values whatever the partitioning.

    Hashes are even, so a threshold leaves hardly more rows than wanted before the sort; it
    is raised where copies left too few values. What reaches the driver is bounded by ``rows``.
    """
    total = df.count() if total is None else total
    x = df.withColumn("_r", F.xxhash64(column, F.lit(seed)))
    share = 1.2 * rows / max(1, total)
    while True:
        part = x.filter(F.col("_r") < F.lit(int(share * 2**64 - 2**63)).cast("long")) if share < 0.6 else x
        picked = part.dropDuplicates(["_r"]).orderBy("_r").limit(rows).drop("_r").collect()
        if len(picked) == rows or share >= 0.6:
            return picked
        share *= 4
