"""Incrementally merged state: keep-last merges, skips of what was seen, early stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import StructType


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the order and types of the schema, null where missing."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def append(state: DataFrame, new: DataFrame) -> DataFrame:
    return state.unionByName(aligned(new, state.schema))


def keep_last(df: DataFrame, keys: list[str | Column], seq: str) -> DataFrame:
    """The row with the largest ``seq`` of every key; null keys are equal to one another.

    An aggregate with map-side combine, not a window: a hot key costs one row per task in
    the shuffle and is never sorted or gathered.
    """
    key = [F.col(k) if isinstance(k, str) else k for k in keys]
    row = F.max_by(F.struct(*df.columns), seq).alias("_row")
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(key)]).agg(row).select("_row.*")


#: Keys of the three states.
ANNOUNCEMENT_KEYS = ["url", "issue_no", "term"]
PLAN_KEYS = ["url"]


def result_key() -> Column:
    """Coded rows by code, the others by url, in one key."""
    return F.coalesce(F.concat(F.lit("c:"), F.col("bond_code")), F.concat(F.lit("u:"), F.col("url")))


def merge(state: DataFrame, new: DataFrame, keys: list[str | Column], seq: str) -> DataFrame:
    return keep_last(append(state, new), keys, seq)


def unseen(items: DataFrame, state: DataFrame, key: str = "url") -> DataFrame:
    return items.join(state.select(key).distinct(), key, "left_anti")


def first_new(items: DataFrame, state: DataFrame, position: str, limit: int, key: str = "url") -> DataFrame:
    """The first unseen items in feed order."""
    return unseen(items, state, key).orderBy(position, key).limit(limit)


def early_stop(items: DataFrame, target: int, run: int = 5, page: str = "page_no", seen: str = "seen", source: str | None = None) -> DataFrame:
    """Items of the pages that an ordered crawl reads: it stops before a page >= 2 once ``target`` items are unseen, and after ``run`` consecutive pages with nothing new.

    Every ``source`` (all items are one without it) is crawled by itself. Pages without
    items are skipped and leave the count of such pages as it is; page 1 never counts. The
    windows run over one row per page of a source.
    """
    key = [source] if source else []
    pages = items.groupBy(*key, page).agg(F.count_if(~F.col(seen)).alias("_new"))
    of = [F.col(source)] if source else [F.lit(0)]
    w = W.partitionBy(*of).orderBy(page)
    stale = (F.col("_new") == 0) & (F.col(page) > 1)
    pages = pages.withColumn("_before", F.coalesce(F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    pages = pages.withColumn("_island", F.sum(F.when(stale, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    pages = pages.withColumn("_length", F.when(stale, F.row_number().over(W.partitionBy(*of, "_island", stale).orderBy(page))).otherwise(0))
    stopped = F.coalesce(F.max((F.col("_length") >= run).cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    met = (F.col("_before") >= target) & (F.col(page) > 1)
    pages = pages.withColumn("_stop", F.greatest(stopped, met.cast("int")))
    return items.join(pages.filter("_stop = 0").select(*key, page), [*key, page], "left_semi")
