"""Implausible readings: robust exponentially weighted control charts per source.

Plan. Every series (a field of a source) is cut by row ids into chunks of about ``chunk``
rows (three to five quarters of it, the last one fewer), so no task ever holds more of one
series however hot it is: rows are counted by ranges of ids, and neighbouring ranges of a
series are put together.

1. Each chunk is scanned in id order: a reading is clipped to the chart's own running limits
   before it updates the running mean and scale of ``log(value)``. A chunk begins at its own
   median and spread; it gives one summary row: the state at its end, and the runs of
   unchanged values at its two borders with their first ``least`` distinct keys.
2. Over the summaries: the state at the end of a chunk is where the next one has to begin,
   and border runs of neighbouring chunks are put together.
3. Each chunk is scanned again from where it has to begin. A chart forgets its beginning, so
   its end is the end found before; where it isn't (a chunk of few readings), the chunk's
   end is corrected and the step repeated until all ends stand. Now every chunk knows its
   suspects (readings outside ``limit`` running deviations), stuck runs and calm readings.
4. The lowest and highest calm reading of a series give the final bounds of its suspects.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bondlake.operators.cut import cut


@dataclass(frozen=True)
class Chart:
    """Parameters of the charts; they are the same at every size of the input."""

    chunk: int = 100_000  #: readings per chunk; a chart forgets its beginning in far fewer
    alpha: float = 0.02  #: weight of the newest reading
    clip: float = 2.5  #: a reading counts as no further from the mean, in running deviations
    limit: float = 2.5  #: chart limit, in running deviations
    floor: float = 0.02  #: least deviation of log(value)
    settled: float = 1e-6  #: two ends of a chunk are the same within this
    ratio: float = 3.0  #: a case is more than this times the highest ordinary value
    run_rows: int = 10  #: least length of a run, in rows
    run_keys: int = 10  #: least length of a run, in distinct run keys


@dataclass(frozen=True)
class Field:
    name: str
    impossible: Column  #: physical limit, true for readings that cannot be
    run_key: str | None = None  #: runs are counted in distinct values of this column, else in rows


def scan(x: np.ndarray, mean: float, var: float, c: Chart) -> tuple[np.ndarray, float, float]:
    """(whether each reading is inside the limits that it meets, mean and variance at the end)."""
    calm = np.empty(len(x), bool)
    keep, least = 1 - c.alpha, c.floor**2
    for i, v in enumerate(x.tolist()):
        dev = max(var, least) ** 0.5
        d = v - mean
        calm[i] = -c.limit * dev <= d <= c.limit * dev
        d = max(-c.clip * dev, min(c.clip * dev, d))
        mean += c.alpha * d
        var = keep * var + c.alpha * d * d
    return calm, mean, var


def _usable(pdf: pd.DataFrame) -> np.ndarray:
    return (~pdf["bad"].to_numpy(bool)) & (pdf["v"].to_numpy() > 0)


def _begin(x: np.ndarray, c: Chart) -> tuple[float, float]:
    """Median of a chunk's readings and the square of their spread around it."""
    if not len(x):
        return np.nan, np.nan
    mid = float(np.median(x))
    return mid, max(c.floor, 1.4826 * float(np.median(np.abs(x - mid)))) ** 2


def _ends(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the runs of unchanged values."""
    cuts = np.flatnonzero(v[1:] != v[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(v)]])


def _some(keys: list, least: int) -> list[str]:
    """The first ``least`` distinct keys."""
    out: dict[str, None] = {}
    for k in keys:
        out[k] = None
        if len(out) == least:
            break
    return list(out)


SUMMARY = "series string, chunk long, mean double, var double, m0 double, v0 double, first_v double, first_keys array<string>, last_v double, last_keys array<string>, least int"


def _summarise(c: Chart):
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id", kind="stable")
        x = np.log(pdf["v"].to_numpy(float)[_usable(pdf)])
        m0, v0 = _begin(x, c)
        _, mean, var = scan(x, m0, v0, c)
        v, keys, least = pdf["v"].to_numpy(float), pdf["run_key"].tolist(), int(pdf["least"].iloc[0])
        a, b = _ends(v)
        last = None if len(a) == 1 else _some(keys[a[-1] :], least)
        return pd.DataFrame([(pdf["series"].iloc[0], pdf["chunk"].iloc[0], mean, var, m0, v0, v[0], _some(keys[: b[0]], least), v[-1], last, least)], columns=[f.split(" ")[0] for f in SUMMARY.split(", ")])

    return one


def _border_runs(summary: DataFrame) -> DataFrame:
    """(series, chunk, first_stuck, last_stuck): whether the runs at the borders of a chunk are long enough, whatever chunks they span."""
    side = lambda k, v, keys: F.struct(F.lit(k).alias("side"), F.col(v).alias("v"), F.col(keys).alias("keys"))
    sides = summary.select("series", "chunk", "least", F.explode(F.array(side(0, "first_v", "first_keys"), side(1, "last_v", "last_keys"))).alias("s")).select("series", "chunk", "least", "s.*").filter("keys is not null")
    w = W.partitionBy("series").orderBy("chunk", "side")
    begins = F.when((F.col("side") == 0) & (F.lag("v").over(w) == F.col("v")), 0).otherwise(1)
    sides = sides.withColumn("begins", begins).withColumn("run", F.sum("begins").over(w.rowsBetween(W.unboundedPreceding, 0)))
    size = sides.select("series", "run", "least", F.explode("keys").alias("key")).groupBy("series", "run").agg((F.count_distinct("key") >= F.max("least")).alias("stuck"))
    at = lambda k: F.max(F.when(F.col("side") == k, F.col("stuck")))
    return sides.join(size, ["series", "run"]).groupBy("series", "chunk").agg(F.coalesce(at(0), F.lit(False)).alias("first_stuck"), F.coalesce(at(1), at(0)).alias("last_stuck"))


FOUND = "series string, chunk long, kind string, row_id long, v double, lo double, hi double"


def _judge(c: Chart):
    """Rows of a chunk that matter: stuck ones, suspects, and one row with its calm range and its end."""

    def one(pdf: pd.DataFrame, ctx: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id", kind="stable")
        v, keys, least, t = pdf["v"].to_numpy(float), pdf["run_key"].tolist(), int(pdf["least"].iloc[0]), ctx.iloc[0]
        a, b = _ends(v)
        stuck = np.zeros(len(v), bool)
        for i in np.flatnonzero(b - a >= least).tolist():
            stuck[a[i] : b[i]] = len(_some(keys[a[i] : b[i]], least)) >= least
        stuck[: b[0]], stuck[a[-1] :] = t["first_stuck"], t["last_stuck"]
        use = _usable(pdf)
        calm, mean, var = scan(np.log(v[use]), t["m_in"], t["v_in"], c)
        plain = v[use][calm & ~stuck[use]]
        suspect = np.zeros(len(v), bool)
        suspect[np.flatnonzero(use)[~calm]] = True
        bad, ids = pdf["bad"].to_numpy(bool), pdf["row_id"].to_numpy()
        at = lambda x, kind: pd.DataFrame({"kind": kind, "row_id": ids[x], "v": v[x], "lo": np.nan, "hi": np.nan})
        lo, hi = (plain.min(), plain.max()) if len(plain) else (np.nan, np.nan)
        own = pd.DataFrame({"kind": ["calm", "end"], "row_id": [0, 0], "v": [0.0, 0.0], "lo": [lo, mean], "hi": [hi, var]})
        return pd.concat([at(bad, "physical"), at(stuck & ~bad, "stuck"), at(suspect & ~stuck, "range"), at(suspect & stuck, "both"), own]).assign(series=pdf["series"].iloc[0], chunk=pdf["chunk"].iloc[0])[[f.split(" ")[0] for f in FOUND.split(", ")]]

    return one


def flag_spikes(df: DataFrame, id_col: str, source_col: str, fields: list[Field], chart: Chart = Chart()) -> DataFrame:
    """(row_id, field, reason) of every implausible reading; reason is physical, range or stuck.

    Null readings are no case and do not break a run; rows without source form one
    source of their own; sources of one row have no range and no run. A value that is
    impossible is reported once, as physical, and is not ordinary. Repeated rows are
    rows like any other. An empty table gives no rows. Other columns are not read.
    """
    c = chart
    row = F.col(id_col).cast("long")
    each = [
        F.struct(
            F.lit(f.name).alias("field"), F.col(f.name).cast("double").alias("v"), F.coalesce(f.impossible, F.lit(False)).alias("bad"),
            (F.coalesce(F.col(f.run_key).cast("string"), F.lit("")) if f.run_key else row.cast("string")).alias("run_key"),
            F.lit(c.run_keys if f.run_key else c.run_rows).alias("least"),
        )
        for f in fields
    ]
    rows = df.select(row.alias("row_id"), F.col(source_col).cast("string").alias("s"), F.explode(F.array(*each)).alias("x")).filter("x.v is not null and not isnan(x.v)")
    # a series is one field of one source; \0 can't be confused with a named source
    rows = rows.select(F.concat("x.field", F.lit("\1"), F.coalesce("s", F.lit("\0"))).alias("series"), "row_id", F.floor(F.col("row_id") / max(1, c.chunk // 4)).cast("long").alias("range"), "x.v", "x.bad", "x.run_key", "x.least")
    ranges = rows.groupBy("series", "range").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("series").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("series", "range", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / c.chunk).cast("long").alias("chunk"))
    rows = cut(rows.join(ranges, ["series", "range"]).drop("range").repartition("series", "chunk"))
    summary = cut(rows.groupBy("series", "chunk").applyInPandas(_summarise(c), SUMMARY))
    runs = _border_runs(summary)
    ends = summary.select("series", "chunk", "mean", "var", "m0", "v0")
    before = W.partitionBy("series").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    known = lambda x: F.when(~F.isnan(x), F.col(x))
    while True:
        begin = ends.withColumn("m_in", F.coalesce(F.last(known("mean"), ignorenulls=True).over(before), F.col("m0"))).withColumn("v_in", F.coalesce(F.last(known("var"), ignorenulls=True).over(before), F.col("v0")))
        context = begin.select("series", "chunk", "m_in", "v_in").join(runs, ["series", "chunk"])
        found = cut(rows.groupBy("series", "chunk").cogroup(context.groupBy("series", "chunk")).applyInPandas(_judge(c), FOUND))
        now = found.filter("kind = 'end'").select("series", "chunk", F.col("lo").alias("mean_now"), F.col("hi").alias("var_now"))
        both = ends.join(now, ["series", "chunk"])
        off = (F.abs(F.col("mean") - F.col("mean_now")) > c.settled) | (F.abs(F.col("var") - F.col("var_now")) > c.settled)
        if both.filter(off & ~F.isnan("mean")).isEmpty():
            break
        ends = cut(both.select("series", "chunk", F.col("mean_now").alias("mean"), F.col("var_now").alias("var"), "m0", "v0"))
    bounds = found.filter("kind = 'calm' and not isnan(lo)").groupBy("series").agg(F.min("lo").alias("low"), F.max("hi").alias("high"))
    cases = found.filter("kind not in ('calm', 'end')").join(bounds, "series", "left")
    outside = F.coalesce((F.col("v") > c.ratio * F.col("high")) | (F.col("v") * c.ratio < F.col("low")), F.lit(False)) & F.col("kind").isin("range", "both")
    reason = F.when(F.col("kind") == "physical", "physical").when(outside, "range").when(F.col("kind").isin("stuck", "both"), "stuck")
    out = cases.select("row_id", F.substring_index("series", "\1", 1).alias("field"), reason.alias("reason"))
    return out.filter("reason is not null")
