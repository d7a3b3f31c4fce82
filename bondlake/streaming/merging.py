"""Streams of new rows merged into a keep-last state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from bondlake.operators.cut import remove
from bondlake.operators.state import aligned, append, keep_last

# A state is a folder of parts, one per hash of the key; a part is a folder of versions
# v<number of the merge>, of which the newest complete one counts. A merge writes new
# versions of the parts that its batch touches and then its log entry; only versions named
# by the log are read, so half a merge is never seen.


def _fs(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, root = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def _log(spark: SparkSession, state: str) -> list[tuple[int, str, int, dict[int, int]]]:
    """Finished merges, oldest first: (number, stream, batch, newest version of each part)."""
    import json

    out = []
    for name in _names(spark, f"{state}/log"):
        if name.isdigit():
            text = spark.read.text(f"{state}/log/{name}").first()
            if text:
                entry = json.loads(text[0])
                out.append((int(name), entry["stream"], entry["batch"], {int(k): v for k, v in entry["parts"].items()}))
    return sorted(out)


def merged(spark: SparkSession, state: str, schema: StructType) -> DataFrame:
    """The state as of its last finished merge; empty where there is none."""
    log = _log(spark, state)
    paths = [f"{state}/part={p}/v{v}" for p, v in sorted(log[-1][3].items())] if log else []
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, schema: StructType, state: str, keys: list[str | Column], seq: str, stream: str, number: int, parts: int = 16) -> bool:
    """Merge one batch; False if there was nothing to do: an empty batch, or one that is in the state already.

    ``stream`` and ``number`` name the batch: a replay after a failure finds its entry in the
    log and does nothing. Only parts that the batch touches are written anew; the number of
    parts is that of the state's first merge. One merge runs at a time.
    """
    import json

    spark = batch.sparkSession
    log = _log(spark, state)
    if any(s == stream and b == number for _, s, b, _ in log):
        return False
    new = keep_last(aligned(batch, schema), keys, seq)
    key = [F.col(k) if isinstance(k, str) else k for k in keys]
    if log:
        parts = json.loads(spark.read.text(f"{state}/log/{log[0][0]}").first()[0])["count"]
    # null keys are equal to one another, so they have a part as well
    part = F.pmod(F.xxhash64(*[x for k in key for x in (k.cast("string"), k.isNull())]), F.lit(parts)).cast("int")
    new = new.withColumn("_part", part).persist()
    try:
        touched = [r[0] for r in new.select("_part").distinct().collect()]  # at most ``parts``
        if not touched:
            return False
        current = dict(log[-1][3]) if log else {}
        version = log[-1][0] + 1 if log else 0
        for p in touched:
            before = spark.read.schema(schema).parquet(f"{state}/part={p}/v{current[p]}") if p in current else spark.createDataFrame([], schema)
            rows = keep_last(append(before, new.filter(F.col("_part") == p).drop("_part")), keys, seq)
            rows.write.mode("overwrite").parquet(f"{state}/part={p}/v{version}")
    finally:
        new.unpersist()
    keep = {p: v for p, v in current.items() if p not in touched}
    entry = json.dumps({"stream": stream, "batch": number, "count": parts, "parts": {**keep, **dict.fromkeys(touched, version)}})
    spark.createDataFrame([(entry,)], "value string").coalesce(1).write.mode("overwrite").text(f"{state}/log/{version}")
    # readers of the version before may still be there; what is older than that goes
    if len(log) > 1:
        for p, v in log[-2][3].items():
            if v not in (current.get(p), keep.get(p)):
                remove(spark, f"{state}/part={p}/v{v}")
    return True


def merge_stream(spark: SparkSession, incoming: str, schema: StructType, state: str, checkpoint: str, keys: list[str | Column], seq: str = "seq", files_per_batch: int = 100) -> StreamingQuery:
    """Read what arrived as Parquet below ``incoming`` and merge each batch into ``state``, which any earlier stream may have begun.

    A batch that is replayed after a failure is merged once. Late rows are ordinary rows: the
    largest ``seq`` of a key stays. Without new rows the state isn't touched.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch, schema, state, keys, seq, checkpoint, number)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per key and time window of a stream; rows later than ``late`` are left out by the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), key, "n")
