"""Merged states: resumed, replayed, untouched without new rows."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from bondlake.streaming.merging import _names, merge_batch, merge_stream, merged

SCHEMA = StructType().add("seq", LongType()).add("url", StringType()).add("k", IntegerType())


def rows(spark, state):
    return sorted(tuple(r) for r in merged(spark, state, SCHEMA).collect())


def test_second_stream_over_an_existing_state_keeps_its_rows(spark, tmp_path):
    state = str(tmp_path / "state")
    for i, data in enumerate(([(1, "a", 1), (2, "b", None)], [(3, "c", 1), (4, "b", None)])):
        spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / f"in{i}"))
        merge_stream(spark, str(tmp_path / f"in{i}"), SCHEMA, state, str(tmp_path / f"check{i}"), ["url", "k"]).awaitTermination()
    assert rows(spark, state) == [(1, "a", 1), (3, "c", 1), (4, "b", None)]
    # the first stream goes on where it was
    spark.createDataFrame([(5, "d", 2)], SCHEMA).write.mode("append").parquet(str(tmp_path / "in0"))
    merge_stream(spark, str(tmp_path / "in0"), SCHEMA, state, str(tmp_path / "check0"), ["url", "k"]).awaitTermination()
    assert rows(spark, state) == [(1, "a", 1), (3, "c", 1), (4, "b", None), (5, "d", 2)]


def test_replay_and_empty_batch_change_nothing(spark, tmp_path):
    state = str(tmp_path / "state")
    one = spark.createDataFrame([(1, "a", 1), (2, None, None)], SCHEMA)
    assert merge_batch(one, SCHEMA, state, ["url", "k"], "seq", "s", 0)
    log = _names(spark, f"{state}/log")
    assert not merge_batch(one, SCHEMA, state, ["url", "k"], "seq", "s", 0)
    assert not merge_batch(one.limit(0), SCHEMA, state, ["url", "k"], "seq", "s", 1)
    assert _names(spark, f"{state}/log") == log
    assert merge_batch(spark.createDataFrame([(3, None, None)], SCHEMA), SCHEMA, state, ["url", "k"], "seq", "s", 2)
    assert rows(spark, state) == [(1, "a", 1), (3, None, None)]
    # only the part of the key was written anew
    assert sum(len(_names(spark, f"{state}/{p}")) for p in _names(spark, state) if p.startswith("part=")) == 3


def test_no_state(spark, tmp_path):
    assert rows(spark, str(tmp_path / "none")) == []
