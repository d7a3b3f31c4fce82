"""Matching records by nearest time: range partition, local scan, exchange of edges.

Left and right records are laid out together in one global order of (entity, time),
split by range into tasks of about equal size, so an entity of any size spans as many
tasks as it needs. Each task scans its own rows once. What a task cannot see is only
the last right record before its first row and the first one after its last row: each
task gives one summary row for either direction, and an exclusive prefix scan over the
summaries (associative: "the later record, if it is of the same entity") brings the
edge records to every task, over any number of tasks without a right record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bondlake.operators.cut import cut


def nearest(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, entity: tuple[Column, Column], day: tuple[Column, Column], tolerance: int, tasks: int | None = None
) -> DataFrame:
    """(left_id, right_id, distance): for each left row the right row of its entity nearest in days.

    At most ``tolerance`` days apart. Of equal distances the earlier right day wins, of
    equal days the smallest right id. Rows with null entity or day match nothing;
    left rows without a match give no row; repeated left rows are matched each. Either
    table may be empty; other columns are not read.
    """
    spark = left.sparkSession
    lhs = left.select(entity[0].alias("e"), F.unix_date(day[0]).alias("d"), F.lit(1).alias("side"), F.col(left_id).cast("long").alias("id")).filter("e is not null and d is not null and id is not null")
    rhs = right.select(entity[1].alias("e"), F.unix_date(day[1]).alias("d"), F.col(right_id).cast("long").alias("id")).filter("e is not null and d is not null and id is not null")
    rhs = rhs.groupBy("e", "d").agg(F.min("id").alias("id")).select("e", "d", F.lit(0).alias("side"), "id")  # of one entity and day only the smallest id can win
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id as last key splits an (entity, day) that holds more rows than one task should
    laid = lhs.unionByName(rhs).repartitionByRange(n, "e", "d", "side", "id").withColumn("task", F.spark_partition_id())
    laid = cut(laid)

    # local scan: rights stand before the lefts of their own day
    order = [F.col("d"), F.col("side"), F.col("id")]
    here = W.partitionBy("task", "e").orderBy(*order)
    is_right = F.col("side") == 0
    rec = F.when(is_right, F.struct("d", "id"))
    x = laid.withColumn("before", F.last(rec, ignorenulls=True).over(here.rowsBetween(W.unboundedPreceding, 0)))
    # looking ahead is looking back in descending order: a frame that grows is scanned once
    back_here = W.partitionBy("task", "e").orderBy(*[c.desc() for c in order])
    x = x.withColumn("after", F.last(rec, ignorenulls=True).over(back_here.rowsBetween(W.unboundedPreceding, -1)))

    # one summary row a task: its first and last entity and their edge right records
    per = laid.groupBy("task", "e").agg(F.min(F.struct(*order)).alias("lo"), F.min(rec).alias("first"), F.max(rec).alias("last"))
    edge = per.groupBy("task").agg(
        F.min("e").alias("e_lo"), F.max("e").alias("e_hi"), F.min_by("first", "e").alias("first"), F.max_by("last", "e").alias("last")
    )
    to_here = W.partitionBy("e").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    from_here = W.partitionBy("e").orderBy(F.desc("task")).rowsBetween(W.unboundedPreceding, -1)
    # an entity shared by tasks is the last of the earlier and the first of the later ones
    ahead = edge.select("task", F.col("e_hi").alias("e"), "last", F.lit(None).cast(edge.schema["first"].dataType).alias("first"))
    back = edge.select("task", F.col("e_lo").alias("e"), F.lit(None).cast(edge.schema["last"].dataType).alias("last"), "first")
    both = ahead.unionByName(back).groupBy("task", "e").agg(F.max("last").alias("last"), F.min("first").alias("first"))
    carried = both.select("task", "e", F.last("last", ignorenulls=True).over(to_here).alias("from_before"), F.last("first", ignorenulls=True).over(from_here).alias("from_after"))
    x = x.filter("side = 1").join(carried, ["task", "e"], "left")
    x = x.withColumn("before", F.coalesce("before", "from_before")).withColumn("after", F.coalesce("after", "from_after"))

    back_gap, on_gap = F.col("d") - F.col("before.d"), F.col("after.d") - F.col("d")
    earlier = F.col("after").isNull() | (F.col("before").isNotNull() & (back_gap <= on_gap))
    best = F.when(earlier, F.col("before")).otherwise(F.col("after"))
    x = x.select(F.col("id").alias("left_id"), best["id"].alias("right_id"), F.abs(F.col("d") - best["d"]).alias("distance"))
    return x.filter(F.col("right_id").isNotNull() & (F.col("distance") <= tolerance))
