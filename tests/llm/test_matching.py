"""Nearest time, survivors and linkage against brute force, and awkward input."""

from __future__ import annotations

import random
from datetime import date, timedelta

import duckdb
import numpy as np
from pyspark.sql import functions as F

from bondlake.llm.linkage import Rules, components, confident, link, link_entities, solve
from bondlake.llm.nearest import nearest
from bondlake.llm.queries import ORACLES, QUERIES
from bondlake.llm.survivor import bond_key, choose, consensus, real_value, survivors, tokens

DAY = date(2024, 1, 1)


def test_nearest_equals_brute_force_over_many_tasks(spark):
    rng = random.Random(5)
    left = [(i, rng.choice(["hot", "hot", "hot", "a", "b", None]), DAY + timedelta(rng.randrange(400)) if rng.random() > 0.05 else None) for i in range(500)]
    right = [(1000 + i, rng.choice(["hot", "a", "c", None]), DAY + timedelta(rng.randrange(400)) if rng.random() > 0.05 else None) for i in range(60)] + [(2000, "hot", DAY + timedelta(7)), (1999, "hot", DAY + timedelta(7))]
    want = {}
    for i, e, d in left:
        near = [(abs((d - s).days), s, p) for p, f, s in right if e and f == e and d and s]
        if near and min(near)[0] <= 20:
            want[i] = min(near)[2]
    lf = spark.createDataFrame(left, "l long, e string, d date").withColumn("id", F.lit(1)).withColumn("task", F.lit("x"))
    rf = spark.createDataFrame(right, "r long, e string, d date")
    for tasks in (1, 3, 40):
        got = nearest(lf, rf, "l", "r", (F.col("e"), F.col("e")), (F.col("d"), F.col("d")), 20, tasks)
        assert {x.left_id: x.right_id for x in got.collect()} == want
    for a, b in ((lf.limit(0), rf), (lf, rf.limit(0)), (lf.limit(0), rf.limit(0))):
        assert nearest(a, b, "l", "r", (F.col("e"), F.col("e")), (F.col("d"), F.col("d")), 20).collect() == []


def test_survivor_is_the_most_trusted_value(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["123456789", "123456789.SH", "１２３４５６７８９", " 123456789", "23456789", None, "000000001"]), rng.choice(["text", "ocr", None]), rng.choice([None, *[DAY + timedelta(k) for k in range(5)]]), rng.choice(["甲 1", "甲1", "甲 2", "—", "", None, "N/A"])) for i in range(200)]
    key = lambda c: None if c is None else c.strip().translate(str.maketrans("１２３４５６７８９", "123456789")).removesuffix(".SH").rjust(9, "0")
    groups = {}
    for r in rows:
        if key(r[1]):
            groups.setdefault(key(r[1]), []).append(r)
    want = {}
    for g in groups.values():
        ok = [r for r in g if r[4] not in ("—", "", None, "N/A")]
        if len(g) > 1 and ok:
            best = min(ok, key=lambda r: ({"text": 0, "ocr": 1}.get(r[2], 2), -(r[3].toordinal()) if r[3] else 10**9, -r[0]))
            want[min(r[0] for r in g)] = best[0]
    df = spark.createDataFrame(rows, "id long, code string, m string, d date, v string").withColumn("key", F.lit("clash")).withColumn("row_id", F.lit(3))
    trust = lambda: [F.when(F.col("m") == "text", 0).when(F.col("m") == "ocr", 1).otherwise(2), F.coalesce(-F.unix_date("d"), F.lit(2**31 - 1))]
    got = {r.group_id: r.row_id for r in survivors(df, "id", bond_key(F.col("code")), ["v"], trust()).collect()}
    assert got == want
    assert survivors(df.limit(0), "id", bond_key(F.col("code")), ["v"], trust()).collect() == []


def test_consensus_votes_by_column():
    values = ["2024年甲省债券", "2024年甲省债卷", "2024年乙省债券"]
    assert "".join(consensus([tokens(v) for v in values], [1, 1, 1])) == "2024年甲省债券"
    assert choose(values, [1, 1, 1]) == 0
    assert choose(["ab", "cd", "cd"], [1.0, 0.5, 0.25]) == 0
    assert choose(["长" * 5000, "短"], [1.0, 0.5]) == 0


def test_placeholders(spark):
    x = spark.createDataFrame([("—",), ("N/A",), (" ",), ("待补充",), ("--",), ("0",), (None,), ("年付",)], "v string")
    assert [r[0] for r in x.select(real_value(F.col("v"))).collect()] == [None, None, None, None, None, "0", None, "年付"]


def test_alternating_directions_solve_the_convex_problem():
    rng = np.random.default_rng(3)
    n = 6
    pro, con = rng.uniform(0, 4, n), rng.uniform(0.5, 4, n)
    groups = (np.array([0, 1, 2, 3, 4, 5]), np.array([0, 0, 0, 1, 1, 1]))
    implies = np.array([[0, 3], [1, 4]])
    r = Rules(alike=2.0, rho=2.0, steps=4000, tolerance=1e-10)
    y = solve(n, pro, con, groups, implies, np.zeros(n, int), r)

    def cost(v):
        return (pro * (1 - v) ** 2 + con * v**2).sum() + 2.0 * (np.maximum(0, v[implies[:, 0]] - v[implies[:, 1]]) ** 2).sum()

    assert y[:3].sum() <= 1 + 1e-4 and y[3:].sum() <= 1 + 1e-4 and (y >= 0).all()
    for _ in range(3000):  # no feasible neighbour is better
        v = np.clip(y + rng.normal(0, 0.03, n), 0, 1)
        if v[:3].sum() <= 1 and v[3:].sum() <= 1:
            assert cost(v) >= cost(y) - 1e-3
    # a component's values don't depend on what else is solved with it
    two = solve(2 * n, np.tile(pro, 2), np.concatenate([con, con + 1]), (np.concatenate([groups[0], groups[0] + n]), np.concatenate([groups[1], groups[1] + 2])), np.concatenate([implies, implies + n]), np.repeat([0, 1], n), r)
    assert np.allclose(two[:n], y)


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(1, 200), (200, 3), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and got[200] == got[3] == got[1] == 1


def test_spread_rounds_give_the_values_of_one_task(spark):
    rng = random.Random(4)
    rows = [(i % 7, 100 + rng.randrange(9), rng.uniform(0, 8), rng.uniform(1, 8), rng.random() < 0.7, rng.choice([None, 1, 2])) for i in range(40)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    links = spark.createDataFrame(rows, "left long, right long, pro double, con double, coded boolean, like long")
    near = {(r.left, r.right): r.confidence for r in confident(links, Rules(steps=5, tolerance=0.0)).collect()}
    far = {(r.left, r.right): r.confidence for r in confident(links, Rules(steps=5, tolerance=0.0, component=3)).collect()}
    assert near.keys() == far.keys() == {(r[0], r[1]) for r in rows}
    assert all(abs(near[k] - far[k]) < 1e-9 for k in near)


ATTRS = ("year", "place", "family", "kind", "number", "term", "amount", "batch", "day1", "day2", "name")
SCHEMA = "id long, year string, place string, family string, kind string, number int, term int, amount double, batch int, day1 int, day2 int, name string, code string"


def _described(side):
    return {c: F.col(c) for c in ATTRS} | ({"code": F.col("code")} if side else {})


def _linked(spark, left, right):
    lf, rf = spark.createDataFrame(left, SCHEMA).withColumn("mention", F.lit(0)), spark.createDataFrame(right, SCHEMA).withColumn("side", F.lit(0))
    return {(r.left_id, r.right_id): r.confidence for r in link(lf, rf, "id", "id", _described(0), _described(1)).collect()}


B = ("2024", "b", "G")


def test_links(spark):
    left = [(1, *B, "G", 1, 10, 5.5, 3, 100, 101, None, None), (2, *B, "G", 2, 10, 7.25, 3, 100, 101, None, None), (3, *B, "G", 1, 10, 5.5, 3, 100, 101, None, None), (4, "2024", "b", "S", "S", 1, 10, 5.5, 3, 100, 101, None, None), (5, *[None] * 12)]
    right = [(11, *B, "G", 1, 10, 5.5, 3, 100, 102, None, "c1"), (12, *B, None, None, 10, 7.2, 3, 99, None, None, "c2"), (13, *B, "G", 3, 10, 5.5, 3, 100, 101, None, "c3"), (14, *B, "G", 1, *[None] * 7), (15, "2023", "b", "G", "G", 1, 10, 5.5, 3, 100, 101, None, None), (16, *B, "G", *[None] * 7, "c1")]
    got = _linked(spark, left, right)
    assert set(got) == {(1, 11), (3, 11), (2, 12), (1, 14), (3, 14), (1, 16), (3, 16)}
    assert all(0.5 <= c <= 1 for c in got.values())
    lf, rf = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    for a, b in ((lf.limit(0), rf), (lf, rf.limit(0))):
        assert link(a, b, "id", "id", _described(0), _described(1)).collect() == []


def test_rows_of_no_known_block(spark):
    # two places without a year and one result: only the place that it has
    left = [(1, None, "Aldra", "G", "G", 1, 10, 5.5, 3, 100, 101, None, None), (2, None, "Brenholt", "G", "G", 1, 10, 5.5, 3, 100, 101, None, None)]
    right = [(11, "2024", "Brenholt", "G", "G", 1, 10, 5.5, 3, 100, 101, None, "c1")]
    assert set(_linked(spark, left, right)) == {(2, 11)}


def test_similar_names_decide(spark):
    left = [(1, *B, "G", None, 10, 5.5, 3, 100, 101, "harbour rail link", None), (2, *B, "G", None, 10, 5.5, 3, 100, 101, "water treatment works", None)]
    right = [(11, *B, "G", None, 10, 5.5, 3, 100, 101, "harbor rail link", "c1")]
    assert set(_linked(spark, left, right)) == {(1, 11)}


def test_hot_copies_are_one_entity(spark):
    row = (*B, "G", 1, 10, 5.5, 3, 100, 101, None, None)
    lf, rf = (spark.createDataFrame([(i, *row) for i in range(n)], SCHEMA) for n in (300, 40))
    assert link(lf, rf, "id", "id", _described(0), _described(0)).count() == 300 * 40
    assert link_entities(lf, rf, "id", "id", _described(0), _described(0))[0].count() == 1


def test_one_block_of_very_many_descriptions(spark):
    n = 200_000
    x = spark.range(n).select(F.col("id"), F.lit("2024").alias("year"), F.lit("b").alias("place"), F.lit("G").alias("family"), F.lit("G").alias("kind"), F.col("id").cast("int").alias("number"), F.lit(10).alias("term"), (F.col("id") % 997 + 1).cast("double").alias("amount"), F.lit(3).alias("batch"), F.lit(100).alias("day1"), F.lit(101).alias("day2"), F.lit("n").alias("name"), F.col("id").cast("string").alias("code"))
    got = link(x, x.limit(3000), "id", "id", _described(0), _described(1))
    assert got.filter("left_id = right_id").count() == got.count() == 3000


def test_all_values_vote(spark):
    # thirty distinct values, of which the trusted one differs in a token that most share
    rows = [(1, "k", "text", "10 0 x")] + [(i, "k", "ocr", f"10 7 x{'' if i % 3 else ' ' + str(i)}") for i in range(2, 40)] + [(50, "k", "ocr", None), (60, "other", "ocr", "z"), (61, None, "ocr", "z")]
    df = spark.createDataFrame(rows, "id long, key string, m string, v string")
    trust = lambda: [F.when(F.col("m") == "text", 0).otherwise(1)]
    first = survivors(df, "id", F.col("key"), ["v"], trust()).collect()
    assert [(r.group_id, r.value) for r in first] == [(1, "10 0 x")]
    for part in (400, 7):
        voted = survivors(df, "id", F.col("key"), ["v"], trust(), "votes", part=part).collect()
        assert [(r.group_id, r.value) for r in voted] == [(1, "10 7 x")]
    assert survivors(df.limit(0), "id", F.col("key"), ["v"], trust(), "votes").collect() == []


def test_long_values_are_aligned_whole():
    rng = random.Random(1)
    a = [rng.choice("abcdefg") for _ in range(5000)]
    b = a[:]
    b[4800] = "z"
    assert choose(["".join(x) for x in (["y"] + a[1:], [*b])], [1, 1]) in (0, 1)
    assert consensus([a, b, a], [1, 1, 1]) == a


def test_precedence_has_no_idle_vote(spark, tmp_path):
    # p5_found is one aggregate: no row goes through an alignment or a window that can't change the outcome
    rng = random.Random(12)
    code = lambda k: rng.choice([f"{k:09d}", f"{k:09d}.SH", f" {k:09d}", f"{k}", f"{k:09d}.ib"])
    # a hot bond of a thousand rows, nearly all different, many small ones, and some of no group
    codes = [code(7) for _ in range(1000)] + [code(rng.randrange(20, 400)) for _ in range(600)] + [code(1000 + i) for i in range(50)] + [None] * 20
    rng.shuffle(codes)
    day = lambda: rng.choice([None, *[DAY + timedelta(k) for k in range(4)]])
    rows = [(i, c, day(), rng.choice(["text", "ocr", "ocr", None]), rng.choice([None, "—", "", f"甲 {rng.randrange(10**6)}号"]), rng.choice([None, rng.randrange(500) / 100, float("nan")]), float(i), rng.choice([None, "n/a", f"2024-01-{rng.randrange(10, 29)}"]), None) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "result_id long, bond_code string, pub_date date, extraction_method string, bond_short_name string, coupon_rate_pct double, total_amount_yi double, value_date string, payment_freq string")
    df.repartition(4).write.parquet(f"{tmp_path}/state_results.parquet")
    found = QUERIES["p5_found"](spark, str(tmp_path))
    got = sorted(tuple(r) for r in found.collect())
    db = duckdb.connect()
    db.execute(f"create view state_results as select * from read_parquet('{tmp_path}/state_results.parquet/*.parquet')")
    assert got == sorted(db.execute(ORACLES["p5_found"]).fetchall()) and len(got) > 400
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("MapInPandas", "Window", "Join", "collect_list"))
    # the vote stays where it has something to decide
    voted = {(r.group_id, r.field): r.result_id for r in QUERIES["p5_consensus"](spark, str(tmp_path)).collect()}
    assert voted.keys() == {r[:2] for r in got} and any(voted[r[:2]] != r[2] for r in got)
