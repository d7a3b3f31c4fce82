"""Control charts against a plain reading of the rules, chunk borders, and awkward input."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from bondlake.operators.spikes import Chart, Field, flag_spikes

SCHEMA = "id long, src string, url string, gap int, amount double"


def fields():
    return [Field("gap", F.col("gap") < 0, "url"), Field("amount", F.col("amount") <= 0)]


def rows(n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        src = "hot" if rng.random() < 0.6 else rng.choice("abc")
        base = {"hot": 10, "a": 40, "b": 5, "c": 20}[src]
        out.append([i + 1, src, f"u{i // 2}", rng.randint(base, int(base * 2.2)), round(rng.uniform(base, base * 4), 4)])
    return out


def brute(data, ratio=3.0):
    """Cases by the definition, with the ordinary range taken from a wide fixed band around the median."""
    found = set()
    for k, name in ((3, "gap"), (4, "amount")):
        for src in {r[1] for r in data}:
            mine = [r for r in data if r[1] == src and r[k] is not None]
            runs, at = [], 0
            for i in range(1, len(mine) + 1):
                if i == len(mine) or mine[i][k] != mine[at][k]:
                    runs.append(mine[at:i])
                    at = i
            stuck = {r[0] for run in runs if (len({r[2] for r in run}) >= 10 if name == "gap" else len(run) >= 10) for r in run}
            ok = sorted(r[k] for r in mine if r[k] > 0)
            mid = ok[len(ok) // 2]
            calm = [r[k] for r in mine if r[0] not in stuck and mid / 4.5 < r[k] < mid * 4.5]
            lo, hi = min(calm), max(calm)
            found |= {(r[0], name) for r in mine if r[k] <= 0 and (name == "amount" or r[k] < 0) or r[k] > ratio * hi or r[k] * ratio < lo or r[0] in stuck}
    return found


def planted():
    data = rows()
    for i, (k, v) in {20: (3, 9999), 77: (4, -3.0), 130: (4, 99999.0), 201: (3, -50), 333: (4, 0.001)}.items():
        data[i][k] = v
    hot = [r for r in data if r[1] == "hot"]
    for r in hot[60:75]:
        r[4] = 17.25  # over a chunk border
    for r in hot[100:140]:
        r[3] = 14
    return data


def test_brute_force_and_chunks(spark):
    data = planted()
    df = spark.createDataFrame([tuple(r) for r in data], SCHEMA)
    want = brute(data)
    for chunk in (120, 100_000):
        got = {(r.row_id, r.field) for r in flag_spikes(df, "id", "src", fields(), Chart(chunk=chunk)).collect()}
        assert got == want


def test_awkward_input(spark):
    data = [(1, None, None, None, None), (2, None, "u", 3, float("nan")), (3, "one", "u", 7, 1.0), (4, "dup", "u", 5, 2.0), (5, "dup", "u", 5, 2.0)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("source", F.lit("clash")).withColumn("v", F.lit(1))
    assert flag_spikes(df, "id", "src", fields()).collect() == []
    assert flag_spikes(df.limit(0), "id", "src", fields()).collect() == []
