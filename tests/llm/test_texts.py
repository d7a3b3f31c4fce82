"""Look-alikes, leaks, truncation, packing and page noise: brute force, invariants, held-out accuracy, awkward input."""

from __future__ import annotations

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from bondlake.llm import pagenoise as N
from bondlake.llm.leaks import Search, leaked
from bondlake.llm.lookalike import consistent, fold, form, is_clean, repair_columns
from bondlake.llm.packing import Packing, Windows, pack
from bondlake.llm.truncation import Fit, cut_scores, cut_share

# ---------------------------------------------------------------- look-alikes


@pytest.mark.parametrize(
    "raw,want",
    [("２０１９年 甲省", "2019年甲省"), ("Sélène  Park", "Sélène Park"), (" 珂​南省　", "珂南省"), ("⼀期（三）", "一期（三）"), ("", ""), ("Ω站", "Ω站"), ("A\tB", "A B"), ("省", "省")],
)
def test_form(raw, want):
    assert form(raw) == want
    assert form(want) == want


def test_repair_needs_the_vocabulary(spark):
    values = ["BOT水厂（一期）", "再融资一般债券", "ВОT水厂（ー期）", "再融资ー般债券", "Москва站", "Мoсква路", "сор", "ВОТ", "Ζzyx站", "Δ测控站", None, "", "BOT水厂（一期）"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, name string").withColumn("value", F.lit("clash")).withColumn("fixed", F.lit(1))
    got = {r.value: r.fixed for r in repair_columns((df, "id", ["name"])).collect()}
    assert got == {"ВОT水厂（ー期）": "BOT水厂（一期）", "再融资ー般债券": "再融资一般债券", "Мoсква路": "Москва路"}
    assert repair_columns((df.limit(0), "id", ["name"])).collect() == []
    long = spark.createDataFrame([("甲" * 50_000 + "​",)], "value string")
    assert consistent(long).first().fixed == "甲" * 50_000


def test_clean_test_agrees_with_form(spark):
    rng = random.Random(2)
    alphabet = "甲乙2019Aé（） -· ​１⼀省é"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    x = spark.createDataFrame([(v,) for v in values], "value string").select("value", is_clean(F.col("value")).alias("clean"), fold(F.col("value")).alias("key"))
    for r in x.collect():
        if r.clean:
            assert form(r.value) == r.value
        assert not any(unicodedata.category(c) in ("Cf", "Zs") for c in r.key)


# ---------------------------------------------------------------- leaks

WORDS = "资金 项目 收入 支出 归集 调整 交付 管线 年度 预算 复核 监理 进度 债券 期限 利率 审计 公示 投向 台账 审核 小组 评估 机构 拨付 缺口 压降 存量 余额 风险".split()


def sentence(rng):
    return "".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(10)) + "。"


def test_leaks_equal_what_was_planted(spark):
    rng = random.Random(4)
    standing = "本期债券到期一次偿还本金利息按约定频率支付遇节假日顺延且不另计息。"
    items = [(i, "".join(sentence(rng) for _ in range(4)) + (standing if i % 3 == 0 else "")) for i in range(12)]
    docs, want = [], set()
    for d in range(300):
        body = [sentence(rng) for _ in range(6)] + ([standing] if d % 4 == 0 else [])
        if d % 10 == 1:
            i = rng.randrange(12)
            text = items[i][1]
            n = len(text)
            part = text if d % 20 == 1 else text[: n * 6 // 10]
            if d % 30 == 1:  # a word replaced here and there, other widths and spacing
                part = part.replace("资金", "经费", 1).replace("1", "１").replace("，", " \n")
            body.insert(3, " ".join(part) if d % 40 == 1 else part)
            want.add((i, d))
        elif d % 10 == 2:
            body.insert(2, items[d % 12][1][:28])  # too little
        docs.append((d, "".join(body)))
    df = spark.createDataFrame([*docs, (900, None), (901, ""), (902, "\x00" * 5 + docs[1][1])], "doc_id long, text string").withColumn("id", F.lit(0)).withColumn("t", F.lit("clash"))
    want |= {(i, 902) for i, d in want if d == 1}
    it = spark.createDataFrame([*items, (50, None), (51, "短")], "item_id long, text string")
    got = {(r.item_id, r.doc_id) for r in leaked(df, it, "doc_id", "item_id").collect()}
    assert got == want
    blocks = {(r.item_id, r.doc_id) for r in leaked(df, it, "doc_id", "item_id", conf=Search(block_chars=500)).collect()}
    assert blocks == want  # item blocks change nothing
    assert leaked(df.limit(0), it, "doc_id", "item_id").collect() == []
    assert leaked(df, it.limit(0), "doc_id", "item_id").collect() == []


def test_short_items_and_copies(spark):
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima".split()
    rng = random.Random(8)
    noise = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(40)]
    items = [(1, "quixotryzm"), (2, "zyqx"), (3, "Vexing jumbly frockz."), (4, ""), (5, None)]
    docs = [(i, t) for i, t in enumerate(noise)] + [(100 + i, noise[0] + " quixo-tryzm") for i in range(60)] + [(300, "golf ZYQX hotel"), (301, "alpha jum bly froc echo"), (302, None), (303, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("item_id", F.lit(2))
    got = {(r.item_id, r.doc_id) for r in leaked(df, spark.createDataFrame(items, "item_id long, text string"), "doc_id", "item_id").collect()}
    assert got == {(1, 100 + i) for i in range(60)} | {(2, 300), (3, 301)}
    assert leaked(df.limit(0), spark.createDataFrame(items, "item_id long, text string"), "doc_id", "item_id").collect() == []


def test_search_finds_every_occurrence():
    from bondlake.llm.leaks import WuManber, codes

    rng = random.Random(8)
    text = "".join(rng.choice("abc") for _ in range(4000))
    strings = list({text[p : p + 12] for p in (3, 500, 501, 777, 3988)} | {"".join(rng.choice("abc") for _ in range(12)) for _ in range(40)})
    place, number = WuManber(strings, 12, 64).find(codes(text))
    want = {(p, k) for k, s in enumerate(strings) for p in range(len(text)) if text.startswith(s, p)}
    assert set(zip(place.tolist(), number.tolist(), strict=True)) == want


# ---------------------------------------------------------------- truncation


def test_truncation_on_held_out_cuts(spark):
    rng = random.Random(6)
    rows, cut = [], set()
    for i in range(2500):
        text = "关于项目的通报\n" + "".join(sentence(rng) for _ in range(rng.randrange(3, 9)))
        tail = rng.choice(["", "", "\n特此公告", "\n（完）", "\n甲市审计局\n2024年5月1日", "\n附件：明细表"])
        source = rng.choice(["a", "a", "b", "limit"])
        if source == "limit" and len(text) > 300:
            text, tail = text[:300], ""
            if text[-1] != "。":
                cut.add(i)
        elif i % 9 == 0:
            text, tail = text[: rng.randrange(60, len(text) - 3)].rstrip("。"), rng.choice(["", "…", "..."])
            cut.add(i)
        rows.append((i, text + tail, source))
    df = spark.createDataFrame([*rows, (9000, None, "a"), (9001, "  ", "a"), (9002, "无来源。", None)], "doc_id long, text string, source string").withColumn("score", F.lit(1)).withColumn("tail", F.lit("x"))
    scores = cut_scores(df, "doc_id").cache()
    got = {r.row_id for r in scores.filter("cut").collect()}
    hit = len(got & cut)
    assert hit / len(got) > 0.93 and hit / len(cut) > 0.93
    assert {r.row_id for r in scores.collect()} == {r[0] for r in rows} | {9002}
    assert {r.source for r in cut_share(scores).collect()} == {"a", "b", "limit", ""}
    assert cut_scores(df.limit(0), "doc_id", conf=Fit(sample=10)).collect() == []


# ---------------------------------------------------------------- packing


def test_windows_are_best_fit_and_bounded():
    w = Windows(2)
    assert w.place(6, 10) == (0, None) and w.place(5, 10) == (1, None)
    assert w.place(4, 10) == (0, None)  # leaves no room
    assert w.place(7, 10) == (2, 0)  # the fullest is emitted
    assert len(w.room) == 2


def test_containers(spark):
    pytest.importorskip("tiktoken")
    import os

    if not os.path.exists(Packing().vocabulary):
        pytest.skip("no vocabulary file")
    rng = random.Random(3)
    docs = [(i, " ".join(["word"] * rng.choice([3, 10, 25, 40, 150])), "hot" if rng.random() < 0.8 else "b") for i in range(800)] + [(5, "again", "hot"), (900, None, "hot"), (901, "", "hot"), (902, "x", "unknown"), (903, "y", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("container", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    caps = spark.createDataFrame([("hot", 64), ("hot", 100), ("b", 50), ("none", None)], "source string, capacity_tokens int")
    out = pack(df, caps, "doc_id", conf=Packing(windows=4, group_rows=90)).toPandas()
    assert set(out.row_id) == {d[0] for d in docs if d[1] is not None}
    room = {"hot": 64, "b": 50}
    packed = out[out.container.notna()]
    assert set(out[out.container.isna()].row_id) == {901, 902, 903}
    for _, g in packed.groupby("container"):
        assert g.source.nunique() == 1 and g.tokens.sum() <= room[g.source.iloc[0]]
    for (i, s), g in packed[packed.row_id != 5].groupby(["row_id", "source"]):
        n = g.tokens.sum()
        assert len(g) == -(-n // room[s]) and sorted(g.from_token) == [k * room[s] for k in range(len(g))]
    fill = packed.tokens.sum() / packed.groupby("container").source.first().map(room).sum()
    assert fill > 0.85
    assert pack(df.limit(0), caps, "doc_id").collect() == []
    assert pack(df, caps.limit(0), "doc_id").filter("container is not null").collect() == []


# ---------------------------------------------------------------- page noise

HAN = "相关凭证存放于档案室不足部分列入滚动计划资金缺口由财政局统筹解决项目完成投资占概算的比例对应建设周期为若干个月本期募集资金余额利率期限债券元亿元万元运营补贴政府收入支出"


def page(rng, scanned, k):
    phrases = [HAN[p : p + 12] for p in range(0, len(HAN) - 12, 3)]
    pars = ["".join(rng.choice(phrases) + rng.choice(["，", "23", "5.6", "，"]) for _ in range(20)) + "。" for _ in range(6)]
    if not scanned:
        return "\n".join(pars), set(), set(), 1
    body = [x for p in pars for x in [p[i : i + 32] for i in range(0, len(p), 32)]]
    lines, furn, bad, no = [], set(), set(), 0
    for i, x in enumerate(body):
        if i % 18 == 0:
            no += 1
            furn.add(len(lines) + 1)
            lines.append(f"第{k}市财政局披露材料")
        if rng.random() < 0.06:
            j = [j for j, ch in enumerate(x) if ch in "元营率府政债券"]
            if j:
                at = rng.choice(j)
                x = x[:at] + {"元": "兀", "营": "菅", "率": "卒", "府": "俯", "政": "攻", "债": "侦", "券": "拳"}[x[at]] + x[at + 1 :]
                bad.add(len(lines) + 1)
        lines.append(x)
        if i % 18 == 17:
            furn.add(len(lines) + 1)
            lines.append(f"— {no} —")
    return "\n".join(lines), furn, bad, no


def test_page_noise_on_planted_cases(spark):
    rng = random.Random(12)
    docs = [(i, *page(rng, i % 2 == 1, i)) for i in range(160)]
    rows = [(i, t, n) for i, t, _, _, n in docs] + [(900, None, 1), (901, "", None), (902, "独行", None)]
    df = spark.createDataFrame(rows, "pdf_id long, text string, n_pages int").withColumn("kind", F.lit("clash")).withColumn("t", F.lit(1))
    out = N.find_noise(df, "pdf_id", conf=N.Fit(sample=120, chars=120_000, epochs=5)).collect()
    for kind, k, least in (("furniture", 2, 0.95), ("misread", 3, 0.8)):
        got = {(r.row_id, r.line_no) for r in out if r.kind == kind}
        want = {(d[0], x) for d in docs for x in d[k]}
        assert len(got & want) / max(1, len(got)) > least and len(got & want) / len(want) > least, kind
    text = {r.row_id: r.text for r in N.repair_text(df, "pdf_id", conf=N.Fit(sample=120, chars=120_000, epochs=5)).collect()}
    assert not any("披露材料" in t or "—" in t for i, t in text.items() if i < 900 and i % 2 == 1)
    assert set(text) == {r[0] for r in rows if r[1]}
    assert N.find_noise(df.limit(0), "pdf_id").collect() == []


def test_hyphens():
    lines = ["the under-", "writing of debt-", "service cover"]
    table = __import__("numpy").zeros(N.SLOTS, "float32")
    for w in ("underwriting", "debt", "service"):
        table[N.OFFSET["word"] + (N._word_code(w) & (N.WORD - 1))] = 16
    a, b = N.join_features(lines[0], lines[1], table), N.join_features(lines[1], lines[2], table)
    assert "w6" in a and "w0" in b
    assert N.ends_broken(lines[0]) and not N.ends_broken("2019-") and not N.ends_broken("word")
    assert N.rebuilt(lines, [False] * 3, [0], [], N.Models(table, N.Linear(), None, 0.0)) == "the underwriting of debt-service cover"


def test_insert_puts_the_missing_character_back():
    import numpy as np

    rng = random.Random(5)
    phrases = [HAN[p : p + 12] for p in range(0, len(HAN) - 12, 3)]
    lines = ["，".join(rng.choice(phrases) for _ in range(4)) + "。" for _ in range(400)] + ["the treasury bureau of the district reserved money for the treasury"] * 40
    counts = np.zeros(N.SLOTS, np.int64)
    N.count_table(lines, counts)
    table = np.log2(1 + counts * (1e7 / counts[: N.UNI].sum())).astype(np.float32)
    for line, at in ((lines[0], 5), (lines[1], 20), (lines[-1], 8), (lines[-1], 21)):
        gap = line[: at + 1] + line[at + 2 :]
        assert N.corrected(gap, [(N.INSERT, at)], table, {}) == line
        assert N.corrected(line, [(N.INSERT, at)], table, {}) == line  # nothing is missing
    assert N.missing("项目甲", 2, table) == ""  # at a line end nothing tells which


def test_inserts_and_joins_on_planted_cases(spark):
    rng = random.Random(21)
    phrases = [HAN[p : p + 12] for p in range(0, len(HAN) - 12, 3)]
    docs, whole, joins = [], {}, 0
    for i in range(160):
        sizes = (rng.randrange(11, 14), rng.randrange(11, 14), rng.randrange(11, 14))
        pars = ["，".join(rng.choice(phrases) for _ in range(n))[: 32 * (n // 3) - 1] + "。" for n in sizes]  # the last line of each is a full one
        whole[i] = "\n".join(pars)
        lines = [p[k : k + 32] for p in pars for k in range(0, len(p), 32)]
        if i % 2:
            for j, x in enumerate(lines):
                at = [k for k in range(4, len(x) - 4) if "，" not in x[k - 3 : k + 4]]
                if at and rng.random() < 0.2:
                    k = rng.choice(at)
                    lines[j] = x[:k] + x[k + 1 :]
        docs.append((i, "\n".join(lines) if i % 2 else whole[i], 1))
    df = spark.createDataFrame(docs, "pdf_id long, text string, n_pages int")
    text = {r.row_id: r.text for r in N.repair_text(df, "pdf_id", conf=N.Fit(sample=120, chars=120_000, epochs=5)).collect()}
    ends = lambda t: sum(p.endswith("。") for p in t.split("\n"))
    assert sum(ends(text[i]) == 3 for i in whole) > 0.9 * len(whole)
    gone = sum(len(whole[i]) - len(t.replace("\n", "")) + 2 for i, t in ((i, docs[i][1]) for i in whole if i % 2))
    left = sum(max(0, len(whole[i].replace("\n", "")) - len(text[i].replace("\n", ""))) for i in whole if i % 2)
    assert gone > 100 and left < 0.5 * gone


def test_page_grid_of_long_scans_and_long_headers():
    body = lambda p, j: f"{HAN[(7 * p + 11 * j) % 60 :][:14]}{chr(0x4E00 + p)}{chr(0x5E00 + j)}{HAN[(5 * p + j) % 50 :][:9]}"
    header = "某市财政局关于政府债券信息披露材料的说明" * 4
    for head in ("某市财政局披露材料", header):
        lines = [x for p in range(450) for x in [head, *(body(p, j) for j in range(10)), f"— {p + 1} —"]]
        g = N.page_grid(lines, 450)
        assert g.period == 12
        assert all(g.sure[i] == 1 for i in range(0, len(lines), 12)) and all(g.sure[i] == 1 for i in range(11, len(lines), 12))
        assert not any(g.sure[i] == 1 for i in range(len(lines)) if i % 12 not in (0, 11))
        none = N.Models(None, N.Linear(), None, 0.0)
        assert N.read_page("\n".join(lines), 450, none)[1] == [i % 12 in (0, 11) for i in range(len(lines))]
