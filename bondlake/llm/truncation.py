"""Text cut off by field limits: hashed logistic regression on how values close.

Positives are made: intact values are cut, twice anywhere and once at each length limit of
their source that they exceed, partly with what a cut may leave behind (an ellipsis, half a
character). Negatives are the values as they are, of which those that sit at a limit of
their source are left out; after a first fit those that the model itself takes for cut leave
the training set and it is fitted again. Features are the closing characters, the shape of
the last line, its open brackets, and how far the length is a limit of the source (the share
of its values with just this length in characters, in UTF-8 bytes or in double-byte units),
counted over all values; positives and negatives have the shares of their own lengths.

What a value closes with is computed in the JVM from the whole text, once, and kept; only
that travels to Python. The fit sees at most ``sample`` values (a documented bound); scoring
sees every value.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bondlake.llm.sampling import smallest_hashes
from bondlake.operators.cut import cut

TAIL = 160  #: closing characters of which words, shapes and signs are features; what is counted is counted in the whole text
DIM = 1 << 18
WIDTH = 40  #: feature slots of a value
LEFTOVERS = ("", "", "", "", "…", "……", "...", "�", "..", "。。。", "―", "—", "[...]", "（…）")
_LEFT = re.compile(r"[\s�…⋯]*(?:\.{2,}|。{2,}|[…⋯�]+|\[(?:\.\.\.|…)\]|[(（](?:\.\.\.|…+)[)）])[\s�…⋯.]*$")
_CLASS = str.maketrans({c: k for k, cs in {"0": "0123456789０１２３４５６７８９", "n": "一二三四五六七八九十百〇"}.items() for c in cs})


@dataclass(frozen=True)
class Fit:
    sample: int = 8_000  #: most values that the model is fitted on
    epochs: int = 6
    seed: int = 7
    threshold: float = 0.5
    peak: float = 0.02  #: a length is a limit of its source if at least this share and ``peak_rows`` values have it
    peak_rows: int = 5
    broadcast_sources: int = 20_000  #: a table of limits of at most so many sources is sent to every task


def _shape(s: str) -> str:
    """Digits, Latin letters and Han characters reduced to runs of one sign each."""
    s = re.sub(r"[0-9０-９][0-9０-９.,，]*", "0", s)
    s = re.sub(r"[A-Za-z]+", "a", s)
    return re.sub(r"[㐀-鿿]+", "汉", s)


OPEN, CLOSE = "（(〔[《", "）)〕]》"


def closing(t: Column) -> Column:
    """What a text closes with: its last characters, and of its last line the opening, the length and the open brackets; whether it has other lines and how the one before ends."""
    body = F.rtrim(F.regexp_replace(t, r"\s+\z", ""))
    line = F.trim(F.substring_index(body, "\n", -1))
    count = lambda signs: F.length(line) - F.length(F.translate(line, signs, ""))
    more = F.contains(body, F.lit("\n"))
    before = F.when(more, F.right(F.regexp_replace(F.left(body, F.length(body) - F.length(F.substring_index(body, "\n", -1))), r"\s+\z", ""), F.lit(1)))
    return F.struct(F.right(line, F.lit(TAIL)).alias("tail"), F.left(line, F.lit(16)).alias("head"), F.length(line).alias("size"), (count(OPEN) - count(CLOSE)).alias("open"), more.alias("more"), F.coalesce(before, F.lit("")).alias("before"))


def names(tail: str, at_limit: float, head: str = "", size: int = 0, open_: int = 0, whole: bool = False, before: str = "") -> list[str]:
    """Feature names of one value: what it closes with and how far its length is a limit."""
    t = tail.rstrip()
    mark = _LEFT.search(t)
    share = min(3, int(at_limit * 20))
    out = ["bias", f"L{share}"]
    if mark and mark.group().strip():
        out.append("left")
        size -= len(t) - mark.start()
        t = t[: mark.start()]
    line = t.strip()
    head = head if size > len(line) else line[:16]
    norm = line.translate(_CLASS)
    plain = re.sub("0[0.,]*", "0", norm)
    last = plain[-1:] or "^"
    shape = _shape(line)
    kind = "han" if re.search("[㐀-鿿]", line) else "lat"
    long = min(9, max(size, len(line)) // 5)
    ends = "stop" if last in "。！？!?；" else "dot" if last == "." else "other"
    start = re.sub("0[0.,]*", "0", head.translate(_CLASS))
    out += [f"1{last}", f"2{plain[-2:]}", f"3{plain[-3:]}", f"4{plain[-4:]}", f"5{plain[-6:]}"]
    out += [f"e{ends}", f"ek{ends}{kind}{whole}", f"es{ends}{long}{whole}", f"ls{last}{long}{whole}", f"h{shape[-8:]}", f"hw{shape if len(shape) < 14 and size <= TAIL else 'long'}{whole}"]
    out += [f"b{start[:2]}{ends}{long}", f"b4{start[:4]}{ends}", f"w{start.split(' ')[0][:12]}{ends}", f"v{plain.split(' ')[-1][-14:]}", f"l{plain if len(plain) < 24 else ''}"]
    out += [f"o{open_}", f"ends{ends}{share}"]
    out += [f"d{bool(re.search('[0-9]$', line))}{bool(re.search('[0-9][.]$', line))}{bool(re.search(' ', line))}{kind}", f"c{'，' in line}{'。' in line}{ends}{kind}"]
    words = line.split(" ")
    out += [f"n{min(4, len(words))}{words[-1][-1:].isdigit()}{whole}{kind}", f"m{bool(mark)}{ends}"]
    out.append(f"p{before.translate(_CLASS) if whole else '-'}{ends}{long}")
    return out


Closing = tuple  #: (tail, share of the length, head, size, open, more, before)


def encode(rows: list[Closing]) -> np.ndarray:
    x = np.full((len(rows), WIDTH), DIM, dtype=np.int64)
    for i, row in enumerate(rows):
        f = names(*row)[:WIDTH]
        x[i, : len(f)] = [zlib.crc32(n.encode("utf-8", "replace")) & (DIM - 1) for n in f]
    return x


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[x].sum(1), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Logistic regression by AdaGrad over small batches; slot DIM is the empty one."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros(DIM + 1), np.full(DIM + 1, 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), 64):
            i = order[k : k + 64]
            err = predict(w, x[i]) - y[i]
            flat = x[i].ravel()
            step = np.repeat(err, WIDTH)
            at, inv = np.unique(flat, return_inverse=True)
            g = np.bincount(inv, step) / 8 + 1e-5 * w[at]
            g2[at] += g * g
            w[at] -= 0.3 * g / np.sqrt(g2[at])
            w[DIM] = 0.0
    return w


def train(intact: list[Closing], made: list[Closing], conf: Fit) -> np.ndarray:
    """Weights from values as they are and artificially cut ones."""
    rng = random.Random(conf.seed)
    pos = []
    for tail, *rest in made:
        left = rng.choice(LEFTOVERS)
        rest[2] += len(left)
        pos.append((tail + left, *rest))
    neg = intact
    x = encode(neg + pos)
    y = np.array([0.0] * len(neg) + [1.0] * len(pos))
    # values that are cut already count as negatives so far: what a model fitted on the
    # other folds takes for cut leaves the training set
    fold = np.random.default_rng(conf.seed).integers(0, 3, len(x))
    keep = np.ones(len(x), bool)
    for _ in range(2):
        doubt = np.zeros(len(x))
        for k in range(3):
            on = keep & (fold != k)
            if on.any():
                doubt[fold == k] = predict(fit(x[on], y[on], conf.epochs // 2, conf.seed), x[fold == k])
        keep = (y == 1) | (doubt < 0.5)
    return fit(x[keep], y[keep], conf.epochs, conf.seed)


def cut_scores(df: DataFrame, id_col: str, text_col: str = "text", source_col: str = "source", conf: Fit = Fit()) -> DataFrame:
    """(row_id, source, score, cut) of every value with a text.

    Null and blank texts give no row; a null source is a source of its own. Repeated rows
    are scored each. An empty table gives no rows. Texts of any length are handled by
    their closing characters and their whole length.
    """
    spark = df.sparkSession
    t = F.col(text_col)
    there = df.filter(t.isNotNull() & (F.length(F.trim(t)) > 0))
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    # the texts are read once for all that follows but the sample
    base = cut(there.select(F.col(id_col).alias("row_id"), source.alias("source"), *_lengths(t), closing(t).alias("c")))
    lens = base.select("source", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.floor(F.col(k) / unit).alias("len")) for k, unit in KINDS.items()])).alias("x")).groupBy("source", "x.kind", "x.len").agg(F.count(F.lit(1)).alias("n"))
    total = base.groupBy("source").agg(F.count(F.lit(1)).alias("of"))
    peaks = lens.join(total, "source").filter((F.col("n") >= conf.peak_rows) & (F.col("n") >= conf.peak * F.col("of")))
    # at most 1 / peak lengths of each kind can be limits of a source
    limits = peaks.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit(":"), F.col("len").cast("string")), F.col("n") / F.col("of")))).alias("limits"),
        F.collect_list(F.when(F.col("kind") != "dbcs", F.struct("kind", "len"))).alias("places"),
    )
    n_all = total.agg(F.sum("of")).first()[0] or 0
    limits = cut(limits)
    # a row per source: sent to every task where that is few, joined with its skew split elsewhere
    limits = F.broadcast(limits) if limits.count() <= conf.broadcast_sources else limits
    share = lambda c="": F.greatest(*[F.coalesce(F.try_element_at("limits", F.concat(F.lit(f"{k}:"), F.floor(F.col(c + k) / unit).cast("string"))), F.lit(0.0)) for k, unit in KINDS.items()])
    scored = base.join(limits, "source", "left").withColumn("at_limit", share())
    models = _fitted(there.select(source.alias("source"), t.alias("t")), limits, share, n_all, conf)
    if models is None:
        return scored.select("row_id", "source", F.lit(0.0).alias("score"), F.lit(False).alias("cut"))
    w = spark.sparkContext.broadcast(models.astype(np.float32))
    parts = ["tail", "at_limit", "head", "size", "open", "more", "before"]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = predict(w.value, encode(list(b[parts].itertuples(index=False, name=None))))
            yield pd.DataFrame({"row_id": b["row_id"], "source": b["source"], "score": p.astype(float), "cut": p > conf.threshold})

    kind = dict(df.dtypes)[id_col]
    return scored.select("row_id", "source", "at_limit", "c.*").mapInPandas(score, f"row_id {kind}, source string, score double, cut boolean")


KINDS = {"chars": 1, "bytes": 4, "dbcs": 4}  #: kinds of length, and how many of them are told apart as one


def _lengths(t: Column) -> list[Column]:
    """Characters, UTF-8 bytes and double-byte units (bytes = ascii + 3 * wide nearly always)."""
    chars, size = F.length(t), F.octet_length(t)
    return [chars.alias("chars"), size.alias("bytes"), (chars + (size - chars) / 2).cast("int").alias("dbcs")]


def _fitted(texts: DataFrame, limits: DataFrame, share, n_all: int, conf: Fit) -> np.ndarray | None:
    """Weights from a bounded sample of values whose length is no limit of their source, and of their cuts."""
    x = texts.select("source", "t", F.xxhash64("t").alias("h"), *_lengths(F.col("t"))).join(limits, "source", "left")
    x = x.withColumn("own", share()).filter(F.col("own") < conf.peak)
    t, n = F.col("t"), F.col("chars")
    anywhere = [F.left(t, (F.lit(12) + F.pmod(F.xxhash64("h", F.lit(conf.seed + k)), F.greatest(n - 12, F.lit(1)))).cast("int")) for k in (1, 2)]
    at_limit = F.transform(
        F.filter(F.coalesce("places", F.array()), lambda p: F.when(p["kind"] == "chars", p["len"] < F.col("chars")).otherwise(p["len"] * 4 < F.col("bytes"))),
        lambda p: F.when(p["kind"] == "chars", F.left(t, p["len"].cast("int"))).otherwise(F.regexp_replace(F.make_valid_utf8(F.substring(F.encode(t, "UTF-8"), F.lit(1), (p["len"] * 4).cast("int")).cast("string")), "\ufffd+\\z", "")),
    )
    heads = F.when(n >= 30, F.concat(F.array(*anywhere), at_limit)).otherwise(F.array().cast("array<string>"))

    def made(head: Column) -> Column:
        c, m, b = F.length(head), F.octet_length(head), F.substring(t, F.length(head) + 1, F.lit(1))
        own = F.greatest(*[F.coalesce(F.try_element_at("limits", F.concat(F.lit(f"{k}:"), F.floor(v / u).cast("string"))), F.lit(0.0)) for (k, u), v in zip(KINDS.items(), (c, m, c + (m - c) / 2), strict=True)])
        return F.struct(own.alias("share"), b.alias("next"), F.right(head, F.lit(1)).alias("last"), closing(head).alias("c"))

    x = x.select("h", "own", closing(t).alias("c"), F.transform(heads, made).alias("made"))
    picked = smallest_hashes(x, "h", conf.sample, conf.seed, n_all)
    if not picked:
        return None
    row = lambda c, share_: (c.tail, share_, c.head, c.size, c.open, c.more, c.before)
    # a cut behind a whole sentence or line leaves nothing to see
    whole = lambda m: (m.c.tail[-1:] or "\n") in "。！？!?" or m.last == "\n" or m.next in ("\n", "") or m.last == "." and m.next in " \n"
    return train([row(r.c, r.own) for r in picked], [row(m.c, m.share) for r in picked for m in r.made if not whole(m)], conf)


def cut_share(scores: DataFrame) -> DataFrame:
    """(source, values, cut_values, share): how often each source cuts its values."""
    n, k = F.count(F.lit(1)), F.count_if("cut")
    return scores.groupBy("source").agg(n.alias("values"), k.alias("cut_values"), F.round(k / n, 6).alias("share"))
