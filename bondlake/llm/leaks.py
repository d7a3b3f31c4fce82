"""Evaluation texts leaking into training text: Wu-Manber search for many test strings.

Items and documents are compared without spacing, punctuation, letter case and character
width. Every item is cut into test strings of ``m`` characters at a fixed stride, so any
passage of a third of an item holds several of them, even where single words were
replaced. The search is Wu-Manber's: a window of ``m`` characters ends in a block; the
shift table says how far the window can move as no test string has the block nearer to
its end; where the shift is 0, the hash of the suffix selects a bucket of test strings,
and direct comparison confirms one. Many windows move in step (numpy), one per stretch
of the text, each stretch overlapping the next by ``m - 1``.

Pass 1 counts, over all distinct texts, how often each sentence of an item occurs, and how
often it does so without the text around it: that tells standing sentences, which are no
item text. Likewise it counts test strings found alone. Counts are added up in Spark, and
only the sentences that stand are sent on; a passage that leaked into ever so many documents
doesn't count as standing, as it is found beside its neighbours, and a sentence that has no
neighbours, or is itself a third of the item, is never taken for one. Pass 2 searches for the
test strings of the other sentences and grows occurrences along the item by direct
comparison, over replaced words, to the passage they belong to. An occurrence is grown if
its test string is rare by itself, or if several of the item lie along one diagonal.

Items of fewer than three test strings are searched for by shorter strings at every place.

Items are a stated query set: they are read one block of ``block_chars`` characters after
the other, one search per block, so what is held and sent is bounded whatever their number.
The search tables of a block are built once and sent to the tasks.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bondlake.operators.cut import cut


@dataclass(frozen=True)
class Search:
    m: int = 12  #: characters of a test string
    stride: int = 8
    share: float = 1 / 3  #: least part of the item's own text in one passage
    standing_docs: int = 3  #: a standing sentence stands without its neighbours in at least so many documents,
    standing_share: float = 0.001  #: and in this share of all distinct texts,
    standing_alone: float = 0.5  #: and in this share of the documents that have it
    phrase_share: float = 0.0005  #: test strings found alone in more than this share of all texts (and more than 3) are searched for in company only
    block_chars: int = 8_000_000
    lane: int = 256  #: characters a window covers
    batch_chars: int = 3_000_000  #: characters searched at a time
    band: int = 48  #: occurrences of one passage lie within so many characters of one diagonal
    intact: float = 0.4  #: part of the least passage's test strings that are company enough
    short: int = 36  #: items of fewer compared characters are searched for by shorter strings


@lru_cache
def _plain() -> np.ndarray:
    """For each BMP character its compared form, 0 where it isn't compared (spacing, punctuation, marks)."""
    table = np.zeros(0x10000, np.uint32)
    for o in range(0x10000):
        if 0xD800 <= o < 0xE000:
            continue
        n = unicodedata.normalize("NFKC", chr(o)).lower()
        n = "".join(c for c in unicodedata.normalize("NFD", n) if c.isalnum()) if len(n) > 1 or o < 0x2E80 else n
        if len(n) >= 1 and n[0].isalnum():
            table[o] = ord(n[0])
    return table


def plain(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compared characters of a UTF-32 array, and the place of each in it."""
    t = _plain()
    out = np.where(codes < 0x10000, t[np.minimum(codes, 0xFFFF)], codes)
    at = np.flatnonzero(out)
    return out[at], at


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


BLOCK = 3
BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack(c: np.ndarray) -> np.ndarray:
    """The block of three characters that begins at each place, as one number (characters have 21 bits)."""
    c = c.astype(np.uint64)
    return (c[..., :-2] << np.uint64(42)) | (c[..., 1:-1] << np.uint64(21)) | c[..., 2:]


def _slot(block: np.ndarray) -> np.ndarray:
    return ((block * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def _mixed(blocks: list[np.ndarray]) -> np.ndarray:
    h = blocks[0] * _MIX
    for b in blocks[1:]:
        h = ((h ^ (h >> np.uint64(31))) + b) * _MIX
    return h


class WuManber:
    """Search for test strings of one length, a multiple of three; ``find`` gives (place, number) of each occurrence."""

    def __init__(self, strings: list[str], m: int, lane: int):
        if m % BLOCK:
            raise ValueError("the length of test strings is a multiple of the block")
        self.m, self.lane = m, lane
        text = np.array([codes(s) for s in strings], np.uint32).reshape(-1, m)
        packs = _pack(text)
        # how far the window can move when it ends in a block
        self.shift = np.full(1 << BITS, m - BLOCK + 1, np.uint8)
        for k in range(m - BLOCK + 1):
            np.minimum.at(self.shift, _slot(packs[:, k]), m - BLOCK - k)
        # buckets of test strings by the hash of the window's blocks, the last of which has shift 0
        self.blocks = [packs[:, k].copy() for k in range(0, m, BLOCK)]
        full = _mixed(self.blocks) if len(text) else np.zeros(0, np.uint64)
        self.order = np.argsort(full, kind="stable")
        self.sorted = full[self.order]

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, m = len(text), self.m
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n < m or not len(self.sorted):
            return none
        pack = _pack(text)
        step = self.shift[_slot(pack)]
        # windows by the place of their last block; each lane covers the windows that end in its stretch
        pos = np.arange(m - BLOCK, n - BLOCK + 1, self.lane)
        end = np.minimum(pos + self.lane, n - BLOCK + 1)
        hits = []
        while len(pos):
            s = step[pos]
            zero = s == 0
            if zero.any():
                hits.append(pos[zero] - (m - BLOCK))
            pos = pos + np.maximum(s, 1)
            on = pos < end
            if not on.all():
                pos, end = pos[on], end[on]
        if not hits:
            return none
        place = np.concatenate(hits)
        h = _mixed([pack[place + k] for k in range(0, m, BLOCK)])
        lo = np.searchsorted(self.sorted, h, "left")
        ok = np.flatnonzero(self.sorted[np.minimum(lo, len(self.sorted) - 1)] == h)
        if not len(ok):
            return none
        place, h, lo = place[ok], h[ok], lo[ok]
        count = np.searchsorted(self.sorted, h, "right") - lo
        rows = np.repeat(np.arange(len(place)), count)
        number = self.order[lo[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)]
        place = place[rows]
        same = np.ones(len(place), bool)
        for k, b in zip(range(0, m, BLOCK), self.blocks, strict=True):
            same &= pack[place + k] == b[number]
        return place[same], number[same]


@dataclass
class Item:
    item_id: int
    text: np.ndarray  #: compared characters
    chars: str
    sentence: np.ndarray  #: number of the sentence of each of them
    sentences: int
    own: np.ndarray | None = None  #: characters that are item text (not standing)


_SENTENCE = re.compile(r"[^。！？!?\n]*?(?:[。！？!?\n]+|\.(?=\s|$)|$)", re.S)


def read_item(item_id: int, text: str) -> Item:
    c = codes(text)
    body, at = plain(c)
    ends = [m.end() for m in _SENTENCE.finditer(text) if m.end() > m.start()]
    number = np.searchsorted(np.array(ends or [len(text)]), at, "right")
    _, number = np.unique(number, return_inverse=True)
    return Item(item_id, body, "".join(map(chr, body)), number, int(number.max()) + 1 if len(number) else 0, np.ones(len(body), bool))


def length_of(it: Item, conf: Search) -> int:
    """Characters of an item's test strings, a multiple of three: for a short item no more than a third of it, or all of it below nine characters."""
    n = len(it.text)
    least = -(-n // 3) if n >= 9 else n
    return conf.m if n >= conf.short else max(BLOCK, min(conf.m, least // BLOCK * BLOCK))


def test_strings(items: list[Item], m: int, stride: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Test strings with (index of the item, place in it) of each; only places where all is item text."""
    strings, which, where = [], [], []
    for k, it in enumerate(items):
        n = len(it.text)
        places = list(range(0, n - m + 1, stride))
        # the last characters of each sentence are covered as well
        if n >= m and places[-1] != n - m:
            places.append(n - m)
        for p in places:
            if it.own[p : p + m].all():
                strings.append(it.chars[p : p + m])
                which.append(k)
                where.append(p)
    return strings, np.array(which, np.int64), np.array(where, np.int64)


ANCHOR, SLACK = 6, 12  #: a passage goes on behind a replaced word if so many characters agree within so many


def _onward(doc: str, item: str, d: int, i: int) -> tuple[int, int] | None:
    """The nearest place behind a difference where document and item agree again."""
    best = None
    for b in range(SLACK + 1):
        if best and b >= max(best):
            break
        piece = item[i + b : i + b + ANCHOR]
        if len(piece) < ANCHOR:
            break
        a = doc.find(piece, d, d + SLACK + ANCHOR) - d
        if a >= 0 and (not best or max(a, b) < max(best)):
            best = a, b
    return best


def _grow(doc: str, item: str, d: int, i: int, m: int) -> tuple[int, int, int]:
    """The passage around an occurrence, over replaced words: (item from, item to, document to)."""
    hi_d, hi_i = d + m, i + m
    while True:
        while hi_i < len(item) and hi_d < len(doc) and doc[hi_d] == item[hi_i]:
            hi_i, hi_d = hi_i + 1, hi_d + 1
        on = _onward(doc, item, hi_d, hi_i)
        if not on:
            break
        hi_d, hi_i = hi_d + on[0] + ANCHOR, hi_i + on[1] + ANCHOR
    # backwards the same on reversed text, as far as the item can reach
    reach = 2 * i + 4 * SLACK
    doc_b, item_b = doc[max(0, d - reach) : d][::-1], item[:i][::-1]
    lo_d = lo_i = 0
    while True:
        while lo_i < len(item_b) and lo_d < len(doc_b) and doc_b[lo_d] == item_b[lo_i]:
            lo_i, lo_d = lo_i + 1, lo_d + 1
        on = _onward(doc_b, item_b, lo_d, lo_i)
        if not on:
            break
        lo_d, lo_i = lo_d + on[0] + ANCHOR, lo_i + on[1] + ANCHOR
    return i - lo_i, hi_i, hi_d


def _sorted_unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, with their numbers."""
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[at], np.diff(np.append(at, len(x)))


def _dense(doc: np.ndarray, item: np.ndarray, diagonal: np.ndarray, number: np.ndarray, need: np.ndarray, band: int) -> np.ndarray:
    """Occurrences that lie with at least ``need`` test strings of their item along one diagonal of a document."""
    keep = np.zeros(len(doc), bool)
    n = int(number.max()) + 1
    for shift in (0, band):  # two grids, so that any band lies whole in a cell of one
        cell = (diagonal + shift) // (2 * band)
        cell -= cell.min()
        key = (doc * len(need) + item) * (int(cell.max()) + 1) + cell
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], np.diff(key[order]) != 0])
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(new) - 1
        once = _sorted_unique(group * n + number)[0] // n
        size = np.bincount(once, minlength=int(group.max()) + 1)
        keep |= size[group] >= need[item]
    return keep


def _texts(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, compared characters of all texts with a separator between, start of each text), of bounded size."""
    def flush(ids: list, texts: list):
        joined = "\x00".join(texts)
        c = codes(joined)
        starts = np.concatenate([[0], np.flatnonzero(c == 0) + 1])
        out = np.where(c < 0x10000, _plain()[np.minimum(c, 0xFFFF)], c)
        out[c == 0] = 1  # never part of a test string
        at = np.flatnonzero(out)
        return np.array(ids, object), out[at], np.searchsorted(at, starts)

    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if not t:
                continue
            ids.append(i)
            texts.append(t.replace("\x00", " ") if "\x00" in t else t)
            size += len(t)
            if size > limit:
                yield flush(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield flush(ids, texts)


def _blocks(items: Iterator[Item], limit: int) -> Iterator[list[Item]]:
    block, size = [], 0
    for it in items:
        if block and size + len(it.text) > limit:
            yield block
            block, size = [], 0
        block.append(it)
        size += len(it.text)
    if block:
        yield block


@dataclass
class Plan:
    """Items whose test strings have one length, with the search for them."""

    items: list[Item]
    m: int
    finder: WuManber
    which: np.ndarray
    where: np.ndarray


def _plans(items: list[Item], conf: Search) -> list[Plan]:
    by: dict[tuple[int, int], list[Item]] = {}
    for it in items:
        if len(it.text) >= BLOCK:
            by.setdefault((length_of(it, conf), conf.stride if len(it.text) >= conf.short else 1), []).append(it)
    out = []
    for (m, stride), its in sorted(by.items(), key=lambda x: x[0]):
        strings, which, where = test_strings(its, m, stride)
        if strings:
            out.append(Plan(its, m, WuManber(strings, m, conf.lane), which, where))
    return out


def _counts(docs: DataFrame, plans: list[Plan], conf: Search) -> tuple[list[tuple[int, int, int]], dict[int, set[int]]]:
    """(plan, item, sentence) of standing sentences, and by plan the test strings that are found alone too often; over distinct texts."""
    shared = docs.sparkSession.sparkContext.broadcast(plans)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for n_plan, p in enumerate(shared.value):
            size = max((it.sentences for it in p.items), default=1) + 1
            sent = np.array([p.items[k].sentence[w] for k, w in zip(p.which, p.where, strict=True)], np.int64)
            last = np.array([p.items[k].sentence[w + p.m - 1] for k, w in zip(p.which, p.where, strict=True)], np.int64)
            inside, code = sent == last, p.which * size + sent
            held.append((n_plan, p, size, inside, code, np.bincount(code[inside], minlength=len(p.items) * size)))
        for ids, text, starts in _texts(batches, conf.batch_chars):
            out: list[list[np.ndarray]] = [[np.full(len(ids), -1)], [np.arange(len(ids))], [np.zeros(len(ids), np.int64)], [np.zeros(len(ids), np.int64)], [np.zeros(len(ids), np.int64)]]
            for n_plan, p, size, inside, code, need in held:
                place, number = p.finder.find(text)
                if not len(place):
                    continue
                base, n = len(p.items) * size, len(p.which)
                doc = np.searchsorted(starts, place, "right") - 1
                tile, _ = _sorted_unique(doc * n + number)  # each test string once a text, in the order of the items
                doc, number = tile // n, tile % n
                new = np.concatenate([[True], (np.diff(tile) > 2) | (np.diff(doc) > 0) | (np.diff(p.which[number]) > 0)])
                few = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] <= 2
                ok = inside[number]
                key, many = _sorted_unique(doc[ok] * base + code[number[ok]])
                lo = np.concatenate([[False], np.diff(key) == 1])[: len(key)]  # the sentence before is there, at least in part
                hi = np.concatenate([np.diff(key) == 1, [False]])[: len(key)]
                half = many >= np.maximum(1, (need[key % base] + 1) // 2)
                for part, values in zip(out, (
                    np.concatenate([np.full(half.sum(), 2 * n_plan), np.full(few.sum(), 2 * n_plan + 1)]), np.concatenate([key[half] // base, doc[few]]),
                    np.concatenate([key[half] % base // size, number[few]]), np.concatenate([key[half] % size, np.zeros(few.sum(), np.int64)]),
                    np.concatenate([(~lo & ~hi)[half].astype(np.int64), np.ones(few.sum(), np.int64)]),
                ), strict=True):
                    part.append(values)
            kind, doc, a, b, alone = (np.concatenate(x).astype(np.int64) for x in out)
            yield pa.RecordBatch.from_pydict({"h": pa.array(ids[doc].tolist(), pa.int64()), "kind": pa.array(kind), "a": pa.array(a), "b": pa.array(b), "alone": pa.array(alone)})

    # copies of a text have one hash: they are one text
    each = docs.select(F.xxhash64("t").alias("h"), "t").mapInArrow(count, "h long, kind long, a long, b long, alone long").distinct()
    counts = cut(each.groupBy("kind", "a", "b").agg(F.count(F.lit(1)).alias("total"), F.sum("alone").alias("alone")))
    shared.unpersist()
    first = counts.filter("kind = -1").first()
    n = first.total if first else 0
    rows = counts.filter((F.col("kind") % 2 == 0) & (F.col("kind") >= 0) & (F.col("alone") >= max(conf.standing_docs, conf.standing_share * n)) & (F.col("alone") >= conf.standing_alone * F.col("total"))).collect()
    often = counts.filter((F.col("kind") % 2 == 1) & (F.col("kind") > 0) & (F.col("total") > max(3, conf.phrase_share * n))).collect()  # both a part of the block's sentences and test strings
    common: dict[int, set[int]] = {}
    for r in often:
        common.setdefault(r.kind // 2, set()).add(r.a)
    return [(r.kind // 2, r.a, r.b) for r in rows], common


def leaked(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, doc_text: str = "text", item_text: str = "text", conf: Search = Search()) -> DataFrame:
    """(item_id, doc_id, share): documents that contain at least ``conf.share`` of an item's own text in one passage.

    Null and blank texts and items match nothing; items of fewer than nine compared
    characters have to be there whole, of fewer than three they match nothing; repeated
    documents are reported each, repeated items each. Empty tables give no rows. Texts are
    searched whole.
    """
    kinds = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    schema = f"item_id {kinds[1]}, doc_id {kinds[0]}, share double"
    base = docs.filter(F.col(doc_text).isNotNull()).select(F.col(doc_id).alias("id"), F.col(doc_text).alias("t"))
    out = None
    listed = (read_item(r[0], r[1]) for r in items.filter(F.col(item_text).isNotNull()).select(item_id, item_text).toLocalIterator())
    for block in _blocks(listed, conf.block_chars):
        plans = _plans(block, conf)
        if not plans:
            continue
        standing, common = _counts(base, plans, conf)
        for p, k, sentence in standing:
            it = plans[p].items[k]
            part = it.sentence == sentence
            if it.sentences > 1 and part.sum() < conf.share * len(it.text):
                it.own[part] = False
        found = _search(base, [_without_standing(p, n, common.get(n, set())) for n, p in enumerate(plans)], conf, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _without_standing(p: Plan, n: int, common: set[int]) -> tuple[Plan, np.ndarray]:
    """The plan of pass 2: test strings of item text only, and which of them are rare by themselves."""
    keep = np.array([p.items[k].own[w : w + p.m].all() for k, w in zip(p.which, p.where, strict=True)], bool)
    rare = np.array([i not in common for i in range(len(p.which))], bool)[keep]
    which, where = p.which[keep], p.where[keep]
    strings = [p.items[k].chars[w : w + p.m] for k, w in zip(which, where, strict=True)]
    return Plan(p.items, p.m, WuManber(strings, p.m, p.finder.lane), which, where), rare


def _search(base: DataFrame, plans: list[tuple[Plan, np.ndarray]], conf: Search, schema: str) -> DataFrame:
    shared = base.sparkSession.sparkContext.broadcast(plans)
    kinds = [f.dataType for f in base.sparkSession.createDataFrame([], schema).schema]
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(k) for k in kinds]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for p, rare in shared.value:
            its = p.items
            least = [max(1, conf.share * it.own.sum()) if len(it.text) >= 9 else len(it.text) for it in its]
            have = np.bincount(p.which, minlength=len(its))
            short = np.array([len(it.text) < conf.short for it in its], bool)
            need = np.where(short, 1, np.maximum(1, (conf.intact * (conf.share * have - 2)).astype(int)))
            held.append((p, rare, least, need, [np.concatenate([[0], np.cumsum(it.own)]) for it in its]))
        for ids, text, starts in _texts(batches, conf.batch_chars):
            found: dict[tuple[int, int, int], float] = {}
            for n_plan, (p, rare, least, need, before) in enumerate(held):
                place, number = p.finder.find(text)
                if not len(place):
                    continue
                doc = np.searchsorted(starts, place, "right") - 1
                keep = rare[number] | _dense(doc, p.which[number], place - p.where[number], number, need, conf.band)
                place, number, doc = place[keep], number[keep], doc[keep]
                order = np.lexsort((place, p.which[number], doc))
                pair, done, last_doc, chars = None, -1, -1, ""
                for at, n, d in zip(place[order].tolist(), number[order].tolist(), doc[order].tolist(), strict=True):
                    k = int(p.which[n])
                    if d != last_doc:
                        e = int(starts[d + 1]) - 1 if d + 1 < len(starts) else len(text)
                        chars, last_doc = text[starts[d] : e].astype("<u4").tobytes().decode("utf-32-le", "replace"), d
                    if (d, k) != pair:
                        pair, done = (d, k), -1
                    here = at - int(starts[d])
                    if here < done:
                        continue  # inside the passage just grown
                    lo, hi, done = _grow(chars, p.items[k].chars, here, int(p.where[n]), p.m)
                    own = int(before[k][hi] - before[k][lo])
                    if own >= least[k]:
                        found[(n_plan, k, d)] = max(found.get((n_plan, k, d), 0.0), own / max(1, int(p.items[k].own.sum())))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([held[p][0].items[k].item_id for p, k, _ in found], types[0]), pa.array([ids[d] for *_, d in found], types[1]), pa.array(list(found.values()), types[2])], names=["item_id", "doc_id", "share"]
                )

    return base.mapInArrow(search, schema)
