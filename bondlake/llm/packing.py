"""Filling fixed-capacity containers: bounded-space online best fit, then merging of leftovers.

Texts are measured in tokens of a public tokenizer in the scan itself; only ids and sizes
are shuffled. Items of one source are dealt to groups of about ``group_rows`` rows by a
hash, so a hot source is spread over tasks. A group is one pass over its items with at
most ``windows`` open containers: an item goes where it leaves the least room; where it
fits nowhere and no more may be opened, the fullest is emitted. The containers still open
at the end of all groups are leftovers: they are items of a next, far smaller round over
fewer groups, until each source has one group.

An item above the capacity is cut into pieces of just the capacity, each a container of
its own, and one rest that is packed like any item. Nothing else is ever split.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bondlake.operators.cut import cut

#: Fixed value: the split of text into pieces that the public byte-level vocabularies were made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Packing:
    windows: int = 32  #: open containers of a group
    group_rows: int = 50_000
    vocabulary: str = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"  #: a file of ranks of a byte-level vocabulary
    broadcast_sources: int = 20_000  #: a capacity table of at most so many rows is sent to every task


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, columns: list[str], text_col: str, vocabulary: str) -> DataFrame:
    """``columns`` and n_tokens of every row with a text."""
    base = df.filter(F.col(text_col).isNotNull()).select(*columns, F.col(text_col).alias("_text"))
    schema = base.drop("_text").schema.add("n_tokens", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocabulary)
        for b in batches:
            n = [len(enc.encode_ordinary(t.as_py())) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])

    return base.mapInArrow(count, schema)


class Windows:
    """The open containers of one group, by the room they have left."""

    def __init__(self, most: int):
        self.most = most
        self.room: list[tuple[int, int]] = []  #: (room, container), ascending
        self.next = 0

    def place(self, size: int, capacity: int) -> tuple[int, int | None]:
        """(container of the item, container emitted for it or None)."""
        out = None
        k = bisect.bisect_left(self.room, (size, -1))
        if k < len(self.room):
            room, c = self.room.pop(k)
        else:
            if len(self.room) >= self.most:
                _, out = self.room.pop(0)  # the fullest
            room, c = capacity, self.next
            self.next += 1
        bisect.insort(self.room, (room - size, c))
        return c, out


def _pack_groups(items: DataFrame, windows: int) -> DataFrame:
    """items (source, grp, item, size, capacity) -> (item, source, capacity, grp, container, open)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, w, emitted = None, None, []
        for b in batches:
            cols = {"item": [], "source": [], "capacity": [], "grp": [], "container": [], "size": []}
            for source, grp, item, size, cap in zip(b["source"], b["grp"], b["item"], b["size"], b["capacity"], strict=True):
                if (source, grp) != key:
                    if w:
                        emitted += [(*key, c) for _, c in w.room]
                    key, w = (source, grp), Windows(windows)
                c, _ = w.place(int(size), int(cap))
                for k, v in zip(cols, (item, source, cap, grp, c, size), strict=True):
                    cols[k].append(v)
            out = pd.DataFrame(cols)
            out["is_open"] = False
            yield out
        if w:
            emitted += [(*key, c) for _, c in w.room]
        if emitted:
            s, g, c = zip(*emitted, strict=True)
            yield pd.DataFrame({"item": "", "source": s, "capacity": 0, "grp": g, "container": c, "size": 0, "is_open": True})

    ordered = items.repartition("source", "grp").sortWithinPartitions("source", "grp", F.xxhash64("item"), "item")
    return ordered.select("source", "grp", "item", "size", "capacity").mapInPandas(pack, "item string, source string, capacity long, grp long, container long, size long, is_open boolean")


def _grouped(items: DataFrame, rows: int) -> DataFrame:
    """Deal the items of each source to groups of about ``rows``."""
    per = items.groupBy("source").agg(F.count(F.lit(1)).alias("of"))
    per = per.select("source", F.ceil(F.col("of") / rows).cast("long").alias("groups"))
    return items.join(per, "source").withColumn("grp", F.pmod(F.xxhash64("item"), F.col("groups"))).drop("groups")


def pack(df: DataFrame, capacities: DataFrame, id_col: str, text_col: str = "text", source_col: str = "source", capacity_source: str = "source", capacity_col: str = "capacity_tokens", conf: Packing = Packing()) -> DataFrame:
    """(row_id, piece, source, from_token, tokens, container) of every text, or of every piece of one that exceeds the capacity.

    ``container`` is null for texts without tokens and for sources without a positive
    capacity; null texts give no row. Repeated rows are packed each. Of several capacities
    of one source the smallest holds. Empty tables give no rows.
    """
    sized = token_counts(df.select(F.col(id_col), F.col(source_col), F.col(text_col)), [id_col, source_col], text_col, conf.vocabulary)
    caps = capacities.filter(F.col(capacity_source).isNotNull() & (F.col(capacity_col) > 0)).groupBy(F.col(capacity_source).cast("string").alias("source")).agg(F.min(capacity_col).cast("long").alias("capacity"))
    sized = sized.select(F.col(id_col).alias("row_id"), F.col(source_col).cast("string").alias("source"), F.col("n_tokens"))
    sized = cut(sized.withColumn("row", F.monotonically_increasing_id()))
    sized = sized.join(F.broadcast(caps) if caps.count() <= conf.broadcast_sources else caps, "source", "left")
    fits = F.col("capacity").isNotNull() & (F.col("n_tokens") > 0)
    n, cap = F.col("n_tokens"), F.col("capacity")
    pieces = sized.select("row_id", "row", "source", "capacity", "n_tokens", F.explode(F.when(fits, F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / cap))).otherwise(F.array(F.lit(0).cast("long")))).alias("piece"))
    pieces = pieces.withColumn("from_token", F.coalesce(F.col("piece") * cap, F.lit(0).cast("long"))).withColumn("tokens", F.when(cap.isNull(), n).otherwise(F.least(cap, n - F.col("from_token"))))
    pieces = cut(pieces.withColumn("item", F.concat_ws("/", F.col("row").cast("string"), F.col("piece").cast("string"))))
    packable = pieces.filter("capacity is not null and n_tokens > 0")
    whole = packable.filter("tokens = capacity").select("item", F.concat(F.lit("full/"), "item").alias("container"))
    items = packable.filter("tokens < capacity").select("source", "item", F.col("tokens").alias("size"), "capacity")

    at, level, last = items, 0, None  # item -> container, round by round
    while True:
        packed = cut(_pack_groups(_grouped(at, conf.group_rows), conf.windows))
        name = F.concat_ws("/", F.lit(str(level)), "source", F.col("grp").cast("string"), F.col("container").cast("string"))
        placed = packed.filter("not is_open").select("item", name.alias("container"), "source", "grp", "capacity", "size")
        step = placed.select("item", "container")
        last = step if last is None else last.join(step.select(F.col("item").alias("container"), F.col("container").alias("later")), "container", "left").select("item", F.coalesce("later", "container").alias("container"))
        groups = placed.groupBy("source").agg(F.count_distinct("grp").alias("g")).filter("g > 1")
        if groups.isEmpty():
            break
        left = packed.filter("is_open").select(name.alias("container")).join(placed, "container").join(groups, "source", "left_semi")
        at = cut(left.groupBy("source", F.col("container").alias("item")).agg(F.sum("size").alias("size"), F.first("capacity").alias("capacity")))
        level += 1
    where = last.unionByName(whole)
    return pieces.join(where, "item", "left").select("row_id", F.col("piece").cast("int").alias("piece"), "source", "from_token", "tokens", "container")


def fill(packed: DataFrame, capacities: DataFrame, capacity_source: str = "source", capacity_col: str = "capacity_tokens") -> DataFrame:
    """(source, containers, tokens, filled): how full the containers of each source are."""
    caps = capacities.groupBy(F.col(capacity_source).alias("source")).agg(F.min(capacity_col).alias("capacity"))
    per = packed.filter("container is not null").groupBy("source", "container").agg(F.sum("tokens").alias("tokens"))
    per = per.groupBy("source").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens")).join(caps, "source")
    return per.select("source", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 4).alias("filled"))
