"""Listing and article pages, PDF checks and state files."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from bondlake.functions.dates import found, full_date, ymd

SITE = "https://www.example.org"


def cache_key(url: Column) -> Column:
    return F.sha1(F.encode(url, "UTF-8"))


def is_valid_pdf(content: Column) -> Column:
    """Starts with %PDF and has %%EOF in its last 2048 bytes; empty is not valid."""
    head, tail = F.substring(content, 1, 4), F.substring(content, -2048, 2048)
    return F.coalesce((head == F.expr("X'25504446'")) & F.contains(tail, F.expr("X'2525454F46'")), F.lit(False))


def total_pages(html: Column) -> Column:
    return F.coalesce(found(html, r"(?U)共\s*(\d+)\s*页", 1).try_cast("int"), F.lit(1))


def page_urls(channels: DataFrame, pages: Column, site: str = SITE) -> DataFrame:
    """(name, page_no, url) of every page of a channel; the first page has no number in its address."""
    x = channels.select("name", "channel_id", F.explode(F.sequence(F.lit(1), pages)).alias("page_no"))
    number = F.when(F.col("page_no") > 1, F.concat(F.lit("_"), F.col("page_no").cast("string"))).otherwise("")
    return x.select("name", "page_no", F.concat(F.lit(f"{site}/zqsclb"), number, F.lit(".jhtml?ad_code=87&channelId="), "channel_id").alias("url"))


class _Tree(HTMLParser):
    """What the two kinds of pages need, with the tolerance that real markup asks for."""

    VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root: dict = {"tag": "", "attrs": {}, "kids": []}
        self.stack = [self.root]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "li" and any(n["tag"] == "li" for n in self.stack):
            k = max(i for i, n in enumerate(self.stack) if n["tag"] == "li")
            if not any(n["tag"] in ("ul", "ol") for n in self.stack[k:]):
                del self.stack[k:]
        node = {"tag": tag, "attrs": {k: v or "" for k, v in attrs}, "kids": []}
        self.stack[-1]["kids"].append(node)
        if tag not in self.VOID:
            self.stack.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k]["tag"] == tag:
                del self.stack[k:]
                break

    def handle_data(self, data: str) -> None:
        self.stack[-1]["kids"].append(data)


def _nodes(node: dict) -> Iterator[dict | str]:
    """Everything below a node in document order; an own stack, as markup may be nested without bound."""
    rest = list(reversed(node["kids"]))
    while rest:
        k = rest.pop()
        yield k
        if isinstance(k, dict):
            rest.extend(reversed(k["kids"]))


def _walk(node: dict) -> Iterator[dict]:
    return (k for k in _nodes(node) if isinstance(k, dict))


def _strings(node: dict) -> Iterator[str]:
    return (k for k in _nodes(node) if isinstance(k, str))


def _text(node: dict, between: str = "") -> str:
    return between.join(s.strip() for s in _strings(node) if s.strip())


def _tree(html: str) -> dict:
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


def listing_rows(html: str) -> list[tuple[str, str, str]]:
    """(href, title, text of the first span) of each list item with a link in #to-print1."""
    box = next((n for n in _walk(_tree(html)) if n["attrs"].get("id") == "to-print1"), None)
    out = []
    for li in (n for n in _walk(box) if n["tag"] == "li") if box else ():
        a = next((n for n in _walk(li) if n["tag"] == "a" and "href" in n["attrs"]), None)
        if a:
            span = next((n for n in _walk(li) if n["tag"] == "span"), None)
            out.append((a["attrs"]["href"].strip(), a["attrs"].get("title", _text(a)).strip(), _text(span) if span else ""))
    return out


def listing_items(pages: DataFrame) -> DataFrame:
    """Pages (source columns..., html) -> a row per listed item: url, title, listing_pub_date; impossible dates are null."""
    keep = [c for c in pages.columns if c != "html"]
    schema = StructType([f for f in pages.schema if f.name != "html"]).add("feed_pos", IntegerType())
    for name in ("url", "title", "_date"):
        schema = schema.add(name, StringType())

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = list(b[keep].itertuples(index=False, name=None)) if keep else [()] * len(b)
            rows = [(*key, i, *r) for key, html in zip(keys, b["html"], strict=True) for i, r in enumerate(listing_rows(html))]
            yield pd.DataFrame(rows, columns=[*keep, "feed_pos", "url", "title", "_date"])

    x = pages.mapInPandas(parse, schema)
    pat = r"(\d{4})-(\d{1,2})-(\d{1,2})"
    return x.withColumn("listing_pub_date", ymd(found(F.col("_date"), pat, 1), found(F.col("_date"), pat, 2), found(F.col("_date"), pat, 3))).drop("_date")


def _with_class(root: dict, name: str) -> dict | None:
    return next((n for n in _walk(root) if name in n["attrs"].get("class", "").split()), None)


def articles(pages: DataFrame) -> DataFrame:
    """(url, html) -> url, title, pub_date, body_text, attachments, parse_ok."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url, html in zip(b["url"], b["html"], strict=True):
                t = _tree(html)
                h1 = next((n for n in _walk(t) if n["tag"] == "h1"), None)
                inf, body, box = (_with_class(t, c) for c in ("secondPage-content-inf", "content-txt", "content-fj"))
                links = [n for n in _walk(box) if n["tag"] == "a" and n["attrs"].get("href", "").strip().lower().endswith(".pdf")] if box else []
                rows.append((url, _text(h1) if h1 else None, _text(inf, " ") if inf else None, _text(body, "\n") if body else "", [{"url": a["attrs"]["href"].strip(), "name": a["attrs"].get("title") or _text(a)} for a in links]))
            yield pd.DataFrame(rows, columns=["url", "title", "_date", "body_text", "attachments"])

    x = pages.select("url", "html").mapInPandas(parse, "url string, title string, _date string, body_text string, attachments array<struct<url:string,name:string>>")
    x = x.withColumn("pub_date", full_date(F.col("_date")))
    ok = F.coalesce(F.length("title") > 0, F.lit(False)) & F.col("pub_date").isNotNull()
    return x.select("url", "title", "pub_date", "body_text", "attachments", ok.alias("parse_ok"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a state, oldest first."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    numbers = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()]
    return sorted(n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/v{n}/_SUCCESS")))


def read_state(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete version of a state below ``path``, or an empty table."""
    have = versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/v{have[-1]}") if have else spark.createDataFrame([], schema)


def write_state(df: DataFrame, path: str, version: int, order: list[str] | None = None) -> None:
    """A new version beside the one being read, globally sorted where an order is given; it counts from when it is complete."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").parquet(f"{path}/v{version}")
