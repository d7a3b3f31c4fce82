"""Matching entities across sources without keys: soft logic solved by alternating directions.

Rows with one description are one mention; mentions that a key of their own source ties
together (a code, or a known number of a known block) are one entity, whose attributes are
those of its most frequent mentions. So copies and hot groups cost one entity. A candidate
link of two entities has a value in [0, 1]; weighted rules speak about it:

  same number -> link          other number, kind, year -> no link
  same amount, term, batch, dates, place, similar name, each to its degree -> link
  other amount, term, batch, dates, place, unlike name -> no link
  no evidence -> no link (prior)
  link(a, r) and alike(r, r') -> link(a, r')        (transitivity; alike: one description)
  a right-hand entity belongs to one left-hand entity, and of a left-hand entity's links
  to entities with different codes the values add up to 1 at most   (exclusivity)

Every rule is a squared hinge of a linear form, exclusivity is a linear constraint: a
convex problem. Consensus ADMM gives each rule its own copy of the values it speaks about,
solves all rules at once in closed form, averages the copies, and repeats. A link that
shares no rule with another has a closed form. The others fall into connected components
(found by alternating large and small stars over the edges), which share no value: tasks
solve whole components, each with a stop of its own, so no value depends on what else is in
the task. A component of more than ``component`` links is solved by the same rounds as
aggregates over its copies and constraints, spread over all tasks. The value of a link is
its confidence.

Candidates come from keys of several attributes (number; amount; term with batch; term with
day; inside a known year, place and family; amount or number with day elsewhere); nothing is
paired exhaustively, and a key with a null part doesn't exist.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bondlake.llm.lookalike import fold
from bondlake.llm.survivor import bond_key, real_value
from bondlake.operators.cut import cut


@dataclass(frozen=True)
class Rules:
    """Weights of the rules, and bounds of the solver."""

    number: float = 6.0
    number_not: float = 12.0
    kind_not: float = 8.0
    year_not: float = 6.0
    place: float = 0.5
    place_not: float = 6.0
    name: float = 0.5
    name_not: float = 1.0
    amount: float = 2.5
    amount_not: float = 2.0
    term: float = 0.8
    term_not: float = 2.0
    batch: float = 1.2
    batch_not: float = 2.5
    day: float = 1.2
    day_not: float = 2.0
    prior: float = 2.0
    unnumbered: float = 1.15  #: where a number is unknown the other rules for a link weigh so much more
    alike: float = 4.0
    rho: float = 2.0
    steps: int = 1_000  #: most rounds of a component
    tolerance: float = 1e-4  #: a component stops when none of its values moves more
    accept: float = 0.5
    bucket: int = 20_000  #: links a task solves together, on average
    component: int = 100_000  #: links of a component that one task solves, at most


def solve(n: int, pro: np.ndarray, con: np.ndarray, groups: tuple[np.ndarray, np.ndarray], implies: np.ndarray, component: np.ndarray, r: Rules) -> np.ndarray:
    """Consensus ADMM for n values.

    ``pro`` and ``con`` weigh (1 - y)^2 and y^2; ``groups`` = (value, constraint): values of
    one constraint add up to 1 at most; ``implies`` = rows (x, y): alike * max(0, x - y)^2.
    A component stops by itself once its values rest.
    """
    if not n:
        return np.zeros(0)
    gv, gc = groups
    m = int(gc.max()) + 1 if len(gc) else 0
    size = np.maximum(1, np.bincount(gc, minlength=m)) if m else np.zeros(0)
    ix, iy = (implies[:, 0], implies[:, 1]) if len(implies) else (np.zeros(0, int), np.zeros(0, int))
    copies = 1 + np.bincount(gv, minlength=n) + np.bincount(ix, minlength=n) + np.bincount(iy, minlength=n)
    z = pro / np.maximum(pro + con, 1e-9)
    u1, u2, u3, u4 = np.zeros(n), np.zeros(len(gv)), np.zeros(len(ix)), np.zeros(len(ix))
    live = np.ones(int(component.max()) + 1, bool)
    for _ in range(r.steps):
        # the unary rules
        y1 = (2 * pro + r.rho * (z - u1)) / (2 * pro + 2 * con + r.rho)
        # exclusivity: project on sum <= 1
        v2 = z[gv] - u2
        y2 = v2 - (np.maximum(0, np.bincount(gc, v2, minlength=m) - 1) / size)[gc] if m else v2
        # transitivity: closed form of the squared hinge
        vx, vy = z[ix] - u3, z[iy] - u4
        move = 2 * r.alike * np.maximum(0, vx - vy) / (r.rho + 4 * r.alike)
        y3, y4 = vx - move, vy + move
        new = (y1 + u1 + np.bincount(gv, y2 + u2, minlength=n) + np.bincount(ix, y3 + u3, minlength=n) + np.bincount(iy, y4 + u4, minlength=n)) / copies
        new = np.where(live[component], np.clip(new, 0, 1), z)
        u1 += y1 - new
        u2 += y2 - new[gv]
        u3 += y3 - new[ix]
        u4 += y4 - new[iy]
        moved = np.zeros(len(live))
        np.maximum.at(moved, component, np.abs(new - z))
        live &= moved >= r.tolerance
        z = new
        if not live.any():
            break
    return z


def solve_bucket(pdf: pd.DataFrame, r: Rules) -> pd.DataFrame:
    """Values of the links of whole components."""
    n = len(pdf)
    left, right = pd.factorize(pdf["left"])[0], pd.factorize(pdf["right"])[0]
    coded = pdf["coded"].to_numpy(bool)
    gv = np.concatenate([np.arange(n), np.flatnonzero(coded)])
    _, gc = np.unique(np.concatenate([right, right.max() + 1 + left[coded]]), return_inverse=True)
    t = pdf[pdf["like"].notna()].assign(v=np.flatnonzero(pdf["like"].notna()), coded=coded[pdf["like"].notna()])
    # of several coded entities with one description the best speaks for the others
    best = t[t["coded"]].sort_values(["pro", "right"], ascending=[False, True]).drop_duplicates(["left", "like"])
    imp = best.merge(t[~t["coded"]], on=["left", "like"])[["v_x", "v_y"]].to_numpy(int)
    y = solve(n, pdf["pro"].to_numpy(float), pdf["con"].to_numpy(float), (gv, gc), imp, pd.factorize(pdf["component"])[0], r)
    return pd.DataFrame({"left": pdf["left"].to_numpy(), "right": pdf["right"].to_numpy(), "confidence": y})


def solve_spread(links: DataFrame, r: Rules) -> DataFrame:
    """The same rounds as aggregates: every copy of a value is a row, every constraint a group."""
    base = cut(links.withColumn("v", F.xxhash64("left", "right")))
    like = base.filter("like is not null")
    best = like.filter("coded").groupBy("left", "like").agg(F.max_by("v", F.struct("pro", -F.col("right"))).alias("x"))
    imp = best.join(like.filter("not coded"), ["left", "like"]).select("x", F.col("v").alias("y"), F.xxhash64(F.lit("i"), "v").alias("c"))
    member = lambda v, c, role: F.struct(v.alias("v"), c.alias("c"), F.lit(role).alias("role"))
    copies = (
        base.select("v", F.xxhash64(F.lit("r"), "right").alias("c"), F.lit(0).alias("role"))
        .unionByName(base.filter("coded").select("v", F.xxhash64(F.lit("l"), "left").alias("c"), F.lit(0).alias("role")))
        .unionByName(imp.select(F.explode(F.array(member(F.col("x"), F.col("c"), 1), member(F.col("y"), F.col("c"), 2))).alias("m")).select("m.*"))
    )
    copies = cut(copies.withColumn("u", F.lit(0.0)))
    values = base.select("v", "pro", "con", (F.col("pro") / F.greatest(F.col("pro") + F.col("con"), F.lit(1e-9))).alias("z"), F.lit(0.0).alias("u1"))
    for _ in range(r.steps):
        w = copies.join(values.select("v", "z"), "v").withColumn("w", F.col("z") - F.col("u"))
        by_role = lambda k: F.coalesce(F.max(F.when(F.col("role") == k, F.col("w"))), F.lit(0.0))
        per = w.groupBy("c").agg(
            (F.greatest(F.lit(0.0), F.sum(F.when(F.col("role") == 0, F.col("w")).otherwise(0.0)) - 1) / F.count(F.lit(1))).alias("over"),
            (2 * r.alike * F.greatest(F.lit(0.0), by_role(1) - by_role(2)) / (r.rho + 4 * r.alike)).alias("move"),
        )
        # both halves of a round are cut, as either is read more than once by the next
        y = cut(w.join(per, "c").select("v", "c", "role", "u", (F.col("w") - F.when(F.col("role") == 0, F.col("over")).when(F.col("role") == 1, F.col("move")).otherwise(-F.col("move"))).alias("y")))
        mean = y.groupBy("v").agg(F.sum(F.col("y") + F.col("u")).alias("s"), F.count(F.lit(1)).alias("k"))
        own = (2 * F.col("pro") + r.rho * (F.col("z") - F.col("u1"))) / (2 * F.col("pro") + 2 * F.col("con") + r.rho)
        new = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("y1") + F.col("u1") + F.col("s")) / (1 + F.col("k"))))
        values = values.join(mean, "v").withColumn("y1", own).withColumn("new", new)
        values = cut(values.select("v", "pro", "con", F.col("new").alias("z"), (F.col("u1") + F.col("y1") - F.col("new")).alias("u1"), F.abs(F.col("new") - F.col("z")).alias("moved")))
        copies = y.join(values.select("v", "z"), "v").select("v", "c", "role", (F.col("u") + F.col("y") - F.col("z")).alias("u"))
        if (values.agg(F.max("moved")).first()[0] or 0.0) < r.tolerance:
            break
        values = values.drop("moved")
    return base.join(values.select("v", "z"), "v").select("left", "right", F.col("z").alias("confidence"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of (a, b): alternating large and small stars, each an aggregate and a join."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both if large else both.filter("b <= a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")) if large else low.groupBy("a").agg(F.min("b").alias("m"))
        moved = low.join(least, "a").filter("b > a" if large else "true").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        return moved.unionByName(own).filter("a != b").distinct()

    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    sign = lambda x: tuple(x.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    seen = sign(e)
    while True:
        e = cut(star(star(e, True), False))
        now = sign(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


TYPES = {"year": "string", "place": "string", "family": "string", "kind": "string", "number": "int", "term": "int", "amount": "double", "batch": "int", "day1": "int", "day2": "int", "name": "string", "code": "string"}
ATTRIBUTES = [c for c in TYPES if c != "code"]


def described(df: DataFrame, id_col: str, columns: dict[str, Column], side: int) -> DataFrame:
    """(side, row_id, entity, attributes) of every row; one scan."""
    x = df.select(F.lit(side).alias("side"), F.col(id_col).cast("long").alias("row_id"), *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in TYPES.items()]).filter("row_id is not null")
    tied = ["year", "place", "family", "kind", "number"]
    known = F.lit(True)
    for c in tied:
        known = known & F.col(c).isNotNull()
    entity = (
        F.when(F.col("code").isNotNull(), F.xxhash64("side", F.lit("c"), "code")).when(known, F.xxhash64("side", F.lit("n"), *tied))
        .otherwise(F.xxhash64("side", F.lit("d"), *[x for c in ATTRIBUTES for x in (F.col(c), F.col(c).isNull())]))
    )
    return x.withColumn("entity", entity)


def entities(rows: DataFrame) -> DataFrame:
    """One row per entity: every attribute from the mention with most rows that knows it."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in ATTRIBUTES), F.lit(0))
    mentions = rows.groupBy("side", "entity", "code", *ATTRIBUTES).agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first")).withColumn("rank", F.struct("n", filled.alias("f"), -F.col("first")))
    return mentions.groupBy("side", "entity").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("rank"))).alias(c) for c in ATTRIBUTES], F.max(F.col("code").isNotNull()).alias("coded"), F.sum("n").alias("rows"), F.min("first").alias("first")
    )


def _keys(e: DataFrame, side: int, soft: bool) -> DataFrame:
    """(key, entity) of one side.

    Keys other than the number serve pairs of which one side has no number: an entity
    without one has keys "a", which every entity of the other side has as well; a left
    one with number has keys "b", which only right ones without have. The same for
    entities of no known block, with a looser key.
    """
    c = F.col
    block = F.when(c("year").isNotNull() & c("place").isNotNull() & c("family").isNotNull(), F.xxhash64("year", "place", "family"))
    cell = F.when(c("amount") > 0, F.floor(F.log("amount") / 0.02).cast("long"))
    cells = [cell] if side == 0 else [cell - 1, cell, cell + 1]
    both = lambda miss: ([F.when(miss, F.lit("a")).otherwise(F.lit("b"))] if side == 0 else [F.lit("a"), F.when(miss, F.lit("b"))])

    def key(tag: str, which: Column | None, *parts: Column) -> Column:
        all_known = which.isNotNull() if which is not None else F.lit(True)
        for p in parts:
            all_known = all_known & p.isNotNull()
        return F.when(all_known, F.xxhash64(F.lit(tag), *([which] if which is not None else []), *parts))

    keys = [key("n", None, block, c("number"))]
    for w in both(c("number").isNull()):
        keys += [key("m", w, block, x) for x in cells] + [key("tb", w, block, c("term"), c("batch")), key("td", w, block, c("term"), c("day2"))]
    if soft:
        for w in both(block.isNull()):
            keys += [key("sm", w, x, c("day2")) for x in cells] + [key("sn", w, c("number"), c("term"), c("day2"))]
    return e.filter(c("side") == side).select("entity", F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("key"))


def candidates(e: DataFrame) -> DataFrame:
    """(left, right) entities that share a key."""
    unknown = F.col("year").isNull() | F.col("place").isNull() | F.col("family").isNull()
    soft = not e.filter(unknown).isEmpty()  # without such entities the loose keys would pair nothing
    a, b = _keys(e, 0, soft), _keys(e, 1, soft)
    return a.select("key", F.col("entity").alias("left")).join(b.select("key", F.col("entity").alias("right")), "key").select("left", "right").distinct()


def weighed(pairs: DataFrame, e: DataFrame, r: Rules) -> DataFrame:
    """(left, right, pro, con, coded, like): the rules that speak about one link alone, added up."""
    side = lambda k, p: e.filter(F.col("side") == k).select(*[F.col(c).alias(f"{p}_{c}") for c in ("entity", *ATTRIBUTES, "coded")])
    x = pairs.join(side(0, "l"), F.col("left") == F.col("l_entity")).join(side(1, "r"), F.col("right") == F.col("r_entity"))
    a, b = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))
    unit = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    alike = lambda c: 1 - F.levenshtein(a(c), b(c)) / F.greatest(F.length(a(c)), F.length(b(c)), F.lit(1))
    equal = lambda c: (a(c) == b(c)).cast("double")
    off = F.abs(F.log(F.when(a("amount") > 0, a("amount"))) - F.log(F.when(b("amount") > 0, b("amount"))))
    # degree (null: no evidence), weight for, weight against
    rules = [
        (equal("number"), r.number, r.number_not), (equal("kind"), 0.0, r.kind_not), (equal("year"), 0.0, r.year_not), (unit(2 * alike("place") - 1), r.place, r.place_not),
        (unit(alike("name") / 0.5 - 0.4), r.name, r.name_not), (unit(1.5 - off / 0.02), r.amount, r.amount_not), (equal("term"), r.term, r.term_not), (equal("batch"), r.batch, r.batch_not),
        *[(unit(1.6 - F.abs(a(d) - b(d)) / 5), r.day / 2, r.day_not / 2) for d in ("day1", "day2")],
    ]
    pro = sum((F.coalesce(plus * d, F.lit(0.0)) for d, plus, _ in rules), F.lit(0.0)) * F.when(a("number").isNotNull() & b("number").isNotNull(), 1.0).otherwise(r.unnumbered)
    con = sum((F.coalesce(minus * (1 - d), F.lit(0.0)) for d, _, minus in rules), F.lit(r.prior))
    told = ["year", "place", "family", "kind", "number", "term"]
    like = F.when(b("year").isNotNull() & b("place").isNotNull() & b("kind").isNotNull() & b("number").isNotNull(), F.xxhash64(*[b(c) for c in told]))
    return x.select("left", "right", pro.alias("pro"), con.alias("con"), b("coded").alias("coded"), like.alias("like"))


def confident(links: DataFrame, r: Rules) -> DataFrame:
    """(left, right, confidence) of every candidate link."""
    per = lambda c: links.groupBy(c).agg((F.count(F.lit(1)) == 1).alias(f"only_{c}"))
    x = cut(links.join(per("left"), "left").join(per("right"), "right"))
    alone = F.col("only_left") & F.col("only_right")
    out = x.filter(alone).select("left", "right", (F.col("pro") / (F.col("pro") + F.col("con"))).alias("confidence"))
    rest = x.filter(~alone).drop("only_left", "only_right")
    if rest.isEmpty():
        return out
    label = components(rest.select(F.col("left").alias("a"), F.col("right").alias("b")))
    rest = rest.join(label.select(F.col("node").alias("left"), "component"), "left")
    size = rest.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rest = cut(rest.join(size, "component"))
    total, largest = rest.agg(F.count(F.lit(1)), F.max("size")).first()
    tasks = total // r.bucket + 1
    near = rest.filter(F.col("size") <= r.component).withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(tasks)))
    out = out.unionByName(near.groupBy("bucket").applyInPandas(lambda pdf: solve_bucket(pdf, r), "left long, right long, confidence double"))
    if largest > r.component:
        out = out.unionByName(solve_spread(rest.filter(F.col("size") > r.component).drop("size", "component"), r))
    return out


def link_entities(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_described: dict[str, Column], right_described: dict[str, Column], rules: Rules = Rules()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links: left, right, confidence; members: side, entity, row_id; entities).

    Descriptions are columns year, place, family, kind, number, term, amount, batch, day1,
    day2, name, code. Nulls are no evidence; a row without any known key links to nothing;
    empty tables give no rows. Links are between entities: copies aren't paired.
    """
    rows = cut(described(left, left_id, left_described, 0).unionByName(described(right, right_id, right_described, 1)))
    e = cut(entities(rows))
    links = confident(weighed(candidates(e), e, rules), rules).filter(F.col("confidence") >= rules.accept)
    return links, rows.select("side", "entity", "row_id"), e


def link(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_described: dict[str, Column], right_described: dict[str, Column], rules: Rules = Rules()) -> DataFrame:
    """(left_id, right_id, confidence): row pairs that mean the same thing, repeated rows included."""
    links, member, _ = link_entities(left, right, left_id, right_id, left_described, right_described, rules)
    of = lambda k, entity, row: member.filter(F.col("side") == k).select(F.col("entity").alias(entity), F.col("row_id").alias(row))
    return links.join(of(0, "left", "left_id"), "left").join(of(1, "right", "right_id"), "right").select("left_id", "right_id", "confidence")


# ---------------------------------------------------------------- bonds


def _family(code: Column) -> Column:
    return F.when(code == "new_general", "G").when(code == "new_special", "S").when(code == "refinancing", "R")


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def day(c: Column) -> Column:
    """Days since 1970 of a date written in any usual notation."""
    t = F.translate(fold(c.cast("string")), "年月/.日", "----")
    return F.unix_date(F.coalesce(F.try_to_date(F.substring_index(t, "-", 3), "yyyy-M-d"), F.try_to_date(t, "yyyyMMdd")))


NUMERAL = "一二三四五六七八九十百零"


def core(name: Column) -> Column:
    """A name without what other attributes tell: numbers, brackets, batch, common words."""
    return F.nullif(F.regexp_replace(name, rf"[\d\s()（）\-—·,，年度政府]+|第?[{NUMERAL}]*[期批]", ""), F.lit(""))


def _where(title: Column, name: Column) -> tuple[Column, Column]:
    pattern = r"(\d{4})年度?(.+?)(?:政府|再融资|一般|专项)"
    usable = F.coalesce(F.when(title.rlike(pattern), title), name)
    return _first(usable, pattern), _first(usable, pattern, 2)


def described_announcement() -> dict[str, Column]:
    from bondlake.functions.numerals import numeral

    title, name = fold(F.col("title")), fold(F.col("bond_name"))
    year, where = _where(title, name)
    family = _family(F.col("category_code"))
    refi = F.coalesce(F.col("category_subtype"), _first(name, "(专项|一般)"))
    return {
        "year": year, "place": where, "family": family, "kind": F.when(family != "R", family).when(refi == "专项", "RS").when(refi == "一般", "RG"),
        "number": F.coalesce(F.col("issue_no"), numeral(_first(name, rf"[（(]第?([{NUMERAL}\d]+)期[）)]"))), "term": _first(F.col("term"), r"(\d+)"), "amount": F.col("total_amount_yi"),
        "batch": F.coalesce(F.col("batch_no"), numeral(_first(title, rf"第([{NUMERAL}\d]+)批"))), "day1": F.unix_date("bid_date"), "day2": F.unix_date("payment_date"), "name": core(name),
    }


def described_result() -> dict[str, Column]:
    from bondlake.functions.numerals import numeral

    title, name = fold(F.col("title")), fold(F.col("bond_name"))
    short = fold(real_value(F.col("bond_short_name")))
    year, where = _where(title, name)
    family = _family(F.col("category_code"))
    # special or general, by the word that stands last in either name
    both = F.concat_ws(" ", name, short)
    kind = F.when(both.rlike("再专|再融资专|专.债"), "RS").when(both.rlike("再一|再融资一|一.债|般债"), "RG")
    # the last number before 期 counts, else the one that ends the short name
    numbers = F.regexp_extract_all(name, F.lit(rf"([{NUMERAL}\d]+)期"), F.lit(1))
    amount = F.coalesce(F.col("total_amount_yi"), F.col("new_amount_yi"), F.col("refi_amount_yi"), F.col("swap_amount_yi"))
    return {
        "year": year, "place": where, "family": family, "kind": F.when(family != "R", family).otherwise(kind),
        "number": F.coalesce(numeral(F.try_element_at(numbers, F.lit(-1))), _first(short, r"\D(\d{1,3})$").cast("int")), "term": _first(F.col("term"), r"(\d+)"), "amount": amount,
        "batch": numeral(_first(F.coalesce(fold(F.col("batch_label")), name), rf"第([{NUMERAL}\d]+)批")), "day1": day(F.col("issue_date")), "day2": day(F.col("value_date")), "name": core(F.coalesce(name, short)), "code": bond_key(F.col("bond_code")),
    }
