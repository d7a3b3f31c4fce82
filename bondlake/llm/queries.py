"""The queries of the operators in this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from bondlake.llm.leaks import leaked
from bondlake.llm.linkage import described, described_announcement, described_result, link, link_entities
from bondlake.llm.lookalike import HAN_LIKE, fold, folds, repair_columns
from bondlake.llm.nearest import nearest
from bondlake.llm.packing import fill, pack
from bondlake.llm.pagenoise import find_noise, repair_text
from bondlake.llm.survivor import PLACEHOLDERS, bond_key, survivors
from bondlake.llm.tables import table
from bondlake.llm.truncation import cut_scores, cut_share

SURVIVOR_FIELDS = ["bond_short_name", "coupon_rate_pct", "total_amount_yi", "value_date", "payment_freq"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_noise(table(spark, sf_dir, "pdf_extract"), "pdf_id").withColumnRenamed("row_id", "pdf_id")


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_text(table(spark, sf_dir, "pdf_extract"), "pdf_id").withColumnRenamed("row_id", "pdf_id")


def _bonds(spark: SparkSession, sf_dir: str):
    anns, results = table(spark, sf_dir, "state_announcements"), table(spark, sf_dir, "state_results")
    return anns, results, "ann_id", "result_id", described_announcement(), described_result()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(*_bonds(spark, sf_dir)).select(F.col("left_id").alias("ann_id"), F.col("right_id").alias("result_id"))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between entities, each named by its smallest row id; the rows of an entity are those of p3_members."""
    links, _, e = link_entities(*_bonds(spark, sf_dir))
    side = lambda c, name, rows: e.select(F.col("entity").alias(c), F.col("first").alias(name), F.col("rows").alias(rows))
    x = links.join(side("left", "ann_id", "ann_rows"), "left").join(side("right", "result_id", "result_rows"), "right")
    return x.select("ann_id", "result_id", F.round("confidence", 3).alias("confidence"), "ann_rows", "result_rows")


def p3_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of either table with the smallest row id of its entity."""
    anns, results, left_id, right_id, left, right = _bonds(spark, sf_dir)
    rows = described(anns, left_id, left, 0).unionByName(described(results, right_id, right, 1)).select("entity", "row_id")
    return rows.join(rows.groupBy("entity").agg(F.min("row_id").alias("first")), "entity").select(F.col("first").alias("entity_id"), "row_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    anns, plans = table(spark, sf_dir, "state_announcements"), table(spark, sf_dir, "state_plans")
    pairs = nearest(anns, plans, "ann_id", "plan_id", (fold(F.col("province")), fold(F.col("province"))), (F.col("bid_date"), F.col("covered_period_start")), 20)
    return pairs.select(F.col("right_id").alias("plan_id"), F.col("left_id").alias("ann_id"))


def _survivors(spark: SparkSession, sf_dir: str, weighting: str) -> DataFrame:
    rows = table(spark, sf_dir, "state_results")
    method = F.when(F.col("extraction_method") == "text", 0).when(F.col("extraction_method") == "ocr", 1).otherwise(2)
    newest = F.coalesce(-F.unix_date("pub_date"), F.lit(2**31 - 1))
    return survivors(rows, "result_id", bond_key(F.col("bond_code")), SURVIVOR_FIELDS, [method, newest], weighting, 3 - method)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir, "lexicographic").select("group_id", "field", F.col("row_id").alias("result_id"))


def p5_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors by vote: a row of the text layer has three votes, one of recognition two, any other one."""
    return _survivors(spark, sf_dir, "votes").select("group_id", "field", "value", F.col("row_id").alias("result_id"))


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_columns((table(spark, sf_dir, "state_announcements"), "ann_id", ["bond_name", "province"]), (table(spark, sf_dir, "state_results"), "result_id", ["bond_short_name"]))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir).select("row_id", "field")


def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir)


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_capacity"), "doc_id")
    return packed.withColumnRenamed("row_id", "doc_id")


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(p7_containers(spark, sf_dir), table(spark, sf_dir, "pack_capacity"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"), "doc_id", "item_id")
    return found.select("item_id", "doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_scores(table(spark, sf_dir, "documents"), "doc_id").filter("cut").select(F.col("row_id").alias("doc_id"))


def p9_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_share(cut_scores(table(spark, sf_dir, "documents"), "doc_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_repaired, p3_found, p3_links, p3_members, p4_found, p5_found, p5_consensus, p6_found, p6_repaired, p7_containers, p7_fill, p8_found, p9_found, p9_share)}


def _sql_fold(column: str) -> str:
    f = folds() | HAN_LIKE
    return f"regexp_replace(translate({column}, '{''.join(f)}', '{''.join(f.values())}'), '[\\p{{Cf}}\\p{{Cc}}\\p{{Z}}\\x{{fe00}}-\\x{{fe0f}}\\x{{3164}}\\x{{34f}}\\x{{180e}}]+', '', 'g')"


def _sql_real(column: str) -> str:
    names = ", ".join("'" + p.replace("'", "''") + "'" for p in PLACEHOLDERS)
    return f"(trim(coalesce({column}::varchar, '')) <> '' and lower(trim({column}::varchar)) not in ({names}))"


ORACLES: dict[str, str] = {
    "p4_found": f"""
        with a as (select ann_id, bid_date, {_sql_fold("province")} e from state_announcements where bid_date is not null and province is not null),
        p as (select plan_id, covered_period_start s, {_sql_fold("province")} e from state_plans where covered_period_start is not null and province is not null)
        select plan_id, ann_id from a join p using (e) where abs(bid_date - s) <= 20
        qualify row_number() over (partition by ann_id order by abs(bid_date - s), s, plan_id) = 1""",
    "p5_found": r"""
        with c as (select *, regexp_replace(regexp_replace(upper(translate(bond_code, '０１２３４５６７８９', '0123456789')), '[\s\p{Z}]+', '', 'g'), '\.(SH|SZ|IB)$', '') k0 from state_results),
        k as (select *, case when k0 = '' then null else lpad(k0, greatest(9, length(k0))::int, '0') end k from c),
        g as (select k, min(result_id) group_id from k where k is not null group by k having count(*) > 1),
        l as ("""
    + " union all ".join(f"select k, result_id, pub_date, extraction_method, '{f}' field from k where {_sql_real(f)}" for f in SURVIVOR_FIELDS)
    + """)
        select group_id, field, result_id from l join g using (k)
        qualify row_number() over (partition by group_id, field order by case extraction_method when 'text' then 0 when 'ocr' then 1 else 2 end, pub_date desc nulls last, result_id desc) = 1""",
}
