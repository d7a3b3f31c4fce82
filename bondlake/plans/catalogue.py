"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from bondlake import dims
from bondlake.functions import dates as D, text as X
from bondlake.functions.numerals import issue_range, numeral, spell
from bondlake.operators.cut import scratch
from bondlake.operators import extract as E, payloads as P, state as S, stats as A
from bondlake.operators.spikes import Field, flag_spikes
from bondlake.plans import tables as T
from bondlake.sources import pages as L

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def anns(spark: SparkSession, d: str) -> DataFrame:
    """Announcements with the derived columns of the statistics."""
    x = read(spark, d, "state_announcements")
    region = read(spark, d, "dim_region").select("province", "region", F.col("ord").alias("region_ord"))
    x = x.join(F.broadcast(region), "province", "left")  # a row per province: 37, fixed
    return x.withColumns({"weekday": D.weekday_label(F.col("bid_date")), "quarter": D.quarter_label(F.col("bid_date"))})


def valid(spark: SparkSession, d: str) -> DataFrame:
    return anns(spark, d).filter("category_code is not null")


# ---------------------------------------------------------------- gaps

GAP_SQL = """case when bid_date = pub_date then 0 when bid_date > pub_date then cb.cum - ca.cum end"""


@query("select ann_id, (bid_date - pub_date)::int as gap from state_announcements")
def natural_gap(spark, d):
    return read(spark, d, "state_announcements").select("ann_id", F.datediff("bid_date", "pub_date").alias("gap"))


@query(f"select ann_id, ({GAP_SQL})::int as gap from state_announcements left join dim_calendar ca on ca.d = pub_date left join dim_calendar cb on cb.d = bid_date")
def workday_gap(spark, d):
    x = read(spark, d, "state_announcements").select("ann_id", "pub_date", "bid_date")
    return D.with_workday_gap(x, read(spark, d, "dim_calendar"), "pub_date", "bid_date", "gap").select("ann_id", "gap")


@query("""select ann_id, (select count(*) from range(1, (bid_date - pub_date)::int + 1) r(i) where isodow(pub_date + i::int) < 6)::int as gap
          from state_announcements where bid_date >= pub_date""")
def workday_gap_crosscheck(spark, d):
    x = read(spark, d, "state_announcements").filter("bid_date >= pub_date")
    return x.select("ann_id", D.workdays_by_formula(F.col("pub_date"), F.col("bid_date")).alias("gap"))


@query(f"""select ann_id, case when abs(bid_date - pub_date) <= 60 then bid_date end as bid_date, case when abs(bid_date - pub_date) <= 60 then (bid_date - pub_date)::int end as gap,
          case when bid_date - pub_date < 0 and abs(bid_date - pub_date) <= 60 then '{E.NOTES["late"]}' when abs(bid_date - pub_date) > 60 then '{E.NOTES["far"]}' || (bid_date - pub_date)::int else '' end as note from state_announcements""")
def gap_sanity_clamp(spark, d):
    """The clamp of implausible gaps, at 60 days so that these tables have cases on both sides."""
    bid, gap, note = E.sane_gap(F.col("bid_date"), F.col("pub_date"), 60)
    return read(spark, d, "state_announcements").select("ann_id", bid.alias("bid_date"), gap.alias("gap"), note.alias("note"))


# ---------------------------------------------------------------- lead statistics


def _stats_sql(keys: str, where: str = "category_code is not null", extra: str = "") -> str:
    per = ", ".join(
        f"round_even(avg({c}) * 100, 0) / 100 as {n}_mean, median({c}) as {n}_median, max({c}) as {n}_max, min({c}) as {n}_min" for c, n in (("natural_day_gap", "natural"), ("workday_gap", "workday"))
    )
    return f"""with a as (select s.*, r.region, r.ord as region_ord, ['周一','周二','周三','周四','周五','周六','周日'][isodow(bid_date)] as weekday, year(bid_date) || 'Q' || quarter(bid_date) as quarter
        from state_announcements s left join dim_region r using (province) where {where})
        select {keys}, count(*) as n, {per} {extra} from a where {" and ".join(k.strip() + " is not null" for k in keys.split(","))} group by {keys}"""


@query(_stats_sql("category_label, term"))
def lead_stats_by_term_category(spark, d):
    return A.lead_by(valid(spark, d), "category_label", "term")


@query(_stats_sql("category_label"))
def lead_stats_by_category(spark, d):
    return A.lead_by(valid(spark, d), "category_label")


@query(_stats_sql("term", "natural_day_gap is null and workday_gap is null"))
def lead_stats_all_null_group(spark, d):
    """Groups without any gap: they count, and every statistic is null."""
    return A.lead_by(anns(spark, d).filter("natural_day_gap is null and workday_gap is null"), "term")


@query(_stats_sql("province"))
def lead_stats_by_province(spark, d):
    return A.lead_by(valid(spark, d), "province")


@query(_stats_sql("province, category_label"))
def lead_stats_by_province_category(spark, d):
    return A.lead_by(valid(spark, d), "province", "category_label")


@query(_stats_sql("region, region_ord"))
def lead_stats_by_region(spark, d):
    return A.lead_by(valid(spark, d), "region", "region_ord").orderBy("region_ord")


@query(_stats_sql("region, category_label"))
def lead_stats_by_region_category(spark, d):
    return A.lead_by(valid(spark, d), "region", "category_label")


@query(_stats_sql("weekday"))
def lead_stats_by_weekday(spark, d):
    return A.lead_by(valid(spark, d), "weekday")


@query(_stats_sql("quarter"))
def lead_stats_by_quarter(spark, d):
    return A.lead_by(valid(spark, d), "quarter")


@query("""with w as (select ['周一','周二','周三','周四','周五','周六','周日'][isodow(bid_date)] as weekday, count(*) n from state_announcements where bid_date is not null and category_code is not null group by 1)
          select weekday, n, round(100.0 * n / sum(n) over (), 4) as share_pct from w""")
def weekday_share(spark, d):
    return A.with_share(valid(spark, d).dropna(subset=["weekday"]).groupBy("weekday").agg(F.count(F.lit(1)).alias("n")))


@query(f"select * from ({_stats_sql('quarter')}) where workday_mean - workday_median > 0.5 and (select count(distinct year(bid_date) || 'Q' || quarter(bid_date)) from state_announcements where category_code is not null) >= 4")
def skewed_quarters(spark, d):
    """Mean above median by more than half a day, which these tables have cases of."""
    return A.skewed_quarters(lead_stats_by_quarter(spark, d), above=0.5)


@query("select ann_id, province, workday_gap from state_announcements where workday_gap < 5")
def low_anomalies(spark, d):
    return A.low_anomalies(read(spark, d, "state_announcements")).select("ann_id", "province", "workday_gap")


@query("select ann_id, workday_gap from state_announcements where workday_gap < 5 order by workday_gap, ann_id limit 50")
def low_anomalies_top50(spark, d):
    return A.low_anomalies(read(spark, d, "state_announcements")).select("ann_id", "workday_gap").orderBy("workday_gap", "ann_id").limit(50)


@query("""select count(*) filter (workday_gap < 5) as anomalies, count(category_code) as valid_rows, round(100.0 * count(*) filter (workday_gap < 5) / greatest(count(category_code), 1), 4) as rate_pct from state_announcements""")
def anomaly_rate(spark, d):
    return A.anomaly_rate(read(spark, d, "state_announcements"))


@query("select ann_id, workday_gap from state_announcements where workday_gap > 30 order by workday_gap desc, ann_id limit 20")
def high_outliers_top20(spark, d):
    return A.high_outliers(read(spark, d, "state_announcements")).select("ann_id", "workday_gap").orderBy(F.desc("workday_gap"), "ann_id").limit(20)


@query("select province, count(*) as n from state_announcements where category_code is not null and province is not null group by 1 order by n desc, province limit 15")
def top15_provinces(spark, d):
    return read(spark, d, "state_announcements").filter("category_code is not null").dropna(subset=["province"]).groupBy("province").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "province").limit(15)


@query("select province, count(*) as n from state_announcements where workday_gap > 30 and province is not null group by 1 order by n desc, province limit 1")
def modal_province_of_outliers(spark, d):
    return A.mode_of(A.high_outliers(read(spark, d, "state_announcements")), "province")


@query("""with b as (select term, count(*) n, quantile_cont(workday_gap, 0.25) q1, quantile_cont(workday_gap, 0.5) as median, quantile_cont(workday_gap, 0.75) q3 from state_announcements where workday_gap is not null and term is not null group by 1)
          select b.*, w.whisker_low, w.whisker_high, w.fliers from b join (select a.term, min(workday_gap) filter (workday_gap between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_low, max(workday_gap) filter (workday_gap between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_high,
            count(*) filter (not (workday_gap between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as fliers from state_announcements a join b using (term) where workday_gap is not null group by 1) w using (term)""")
def boxplot_stats(spark, d):
    return A.boxplot(read(spark, d, "state_announcements"), "workday_gap", "term")


# ---------------------------------------------------------------- plans and calendar

LEAD_SQL = """with m as (select p.plan_id, p.province, p.pub_date as plan_pub_date, (a.bid_date - p.pub_date)::int as days, case when a.bid_date = p.pub_date then 0 when a.bid_date > p.pub_date then cb.cum - ca.cum end as work
    from state_plans p join state_announcements a on p.province = a.province and a.bid_date between p.covered_period_start and p.covered_period_end
    left join dim_calendar ca on ca.d = p.pub_date left join dim_calendar cb on cb.d = a.bid_date where p.pub_date is not null)
    select plan_id, province, plan_pub_date, count(*) as n, min(days) as natural_min, max(days) as natural_max, round_even(avg(days) * 10, 0) / 10 as natural_mean, min(work)::int as workday_min, max(work)::int as workday_max, round_even(avg(work) * 10, 0) / 10 as workday_mean from m group by 1, 2, 3"""


@query(LEAD_SQL)
def plan_actual_range_join(spark, d):
    return A.plan_lead(read(spark, d, "state_plans"), read(spark, d, "state_announcements"), read(spark, d, "dim_calendar"))


@query(LEAD_SQL + " order by plan_id limit 30")
def plan_lead_top30(spark, d):
    return plan_actual_range_join(spark, d).orderBy("plan_id").limit(30)


def _month():
    return F.lit("2022-04-01").cast("date")


SUMS = "round(sum(coalesce(plan_general_amount_yi, 0)), 2) as general, round(sum(coalesce(plan_special_amount_yi, 0)), 2) as special, round(sum(coalesce(plan_refinancing_amount_yi, 0)), 2) as refi"
PROVINCE_SQL = f"select province, {SUMS}, round(sum(coalesce(plan_general_amount_yi, 0)) + sum(coalesce(plan_special_amount_yi, 0)) + sum(coalesce(plan_refinancing_amount_yi, 0)), 2) as total from state_plans where covered_period_start = date '2022-04-01' and province is not null group by 1"


@query(PROVINCE_SQL)
def plan_month_by_province(spark, d):
    return A.month_by_province(A.month_slice(read(spark, d, "state_plans"), _month()))


@query(f"""with p as (select r.region, {SUMS} from state_plans s join dim_region r using (province) where covered_period_start = date '2022-04-01' group by 1)
           select region, ord, coalesce(general, 0.0) as general, coalesce(special, 0.0) as special, coalesce(refi, 0.0) as refi from (select distinct region, ord from dim_region) left join p using (region)""")
def plan_month_by_region_reindexed(spark, d):
    return A.month_by_region(A.month_slice(read(spark, d, "state_plans"), _month()), read(spark, d, "dim_region"))


@query("select max(pub_date) as as_of from state_plans where covered_period_start = date '2022-04-01'")
def plan_as_of(spark, d):
    return A.month_slice(read(spark, d, "state_plans"), _month()).agg(F.max("pub_date").alias("as_of"))


@query(f"select count(*) as covered, round(sum(total), 1) as total_yi from ({PROVINCE_SQL}) having count(*) > 0")
def plan_month_totals(spark, d):
    x = P.month_payload(read(spark, d, "state_plans"), read(spark, d, "dim_region"), 37, _month())
    return x.select(F.col("covered").cast("long").alias("covered"), F.col("totalYi").alias("total_yi"))


@query()
def month_payload_json(spark, d):
    return P.month_json(P.month_payload(read(spark, d, "state_plans"), read(spark, d, "dim_region"), 37, _month()))


ISSUE_SQL = r"""results as (select *, coalesce(try_strptime(regexp_replace(regexp_replace(trim(issue_date), '[年月/.]', '-', 'g'), '日$', ''), '%Y-%m-%d')::date, case when regexp_matches(trim(issue_date), '^\d{8}$') then try_strptime(trim(issue_date), '%Y%m%d')::date end) as issued from state_results)"""


def _results(spark, d):
    return read(spark, d, "state_results").withColumn("issue_date", D.any_date(F.col("issue_date")))


@query(f"with {ISSUE_SQL} select result_id, issued as issue_date from results")
def issue_date_notations(spark, d):
    return _results(spark, d).select("result_id", "issue_date")


@query(f"with {ISSUE_SQL} select date_trunc('month', max(issued))::date as month_start, last_day(max(issued)) as month_end, max(issued) as as_of from results")
def latest_month(spark, d):
    return P.latest_month(_results(spark, d))


@query(f"""with {ISSUE_SQL}, m as (select date_trunc('month', max(issued))::date s, last_day(max(issued)) e from results)
           select strftime(issued, '%Y-%m-%d') as day, count(*) as n, round(coalesce(sum(total_amount_yi), 0), 1) as amount_yi from results, m where issued between s and e group by 1""")
def latest_month_calendar(spark, d):
    return P.calendar_days(_results(spark, d)).drop("bonds")


@query(f"""with {ISSUE_SQL}, m as (select date_trunc('month', max(issued))::date s, last_day(max(issued)) e from results)
           select strftime(issued, '%Y-%m-%d') as day, list(coalesce(bond_short_name, bond_name) order by -total_amount_yi nulls last, coalesce(bond_short_name, bond_name) nulls first, province nulls first, term nulls first, result_id) as bonds from results, m where issued between s and e group by 1""")
def calendar_bonds_nested(spark, d):
    return P.calendar_days(_results(spark, d)).select("day", F.transform("bonds", lambda b: b["bondShortName"]).alias("bonds"))


@query()
def calendar_payload_json(spark, d):
    x = P.calendar_payload(_results(spark, d))
    return x.select("monthLabel", F.to_json(F.struct(*x.columns), {"ignoreNullFields": "false"}).alias("json"))


#: The public holiday schedule of 2024 from May.
OFF_2024 = ["2024-05-01", "2024-05-02", "2024-05-03", "2024-06-10", "2024-09-16", "2024-09-17", "2024-10-01", "2024-10-02", "2024-10-03", "2024-10-04", "2024-10-07"]
ON_2024 = ["2024-04-28", "2024-05-11", "2024-09-14", "2024-09-29", "2024-10-12"]


@query(f"""with h as (select unnest({OFF_2024})::date d), m as (select unnest({ON_2024})::date d), hk as (select d, row_number() over (order by d) k from h), mk as (select d, row_number() over (order by d) k from m)
          select hk.d as holiday, mk.d as makeup, k::int as k from hk full join mk using (k)""")
def holiday_makeup_lists(spark, d):
    """Weekdays off and weekend days worked of a calendar with holidays, side by side."""
    from datetime import date

    days = lambda xs: [date.fromisoformat(x) for x in xs]
    c = dims.calendar(spark, date(2024, 1, 1), date(2024, 12, 31), days(OFF_2024), days(ON_2024))
    w = W.orderBy("d")
    off = c.filter((F.weekday("d") < 5) & ~F.col("is_workday")).select(F.col("d").alias("holiday"), F.row_number().over(w).alias("k"))
    on = c.filter((F.weekday("d") >= 5) & F.col("is_workday")).select(F.col("d").alias("makeup"), F.row_number().over(w).alias("k"))
    return off.join(on, "k", "full").select("holiday", "makeup", "k")


@query("""select coalesce(least(min(pub_date), min(bid_date)) - 10, date '2015-01-01')::date as first_day, coalesce(greatest(max(pub_date), max(bid_date)) + 30, date '2026-12-31')::date as last_day from state_announcements""")
def calendar_window(spark, d):
    x = read(spark, d, "state_announcements").agg(F.least(F.min("pub_date"), F.min("bid_date")).alias("a"), F.greatest(F.max("pub_date"), F.max("bid_date")).alias("b"))
    return x.select(F.coalesce(F.date_sub("a", 10), F.lit("2015-01-01").cast("date")).alias("first_day"), F.coalesce(F.date_add("b", 30), F.lit("2026-12-31").cast("date")).alias("last_day"))


# ---------------------------------------------------------------- state


@query("select max(ann_id) as ann_id, url, issue_no, term from state_announcements group by url, issue_no, term")
def dedup_keep_last_null_key(spark, d):
    return S.keep_last(read(spark, d, "state_announcements").select("ann_id", "url", "issue_no", "term"), S.ANNOUNCEMENT_KEYS, "ann_id")


@query("select max(plan_id) as plan_id, url from state_plans group by url")
def dedup_by_url(spark, d):
    return S.keep_last(read(spark, d, "state_plans").select("plan_id", "url"), S.PLAN_KEYS, "plan_id")


@query("select max(result_id) as result_id from state_results group by coalesce('c:' || bond_code, 'u:' || url)")
def split_dedup_coded_uncoded(spark, d):
    return S.keep_last(read(spark, d, "state_results").select("result_id", "bond_code", "url"), [S.result_key()], "result_id").select("result_id")


@query("""select plan_id, url, province, pub_date from state_plans where plan_id % 2 = 0 union all select plan_id, url, null, null from state_plans where plan_id % 2 = 1""")
def merge_append_align(spark, d):
    """A batch without two of the columns appended to a state: the missing ones are null."""
    p = read(spark, d, "state_plans").select("plan_id", "url", "province", "pub_date")
    return S.append(p.filter("plan_id % 2 = 0"), p.filter("plan_id % 2 = 1").select("url", "plan_id"))


@query("""select ann_id, url from state_announcements a where not exists (select 1 from state_announcements s where s.pub_date < date '2022-01-01' and s.url = a.url) order by ann_id, url limit 25""")
def seen_url_antijoin_limit(spark, d):
    a = read(spark, d, "state_announcements").select("ann_id", "url", "pub_date")
    return S.first_new(a.select("ann_id", "url"), a.filter("pub_date < date '2022-01-01'"), "ann_id", 25)


@query("select distinct url from state_results")
def distinct_urls(spark, d):
    return read(spark, d, "state_results").select("url").distinct()


PAGES_VALUES = "(1,'a',true),(2,'b',true),(2,'c',true),(3,'d',false),(4,'e',true),(5,'f',true),(6,'g',true),(8,'h',true),(9,'i',true),(9,'j',true),(10,'k',false),(11,'l',true)"


@query(f"select * from (values {PAGES_VALUES}) t(page_no, url, seen) where page_no <= 9")
def crawl_early_stop(spark, d):
    """Five stale pages in a row (4, 5, 6, 8, 9; page 7 was empty) stop the crawl after page 9."""
    items = spark.sql(f"select * from values {PAGES_VALUES} t(page_no, url, seen)")
    return S.early_stop(items, target=100)


@query(f"select * from (values {PAGES_VALUES}) t(page_no, url, seen) where page_no <= 3")
def crawl_target_met(spark, d):
    return S.early_stop(spark.sql(f"select * from values {PAGES_VALUES} t(page_no, url, seen)"), target=1)


@query(f"select page_no, bool_and(seen) as all_seen from (values {PAGES_VALUES}) t(page_no, url, seen) group by 1")
def page_fully_seen(spark, d):
    return spark.sql(f"select * from values {PAGES_VALUES} t(page_no, url, seen)").groupBy("page_no").agg(F.bool_and("seen").alias("all_seen"))


@query("select coalesce(extraction_method, 'none') as method, count(*) as n from state_announcements group by 1")
def extraction_method_counts(spark, d):
    return read(spark, d, "state_announcements").groupBy(F.coalesce("extraction_method", F.lit("none")).alias("method")).agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) filter (extraction_method = 'text') as text, count(*) filter (extraction_method = 'ocr') as ocr, count(*) filter (extraction_method = 'failed') as failed, count(*) filter (length(warnings) > 0) as warned from state_announcements")
def report_counts(spark, d):
    m = F.col("extraction_method")
    return read(spark, d, "state_announcements").agg(*[F.count_if(m == v).alias(v) for v in ("text", "ocr", "failed")], F.count_if(F.length("warnings") > 0).alias("warned"))


LISTED = "(select url, max(title) as title, max(pub_date) as pub_date, max(source_name) as source_name, 'announcement' as doc_type from state_announcements group by url)"


def _listed(spark, d):
    x = read(spark, d, "state_announcements")
    return x.groupBy("url").agg(*[F.max(c).alias(c) for c in ("title", "pub_date", "source_name")]).withColumn("doc_type", F.lit("announcement"))


@query(f"select case when method is null then 'no_attachment' when method = 'failed' then 'error' else 'included' end as bucket, count(*) as n from {LISTED} l left join pdf_extract p using (url) group by 1")
def status_buckets(spark, d):
    x = E.dispatched(_listed(spark, d), read(spark, d, "pdf_extract"), read(spark, d, "dim_calendar"))["status"]
    return x.groupBy(F.split_part("status", F.lit(":"), F.lit(1)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"""with docs as (select l.*, p.text, p.tables, p.method from {LISTED} l join pdf_extract p using (url)),
    t as (select url, unnest(tables) as tab from docs where method = 'text'), r as (select url, tab[1] as head, unnest(tab[2:]) as row from t where len(tab) >= 2),
    c as (select url, row[list_position(head, '债券名称')] as name, coalesce(row[list_position(head, '期限')], '') as term, coalesce(row[list_position(head, '面值（亿元）')], '') as amount from r where list_contains(head, '期限') and list_contains(head, '面值（亿元）') and len(list_filter(row, lambda x: x is not null)) > 0),
    rows as (select url, nullif(name, '') as bond_name, try_cast(nullif(regexp_extract(term, '(\d{{1,2}})\s*年', 1), '') as int)::varchar || 'Y' as term, try_cast(nullif(regexp_extract(replace(amount, ',', ''), '([\d,]+\.?\d*)', 1), '') as double) as amount from c where term <> '' or amount <> ''),
    every as (select url, bond_name, term, amount, 'tranche' as kind from rows union all select url, null, null, null, case when method = 'failed' then 'failed' else 'document' end from docs where url not in (select url from rows))
    select url, kind, d.title, d.pub_date, d.method as extraction_method, bond_name, term, case when kind = 'tranche' then amount end as tranche_amount,
      case when contains(coalesce(case kind when 'tranche' then bond_name when 'document' then d.title end, ''), '再融资') then 'refinancing' when contains(coalesce(case kind when 'tranche' then bond_name when 'document' then d.title end, ''), '专项') then 'new_special' when contains(coalesce(case kind when 'tranche' then bond_name when 'document' then d.title end, ''), '一般') then 'new_general' end as category_code
    from every join docs d using (url)""")
def announcement_documents(spark, d):
    """Listed announcements through their documents to rows: the whole run, every document of the table."""
    rows = E.dispatched(_listed(spark, d), read(spark, d, "pdf_extract"), read(spark, d, "dim_calendar"))["announcements"]
    failed, merged = F.contains("warnings", F.lit(E.FAILED)), F.contains("warnings", F.lit(E.NOTES["merged"]))
    kind = F.when(failed, "failed").when(merged, "document").otherwise("tranche")
    return rows.select("url", kind.alias("kind"), "title", "pub_date", "extraction_method", "bond_name", "term", F.when(kind == "tranche", F.col("total_amount_yi")).alias("tranche_amount"), "category_code")


@query("""with urls as (select source_name as source, url, min(pub_date) as first, max(pub_date) as last from state_announcements group by 1, 2),
    items as (select source, url, ((row_number() over (partition by source order by last desc, url) - 1) // 5 + 1)::int as page_no, first < date '2022-01-01' as seen from urls),
    p as (select source, page_no, count(*) filter (not seen) as fresh from items group by 1, 2),
    q as (select *, fresh = 0 and page_no > 1 as stale, coalesce(sum(fresh) over (partition by source order by page_no rows between unbounded preceding and 1 preceding), 0) as before,
        sum((not (fresh = 0 and page_no > 1))::int) over (partition by source order by page_no) as island from p),
    s as (select *, case when stale then row_number() over (partition by source, island, stale order by page_no) else 0 end as length from q),
    z as (select *, coalesce(max((length >= 5)::int) over (partition by source order by page_no rows between unbounded preceding and 1 preceding), 0) as stopped from s)
    select source, page_no, url, seen from items join z using (source, page_no) where stopped = 0 and not (before >= 300 and page_no > 1)""")
def crawl_by_source(spark, d):
    """The documents of every source as its listing, five a page and the newest first; what came before 2022 has been seen. Each source stops by itself."""
    u = read(spark, d, "state_announcements").groupBy(F.col("source_name").alias("source"), "url").agg(F.min("pub_date").alias("first"), F.max("pub_date").alias("last"))
    place = F.row_number().over(W.partitionBy("source").orderBy(F.desc("last"), "url")) - 1
    items = u.select("source", "url", (F.floor(place / 5) + 1).cast("int").alias("page_no"), (F.col("first") < "2022-01-01").alias("seen"))
    return S.early_stop(items, target=300, source="source").select("source", "page_no", "url", "seen")


@query("""with m as (select date '2022-04-01' as s, 'current' as which union all select date '2022-05-01', 'next')
    select which, province, round(sum(coalesce(plan_general_amount_yi, 0)) + sum(coalesce(plan_special_amount_yi, 0)) + sum(coalesce(plan_refinancing_amount_yi, 0)), 2) as total from state_plans join m on covered_period_start = s where province is not null group by 1, 2""")
def plan_current_and_next_month(spark, d):
    """The month of an as-of date and the one after it."""
    both = A.current_and_next(read(spark, d, "state_plans"), F.lit("2022-04-18").cast("date"))
    return A.month_by_province(both["current"]).select(F.lit("current").alias("which"), "province", "total").unionByName(A.month_by_province(both["next"]).select(F.lit("next").alias("which"), "province", "total"))


@query("select ann_id as \"序号\", province as \"所属省份/计划单列市\", total_amount_yi as \"发行规模(亿元)\" from state_announcements")
def export_projection(spark, d):
    labels = {"ann_id": "序号", "province": "所属省份/计划单列市", "total_amount_yi": "发行规模(亿元)"}
    x = read(spark, d, "state_announcements")
    kinds = dict(x.dtypes)
    return x.select(*[(F.when(~F.isnan(c), F.col(c)) if kinds[c] == "double" else F.col(c)).alias(n) for c, n in labels.items()])


DICTIONARY = ["result_id", "bond_code", "bond_short_name", "bond_name", "bond_market_type", "province", "province_code", "category_code", "category_label", "term", "total_amount_yi", "coupon_rate_pct", "issue_date", "value_date", "payment_freq", "batch_label", "url"]


@query(f"select {', '.join(DICTIONARY)} from state_results where bond_code is not null")
def bond_dictionary(spark, d):
    return T.bond_dictionary(read(spark, d, "state_results"))[0].select(*DICTIONARY)


@query("""select ann_id, category_code, case category_code when 'new_general' then '一般新增债券' when 'new_special' then '专项新增债券' when 'refinancing' then '再融资债券' end as label from state_announcements""")
def category_label_lookup(spark, d):
    return read(spark, d, "state_announcements").select("ann_id", "category_code", X.category_label(F.col("category_code")).alias("label"))


@query("select result_id, title from state_results where extraction_method = 'unsupported_legacy_format'")
def legacy_results(spark, d):
    return read(spark, d, "state_results").filter("extraction_method = 'unsupported_legacy_format'").select("result_id", "title")


@query("select * from state_plans")
def state_schema_roundtrip(spark, d):
    """Written as a version of a state, sorted, and read back with its schema: codes stay strings, dates dates."""
    x = read(spark, d, "state_plans")
    path = scratch(spark)
    L.write_state(x, path, 0, ["pub_date", "plan_id"])
    return L.read_state(spark, path, x.schema)


@query("select max(ann_id) as seq, url, issue_no, term from state_announcements group by url, issue_no, term")
def streaming_merge_equals_batch(spark, d):
    """The announcements in three files, streamed in and merged: the same rows as the batch merge."""
    from bondlake.streaming.merging import merge_stream, merged

    x = read(spark, d, "state_announcements").select(F.col("ann_id").alias("seq"), "url", "issue_no", "term")
    base = scratch(spark)
    x.repartition(3).write.parquet(f"{base}/in")
    merge_stream(spark, f"{base}/in", x.schema, f"{base}/state", f"{base}/check", S.ANNOUNCEMENT_KEYS).awaitTermination()
    return merged(spark, f"{base}/state", x.schema)


# ---------------------------------------------------------------- pages

LISTING = """<html><div id="to-print1"><ul><li><a href=" /a.html " title="甲省公告">甲</a><span>2026-7-1</span></li><li><a href="/b.html">乙省 <b>公告</b></a></li>
<li>无链接</li><li><a href="/c.html">丙</a><span>发布 2026-02-30</span></ul></div><p>共 12 页</p></html>"""
ARTICLE = """<h1> 某省公告 </h1><div class="x secondPage-content-inf">来源 2026年7月2日</div><div class="content-txt"><p>第一段</p><p>第二段</p></div>
<div class="content-fj"><a href="/p/1.PDF" title="信息披露">x</a><a href="/p/2.doc">y</a><a href=" /p/3.pdf ">发行公开通知</a></div>"""


@query("select * from (values (0, '/a.html', '甲省公告', date '2026-07-01'), (1, '/b.html', '乙省公告', null), (2, '/c.html', '丙', null)) t(feed_pos, url, title, listing_pub_date)")
def listing_links(spark, d):
    return L.listing_items(spark.createDataFrame([(LISTING,)], "html string"))


@query("select * from (values ('u', '某省公告', date '2026-07-02', 2, true), ('v', null, null, 0, false)) t(url, title, pub_date, n_attachments, parse_ok)")
def article_pages(spark, d):
    x = L.articles(spark.createDataFrame([("u", ARTICLE), ("v", "<p>空</p>")], "url string, html string"))
    return x.select("url", "title", "pub_date", F.size("attachments").alias("n_attachments"), "parse_ok")


@query("select * from (values ('announcement', '/p/3.pdf'), ('plan', '/p/1.PDF'), ('result', '/p/1.PDF')) t(doc_type, url)")
def primary_attachment(spark, d):
    x = L.articles(spark.createDataFrame([("u", ARTICLE)], "url string, html string"))
    x = x.select("attachments", F.explode(F.array(*map(F.lit, ("announcement", "plan", "result")))).alias("doc_type"))
    return x.select("doc_type", E.primary_attachment(F.col("attachments"), F.col("doc_type"))["url"].alias("url"))


HTMLS = "('共 12 页'),('共3页 其他'),('无'),('共　7　页')"


@query(rf"select html, coalesce(try_cast(nullif(regexp_extract(html, '共[\s　]*(\d+)[\s　]*页', 1), '') as int), 1) as pages from (values {HTMLS}) t(html)")
def total_pages(spark, d):
    x = spark.sql(f"select * from values {HTMLS} t(html)")
    return x.select("html", L.total_pages(F.col("html")).alias("pages"))


@query(f"""select name, i::int as page_no, '{L.SITE}/zqsclb' || case when i > 1 then '_' || i else '' end || '.jhtml?ad_code=87&channelId=' || id as url from (values ('dfzfxjh', '192'), ('fxqgg', '193'), ('fxjg', '194')) c(name, id), range(1, 4) r(i)""")
def page_urls(spark, d):
    return L.page_urls(dims.channels(spark), F.lit(3))


@query("select distinct url, sha1(url) as key from state_announcements")
def url_cache_key(spark, d):
    return read(spark, d, "state_announcements").select("url").distinct().withColumn("key", L.cache_key(F.col("url")))


@query("select * from (values (1, true), (2, false), (3, false), (4, false), (5, false)) t(id, ok)")
def pdf_validity(spark, d):
    rows = [(1, b"%PDF-1.7 x %%EOF\n"), (2, b"%PDF-1.7"), (3, b""), (4, b"<html>%%EOF"), (5, b"%PDF" + b"%%EOF" + b" " * 3000)]
    return spark.createDataFrame(rows, "id int, content binary").select("id", L.is_valid_pdf(F.col("content")).alias("ok"))


@query("select * from (values (1, 'text'), (2, 'ocr'), (3, 'failed')) t(id, method)")
def method_decision(spark, d):
    rows = [(1, ["", " 文 "], ["x"]), (2, [" ", ""], ["字"]), (3, [], [" "])]
    return spark.createDataFrame(rows, "id int, pages array<string>, scans array<string>").select("id", E.method_of(F.col("pages"), F.col("scans")).alias("method"))


@query("select * from (values ('dfzfxjh', '192', 'plan'), ('fxqgg', '193', 'announcement'), ('fxjg', '194', 'result')) t(name, channel_id, doc_type)")
def channel_catalogue(spark, d):
    return dims.channels(spark).select("name", "channel_id", "doc_type")


# ---------------------------------------------------------------- scalars on fixtures


def _case(names: list[str], c: str) -> str:
    return "case " + " ".join(f"when contains({c}, '{n}') then '{n}'" for n in names) + " end"


TITLES = "('2019年新疆维吾尔自治区（新疆生产建设兵团）一般债券（三期）'),('2022年新疆生产建设兵团再融资一般债券'),('江苏省与北京市'),('新疆兵团2025年第三批'),(null),('')"


@query(f"select t, {_case(dims.PROVINCE_SEARCH, 't')} as province from (values {TITLES}) v(t)")
def province_first_match(spark, d):
    x = spark.sql(f"select * from values {TITLES} v(t)")
    return x.select("t", X.province(F.col("t"), F.lit("")).alias("province"))


@query("""select ann_id, case when contains(bond_name, '再融资') then 'refinancing' when contains(bond_name, '专项') then 'new_special' when contains(bond_name, '一般') then 'new_general' end as category,
          case when contains(bond_name, '再融资') then case when contains(bond_name, '专项') then '专项' when contains(bond_name, '一般') then '一般' end end as subtype from state_announcements""")
def classify_category(spark, d):
    n = F.col("bond_name")
    return read(spark, d, "state_announcements").select("ann_id", X.category(n).alias("category"), X.category_subtype(n).alias("subtype"))


@query("""select result_id, case when refi_amount_yi > 0 then 'refinancing' when new_amount_yi > 0 and contains(coalesce(bond_market_type, ''), '专项') then 'new_special' when new_amount_yi > 0 then 'new_general' when swap_amount_yi > 0 then 'refinancing' end as category from state_results""")
def result_category(spark, d):
    c = X.category_of_amounts(F.col("refi_amount_yi"), F.col("new_amount_yi"), F.col("swap_amount_yi"), F.col("bond_market_type"))
    return read(spark, d, "state_results").select("result_id", c.alias("category"))


@query("select * from (values ('十二', 12), ('一百零五', 105), ('三百四十', 340), ('7', 7), (' 二十 ', 20), ('甲', null), ('', null), ('九百九十九', 999), ('一百一十', 110), ('１２', 12)) t(s, n)")
def numeral_parse(spark, d):
    x = spark.sql("select * from values ('十二'),('一百零五'),('三百四十'),('7'),(' 二十 '),('甲'),(''),('九百九十九'),('一百一十'),('１２') t(s)")
    return x.select("s", numeral(F.col("s")).alias("n"))


@query("select i::int as n, true as ok from range(0, 1000) r(i)")
def numeral_round_trip(spark, d):
    x = spark.createDataFrame([(n, spell(n)) for n in range(1000)], "n int, s string")
    return x.select("n", (numeral(F.col("s")) == F.col("n")).alias("ok"))


@query("""select * from (values ('八至十期', [8, 9, 10]), ('一期至二期', [1, 2]), ('12-13期', [12, 13]), ('十二期', [12]), ('十三至十二期', [13, 12]), ('甲期', []::int[]), ('甲至三期', [3])) t(s, numbers)""")
def issue_range_expand(spark, d):
    x = spark.sql("select * from values ('八至十期'),('一期至二期'),('12-13期'),('十二期'),('十三至十二期'),('甲期'),('甲至三期') t(s)")
    return x.select("s", issue_range(F.col("s")).alias("numbers"))


@query(r"select result_id, try_cast(nullif(regexp_extract(term, '(\d{1,2})\s*年', 1), '') as int)::varchar || 'Y' as term_bucket from state_results")
def term_bucket(spark, d):
    return read(spark, d, "state_results").select("result_id", X.term_bucket(F.col("term")).alias("term_bucket"))


@query("select a.ann_id, t.term, t.ord from state_announcements a left join dim_term t on a.term = t.term")
def term_in_vocabulary(spark, d):
    """Terms outside the ordered vocabulary become null."""
    t = read(spark, d, "dim_term")
    a = read(spark, d, "state_announcements").select("ann_id", F.col("term").alias("t"))
    return a.join(F.broadcast(t), F.col("t") == F.col("term"), "left").select("ann_id", "term", "ord")


@query("select s, x::double as x from (values ('3. 28', 3.28), ('1,234.5', 1234.5), ('3.28%', 3.28), ('约12.5亿', 12.5), ('—', null), ('', null), (null, null)) t(s, x)")
def robust_float(spark, d):
    x = spark.sql("select * from values ('3. 28'),('1,234.5'),('3.28%'),('约12.5亿'),('—'),(''),(null) t(s)")
    return x.select("s", X.robust_float(F.col("s")).alias("x"))


PLAN_DOCS = [
    (1, "2026年8月某省发行计划", "表2-1\n时间 再融资债券计划发行规模\n8月 1,234.5\n时间 新增一般债券 新增专项债券\n8 月 100 20\n", "text"),
    (2, "2019年第三季度北京市发行计划", "时间 再融资债券计划发行规模\n三季度 5 6 11\n时间 新增一般债券 新增专项债券\n第三季度 100.0 200.5", "text"),
    (3, "发行计划", "2024年2月安排\n时间 再融资债券计划发行规模\n8月\n", "ocr"), (4, "2026年13月计划", "", "text"), (5, "2024年5月天津市", None, "failed"),
]


@query("""select * replace (refi::double as refi, general::double as general, special::double as special) from (values (1, null, 2026, 8, 8, date '2026-08-01', date '2026-08-31', 1234.5, 100.0, 20.0), (2, '北京市', 2019, 7, 9, date '2019-07-01', date '2019-09-30', 11.0, 100.0, 200.5),
    (3, null, 2024, 2, 2, date '2024-02-01', date '2024-02-29', null, null, null), (4, null, 2026, 13, 13, null, null, null, null, null), (5, '天津市', null, null, null, null, null, null, null, null)) t(id, province, y, m1, m2, s, e, refi, general, special)""")
def plan_extraction(spark, d):
    x = spark.createDataFrame(PLAN_DOCS, "id int, title string, text string, method string")
    x = x.selectExpr("title", "text", "method", "cast(id as string) as url", "cast(null as date) as pub_date", "'p' as source_name", "'plan' as doc_type")
    p = E.plans(x)
    return p.select(F.col("url").cast("int").alias("id"), "province", F.col("covered_year").alias("y"), F.col("covered_month_start").alias("m1"), F.col("covered_month_end").alias("m2"), F.col("covered_period_start").alias("s"), F.col("covered_period_end").alias("e"), F.col("plan_refinancing_amount_yi").alias("refi"), F.col("plan_general_amount_yi").alias("general"), F.col("plan_special_amount_yi").alias("special"))


@query(r"""select plan_id, coalesce(try_cast(nullif(regexp_extract(title, '(\d{4})年第?[一二三四1234]季度', 1), '') as int), try_cast(nullif(regexp_extract(title, '(\d{4})年(\d{1,2})月', 1), '') as int)) as y,
    coalesce(case regexp_extract(title, '\d{4}年第?([一二三四1234])季度', 1) when '一' then 1 when '二' then 4 when '三' then 7 when '四' then 10 when '1' then 1 when '2' then 4 when '3' then 7 when '4' then 10 end, try_cast(nullif(regexp_extract(title, '\d{4}年(\d{1,2})月', 1), '') as int)) as m from state_plans""")
def covered_period(spark, d):
    y, m, _ = D.covered_period(F.col("title"), F.lit(""))
    return read(spark, d, "state_plans").select("plan_id", y.alias("y"), m.alias("m"))


DATES = [
    (1, "2026 年 7 月 24 日上午 9:30-10:10 为竞争性招标，7月27日开始计息，7月29日起在市场上市"), (2, "2050年2月25日偿还，竞争性招标结束后"), (3, "2026年7月24日（周五）招标"), (4, "2026年2月30日招标"), (5, "7月3日招标"), (6, "😀2025年1月2日公告，3月4日招标"),
]


@query("""select * from (values (1, date '2026-07-24', date '2026-07-27', date '2026-07-29'), (2, null, null, null), (3, null, null, null), (4, null, null, null), (5, date '2020-07-03', null, null), (6, date '2025-03-04', null, null)) t(id, bid, pay, listed)""")
def date_parse_anchor_year(spark, d):
    x = spark.createDataFrame(DATES, "id int, text string")
    return x.select("id", *[D.anchored_date(F.col("text"), p, F.lit(2020)).alias(n) for n, p in (("bid", D.BID), ("pay", D.PAYMENT), ("listed", D.LISTING))])


ANN_DOC = [(
    "u1", "2026年北京市第十二批专项债券", "依据财库〔2020〕43号文，2026年7月24日招标，计划发行总额1,100.5亿元。",
    [[["债券名称", "期限", "面值（亿元）", "费率（亿元）"], ["某专项债券（十二期）", "10年", "1,000.5", "0.1"], [None, None, None, None], ["合计", "", "", ""], ["某一般债券（八至十期）", "5 年", "100", None]]], "text",
), ("u2", "2026年天津市一般债券", "发行总额20亿元，7月1日招标", [], "ocr"), ("u3", "上海市", "", [], "failed")]


def _docs(spark, rows, day="2026-07-15"):
    x = spark.createDataFrame(rows, "url string, title string, text string, tables array<array<array<string>>>, method string")
    return x.selectExpr("*", f"date '{day}' as pub_date", "'s' as source_name", "'d' as doc_type")


@query("""select * replace (total_amount_yi::double as total_amount_yi) from (values ('u1', '北京市', 'new_special', '10Y', 12, 12, null, 1000.5, date '2026-07-24', 9, 7, '依据财库〔2020〕43号'), ('u1', '北京市', 'new_general', '5Y', 12, null, '8,9,10', 100.0, date '2026-07-24', 9, 7, '依据财库〔2020〕43号'),
    ('u2', '天津市', 'new_general', null, null, null, null, 20.0, date '2026-07-01', -14, null, null), ('u3', '上海市', null, null, null, null, null, null, null, null, null, null)) t(url, province, category_code, term, batch_no, issue_no, issue_no_range, total_amount_yi, bid_date, natural_day_gap, workday_gap, doc_no)""")
def announcement_extraction(spark, d):
    from datetime import date

    x = E.announcements(_docs(spark, ANN_DOC), dims.calendar(spark, date(2026, 1, 1), date(2026, 12, 31)))
    return x.select("url", "province", "category_code", "term", "batch_no", "issue_no", "issue_no_range", "total_amount_yi", "bid_date", "natural_day_gap", "workday_gap", "doc_no")


@query(r"""with t as (select pdf_id, unnest(tables) as tab from pdf_extract), r as (select pdf_id, tab[1] as head, unnest(tab[2:]) as row from t where len(tab) >= 2),
    p as (select pdf_id, row[list_position(head, '债券名称')] as name, coalesce(row[list_position(head, '期限')], '') as term, coalesce(row[list_position(head, '面值（亿元）')], '') as amount from r where list_contains(head, '期限') and list_contains(head, '面值（亿元）') and len(list_filter(row, lambda x: x is not null)) > 0)
    select pdf_id, nullif(name, '') as bond_name, try_cast(nullif(regexp_extract(term, '(\d{1,2})\s*年', 1), '') as int)::varchar || 'Y' as term, try_cast(nullif(regexp_extract(replace(amount, ',', ''), '([\d,]+\.?\d*)', 1), '') as double) as total_amount_yi from p where term <> '' or amount <> ''""")
def tranche_extraction(spark, d):
    x = read(spark, d, "pdf_extract").select("pdf_id", "tables")
    return E.tranches(x).select("pdf_id", "bond_name", "term", "total_amount_yi")


RESULT_HEAD = ["债券名称", "债券编码", "债券 简称", "债券类型", "期限", "发行规模", "新增债券", "置换债券", "再融资债券", "发行批次", "票面利率", "发行日期", "起息日", "付息方式", "赎回模式"]
RESULT_DOCS = [
    ("r1", "北京市结果", "表2-9", [[RESULT_HEAD, ["甲", "2205123", "22甲", "专项债券", "10年期", "1,000", "1000", None, None, "一", "3. 28", "2026-07-01", "2026-07-02", "半年", "无"], ["乙", "21江苏01", "x", "一般债券", "5年", "2000", None, None, "5", "二", "9.1", "20260701", None, None, None], ["合计", "无", None, None, None, None, None, None, None, None, None, None, None, None, None]]], "text"),
    ("r2", "天津市结果", "旧版", [], "text"), ("r3", "上海市结果", "表2-10", [[["债券名称债券编码债券简称期限发行规模利率", None], ["1", "2"]]], "text"),
]


@query("""select * replace (total_amount_yi::double as total_amount_yi, coupon_rate_pct::double as coupon_rate_pct) from (values ('r1', '2205123', 'new_special', '10Y', 1000.0, 3.28, 'text', 0), ('r1', null, 'refinancing', '5Y', null, null, 'text', 3), ('r2', null, null, null, null, null, 'unsupported_legacy_format', 1), ('r3', null, null, null, null, null, 'text', 1)) t(url, bond_code, category_code, term, total_amount_yi, coupon_rate_pct, extraction_method, notes)""")
def result_extraction(spark, d):
    x = E.results(_docs(spark, RESULT_DOCS))
    return x.select("url", "bond_code", "category_code", "term", "total_amount_yi", "coupon_rate_pct", "extraction_method", F.when(F.col("warnings") == "", 0).otherwise(F.size(F.split("warnings", "; "))).alias("notes"))


@query(f"""select result_id, case when length(bond_code) <= 12 and regexp_full_match(bond_code, '[0-9０-９A-Za-z.]+') then bond_code end as bond_code, case when coupon_rate_pct between 0.1 and 4.0 then coupon_rate_pct end as coupon, case when total_amount_yi > 0 and total_amount_yi <= 100 then total_amount_yi end as total,
    (bond_code is not null and not (length(bond_code) <= 12 and regexp_full_match(bond_code, '[0-9０-９A-Za-z.]+')))::int + coalesce((not coupon_rate_pct between 0.1 and 4.0)::int, 0) + coalesce((not (total_amount_yi > 0 and total_amount_yi <= 100))::int, 0) as notes from state_results""")
def warnings_concat(spark, d):
    """Range checks that null a value and add a warning, with bounds that these tables have cases on both sides of."""
    (code, coupon, total), noted = E.result_ranges(F.col("bond_code"), F.col("coupon_rate_pct"), F.col("total_amount_yi"), coupons=(0.1, 4.0), most=100.0)
    notes = X.warnings(*noted)
    return read(spark, d, "state_results").select("result_id", code.alias("bond_code"), coupon.alias("coupon"), total.alias("total"), F.when(notes == "", 0).otherwise(F.size(F.split(notes, "; "))).alias("notes"))


@query("select * from (values (1, 'N/A'), (2, '2.4'), (3, '2.6'), (4, '7.0')) t(id, shown)")
def number_format(spark, d):
    return spark.createDataFrame([(1, None), (2, 2.35), (3, 2.55), (4, 7.0)], "id int, x double").select("id", X.shown(F.col("x")).alias("shown"))


# ---------------------------------------------------------------- general data processing


@query()
def p2_found(spark, d):
    rows = read(spark, d, "state_announcements")
    fields = [
        Field("workday_gap", (F.col("workday_gap") < 0) | (F.col("workday_gap") > F.col("natural_day_gap")), "url"),
        Field("natural_day_gap", F.col("natural_day_gap") < 0, "url"),
        Field("total_amount_yi", F.col("total_amount_yi") <= 0),
    ]
    return flag_spikes(rows, "ann_id", "source_name", fields).select(F.col("row_id").alias("ann_id"), "field")
