"""A Markdown report of the summary tables, and the command line."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from bondlake.operators.stats import anomaly_rate
from bondlake.plans.tables import raw_tables, summary_tables

#: Rows shown of the long lists.
SHOWN = {"by_province": 15, "anomalies": 50, "plan_lead": 30}
LEAD = ["n", "natural_mean", "natural_median", "workday_mean", "workday_median", "workday_max", "workday_min"]
COLUMNS = {"anomalies": ["ann_id", "province", "pub_date", "bid_date", "workday_gap", "url"]}


def shown(v: object) -> str:
    if v is None:
        return "N/A"
    return f"{v:.1f}" if isinstance(v, float) else str(v).replace("|", "\\|")


def section(name: str, df: DataFrame) -> str:
    """A table of at most the shown rows; one row more is read to tell whether there are more."""
    cols = COLUMNS.get(name) or [c for c in df.columns if c in LEAD or c not in ("natural_max", "natural_min")]
    limit = SHOWN.get(name, 200)
    rows = df.select(*[c for c in cols if c in df.columns]).limit(limit + 1).collect()
    lines = [f"## {name}", "", "| " + " | ".join(cols) + " |", "|" + "-|" * len(cols)]
    lines += ["| " + " | ".join(shown(v) for v in r) + " |" for r in rows[:limit]]
    if len(rows) > limit:
        lines.append(f"\nMore rows than these {limit} exist.")
    return "\n".join(lines) + "\n"


def render(tables: dict[str, DataFrame], title: str) -> str:
    return f"# {title}\n\n" + "\n".join(section(k, v) for k, v in tables.items())


def replace_block(text: str, name: str, new: str) -> tuple[str, bool]:
    """The text with what stands between the marks ``/* name begin */`` and ``/* name end */`` replaced, and whether that changed anything; a text without the marks stays as it is."""
    begin, end = f"/* {name} begin */", f"/* {name} end */"
    a = text.find(begin)
    b = text.find(end, a + len(begin)) if a >= 0 else -1
    if b < 0 or text[a + len(begin) : b].strip() == new.strip():
        return text, False
    return f"{text[: a + len(begin)]}\n{new}\n{text[b:]}", True


def update_page(path: Path, blocks: dict[str, str]) -> bool:
    """Replace blocks of a page; the file isn't touched unless a block differs."""
    text, changed = path.read_text(encoding="utf-8"), False
    for name, new in blocks.items():
        text, one = replace_block(text, name, new)
        changed |= one
    if changed:
        path.write_text(text, encoding="utf-8")
    return changed


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Summary tables and report of a folder of state tables")
    p.add_argument("data", help="folder with state_announcements.parquet and the other tables")
    p.add_argument("out", help="folder for the tables and report.md")
    p.add_argument("--raw", action="store_true", help="write the row tables and the bond dictionary as well")
    p.add_argument("--no-report", action="store_true", help="write tables only")
    p.add_argument("--page", type=Path, help="page whose plan and calendar blocks are replaced")
    p.add_argument("--as-of", help="day whose month the plan block shows, the latest issue by default")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("bondlake").getOrCreate()
    read = lambda n: spark.read.parquet(f"{args.data}/{n}.parquet")
    anns = read("state_announcements")
    if anns.isEmpty():
        print("No announcements.")
        return 1
    tables = summary_tables(anns, read("state_plans"), read("dim_region"), read("dim_term"), read("dim_calendar")) | {"rate": anomaly_rate(anns)}
    raw = raw_tables(anns, read("state_plans"), read("state_results"), read("dim_region"), read("dim_calendar")) if args.raw else {}
    for name, df in (tables | raw).items():
        df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    Path(args.out).mkdir(parents=True, exist_ok=True)
    if not args.no_report:
        # what was written is read back, so no table is computed twice
        written = {name: spark.read.parquet(f"{args.out}/{name}") for name in tables}
        Path(args.out, "report.md").write_text(render(written, "Lead times of bond announcements"), encoding="utf-8")
    if args.page:
        update_page(args.page, _blocks(spark, args.data, args.as_of))
    return 0


def _blocks(spark: SparkSession, data: str, as_of: str | None) -> dict[str, str]:
    """JSON of the plan month and of the issuance calendar by block name; none where there is no such month."""
    from pyspark.sql import functions as F

    from bondlake.functions.dates import any_date
    from bondlake.operators import payloads as P

    results = spark.read.parquet(f"{data}/state_results.parquet").withColumn("issue_date", any_date(F.col("issue_date")))
    out = {}
    calendar = P.calendar_payload(results)
    row = calendar.select(F.to_json(F.struct(*calendar.columns), {"ignoreNullFields": "false"}).alias("json"), "asOf").first()
    if row:
        out["calendar"] = row.json
    day = as_of or (row.asOf if row else None)
    if day:
        regions = spark.read.parquet(f"{data}/dim_region.parquet")
        month = P.month_json(P.month_payload(spark.read.parquet(f"{data}/state_plans.parquet"), regions, regions.count(), F.trunc(F.lit(day).cast("date"), "MM"))).first()
        if month:
            out["plans"] = month.json
    return out


if __name__ == "__main__":
    raise SystemExit(main())
