"""Writers of the result tables and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.operators import charts
from ampline.operators.ranking import numbered
from ampline.sources.readers import table_options

# Rules whose values the report shows.
LISTED_RULES = ["DQ-9", "DQ-10", "DQ-12", "DQ-18", "DQ-20"]
EVENT_OUTPUT = ["vehicle_id", "event", "event_ts"]


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    df.write.mode("overwrite").options(**table_options(fmt)).format(fmt).save(path)


def write_chart_tables(results: dict[str, DataFrame], out_dir: str, p: Params, fmt: str = "csv") -> None:
    """Chart tables of the result tables, as ``read_results`` gives them."""
    for name, table in charts.chart_tables(results, p).items():
        write_table(table, f"{out_dir}/{name}", fmt)


def write_events(events: DataFrame, order: list[str], path: str, fmt: str = "csv") -> None:
    """Events in (vehicle, time) order; the full key keeps a large vehicle in many parts."""
    write_table(events.orderBy("vehicle_id", "event_ts", *order).select(EVENT_OUTPUT), path, fmt)


def write_sessions(sessions: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(sessions.orderBy("vehicle_id", "start_ts"), path, fmt)


def report_lines(findings: DataFrame, values: DataFrame) -> DataFrame:
    """Numbered findings, a blank line after each, and below them a line per offending value: line_no, value.

    ``values``: rule, shown, n_rows; each of their rules has one finding.
    """
    heads = numbered(findings, ["stage", "k1", "k2", "rule", "item"], "finding_no")
    lines = heads.select(
        "finding_no", F.lit("").alias("shown"), F.format_string("%d. %s\n", F.col("finding_no") + 1, F.col("detail")).alias("value")
    )
    numbers = heads.where(F.col("rule").isin(LISTED_RULES)).select("rule", "finding_no")
    below = values.where(F.col("rule").isin(LISTED_RULES)).join(numbers, "rule").select(
        "finding_no", "shown", F.format_string("    %s (%d rows)", F.col("shown"), F.col("n_rows")).alias("value")
    )
    return numbered(lines.unionByName(below), ["finding_no", "shown"], "line_no").select("line_no", "value")


def write_report(findings: DataFrame, values: DataFrame, path: str) -> None:
    title = findings.sparkSession.createDataFrame(
        [(-2, "DATA QUALITY REPORT"), (-1, "=" * 60 + "\n")], "line_no bigint, value string"
    )
    lines = title.unionByName(report_lines(findings, values)).orderBy("line_no")
    lines.select("value").write.mode("overwrite").text(path)
