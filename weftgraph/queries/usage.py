"""The usage log: events are queries of their user's app, in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.operators import usage
from weftgraph.plans import dashboard, skew
from weftgraph.queries.registry import query, table

USAGE_SQL = """
e AS (SELECT *, CAST(props::JSON->>'k' AS INTEGER) AS k FROM events),
usage AS (
  SELECT 'u' || user_id AS file_path, ts, event_id, event_type AS chart_type,
         CASE WHEN event_id % 10 > 0 THEN 'chart ' || (event_id % 7) END AS chart_name,
         CASE WHEN k % 10 = 9 THEN CAST([] AS VARCHAR[]) WHEN k % 10 = 3 THEN ['', 't_' || k]
              ELSE ['t_' || ((k + 7 * i) % 100) for i in range(0, k % 5)] END AS tables_used,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS id
  FROM e)
"""


def usage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_events(table(spark, sf_dir, "events"))


def of_events(events: DataFrame) -> DataFrame:
    k = F.col("k")
    several = F.transform(
        F.when(k % 5 > 0, F.sequence(F.lit(0), k % 5 - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(F.lit("t_"), (k + i * 7) % 100),
    )
    return (
        events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .select(
            F.concat(F.lit("u"), "user_id").alias("file_path"),
            "ts",
            "event_id",
            F.col("event_type").alias("chart_type"),
            F.when(
                F.col("event_id") % 10 > 0, F.concat(F.lit("chart "), F.col("event_id") % 7)
            ).alias("chart_name"),
            F.when(k % 10 == 9, F.array().cast("array<string>"))
            .when(k % 10 == 3, F.array(F.lit(""), F.concat(F.lit("t_"), k)))
            .otherwise(several)
            .alias("tables_used"),
        )
    )


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.with_ids(usage_rows(spark, sf_dir), ["ts", "event_id"])


SUMMARY_SQL = f"""WITH {USAGE_SQL},
unnested AS (SELECT unnest(tables_used) AS table_name, chart_type, chart_name FROM usage)
SELECT table_name, usage_count, used_in_chart_types, chart_name
FROM (SELECT table_name, count(*) AS usage_count,
             string_agg(DISTINCT chart_type, ',' ORDER BY chart_type) AS used_in_chart_types
      FROM unnested WHERE table_name IS NOT NULL AND table_name <> '' GROUP BY table_name)
JOIN (SELECT DISTINCT table_name, chart_name FROM unnested) USING (table_name)
"""


def flat_summary(rows: DataFrame) -> DataFrame:
    return rows.withColumn("used_in_chart_types", F.array_join("used_in_chart_types", ","))


@query("usage_summary", SUMMARY_SQL)
def usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_summary(usage.usage_summary(usage_rows(spark, sf_dir)))


@query(
    "usage_results",
    f"""WITH {USAGE_SQL} SELECT file_path, id, chart_type, chart_name, array_to_string(tables_used, ',') AS tables
    FROM usage ORDER BY file_path, id""",
)
def usage_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.results(numbered(spark, sf_dir)).select(
        "file_path", "id", "chart_type", "chart_name", F.array_join("tables_used", ",").alias("tables")
    )


@query(
    "agg_app_tables",
    f"""WITH {USAGE_SQL},
    pairs AS (SELECT DISTINCT file_path, unnest(tables_used) AS t FROM usage)
    SELECT file_path, row_number() OVER (PARTITION BY file_path ORDER BY t) AS position, t AS table_name
    FROM pairs""",
)
def agg_app_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.file_tables(usage_rows(spark, sf_dir))


@query(
    "filter_charts",
    f"WITH {USAGE_SQL} SELECT file_path, event_id, chart_type FROM usage WHERE len(tables_used) > 0",
)
def filter_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.charted(usage_rows(spark, sf_dir)).select("file_path", "event_id", "chart_type")


PREVIEW_SQL = """array_to_string(tables_used[1:{n}], ', ')
  || CASE WHEN len(tables_used) > {n} THEN ' and ' || (len(tables_used) - {n}) || ' more' ELSE '' END"""


@query(
    "preview_list",
    f"""WITH {USAGE_SQL} SELECT event_id, {PREVIEW_SQL.format(n=3)} AS three, {PREVIEW_SQL.format(n=2)} AS two
    FROM usage""",
)
def preview_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = F.col("tables_used")
    return usage_rows(spark, sf_dir).select(
        "event_id", text.preview(tables, 3).alias("three"), text.preview(tables, 2).alias("two")
    )


# -- windows along a user's events -------------------------------------------------------------------


def positions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, skew.HotKeys]:
    """Events as lines of their user's file, numbered from 0, and the users with very many."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    hot = skew.find_hot(rows, ["user_id"])
    numbered = skew.number_rows(rows, ["user_id"], ["ts", "event_id"], "n", hot)
    return numbered.withColumn("i", F.col("n") - 1), hot


@query(
    "win_next",
    """SELECT event_id, first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS next_render
    FROM events""",
)
def win_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    render = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    lines, hot = positions(spark, sf_dir)
    return skew.next_within(lines, ["user_id"], "i", render, 50, "next_render", hot).select(
        "event_id", "next_render"
    )


@query(
    "win_prev",
    """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS header
    FROM events""",
)
def win_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.when(F.col("event_type") == "signup", F.col("event_id"))
    lines, hot = positions(spark, sf_dir)
    return skew.carry_last(lines, ["user_id"], "i", header, "header", hot).select(
        "event_id", "header"
    )


@query(
    "join_tab_range",
    """WITH lines AS (
      SELECT event_id, user_id, event_type, CAST(props::JSON->>'k' AS INTEGER) % 3 AS var,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i
      FROM events)
    SELECT u.event_id, max(d.i) AS def_line
    FROM lines u LEFT JOIN (SELECT * FROM lines WHERE event_type = 'view' AND i >= 1) d
      ON d.user_id = u.user_id AND d.var = u.var AND d.i BETWEEN u.i - 29 AND u.i
    WHERE u.event_type = 'click' GROUP BY u.event_id""",
)
def join_tab_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest definition of the same variable at most 29 lines back: a frame instead of a range join."""
    lines, hot = positions(spark, sf_dir)
    both = lines.withColumn("var", F.col("k") % 3)
    both = both.filter(F.col("event_type").isin("view", "click"))
    defined = F.when((F.col("event_type") == "view") & (F.col("i") >= 1), F.col("i"))
    return (
        skew.last_within(both, ["user_id", "var"], "i", defined, 30, "def_line", hot)
        .filter(F.col("event_type") == "click")
        .select("event_id", "def_line")
    )
