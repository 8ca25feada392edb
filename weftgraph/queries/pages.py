"""Web pages as artifacts: their title, links and address stand for an app's title, tables and path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.operators import graph
from weftgraph.operators.parent_child import parent_child_nodes
from weftgraph.plans import dashboard
from weftgraph.queries.registry import query, table
from weftgraph.schemas import PARSE_FAILURE
from weftgraph.sources import artifacts as src

PAGES_SQL = r"""
p AS (
  SELECT page_id, html, regexp_replace(regexp_replace(url, '^https?://[^/]+/?', ''), '[?#].*$', '') AS path,
         regexp_extract(url, '^https?://([^/]+)', 1) AS host,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
  FROM pages),
art AS (SELECT *, path || CASE WHEN path = '' OR path LIKE '%/' THEN 'index' ELSE '' END || '_' || page_id || '.py'
               AS rel_path FROM p)
"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", r"^https?://[^/]+/?", ""), r"[?#].*$", "")
    index = F.when((path == "") | path.endswith("/"), "index").otherwise("")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(path, index, F.lit("_"), "page_id", F.lit(".py")).alias("rel_path"),
        F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("content"),
    )


MARK = 'class="ad"'


@query("src_discover", f"WITH {PAGES_SQL} SELECT rel_path FROM art WHERE contains(html, '{MARK}') ORDER BY 1")
def src_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.containing(pages(spark, sf_dir), MARK).select("rel_path")


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English pages and, as paths that are not there, the customers' names."""
    english = pages(spark, sf_dir).filter(F.col("rel_path").startswith("en/")).select("rel_path")
    absent = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("en/"), "c_name", F.lit(".py")).alias("rel_path")
    )
    return english.unionByName(absent)


@query("src_allowlist", f"WITH {PAGES_SQL} SELECT page_id, rel_path FROM art WHERE rel_path LIKE 'en/%'")
def src_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.allowed(pages(spark, sf_dir), listed(spark, sf_dir)).select("page_id", "rel_path")


@query("src_missing", "SELECT 'en/' || c_name || '.py' AS rel_path FROM customer")
def src_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.missing(pages(spark, sf_dir), listed(spark, sf_dir))


@query(
    "name_app",
    f"""WITH {PAGES_SQL}
    SELECT page_id, CASE WHEN contains(rel_path, '/') THEN split_part(rel_path, '/', 1)
                         ELSE rel_path[:-4] END AS app_name FROM art""",
)
def name_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", text.app_name(F.col("rel_path")).alias("app_name"))


@query(
    "name_title",
    """
    WITH n AS (SELECT p_partkey, lower(p_name || '-' || p_partkey || 'nd load') AS t FROM part)
    SELECT p_partkey, array_to_string(
      [CASE WHEN regexp_matches(x, '^[a-z]') THEN upper(x[1:1]) || x[2:] ELSE x END
       for x in regexp_extract_all(t, '[a-z]+|[^a-z]+')], '') AS title
    FROM n""",
)
def name_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(
        F.lit("flows/x.y/"), F.translate("p_name", " ", "_"), F.lit("-"), "p_partkey", F.lit("ND_load.orch.yaml")
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.display_name(path).alias("title"))


@query(
    "tbl_bare",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN lower(replace(p_name, ' ', '_')) END AS bare FROM part""",
)
def tbl_bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.upper(F.translate("p_name", " ", "_"))
    full = (
        F.when(F.col("p_partkey") % 5 == 0, "")
        .when(F.col("p_partkey") % 2 == 0, name)
        .otherwise(F.concat_ws(".", F.lit("DB"), F.col("p_brand"), name))
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.bare_table(full).alias("bare"))


@query(
    "orch_leaf",
    """SELECT p_partkey, CASE WHEN p_partkey % 6 < 5 THEN 'Flow_' || p_partkey END AS leaf FROM part""",
)
def orch_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    ending = F.get(
        F.array(*[F.lit(x) for x in (".orch.yaml", ".ORCH.Yaml/", ".yaml", "", "//")]), k % 6
    )
    path = F.when(k % 6 == 5, "/").otherwise(
        F.concat(F.lit("A B/"), "p_brand", F.lit("/Flow_"), k, ending)
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.call_leaf(path).alias("leaf"))


@query(
    "line_numbers",
    """SELECT doc_id, CAST(CASE WHEN instr(text, ' de ') > 0
         THEN 1 + length(text[1:instr(text, ' de ') - 1]) - length(replace(text[1:instr(text, ' de ') - 1], chr(10), ''))
         END AS INTEGER) AS line
    FROM documents""",
)
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.instr("text", " de ")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(at > 0, text.line_of(F.col("text"), at)).alias("line")
    )


# -- pages read as dashboard apps ----------------------------------------------------------------------

APP_SQL = f"""{PAGES_SQL},
app AS (SELECT *, CASE WHEN page_id % 3 <> 1 AND NOT regexp_matches(title, '["'']') THEN nullif(title, '') END AS app_title,
               CASE WHEN page_id % 3 > 0 THEN 'About ' || host || '.' END AS app_description FROM art),
links AS (SELECT rel_path, url, generate_subscripts(hrefs, 1) AS id, unnest(hrefs) AS href
          FROM (SELECT rel_path, 'https://git.example.org/web/blob/dev/' || rel_path AS url,
                       regexp_extract_all(html, '<a href="([^"]+)"', 1) AS hrefs FROM art)),
use AS (SELECT *, 'link (Line ' || id || ')' AS label, [lower(href), 'hub'] AS tables FROM links)
"""


def app_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page's title and host written as the calls of a dashboard source."""
    k = F.col("page_id")
    title = F.when(k % 3 != 1, F.concat(F.lit('x\nst.title("'), "title", F.lit('")\n'))).otherwise("\n")
    about = F.when(
        k % 3 > 0, F.concat(F.lit('st.markdown("""\n About '), "host", F.lit('.\n""")\n'))
    ).otherwise("\n")
    return pages(spark, sf_dir).select(
        "page_id", "rel_path", F.concat(title, about).alias("source"), "content"
    )


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_source(spark, sf_dir).select(
        "page_id",
        "rel_path",
        text.app_title(F.col("source")).alias("app_title"),
        F.nullif(text.app_description(F.col("source")), F.lit("")).alias("app_description"),
    )


@query(
    "app_metadata",
    f"""WITH {APP_SQL} SELECT page_id, app_title, app_description FROM app
    WHERE app_title IS NOT NULL OR app_description IS NOT NULL""",
)
def app_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.app_metadata(apps(spark, sf_dir)).select("page_id", "app_title", "app_description")


def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App per page, chart per link with the link's target and a hub as its tables."""
    hrefs = F.regexp_extract_all("content", F.lit(r'<a href="([^"]+)"'), F.lit(1))
    none = F.lit(None).cast("string")
    usage = (
        pages(spark, sf_dir)
        .select(F.col("rel_path").alias("file_path"), F.posexplode(hrefs).alias("i", "href"))
        .select(
            (F.col("i") + 1).cast("long").alias("id"),
            "file_path",
            F.lit("link").alias("chart_type"),
            none.alias("chart_name"),
            F.when(F.col("i") % 2 == 0, F.concat(F.lit("to "), "href")).alias("chart_caption"),
            (F.col("i") + 1).alias("line_number"),
            F.array(F.lower("href"), F.lit("hub")).alias("tables_used"),
        )
    )
    failures = spark.createDataFrame([], PARSE_FAILURE)
    parsed = dashboard.Parsed(apps(spark, sf_dir), usage, failures)
    return dashboard.convert(parsed, "https://git.example.org/web", "dev")


APP_DESC_SQL = """
SELECT app.rel_path, app_title, app_description, coalesce(n, 0) AS n, coalesce(t, CAST([] AS VARCHAR[])) AS t
FROM app LEFT JOIN (SELECT rel_path, count(DISTINCT id) AS n, list_sort(list_distinct(flatten(list(tables)))) AS t
                    FROM use GROUP BY rel_path) u ON u.rel_path = app.rel_path
"""
APP_TEXT_SQL = """
CASE WHEN app_title IS NOT NULL THEN app_title || CASE WHEN app_description IS NOT NULL THEN ' - ' || app_description ELSE '' END
     ELSE 'Streamlit application with ' || n || ' SQL queries'
          || CASE WHEN len(t) > 0 THEN ' using tables: ' || array_to_string(t[1:3], ', ')
             || CASE WHEN len(t) > 3 THEN ' and ' || (len(t) - 3) || ' more' ELSE '' END ELSE '' END END
"""
CHART_TEXT_SQL = """CASE WHEN id % 2 = 1 THEN label || ' - to ' || href
     ELSE 'link chart (line ' || id || ') using ' || lower(href) || ', hub' END"""
NAME_SQL = "CASE WHEN contains(rel_path, '/') THEN split_part(rel_path, '/', 1) ELSE rel_path[:-4] END"


@query(
    "desc_app",
    f"WITH {APP_SQL}, d AS ({APP_DESC_SQL}) SELECT rel_path, {APP_TEXT_SQL} AS description FROM d",
)
def desc_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = "https://git.example.org/web/blob/dev/"
    return page_nodes(spark, sf_dir).filter("node_type = 'App'").select(
        F.replace("attributes.url", F.lit(prefix), F.lit("")).alias("rel_path"),
        F.col("attributes.description").alias("description"),
    )


@query(
    "desc_chart",
    f"""WITH {APP_SQL} SELECT {NAME_SQL} || '.' || label AS name, url || '#L' || id AS url,
        {CHART_TEXT_SQL} AS description FROM use""",
)
def desc_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_nodes(spark, sf_dir).filter("node_type = 'Chart'").select(
        "name", F.col("attributes.url").alias("url"), F.col("attributes.description").alias("description")
    )


def flat_nodes(nodes: DataFrame) -> DataFrame:
    def labels(side: str) -> Column:
        return F.array_join(F.transform(f"lineage.{side}_dependencies", graph.dep_label), ",").alias(side)

    return nodes.select(
        "integration", "name", "node_type", F.col("attributes.description").alias("description"),
        F.col("attributes.url").alias("url"), labels("upstream"), labels("downstream"),
    )


@query(
    "pages_nodes",
    f"""WITH {APP_SQL}, d AS ({APP_DESC_SQL})
    SELECT 'Streamlit' AS integration, {NAME_SQL} AS name, 'App' AS node_type, {APP_TEXT_SQL} AS description,
           'https://git.example.org/web/blob/dev/' || rel_path AS url, '' AS upstream,
           CAST(NULL AS VARCHAR) AS downstream FROM d
    UNION ALL
    SELECT 'Streamlit', {NAME_SQL} || '.' || label, 'Chart', {CHART_TEXT_SQL}, url || '#L' || id,
           array_to_string([split_part(t, '.', -1) for t in tables if split_part(t, '.', -1) <> ''], ','),
           'App:' || {NAME_SQL} FROM use""",
)
def pages_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_nodes(page_nodes(spark, sf_dir))


@query(
    "tmpl_parent_child",
    f"""WITH {PAGES_SQL}
    SELECT 'Web' AS integration, host AS name, 'ParentNode' AS node_type,
           'Auto-generated parent node for ' || host || '.' AS description, min(rel_path) AS url,
           '' AS upstream, CAST(NULL AS VARCHAR) AS downstream FROM art GROUP BY host
    UNION ALL
    SELECT 'Web', host || '.page ' || page_id, 'ChildNode', 'Child node: page ' || page_id || '.', rel_path,
           'ParentNode:' || host, CASE WHEN page_id % 4 > 0 THEN 't_' || (page_id % 50) ELSE '' END
    FROM art""",
)
def tmpl_parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is a record of its host."""
    k = F.col("page_id")
    nodes = parent_child_nodes(
        pages(spark, sf_dir),
        "Web",
        F.col("host"),
        F.concat(F.lit("page "), k),
        F.when(k % 4 > 0, F.concat(F.lit("T_"), k % 50)),
        F.col("rel_path"),
        sources=pages(spark, sf_dir),
    )
    return flat_nodes(nodes)


@query(
    "tmpl_parent_child_whole",
    f"""WITH {PAGES_SQL},
    held AS (SELECT host, rel_path FROM art UNION ALL SELECT 'empty.' || host, 'empty/' || rel_path FROM art)
    SELECT 'Web' AS integration, host AS name, 'ParentNode' AS node_type,
           'Auto-generated parent node for ' || host || '.' AS description, min(rel_path) AS url,
           '' AS upstream, CAST(NULL AS VARCHAR) AS downstream FROM held GROUP BY host
    UNION ALL
    SELECT 'Web', host || '.page ' || page_id, 'ChildNode', 'Child node: page ' || page_id || '.', rel_path,
           'ParentNode:' || host, CASE WHEN page_id % 4 > 0 THEN 't_' || (page_id % 50) ELSE '' END
    FROM art""",
)
def tmpl_parent_child_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is a record; beside each host stands a source that holds none and is a parent all the same."""
    k = F.col("page_id")
    held = pages(spark, sf_dir)
    empty = held.select(
        F.concat(F.lit("empty."), "host").alias("host"), F.concat(F.lit("empty/"), "rel_path").alias("rel_path")
    )
    nodes = parent_child_nodes(
        held,
        "Web",
        F.col("host"),
        F.concat(F.lit("page "), k),
        F.when(k % 4 > 0, F.concat(F.lit("T_"), k % 50)),
        F.col("rel_path"),
        sources=held.select("host", "rel_path").unionByName(empty),
    )
    return flat_nodes(nodes)
