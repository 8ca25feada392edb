"""Conversations as notebooks: a file holds eight turns of one conversation, each turn is a cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.operators import cells as cell_ops
from weftgraph.plans import notebook
from weftgraph.queries.pages import flat_nodes
from weftgraph.queries.registry import query, table
from weftgraph.session import spread_by, stage_table

TURNS = 8

CELLS_SQL = f"""
t AS (SELECT *, 'conv/talk_' || conv_id || '_' || (turn // {TURNS}) || '.ipynb' AS rel_path,
             'Talk ' || conv_id || ' ' || (turn // {TURNS}) AS notebook,
             CAST(row_number() OVER (PARTITION BY conv_id, turn // {TURNS} ORDER BY turn) - 1 AS INTEGER) AS cell_index,
             regexp_replace(text, '\\s+', ' ', 'g') AS line
      FROM conversations),
code AS (
  SELECT *, CASE role WHEN 'user' THEN 'sql' ELSE 'python' END AS language,
         CASE WHEN turn % 3 = 2 THEN 'Cell ' || (cell_index + 1) || ' (' || CASE role WHEN 'user' THEN 'sql' ELSE 'python' END || ')'
              ELSE 'Role ' || role END AS title,
         CASE role WHEN 'user' THEN ['c_' || conv_id, 't_' || turn]
              ELSE CASE WHEN conv_id % 2 = 0 THEN ['p_' || turn] ELSE CAST([] AS VARCHAR[]) END END AS tables,
         CASE role WHEN 'user' THEN '%%sql -r x' || chr(10) || 'SELECT * FROM db.C_' || conv_id || ' JOIN T_' || turn
                        || ' USING (id) -- ' || line
              ELSE CASE WHEN conv_id % 2 = 0 THEN 'df = session.sql(f"select a from {{db}}.P_' || turn || ' where 1 = 1")'
                   ELSE 'x = ' || conv_id || ' # ' || line END END AS source
  FROM t WHERE role <> 'system'),
named AS (SELECT *, CASE WHEN n > 1 THEN title || ' (' || n || ')' ELSE title END AS unique_title
          FROM (SELECT *, row_number() OVER (PARTITION BY rel_path, title ORDER BY cell_index) AS n FROM code)),
described AS (
  SELECT *, upper(language) || ' cell: **' || unique_title || '**.'
         || CASE WHEN len(tables) > 0 THEN ' Queries tables: ' || array_to_string(['`' || x || '`' for x in list_sort(tables)], ', ') || '.'
                 ELSE ' `' || rtrim(source[1:120]) || '…`' END AS description
  FROM named)
"""


def notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notebook files as JSON text. A file is bounded by its eight turns."""
    c = F.col
    line = F.regexp_replace("text", r"\s+", " ")
    sql = F.array(
        F.lit("%%sql -r x\n"),
        F.concat(F.lit("SELECT * FROM db.C_"), c("conv_id"), F.lit(" JOIN T_"), c("turn")),
        F.concat(F.lit(" USING (id) -- "), line),
    )
    python = F.when(
        c("conv_id") % 2 == 0,
        F.concat(F.lit('df = session.sql(f"select a from {db}.P_'), c("turn"), F.lit(' where 1 = 1")')),
    ).otherwise(F.concat(F.lit("x = "), c("conv_id"), F.lit(" # "), line))
    one = lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1)
    source = (
        F.when(c("role") == "user", F.to_json(sql))
        .when(c("role") == "system", one(F.concat(F.lit("# \n## Heading "), c("conv_id"), F.lit("\nmore"))))
        .otherwise(one(python))
    )
    title = F.when(c("turn") % 3 == 2, "  ").otherwise(F.concat(F.lit("Role "), c("role")))
    meta = F.to_json(
        F.struct(F.when(c("role") == "user", "SQL").alias("language"), title.alias("title"))
    )
    kind = F.when(c("role") == "system", "markdown").otherwise("code")
    cell = F.concat(
        F.lit('{"cell_type":"'), kind, F.lit('","metadata":'), meta, F.lit(',"source":'), source, F.lit("}")
    )
    cells = table(spark, sf_dir, "conversations").select(
        "conv_id",
        F.floor(c("turn") / TURNS).alias("piece"),
        F.struct(c("turn"), cell.alias("cell")).alias("x"),
    )
    return (
        spread_by(cells, "conv_id", "piece")
        .groupBy("conv_id", "piece")
        .agg(F.sort_array(F.collect_list("x")).alias("xs"))
        .select(
            F.concat(F.lit("conv/talk_"), "conv_id", F.lit("_"), "piece", F.lit(".ipynb")).alias("rel_path"),
            F.concat(
                F.lit('{"cells":['),
                F.array_join(F.transform("xs", lambda x: x["cell"]), ","),
                F.lit("]}"),
            ).alias("content"),
        )
    )


def parsed(spark: SparkSession, sf_dir: str) -> notebook.Parsed:
    return notebook.parse(notebooks(spark, sf_dir))


@query(
    "nested_cells",
    f"""WITH {CELLS_SQL} SELECT rel_path, cell_index, language, array_to_string(list_sort(tables), ',') AS tables FROM code""",
)
def nested_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).cells.select(
        "rel_path", "cell_index", "language", F.array_join("tables", ",").alias("tables")
    )


@query(
    "cell_defaults",
    f"WITH {CELLS_SQL} SELECT rel_path, cell_index, language, title, source FROM code",
)
def cell_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notebook.code_cells(notebook.split_cells(notebooks(spark, sf_dir))).select(
        "rel_path", "cell_index", "language", "title", "source"
    )


@query(
    "win_title_dedupe",
    f"WITH {CELLS_SQL} SELECT rel_path, cell_index, unique_title FROM named",
)
def win_title_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = notebook.code_cells(notebook.split_cells(notebooks(spark, sf_dir)))
    return cell_ops.unique_titles(cells.drop("source"), ["rel_path"]).select(
        "rel_path", "cell_index", "unique_title"
    )


@query(
    "agg_cells",
    f"""WITH {CELLS_SQL} SELECT rel_path, count(*) AS n_cells, count(*) FILTER (WHERE len(tables) > 0) AS n_sql_cells
    FROM code GROUP BY rel_path""",
)
def agg_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_ops.counts(parsed(spark, sf_dir).cells, ["rel_path"])


@query("desc_cell", f"WITH {CELLS_SQL} SELECT rel_path, cell_index, description FROM described")
def desc_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cell_ops.unique_titles(parsed(spark, sf_dir).cells, ["rel_path"])
    c = F.col
    return cells.select(
        "rel_path",
        "cell_index",
        cell_ops.cell_description(
            c("language"), c("unique_title"), c("tables"), c("source_snippet")
        ).alias("description"),
    )


@query(
    "conv_nodes",
    f"""WITH {CELLS_SQL},
    per AS (SELECT rel_path, min(notebook) AS notebook, max(CASE WHEN role = 'system' THEN conv_id END) AS headed
            FROM t GROUP BY rel_path),
    n AS (SELECT rel_path, count(*) AS cells, count(*) FILTER (WHERE len(tables) > 0) AS sqls FROM code GROUP BY rel_path)
    SELECT 'Snowflake Notebooks' AS integration, notebook AS name, 'Notebook' AS node_type,
           CASE WHEN headed IS NOT NULL THEN 'Heading ' || headed
                ELSE 'Snowflake Notebook with ' || coalesce(cells, 0) || ' code cell(s)'
                     || CASE WHEN sqls > 0 THEN ', ' || sqls || ' querying dbt model output' ELSE '' END || '.' END AS description,
           'https://git.example.org/nb/blob/main/' || per.rel_path AS url, '' AS upstream,
           CAST(NULL AS VARCHAR) AS downstream
    FROM per LEFT JOIN n ON n.rel_path = per.rel_path
    UNION ALL
    SELECT 'Snowflake Notebooks', notebook || '.' || unique_title, 'Cell', description,
           'https://git.example.org/nb/blob/main/' || rel_path,
           array_to_string(list_sort(tables), ','), 'Notebook:' || notebook FROM described""",
)
def conv_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = notebook.parse(notebooks(spark, sf_dir), stage_table)
    return flat_nodes(notebook.convert(files, "https://git.example.org/nb", "main"))
