"""SQL and Python text written from the columns of orders, so that the expected tables are known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import sqlrefs, text
from weftgraph.functions.pyliterals import python_literals
from weftgraph.plans import dashboard
from weftgraph.queries.registry import query, table
from weftgraph.session import spread_rows, stage_table

# One template per remainder of the order key; {o} {c} {n} are the order's, customer's and nation's table.
TEMPLATES = (
    "SELECT a.x, b.y FROM db.S.{o} a JOIN {c} b ON a.id = b.id LEFT JOIN {n} n ON (n.id = b.id)"
    " WHERE a.p = 'from prio'",
    "SELECT * FROM {o}, raw.{c} c, {n} WHERE {o}.id = c.id ORDER BY 1",
    "WITH recent AS (SELECT * FROM {o}), other AS (SELECT * FROM recent JOIN {c} USING (id))"
    " SELECT * FROM other JOIN {n} ON 1 = 1",
    "SELECT * FROM (SELECT id FROM (SELECT * FROM {o}) q1 JOIN {c} ON q1.id = {c}.id) q2, {n}",
    "INSERT INTO T_{o} (x, y) SELECT x, y FROM {o} JOIN {c} ON {o}.id = {c}.id",
    "CREATE OR REPLACE VIEW mart.V_{o} AS SELECT * FROM {o} UNION ALL SELECT * FROM {c}",
    "MERGE INTO T_{o} t USING (SELECT * FROM {o} JOIN {c} USING (id)) s ON t.id = s.id"
    " WHEN MATCHED THEN UPDATE SET x = s.x",
    "/* FROM nope */ SELECT x, 'it''s FROM trap' AS l -- JOIN nope2\n FROM {o}"
    " WHERE y IN (SELECT y FROM \"{c}\") AND z = 'a;b'; SELECT * FROM second_stmt",
    "SELECT * FROM ((raw.{o})) JOIN ({c} AS c) ON o.id = c.id WHERE x IN ((1)) AND EXTRACT(DAY FROM (ts)) = 1",
    "WITH deep AS (SELECT * FROM {o} WHERE x = " + "(" * 70 + "1" + ")" * 70 + ")"
    " SELECT * FROM deep, " + "(SELECT * FROM " * 70 + "{c}" + ")" * 70 + " q",
)

SCRIPT = (
    "INSERT INTO ${DB}.stg.T_{o} (x) SELECT x FROM ${DB}.raw.{o} JOIN {c} USING (id);\n"
    "CREATE OR REPLACE TABLE ${DB}.V_{o} AS SELECT * FROM {n}, T_{o} WHERE t = ';from x';\n"
    "MERGE INTO M_{o} m USING {c} s ON m.id = s.id WHEN MATCHED THEN DELETE;\n"
    "UPDATE audit SET done = 1; TRUNCATE TABLE old; CALL p('{o}');"
)


def fill_sql(template: str) -> str:
    quoted = template.replace("'", "''")
    for name in "ocn":
        quoted = quoted.replace("{" + name + "}", f"' || {name} || '")
    return f"('{quoted}')"


def fill_column(template: str) -> Column:
    parts: list[Column] = []
    rest = template
    while rest:
        at, name = min((rest.find("{" + n + "}") % (len(rest) + 1), n) for n in "ocn")
        if at:
            parts.append(F.lit(rest[:at]))
        if at < len(rest):
            parts.append(F.col(name))
        rest = rest[at + 3 :]
    return F.concat(*parts)


NAMES_SQL = """
names AS (SELECT o_orderkey AS k, o_custkey AS cust, 'O_' || o_orderkey AS o, 'C_' || o_custkey AS c, n_name AS n
          FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
"""
CORPUS_SQL = f"""{NAMES_SQL},
corpus AS (SELECT *, CASE k % 10 {" ".join(f"WHEN {i} THEN {fill_sql(t)}" for i, t in enumerate(TEMPLATES))}
           END AS sql FROM names)
"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = (
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("o_orderkey", "o_custkey", "n_name")
    )
    # Text is made and searched after this: the joins leave few, large partitions.
    return spread_rows(joined, orders.count()).select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cust"),
        F.concat(F.lit("O_"), "o_orderkey").alias("o"),
        F.concat(F.lit("C_"), "o_custkey").alias("c"),
        F.col("n_name").alias("n"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    which = F.col("k") % 10
    sql = F.when(which == 0, fill_column(TEMPLATES[0]))
    for i, template in enumerate(TEMPLATES[1:], 1):
        sql = sql.when(which == i, fill_column(template))
    return names(spark, sf_dir).withColumn("sql", sql)


def refs_sql(lists: tuple[str, ...], rows: str = "names") -> str:
    """Expected list per template, sorted and joined."""
    cases = " ".join(f"WHEN {i} THEN [{x}]" for i, x in enumerate(lists))
    return f"array_to_string(list_sort(CASE k % 10 {cases} END), ',')"


QUALIFIED = (
    "'db.S.' || o, c, n", "o, 'raw.' || c, n", "o, c, n, 'recent', 'other'", "o, c, n",
    "o, c, 'T_' || o", "o, c, 'mart.V_' || o", "o, c, 'T_' || o", "o, c", "'raw.' || o, c", "o, c, 'deep'",
)
READ = tuple(
    f"lower(o), lower(c){', lower(n)' if i < 4 else ''}" for i in range(10)
)


@query(
    "sql_qualified_refs",
    f"WITH {NAMES_SQL} SELECT k, {refs_sql(QUALIFIED)} AS tables FROM names",
)
def sql_qualified_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sqlrefs.with_qualified_refs(corpus(spark, sf_dir), "sql", "t").select(
        "k", F.array_join("t", ",").alias("tables")
    )


@query("sql_read_refs", f"WITH {NAMES_SQL} SELECT k, {refs_sql(READ)} AS tables FROM names")
def sql_read_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sqlrefs.with_read_refs(corpus(spark, sf_dir), "sql", "t").select(
        "k", F.array_join("t", ",").alias("tables")
    )


@query(
    "sql_script_io",
    f"""WITH {NAMES_SQL}
    SELECT k, array_to_string(list_sort([lower(o), lower(c), lower(n), 't_' || lower(o)]), ',') AS sources,
           'm_' || lower(o) || ',t_' || lower(o) || ',v_' || lower(o) AS targets, k % 3 > 0 AS partial
    FROM names""",
)
def sql_script_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three scripts hold a statement that cannot be read, in their midst or at their end."""
    k = F.col("k") % 3
    script = F.concat(
        F.when(k == 1, F.lit("SELEC BAD BAD FROM bad_1;\n")).otherwise(F.lit("")),
        fill_column(SCRIPT),
        F.when(k == 2, F.lit(" INSERT INTO bad_2 SELECT * FROM")).otherwise(F.lit("")),
    )
    scripts = names(spark, sf_dir).withColumn("script", script)
    return sqlrefs.with_script_io(scripts, "script", "s", "t", "partial").select(
        "k", F.array_join("s", ",").alias("sources"), F.array_join("t", ",").alias("targets"), "partial"
    )


@query(
    "sql_placeholder",
    f"""WITH {NAMES_SQL}
    SELECT k, 'SELECT * FROM _MTL_VAR_._MTL_VAR_.' || o AS flow_text,
           'SELECT * FROM placeholder.' || o || ' JOIN placeholder' AS app_text FROM names""",
)
def sql_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = F.concat(F.lit("SELECT * FROM ${DB}.${SC"), F.col("k"), F.lit("}."), F.col("o"))
    app = F.concat(F.lit("SELECT * FROM {db.name}."), F.col("o"), F.lit(" JOIN {t"), F.col("k"), F.lit("}"))
    return names(spark, sf_dir).select(
        "k",
        text.fill_flow_variables(flow).alias("flow_text"),
        text.fill_placeholders(app).alias("app_text"),
    )


@query(
    "sql_magic",
    f"""WITH {CORPUS_SQL}
    SELECT k, CASE WHEN k % 3 = 2 THEN ' %%sql x' || chr(10) || sql ELSE sql END AS bare FROM corpus""",
)
def sql_magic(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, sql = F.col("k"), F.col("sql")
    cell = (
        F.when(k % 3 == 0, F.concat(F.lit("%%SQL -r frame\n"), sql))
        .when(k % 3 == 2, F.concat(F.lit(" %%sql x\n"), sql))
        .otherwise(sql)
    )
    return corpus(spark, sf_dir).select("k", text.drop_magic(cell).alias("bare"))


@query(
    "sql_session_calls",
    f"""WITH {NAMES_SQL}
    SELECT k, CAST(1 + k % 5 AS INTEGER) AS line, 'select a from ' || o AS sql FROM names
    UNION ALL
    SELECT k, CAST(2 + k % 5 AS INTEGER), chr(10) || ' select b from {{db}}.' || c || ' where x = ' FROM names
    UNION ALL
    SELECT k, CAST(4 + k % 5 AS INTEGER), 'session.sql(' FROM names""",
)
def sql_session_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call per line; the second one holds a quote, where its text ends, the third a call, which is none."""
    content = F.concat(
        F.repeat(F.lit("pad = 1\n"), (F.col("k") % 5).cast("int")),
        F.lit('x = session.sql("select a from '), F.col("o"), F.lit('")\n'),
        F.lit('y = Session.SQL ( f"""\n select b from {db}.'), F.col("c"), F.lit(" where x = 'a'\"\"\")\n"),
        F.lit("""z = session.sql("session.sql('select c from no_call')")\n"""),
    )
    return (
        names(spark, sf_dir)
        .select("k", F.explode(sqlrefs.session_calls(content)).alias("call"))
        .select("k", "call.line", F.col("call.text").alias("sql"))
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL statements and prose documents."""
    return corpus(spark, sf_dir).select(
        F.lit("sql").alias("kind"), F.col("k").alias("id"), F.col("sql").alias("text")
    ).unionByName(
        table(spark, sf_dir, "documents").select(
            F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), "text"
        )
    )


TEXTS_SQL = f"""{CORPUS_SQL},
texts AS (SELECT 'sql' AS kind, k AS id, sql AS text FROM corpus
          UNION ALL SELECT 'doc', doc_id, text FROM documents)
"""


@query(
    "sql_sniff",
    f"""WITH {TEXTS_SQL}
    SELECT kind, id, length(trim(text, ' ' || chr(10) || chr(9) || chr(13))) >= 15 AND contains(upper(text), 'FROM')
           AND regexp_matches(upper(text), '^\\s*(SELECT|WITH[\\s\\S]*SELECT)') AS is_sql
    FROM texts""",
)
def sql_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("kind", "id", text.looks_like_sql(F.col("text")).alias("is_sql"))


@query(
    "sql_prose",
    f"""WITH {TEXTS_SQL}
    SELECT kind, id, ({" + ".join(
        f"CAST(contains(' ' || upper(regexp_replace(text, '^\\s+|\\s+$', '', 'g')), ' {w}') AS INTEGER)"
        for w in text.PROSE_WORDS)}) > 2 AS is_prose
    FROM texts""",
)
def sql_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select(
        "kind", "id", text.reads_like_prose(F.col("text")).alias("is_prose")
    )


# -- Python sources --------------------------------------------------------------------------------


@query(
    "py_literals",
    f"""WITH {CORPUS_SQL},
    v AS (SELECT *, (k // 8) % 4 AS variant FROM corpus)
    SELECT k, variant < 3 AS ok,
           CAST(CASE variant WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 2 END AS INTEGER) AS line,
           CASE variant WHEN 0 THEN sql WHEN 1 THEN 'SELECT * FROM {{x}}.' || o || ' JOIN {{x}}'
                        WHEN 2 THEN 'doc ' || sql END AS literal
    FROM v""",
)
def py_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain string, f-string, docstring, and a file that is no Python."""
    k, sql = F.col("k"), F.col("sql")
    q = '"""'
    variant = F.floor(k / 8) % 4
    source = (
        F.when(variant == 0, F.concat(F.lit(f"import os\nq = {q}"), sql, F.lit(f"{q}\n")))
        .when(
            variant == 1,
            F.concat(F.lit("db = 1\n\nq = f'SELECT * FROM {db!r:>{10}}.'\\\n  f'"), "o", F.lit(" JOIN {db + 1}'\n")),
        )
        .when(variant == 2, F.concat(F.lit(f"def f():\n    {q}doc "), sql, F.lit(f"{q}\n    return 1\n")))
        .otherwise(F.concat(F.lit(f"q = {q}"), sql, F.lit(f"{q} +\n")))
    )
    return (
        corpus(spark, sf_dir)
        .select("k", python_literals(source).alias("x"))
        .select("k", "x.ok", F.explode_outer("x.items").alias("item"))
        .select("k", "ok", "item.line", F.col("item.text").alias("literal"))
    )


def app_text() -> Column:
    """An app with one query: header by customer, rendering and caption at distances by order."""
    k, cust = F.col("k"), F.col("cust")
    pick = lambda items, by: F.get(F.array(*[F.lit(i) for i in items]), by)
    header = F.concat(
        pick(('st.subheader("Sub ', 'st.header("Head ', "with tabs[0]: pass # ", "n = 0 # "), cust % 4),
        F.col("c"),
        pick(('")', '")', "", ""), cust % 4),
    )
    render = pick(
        ("st.bar_chart(q)", "st.line_chart(q)", "st.dataframe(q)", "st.table(q)", "st.metric(q)",
         "z = q.to_pandas()"), k % 6,
    )
    return F.concat(
        F.lit("import streamlit as st\n"),
        F.lit('tabs = st.tabs(["First '), F.col("c"), F.lit('", "Second"])\n'),
        header, F.lit("\n"),
        F.lit('q = """SELECT * FROM db.s.'), F.col("o"), F.lit(" JOIN "), F.col("c"), F.lit(' USING (id)"""\n'),
        F.repeat(F.lit("y = 1\n"), (k % 60).cast("int")),
        render, F.lit("\n"),
        F.repeat(F.lit("w = 1\n"), (k % 12).cast("int")),
        F.lit('st.caption("Cap '), F.col("o"), F.lit('")\n'),
    )


def stage_extracted(df: DataFrame, name: str) -> DataFrame:
    """Write what Python read once: queries and markers both start from it."""
    return stage_table(df, name) if name == "extracted" else df


@query(
    "chart_infer",
    f"""WITH {NAMES_SQL}
    SELECT 'apps/' || k || '.py' AS file_path, CAST(1 AS BIGINT) AS id, CAST(4 AS INTEGER) AS line_number,
           CASE WHEN k % 60 > 49 THEN 'unknown' ELSE CASE k % 6 WHEN 0 THEN 'bar_chart' WHEN 1 THEN 'line_chart'
                WHEN 2 THEN 'dataframe' WHEN 3 THEN 'table' WHEN 4 THEN 'metric' ELSE 'pandas_dataframe' END END
             AS chart_type,
           CASE cust % 4 WHEN 0 THEN 'Sub ' || c WHEN 1 THEN 'Head ' || c WHEN 2 THEN 'First ' || c END AS chart_name,
           CASE WHEN k % 60 <= 49 AND k % 12 <= 8 THEN 'Cap ' || o END AS chart_caption,
           c || ',db.s.' || o AS tables
    FROM names""",
)
def chart_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = names(spark, sf_dir).select(
        F.concat(F.lit("apps/"), "k", F.lit(".py")).alias("rel_path"), app_text().alias("content")
    )
    return dashboard.parse(dashboard.discover(apps), stage_extracted).usage.select(
        "file_path", "id", "line_number", "chart_type", "chart_name", "chart_caption",
        F.array_join("tables_used", ",").alias("tables"),
    )
