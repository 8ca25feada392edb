import pytest

from weftgraph.functions import sqlrefs, text

CASES = [
    ("select * from a, B b2, c.d where x in (select y from e)", ["B", "a", "c.d", "e"], ["a", "b", "d", "e"]),
    (
        "WITH x AS (SELECT * FROM base), y AS (select 1 from x join z.w using (id)) SELECT * FROM x, y",
        ["base", "x", "y", "z.w"],
        ["base", "w"],
    ),
    ("WITH RECURSIVE r (n) AS (SELECT 1 FROM seed) SELECT * FROM r JOIN s.r USING (n)", ["r", "s.r", "seed"], ["r", "seed"]),
    (
        "SELECT EXTRACT(YEAR FROM d) FROM (SELECT * FROM i1 JOIN i2 ON (a=b)) q, o -- from nope\n"
        " WHERE x IS NOT DISTINCT FROM y",
        ["i1", "i2", "o"],
        ["i1", "i2", "o"],
    ),
    (
        'SELECT * FROM "My Db"."S"."Order, Items" o LEFT JOIN foo(1) f ON true, LATERAL FLATTEN(input => o.x) g',
        ["My Db.S.Order, Items"],
        ["order, items"],
    ),
    ("SELECT * FROM (a JOIN b ON a.i=b.i) JOIN c", ["a", "b", "c"], ["a", "b", "c"]),
    ("SELECT * FROM {db}.{sch}.tab JOIN {t2} USING (x)", ["placeholder", "placeholder.placeholder.tab"], ["tab"]),
    ("SELECT * FROM db . sch . Tab t", ["db.sch.Tab"], ["tab"]),
    ("SELECT * FROM db..Tab", ["db.Tab"], ["tab"]),
    ("SELECT * FROM t WHERE x = ", [], []),
    ("SELECT * FROM t WHERE (x = 1", [], []),
    ("SELECT * FROM t WHERE x = 'open", [], []),
    ("SELECT * FROM t WHERE x = 'it''s'; SELECT * FROM u", ["t"], ["t"]),
    ("%%sql -r x\nSELECT * FROM magic_t", [], ["magic_t"]),
    ("REVOKE SELECT ON TABLE t FROM ROLE r", [], []),
    ("SELECT a.order FROM t1 a JOIN t2 b ON a.order = b.where JOIN t3", ["t1", "t2", "t3"], ["t1", "t2", "t3"]),
    ("SELECT * FROM a /* ' */ JOIN b // '\n JOIN c WHERE q='\\'from z'", ["a", "b", "c"], ["a", "b", "c"]),
    ("select * from t1 union all select * from (select * from t2) x minus select * from t3", ["t1", "t2", "t3"], ["t1", "t2", "t3"]),
    ("INSERT INTO tgt (a) SELECT a FROM s1", ["s1", "tgt"], ["s1"]),
    ("MERGE INTO tgt t USING src s ON t.i = s.i WHEN MATCHED THEN DELETE", ["src", "tgt"], []),
    ("DELETE FROM t WHERE i IN (SELECT i FROM u)", ["t", "u"], ["u"]),
    ("", [], []),
    (None, [], []),
]


def test_refs(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, sql string")
    df = sqlrefs.with_read_refs(sqlrefs.with_qualified_refs(df, "sql", "q"), "sql", "r")
    for row in df.collect():
        _, qualified, read = CASES[row["i"]]
        assert (row["q"], row["r"]) == (qualified, read), CASES[row["i"]][0]


def test_long_text(spark):
    many = "SELECT * FROM t WHERE x IN (" + ",".join(f"'{i}'" for i in range(50_000)) + ")"
    quoted = f"{many} AND y = '{'a' * 1}{chr(39) * 2 * 100_000}' AND z IN (SELECT q FROM u)"
    nested = "SELECT * FROM " + "(SELECT * FROM " * 60 + "deep" + ") x" * 60
    wide = "SELECT * FROM " + ", ".join(f"db.t{i} a{i}" for i in range(2_000))
    df = spark.createDataFrame([(quoted,), (nested,), (wide,)], "sql string")
    found = [r["r"] for r in sqlrefs.with_read_refs(df, "sql", "r").collect()]
    assert found[:2] == [["t", "u"], ["deep"]] and len(found[2]) == 2_000


def test_script(spark):
    script = """CREATE OR REPLACE VIEW ${DB}.${S}.V_A AS SELECT * FROM raw.R1 JOIN r2 USING (id);
    INSERT INTO stg (a, b) SELECT a, b FROM src1, src2 WHERE x='; insert into q select 1 from bad';
    MERGE INTO tgt t USING (SELECT * FROM m1 JOIN tgt ON 1=1) s ON t.i=s.i
      WHEN MATCHED THEN UPDATE SET a = (select max(z) from nope);
    MERGE INTO tgt2 USING m2 s ON t.i=s.i WHEN NOT MATCHED THEN INSERT (a) VALUES (1);
    UPDATE u SET a=1 FROM uu; DELETE FROM d; TRUNCATE TABLE t; CALL p(1);
    CREATE TRANSIENT TABLE IF NOT EXISTS plain (a int); INSERT INTO audit VALUES (1,2);
    INSERT OVERWRITE INTO self SELECT * FROM self JOIN o1; WITH c AS (select 1 from c0) select * from c;
    CREATE TABLE w AS WITH c AS (SELECT * FROM c1) SELECT * FROM c; SELECT * FROM ${X}"""
    cases = [script, "INSERT INTO a SELECT * FROM b WHERE (x", "INSERT INTO ${T} SELECT * FROM ${S}", "", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, sql string")
    rows = sqlrefs.with_script_io(df, "sql", "s", "t").orderBy("i").collect()
    assert rows[0]["s"] == ["c", "c1", "m1", "m2", "o1", "r1", "r2", "src1", "src2"]
    assert rows[0]["t"] == ["audit", "plain", "self", "stg", "tgt", "tgt2", "v_a", "w"]
    assert all(r["s"] == [] and r["t"] == [] for r in rows[1:])


@pytest.mark.parametrize(
    "path, name",
    [
        ("x/f1_custom_load.orch.yaml", "F1 Custom Load"),
        ("custom-load_2nd.ipynb", "Custom-Load 2Nd"),
        ("o'neil_été.orch.yaml", "O'Neil Été"),
    ],
)
def test_display_name(spark, path, name):
    from pyspark.sql import functions as F

    assert spark.range(1).select(text.display_name(F.lit(path))).first()[0] == name


def test_sniffing(spark):
    from pyspark.sql import functions as F

    texts = ["select 1 from t", "\n\t select a from tab  ", "with a as (select 1 from b) select", "with a from b, c, d", "update t set a = 1 from b", "SELECT x FRM table_x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(text.looks_like_sql(F.col("t"))).collect()] == [
        True, True, True, False, False, False, False,
    ]
