"""Table references of SQL text, as column expressions.

The text is never parsed by a grammar. Literals and comments are blanked, quoted identifiers are
turned into plain words, brackets are opened so that every SELECT ends up as its
own bracket-free fragment, and table names are what stands between FROM and the next clause. Text that
cannot be a statement (odd quotes, unbalanced brackets, a dangling operator at the end) has no tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.text import (
    FLOW_NAME,
    PLACEHOLDER_NAME,
    drop_magic,
    fill_flow_variables,
    fill_placeholders,
    strip,
)

#: Stands where a bracket was peeled off; cannot occur in SQL text.
HOLE = "\x01"
#: Stands where a fragment ends while fragments are put together.
END = "\x02"

BLANK = (
    r"(?s)(')[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+(')"  # literal -> ''
    r'|("[^"]*+")'  # quoted identifier, kept
    r"|--[^\n]*+|//[^\n]*+|/\*.*?\*/|\$\$.*?\$\$"  # comment or dollar-quoted text -> blank
)
# What begins a literal, a quoted identifier or a comment; without one of these nothing is blanked.
BLANKED = ("'", '"', "--", "//", "/*", "$$")

# The words a statement can begin with.
STATEMENT_WORDS = (
    "SELECT WITH INSERT UPDATE DELETE MERGE CREATE ALTER DROP TRUNCATE COPY PUT GET LIST REMOVE UNLOAD CALL EXECUTE "
    "EXEC BEGIN START COMMIT ROLLBACK END DECLARE LET SET UNSET USE SHOW DESCRIBE DESC EXPLAIN GRANT REVOKE COMMENT "
    "ANALYZE VACUUM REFRESH UNDROP RETURN IF FOR WHILE LOOP REPEAT VALUES"
).split()
# Words that end a FROM clause, and words that are no table although they follow FROM.
CLAUSE_WORDS = (
    "WHERE GROUP ORDER HAVING QUALIFY LIMIT UNION INTERSECT EXCEPT MINUS WINDOW START CONNECT FETCH "
    "OFFSET WHEN SET RETURNING FROM SELECT"
).split()
NOT_TABLES = ("lateral", "table", "unnest", "values", "select", "only")
#: Looked for in the last characters only.
DANGLING = (
    r"(?i)(?:[=<>+\-/,.(|]|\b(?:SELECT|FROM|WHERE|AND|OR|NOT|ON|BY|JOIN|IN|LIKE|BETWEEN|HAVING))\s*$"
)

IDENT = r"[\p{L}_$][\p{L}\p{N}_$]*+"
DOTTED = rf"(?:{IDENT}\s*+\.\s*+(?:\.\s*+)?+)*+{IDENT}"
# Word by word rather than character by character; a dotted word such as ``a.order`` ends nothing.
FROM_BODY = (
    rf"(?i)(?<![.\w])FROM\b((?:[^\w;]++|(?!(?:{'|'.join(CLAUSE_WORDS)})\b)[\w.$]++)*+)"
)
# A single table in brackets: directly inside other brackets, or after FROM or JOIN.
LONE = rf"(?!SELECT\b|VALUES\b){DOTTED}(?:\s+(?:AS\s+)?{IDENT})?"
LONE_INSIDE = rf"(?i)(?<=\()\s*\(\s*({LONE})\s*\)\s*(?=\))"
LONE_TABLE = rf"(?i)(?<![.\w])(FROM|JOIN)\s*\(\s*({LONE})\s*\)"
LONE_CHAIN = rf"(?i)(?<![.\w])(?:FROM|JOIN)\s*\((?:\s*\()*\s*{LONE}\s*\)"
USING_BODY = r"(?is)\A\s*MERGE\s.*?(?<![.\w])USING\b(.*?)(?=(?<![.\w])ON\b|$)"
HEADS = r"(?is)\A[\s(]*+(?:SELECT|WITH|INSERT|CREATE|UPDATE|MERGE|DELETE)\b"
CTE_NAME = rf"(?is)(?:\bWITH(?:\s+RECURSIVE)?\s|,)\s*({IDENT})\s*{HOLE}?\s*AS\s*(?:(?:NOT\s+)?MATERIALIZED\s*)?{HOLE}"
TARGET = (
    rf"(?is)\A\s*(?:CREATE\s+(?:OR\s+(?:REPLACE|ALTER)\s+)?"
    rf"(?:(?:LOCAL|GLOBAL|TEMP|TEMPORARY|TRANSIENT|VOLATILE|SECURE|RECURSIVE|MATERIALIZED|DYNAMIC|"
    rf"EXTERNAL|HYBRID|ICEBERG)\s+)*+(?:TABLE|VIEW)\s+(?:IF\s+NOT\s+EXISTS\s+)?"
    rf"|INSERT\s+(?:OVERWRITE\s+)?INTO\s+(?:TABLE\s+)?|MERGE\s+INTO\s+)({DOTTED})"
)

#: Every table a statement writes to, for the list of all tables it names.
ANY_TARGET = TARGET.replace(
    r"|MERGE\s+INTO\s+)", r"|MERGE\s+INTO\s+|UPDATE\s+|DELETE\s+FROM\s+|TRUNCATE\s+TABLE\s+)"
)


# -- preparation -------------------------------------------------------------------------------


def encode_quoted(c: Column) -> Column:
    """``"a b"`` becomes one plain word that ``decode_quoted`` turns back."""
    parts = F.split(c, '"', -1)
    words = F.transform(
        parts,
        lambda x, i: F.when(
            i % 2 == 1, F.concat(F.lit("q__"), F.hex(F.encode(x, "UTF-8")), F.lit("__q"))
        ).otherwise(x),
    )
    return F.when(c.contains('"'), F.array_join(words, "")).otherwise(c)


def decode_quoted(word: Column) -> Column:
    code = F.regexp_extract(word, r"^q__([0-9A-F]*)__q$", 1)
    return F.when(word.startswith("q__"), F.decode(F.unhex(code), "UTF-8")).otherwise(word)


def blank(c: Column) -> Column:
    """Literals become ``''``, comments a blank, and ``IS DISTINCT FROM`` an operator."""
    held = reduce(or_, [c.contains(sign) for sign in BLANKED])
    text = F.when(held, F.regexp_replace(c, BLANK, " $1$2$3 ")).otherwise(c)
    return F.when(
        F.upper(c).contains("DISTINCT"), F.regexp_replace(text, r"(?i)\bIS\s+(?:NOT\s+)?DISTINCT\s+FROM\b", "=")
    ).otherwise(text)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def well_formed(blanked: Column) -> Column:
    """No open literal or quoted identifier, brackets pair up."""
    return (
        (_count(blanked, "'") % 2 == 0)
        & (_count(blanked, '"') % 2 == 0)
        & (_count(blanked, "(") == _count(blanked, ")"))
    )


def unwrap(c: Column) -> Column:
    """``FROM ((t))`` and the like without the brackets around the single table, as often as the longest such
    chain of brackets asks for."""
    chains = F.transform(F.regexp_extract_all(c, F.lit(LONE_CHAIN), F.lit(0)), lambda x: _count(x, "("))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.array_max(chains)),
        c,
        lambda acc, _: F.regexp_replace(F.regexp_replace(acc, LONE_INSIDE, "$1"), LONE_TABLE, "$1 $2 "),
    )
    return F.when(c.rlike(LONE_CHAIN), steps).otherwise(c)


def peel(c: Column) -> Column:
    """Bracket-free fragments: what stands in each pair of brackets, with a hole for every bracket inside it,
    and the text around them all.

    The text is cut after every bracket and each piece gets the depth it stands at, a running count. Pieces in
    the order of their depths are the fragments one after the other, ended by the piece that closes them. So
    each piece of text is taken up once, however deep it lies.
    """
    start = F.struct(F.lit(0).alias("now"), F.lit("").alias("trail"))

    def count(acc: Column, piece: Column) -> Column:
        return F.struct(
            (acc["now"] + piece.endswith("(").cast("int") - piece.endswith(")").cast("int")).alias("now"),
            F.concat(acc["trail"], acc["now"].cast("string"), F.lit(" ")).alias("trail"),
        )

    def placed(piece: Column, i: Column) -> Column:
        told = F.when(piece["text"].endswith("("), F.concat(piece["text"], F.lit(f" {HOLE} "))).when(
            piece["text"].endswith(")"), F.concat(piece["text"], F.lit(END))
        )
        return F.struct(
            piece["depth"].cast("int").alias("depth"), i.alias("nth"), told.otherwise(piece["text"]).alias("text")
        )

    def sorted_text(pieces: Column) -> Column:
        depths = F.split(F.rtrim(F.aggregate(pieces, start, count, lambda acc: acc["trail"])), " ")
        sorted_ = F.sort_array(F.transform(F.arrays_zip(pieces.alias("text"), depths.alias("depth")), placed))
        return F.array_join(sorted_["text"], "")

    joined = let(F.split(F.concat(c, F.lit(END)), r"(?<=[()])", -1), sorted_text)
    fragments = F.split(F.translate(joined, "()", ""), END)
    return F.when(c.contains("("), fragments).otherwise(F.array(c))


# -- references --------------------------------------------------------------------------------


def from_bodies(fragments: Column) -> Column:
    """Text between FROM and the next clause; for a bracketed join, the whole fragment."""

    def of(fragment: Column) -> Column:
        query = fragment.rlike(r"(?i)(?<![.\w])(?:SELECT|UPDATE)\b")
        join = fragment.rlike(r"(?i)(?<![.\w])JOIN\b")
        return (
            F.when(query, F.regexp_extract_all(fragment, F.lit(FROM_BODY), F.lit(1)))
            .when(join, F.array(fragment))
            .otherwise(F.array().cast("array<string>"))
        )

    return F.flatten(F.transform(fragments, of))


def _squeeze(name: Column) -> Column:
    return F.translate(name, " \t\r\n", "")


def dotted_names(bodies: Column) -> Column:
    """Leading dotted name of each comma or JOIN item; functions and sub-queries have none."""
    items = F.flatten(F.transform(bodies, lambda b: F.split(b, r"(?i),|(?<![.\w])JOIN\b")))
    pattern = rf"(?is)\A\s*({DOTTED})(?!\s*{HOLE})"
    names = F.transform(items, lambda i: _squeeze(F.regexp_extract(i, pattern, 1)))
    return F.filter(names, lambda n: (n != "") & ~F.lower(n).isin(*NOT_TABLES))


def _segments(name: Column) -> Column:
    return F.transform(F.filter(F.split(name, r"\."), lambda s: s != ""), decode_quoted)


def full_name(name: Column) -> Column:
    return F.array_join(_segments(name), ".")


def bare_name(name: Column) -> Column:
    return F.lower(decode_quoted(F.substring_index(name, ".", -1)))


def cte_names(fragments: Column) -> Column:
    found = F.flatten(
        F.transform(fragments, lambda f: F.regexp_extract_all(f, F.lit(CTE_NAME), F.lit(1)))
    )
    return F.transform(found, lambda n: F.lower(decode_quoted(n)))


def _distinct(names: Column) -> Column:
    return F.array_sort(F.array_distinct(names))



def _empty() -> Column:
    return F.array().cast("array<string>")


def _first_statement(df: DataFrame, sql: Column) -> DataFrame:
    """Adds ``_frag``: fragments of the first statement, null where the text is no statement."""
    df = df.withColumn("_text", sql).withColumn("_blank", blank(F.col("_text")))
    whole = well_formed(F.col("_blank"))
    df = df.withColumn(
        "_stmt", F.when(whole, F.get(F.split(encode_quoted(F.col("_blank")), ";"), F.lit(0)))
    ).withColumn(
        "_stmt",
        F.when(F.col("_stmt").rlike(HEADS) & ~F.right(strip(F.col("_stmt")), F.lit(9)).rlike(DANGLING), F.col("_stmt")),
    )
    df = df.withColumn("_stmt", unwrap(F.col("_stmt")))
    return df.withColumn("_frag", peel(F.col("_stmt"))).drop("_text", "_blank", "_stmt")


def with_qualified_refs(df: DataFrame, sql: str, out: str) -> DataFrame:
    """Every table the first statement names, qualifiers and case kept, CTE references included."""
    df = _first_statement(df, fill_placeholders(F.col(sql)))
    written = F.filter(
        F.transform("_frag", lambda f: F.regexp_extract(f, ANY_TARGET, 1)), lambda t: t != ""
    )
    using = F.filter(
        F.transform("_frag", lambda f: F.regexp_extract(f, USING_BODY, 1)), lambda u: u != ""
    )
    df = df.withColumn(
        "_names", F.concat(dotted_names(F.concat(from_bodies(F.col("_frag")), using)), written)
    )
    names = _distinct(F.transform("_names", lambda n: full_name(_squeeze(n))))
    return df.withColumn(out, F.coalesce(names, _empty())).drop("_frag", "_names")


def with_read_refs(df: DataFrame, sql: str, out: str) -> DataFrame:
    """Bare lower-case tables under FROM and JOIN of the first statement, without its CTEs."""
    text = fill_placeholders(strip(drop_magic(F.col(sql))))
    df = _first_statement(df, text)
    df = df.withColumn("_names", dotted_names(from_bodies(F.col("_frag"))))
    # Qualified names cannot be CTE references. The difference is taken outside of any lambda, so that
    # the CTE names are found once per statement.
    qualified = F.transform(F.filter("_names", lambda n: n.contains(".")), bare_name)
    plain = F.transform(F.filter("_names", lambda n: ~n.contains(".")), bare_name)
    kept = F.concat(qualified, F.array_except(plain, cte_names(F.col("_frag"))))
    names = _distinct(F.filter(kept, lambda n: n != PLACEHOLDER_NAME))
    return df.withColumn(out, F.coalesce(names, _empty())).drop("_frag", "_names")


def statement_io(statement: Column) -> Column:
    """Struct (target, sources) of one blanked statement; target null if it moves no data.

    The sources of a MERGE are what its USING clause names. A statement's own target is no source.
    """
    merge = statement.rlike(r"(?i)\A\s*MERGE\b")
    body = F.when(
        merge, F.regexp_replace(statement, r"(?is)(?<![.\w])WHEN\s+(?:NOT\s+)?MATCHED\b.*\z", "")
    ).otherwise(statement)
    fragments = let(body, lambda b: let(unwrap(b), peel))
    target = bare_name(F.nullif(_squeeze(F.regexp_extract(statement, TARGET, 1)), F.lit("")))
    return F.struct(target.alias("target"), fragments.alias("fragments"), merge.alias("merge"))


def unreadable(statement: Column) -> Column:
    """Whether a statement begins with no word a statement begins with, or breaks off at its end."""
    known = statement.rlike(rf"(?i)\A[\s(]*+(?:{'|'.join(STATEMENT_WORDS)})\b")
    return (strip(statement) != "") & (~known | F.right(strip(statement), F.lit(9)).rlike(DANGLING))


def with_script_io(
    df: DataFrame, sql: str, sources: str, targets: str, partial: str | None = None
) -> DataFrame:
    """Sorted bare tables a script reads (``sources``) and writes (``targets``).

    CREATE ... AS, INSERT ... SELECT and MERGE ... USING count; a statement without a target (UPDATE,
    DELETE, CALL, a bare SELECT) does not. CTE references stay. A script with odd quotes or brackets
    yields nothing; an unreadable statement is left out alone. Either way ``partial`` says so.
    """
    df = df.withColumn("_text", fill_flow_variables(F.col(sql))).withColumn("_blank", blank(F.col("_text")))
    if partial:
        bad = F.exists(F.split("_blank", ";"), unreadable)
        df = df.withColumn(partial, F.coalesce(~well_formed(F.col("_blank")) | bad, F.lit(False)))
    df = df.withColumn(
        "_stmts",
        F.when(
            well_formed(F.col("_blank")),
            F.filter(
                F.split(encode_quoted(F.col("_blank")), ";"),
                lambda s: s.rlike(r"(?i)\A\s*(?:CREATE|INSERT|MERGE)\b") & ~unreadable(s),
            ),
        ),
    ).drop("_text", "_blank")
    df = df.withColumn(
        "_io", F.filter(F.transform("_stmts", statement_io), lambda x: x["target"].isNotNull())
    ).drop("_stmts")

    def read_by(io: Column) -> Column:
        using = F.transform(
            io["fragments"], lambda f: F.regexp_extract(f, USING_BODY, 1)
        )
        bodies = F.concat(
            from_bodies(io["fragments"]),
            F.when(io["merge"], F.filter(using, lambda u: u != "")).otherwise(_empty()),
        )
        names = F.transform(dotted_names(bodies), bare_name)
        return F.filter(names, lambda n: n != io["target"])

    df = df.withColumn("_read", F.transform("_io", read_by))
    real = lambda names: _distinct(F.filter(names, lambda n: n != FLOW_NAME.lower()))
    return (
        df.withColumn(sources, F.coalesce(real(F.flatten("_read")), _empty()))
        .withColumn(
            targets, F.coalesce(real(F.transform("_io", lambda x: x["target"])), _empty())
        )
        .drop("_io", "_read")
    )


# -- session.sql("...") calls in Python text ---------------------------------------------------

# Fixed value: pattern of the start of a query call.
CALL_HEAD = r"""session\.sql\s*\(\s*[f]?["']+"""
# What no such call is without, in lower case.
CALL_WORD = "session.sql"


def session_calls(content: Column) -> Column:
    """Array of (line, sql) for each ``session.sql("...")``, text up to the first quote character. A call in
    the text of a call is none: the search goes on after the end of a match."""
    call = rf"""(?is){CALL_HEAD}(.*?)["']+"""
    none = F.array().cast("array<struct<line:int,text:string>>")
    between = F.split(content, call, -1)
    whole, texts = (F.regexp_extract_all(content, F.lit(call), F.lit(group)) for group in (0, 1))
    found = F.aggregate(
        F.arrays_zip(between.alias("before"), whole.alias("whole"), texts.alias("text")),
        F.struct(F.lit(1).alias("line"), none.alias("found")),
        lambda acc, c: F.struct(
            (acc["line"] + _count(c["before"], "\n") + F.coalesce(_count(c["whole"], "\n"), F.lit(0))).alias("line"),
            F.concat(
                acc["found"],
                F.when(
                    c["whole"].isNotNull(),
                    F.array(
                        F.struct(
                            (acc["line"] + _count(c["before"], "\n")).alias("line"), c["text"].alias("text")
                        )
                    ),
                ).otherwise(none),
            ).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    # Most texts have none, and are not searched.
    return F.when(F.lower(content).contains(CALL_WORD), found).when(content.isNotNull(), none)
