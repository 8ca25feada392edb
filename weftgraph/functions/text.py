"""String rules as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words whose presence marks a text as English prose.
PROSE_WORDS = (
    "THE ", "A ", "AN ", "IS ", "ARE ", "WAS ", "WERE ",
    "THIS ", "THAT ", "THESE ", "THOSE ", "WILL ", "CAN ",
)

MIN_SQL_LENGTH = 15

# Patterns of templated names and of the line that starts a SQL cell, and what stands in
# for the names.
FLOW_VARIABLE, FLOW_NAME = r"\$\{[^}]+\}", "_MTL_VAR_"
PLACEHOLDER, PLACEHOLDER_NAME = r"\{[^}]+\}", "placeholder"
MAGIC_LINE = r"(?i)\A%%sql[^\n]*\n?"

# Formats of links and lists.
SOURCE_URL = "{}/blob/{}/{}"
MORE = " and {} more"


# What counts as whitespace at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Whitespace of any kind off both ends (a plain ``trim`` takes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def fill(template: str, *values: Column) -> Column:
    """``template`` with its ``{}`` replaced; null if a value is null."""
    pieces = template.split("{}")
    parts: list[Column] = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)


def title_case(c: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others."""
    words = F.split(F.lower(c), r"(?<=[^\p{L}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**30))),
        "",
    )


def file_stem(path: Column) -> Column:
    """Last path segment without its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def display_name(path: Column) -> Column:
    return title_case(F.translate(F.replace(file_stem(path), F.lit(".orch"), F.lit("")), "_", " "))


def app_name(rel_path: Column) -> Column:
    """Top folder of a nested file, else the file stem."""
    parts = F.split(rel_path, "/")
    return F.when(F.size(parts) > 1, parts[0]).otherwise(file_stem(rel_path))


def source_url(repo: Column, branch: Column, rel_path: Column) -> Column:
    return fill(SOURCE_URL, repo, branch, rel_path)


def bare_table(c: Column) -> Column:
    """Last segment of a dotted name, lower-cased; null for nothing."""
    return F.nullif(F.lower(F.element_at(F.split(c, r"\."), -1)), F.lit(""))


def fill_flow_variables(c: Column) -> Column:
    return F.regexp_replace(c, FLOW_VARIABLE, FLOW_NAME)


def fill_placeholders(c: Column) -> Column:
    return F.when(c.contains("{"), F.regexp_replace(c, PLACEHOLDER, PLACEHOLDER_NAME)).otherwise(c)


def drop_magic(c: Column) -> Column:
    """Takes a leading ``%%sql ...`` line off."""
    return F.regexp_replace(c, MAGIC_LINE, "")


def _holds(value: Column, test) -> Column:
    """``test(value)`` with ``value`` computed once, however often the test mentions it."""
    return F.exists(F.array(value), test)


def looks_like_sql(c: Column) -> Column:
    def test(t: Column) -> Column:
        query = t.startswith("SELECT") | (t.startswith("WITH") & t.contains("SELECT"))
        return (F.length(t) >= MIN_SQL_LENGTH) & query & t.contains("FROM")

    # Most strings of a program are shorter than any query: they are not even stripped.
    return F.coalesce(
        (F.length(c) >= MIN_SQL_LENGTH) & _holds(F.upper(strip(c)), test), F.lit(False)
    )


def reads_like_prose(c: Column) -> Column:
    """More than two of the prose words occur."""

    def test(t: Column) -> Column:
        return sum(t.contains(f" {w}").cast("int") for w in PROSE_WORDS) > 2

    return _holds(F.concat(F.lit(" "), F.upper(strip(c))), test)


def call_leaf(path: Column) -> Column:
    """Last segment of a call path without its yaml suffix."""
    leaf = F.element_at(F.split(F.regexp_replace(path, r"/+$", ""), "/"), -1)
    return F.nullif(F.regexp_replace(leaf, r"(?i)(?:\.orch)?\.yaml$", ""), F.lit(""))


def landing_to_staging(table: Column) -> Column:
    return F.when(
        F.upper(table).endswith("_LND"), F.concat(table.substr(F.lit(1), F.length(table) - 4), F.lit("_STG"))
    ).otherwise(table)


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def preview(items: Column, n: int) -> Column:
    """``a, b, c and k more``."""
    shown = F.array_join(F.slice(items, 1, n), ", ")
    more = fill(MORE, F.size(items) - n)
    return F.when(F.size(items) > n, F.concat(shown, more)).otherwise(shown)


def snippet(c: Column, n: int = 200) -> Column:
    return F.substring(c, 1, n)


def heading(markdown: Column) -> Column:
    """First line that is not empty once ``#`` and blanks are off; null if there is none."""
    lines = F.split(markdown, r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]")
    bare = F.transform(lines, lambda x: strip(F.ltrim(x, F.lit("#"))))
    return F.get(F.filter(bare, lambda x: x != ""), F.lit(0))


def line_of(text: Column, position: Column) -> Column:
    """1-based line of the 1-based character ``position``."""
    return F.size(F.split(F.substring(text, F.lit(1), position - 1), "\n", -1))


# -- dashboard markers -------------------------------------------------------------------------

# What marks a rendered result, in order of precedence within a line.
RENDER_MARKS = (
    ("st.bar_chart", "bar_chart"),
    ("st.line_chart", "line_chart"),
    ("st.dataframe", "dataframe"),
    ("st.table", "table"),
    ("st.metric", "metric"),
    ("to_pandas()", "pandas_dataframe"),
)


# Patterns of a call with one quoted argument and of a triple-quoted markdown call.
QUOTED_CALL = r"""st\.{}\(["']([^"']+)["']\)"""
MARKDOWN_CALL = r"""(?s)st\.markdown\(["']{3}(.*?)["']{3}\)"""


def call_text(c: Column, name: str) -> Column:
    """First quoted argument of ``st.<name>("...")``; null without one."""
    found = F.nullif(F.regexp_extract(c, QUOTED_CALL.format(name), 1), F.lit(""))
    return F.when(c.contains(f"st.{name}("), found)


def render_type(line: Column) -> Column:
    return F.coalesce(*[F.when(line.contains(mark), F.lit(kind)) for mark, kind in RENDER_MARKS])


def app_title(content: Column) -> Column:
    return call_text(content, "title")


def app_description(content: Column) -> Column:
    """Text of the first triple-quoted ``st.markdown``; null without one."""
    return F.when(
        content.contains("st.markdown(") & content.rlike(MARKDOWN_CALL),
        strip(F.regexp_extract(content, MARKDOWN_CALL, 1)),
    )
