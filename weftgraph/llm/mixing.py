"""Mixing sources to target weights by weighted fair queueing.

Every source sends its documents in a shuffled order, as often as the limit on repeats allows. A copy is
finished when its source has sent so many words, counted from the start, divided by the source's target:
its virtual finish time. All copies in the order of finish times, cut where the budget is used up, are
the mix. Time 1 is where each source has just reached its target.

Null, empty and blank texts have size 0 and are taken 0 times their size; a null source is a source of
its own, after all others; a null key is shuffled like any other key; repeated rows are sent one after
the other; an empty table gives an empty mix. Other columns are carried in ``row`` and may have any name.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.words import word_count
from weftgraph.session import stage_table

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents in one sorted piece of a source, on average.
PIECE_ROWS = 50_000
#: Pieces per unit of virtual time in which the cut is looked for.
TIME_PIECES = 4096


def shuffle_key(key: Column) -> Column:
    """60 bits of a digest of the key: the shuffled order, the same in every run."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source (one row each: source, source_size) its place, weight and target in words.

    Sources in code point order, null last, weigh ``weights`` by turns. A source gets its weight's share of
    all words; above ``most`` times its size it stops there and the excess goes to the others by weight.
    In ascending order of the level at which a source is full, a source is full if the level that those
    before it leave exceeds its own.
    """
    turn = F.array(*[F.lit(int(w)) for w in weights])
    one = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", "place")
    unit = lcm(*weights)
    ranked = (
        sizes.withColumn("place", F.row_number().over(one) - 1)
        .withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("most", F.col("source_size") * most)
        .withColumn("level", F.expr(f"most * {unit} div weight"))
    )
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    full = ranked.withColumn(
        "full", left * unit > F.col("level") * F.sum("weight").over(after)
    )
    rest = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0)
    )
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    share = (F.col("weight") * rest).cast("double") / open_weight.cast("double")
    return full.withColumn(
        "target", F.when(F.col("full"), F.col("most").cast("double")).otherwise(share)
    ).select("source", "source_size", "place", "target")


def mix(
    docs: DataFrame,
    keep: list[str] | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """``row`` (the columns to keep), source, size, source_size, target, copies, taken per document.

    A source is cut into pieces of its shuffled order, whose sums give every piece its start, so no source
    is ever sorted in one task. The place of the cut is a sum over pieces of time, then over one piece.
    """
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in (keep if keep is not None else docs.columns)])
    sized = docs.select(
        row.alias("row"),
        docs[source].alias("source"),
        docs[key].cast("string").alias("key"),
        word_count(docs[text]).alias("size"),
        shuffle_key(docs[key]).alias("turn"),
    )
    narrow = stage_table(sized.select("source", "key", "size", "turn"), "mix-sizes")
    sources = stage_table(
        targets(
            narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most
        ),
        "mix-sources",
    )
    bits = max(0, (narrow.count() // PIECE_ROWS).bit_length())
    piece = F.shiftright("turn", 60 - bits)
    pieces = (
        narrow.groupBy("source", piece.alias("piece"))
        .agg(F.sum("size").alias("words"))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("words").over(
                    Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .join(sources.withColumnRenamed("source", "s"), F.expr("source <=> s"))
        .select(F.struct("source", "piece").alias("at"), "before", "source_size", "place", "target")
    )
    pieces = stage_table(pieces, "mix-pieces")

    def queued(rows: DataFrame) -> DataFrame:
        """Rows with what their source has sent when the first copy is finished, and copies by time 1."""
        here = rows.withColumn("at", F.struct("source", piece.alias("piece"))).join(pieces, "at")
        order = Window.partitionBy("at").orderBy("turn", "key", "size")
        sent = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        return here.withColumn("sent", sent).withColumn(
            "copies", sum((sent + F.col("source_size") * e <= F.col("target")).cast("int") for e in range(most))
        )

    late = (
        queued(narrow)
        .where("size > 0")
        .select(
            "place",
            "size",
            F.explode(
                F.expr(
                    f"transform(filter(sequence(0, {most - 1}), e -> e >= copies), "
                    "e -> (sent + source_size * e) / target)"
                )
            ).alias("finish"),
        )
    )
    time, at_place = _cut(narrow, sources, late, queued)
    finish = [(F.col("sent") + F.col("source_size") * e) / F.col("target") for e in range(most)]
    extra = sum(
        (
            F.coalesce(
                (F.lit(e) >= F.col("copies"))
                & ((f < time) | ((f == time) & (F.col("place") <= at_place))),
                F.lit(False),
            )
        ).cast("int")
        for e, f in enumerate(finish)
    )
    return (
        queued(sized)
        .withColumn("copies", F.when(F.col("size") > 0, F.col("copies") + extra).otherwise(1))
        .select(
            "row",
            F.col("at.source").alias("source"),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def _cut(narrow: DataFrame, sources: DataFrame, late: DataFrame, queued) -> tuple[float, int]:
    """(time, place) of the last copy after time 1 that the budget still holds; two numbers."""
    budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    sent = queued(narrow).agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0))).first()[0]
    left = int(budget - sent)
    late = stage_table(late.withColumn("slot", F.floor(F.col("finish") * TIME_PIECES)), "mix-late")
    by_slot = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    slots = late.groupBy("slot").agg(F.sum("size").alias("words"))
    first = (
        slots.withColumn("total", F.sum("words").over(by_slot))
        .where(F.col("total") > left)
        .orderBy("slot")
        .select("slot", (F.col("total") - F.col("words")).alias("before"))
        .first()
    )
    if first is None:
        return float("inf"), 0
    inside = Window.orderBy("finish", "place").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        late.where(F.col("slot") == first.slot)
        .withColumn("total", F.sum("size").over(inside))
        .where(F.col("total") + first.before <= left)
        .agg(F.max(F.struct("finish", "place")).alias("at"))
        .first()
        .at
    )
    # With none inside the slot, every copy of an earlier slot still counts.
    return (last.finish, last.place) if last else (float(first.slot) / TIME_PIECES, -1)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it was taken. Documents of size 0 are kept once."""
    return (
        mix(docs, **options)
        .where("copies > 0")
        .select(F.explode(F.expr("array_repeat(row, copies)")).alias("row"))
        .select("row.*")
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS turn
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM sources
), leveled AS (
  SELECT *, 3 * source_size AS most, 3 * source_size * 10 // weight AS level FROM weighted
), judged AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (
             ORDER BY level, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * 10
           > level * sum(weight) OVER (
             ORDER BY level, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full
  FROM leveled
), aimed AS (
  SELECT source, source_size, place,
         CASE WHEN is_full THEN CAST(most AS DOUBLE)
              ELSE CAST(weight * (sum(source_size) OVER ()
                     - coalesce(sum(most) FILTER (is_full) OVER (), 0)) AS DOUBLE)
                   / CAST(sum(weight) FILTER (NOT is_full) OVER () AS DOUBLE) END AS target
  FROM judged
), sent AS (
  SELECT d.doc_id, d.size, d.turn, a.source_size, a.place, a.target,
         sum(d.size) OVER (PARTITION BY a.place ORDER BY d.turn, CAST(d.doc_id AS VARCHAR), d.size
                           ROWS UNBOUNDED PRECEDING) AS sent,
         row_number() OVER (PARTITION BY a.place ORDER BY d.turn, CAST(d.doc_id AS VARCHAR), d.size) AS nth
  FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
), copies AS (
  SELECT s.place, s.nth, s.size, CAST(s.sent + s.source_size * e.range AS DOUBLE) / s.target AS finish
  FROM sent s, range(3) e WHERE s.size > 0
), cut AS (
  SELECT place, nth, size,
         sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS total
  FROM copies
), kept AS (
  SELECT place, nth, sum(size) AS taken FROM cut
  WHERE total <= (SELECT sum(source_size) FROM sources) GROUP BY place, nth
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, s.source_size, s.target,
       CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM sent s LEFT JOIN kept k ON s.place = k.place AND s.nth = k.nth
"""
