"""Driver queries of the numbered operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import anchors, bpe, hmm, langid, maintext, mixing, neighbours, partenum, repetition, sharding, simhash, warc, whitening
from weftgraph.llm.words import fold
from weftgraph.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", fold(F.col("doc_id"), 4, 2))
    model = langid.fit(docs.where("doc_id is not null and not held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).drop("text")


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document."""
    return repetition.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    path = fresh_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    rows = warc.resolve(warc.assemble(spark, path, payload=False))
    return rows.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = maintext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", sharding.shard_names())


@query
def op9_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = partenum.near_duplicates(docs, width=4, percent=85)
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


@query
def op10_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, by the model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold(F.col("doc_id"), 5, 1)
    scores = hmm.score(docs.withColumn("learn", F.col("doc_id").isNotNull() & ~held), "learn")
    return scores.withColumn("held_out", held)


@query
def op11_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, by codebooks trained over all of them."""
    coded, codebooks = anchors.compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return anchors.with_label_errors(coded).select(
        "vec_id",
        F.concat_ws("", digits).alias("code"),
        "error",
        "label_error",
        F.lit(anchors.codebooks_sha256(codebooks)).alias("codebooks_sha256"),
    )


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sixteen whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    print_ = simhash.as_hex(F.col("fingerprint")).alias("fingerprint")
    return found.select("doc_id", print_, F.col("component").alias("component_id"))


WARC_SQL = """
WITH captured AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS bytes,
         sha256(coalesce(html, '')) AS digest
  FROM pages
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id NULLS LAST) AS nth,
         min(page_id) OVER (PARTITION BY digest) AS first_id
  FROM captured
)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN bytes < 100 OR nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN bytes >= 100 AND nth > 1 THEN first_id END AS refers_to
FROM placed
"""

ORACLES |= {
    "op5_mixing": mixing.SQL,
    "op6_warc": WARC_SQL,
    "op8_sharding": sharding.sql(),
    "op11_anchors": anchors.sql(),
}
