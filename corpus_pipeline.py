"""From raw documents to token ids: quality rules, language, near duplicates, mixture, encoding.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written and read again as the next
one's documents. All but the last give the columns of documents, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import bpe, langid, mixing, partenum, repetition
from weftgraph.llm.queries import tokenizer
from weftgraph.session import stage_table

#: A document whose language wins by less than this share of all languages is in none of them.
SURE_LANGUAGE = 0.5
TOKENIZER = "byte_bpe_50k.json"


def _own_names(docs: DataFrame) -> tuple[DataFrame, str, list[Column]]:
    """The documents under names that no result has, which of them is the text, and the way back. Each column is
    sent to Python once."""
    own = [f"_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*own), own[docs.columns.index("text")], [F.col(o).alias(c) for o, c in zip(own, docs.columns)]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits on repetition."""
    rows, text, back = _own_names(docs)
    return repetition.judge(rows, text=text).where("kept").select(*back)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are clearly in one of the languages of the labelled documents.

    Without any labelled document nothing can be said about languages, and all documents are kept.
    """
    model = langid.fit(docs)
    if not model["langs"]:
        return docs
    rows, text, back = _own_names(docs)
    told = langid.predict(rows, model, text=text)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= SURE_LANGUAGE)).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id. Documents without words stay."""
    return partenum.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document as often as it is taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture."""
    coded = bpe.encode(docs.select("doc_id", "text"), tokenizer(TOKENIZER))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Suffix arrays, back-off models and signatures are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
