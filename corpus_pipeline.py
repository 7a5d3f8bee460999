"""A corpus pipeline of five stages, each on all that the one before kept.

Columns that the stages do not know pass through, whatever their names. An empty table gives an empty one.
Without labelled texts, the language of no text can be told, and all go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import digest_index, languages, packing, secrets, setsketch
from quayside.plans.settle import settle


def _kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that ``decided`` keeps. The ids kept grow with the corpus: both sides are shuffled at every size.

    Rows that share an id stay together: all of them if one is kept. Rows without id count as one id.
    """
    ids = settle(decided.where("kept").select("doc_id").distinct(), "kept")
    return docs.join(ids.hint("merge"), docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told, as they have no letter, go; lang becomes the language found."""
    found = "_lang"
    while found in {c.lower() for c in docs.columns}:
        found = f"_{found}"
    model = languages.train(docs.where(~languages.held_out()))
    labelled = languages.label_rows(docs, model, found).where(F.col(found) != languages.UNKNOWN)
    return labelled.withColumn("lang", F.col(found)).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest doc_id."""
    decided = digest_index.deduplicate_once(docs)
    return _kept(docs, decided)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    decided = setsketch.near_duplicates(docs)
    return _kept(docs, decided)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark, and n_chars counts the new text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every document."""
    return packing.pack_documents(docs)


STAGES = [
    ("language id", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("packing", packed),
]

# Language identification and near-duplicate detection have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, f"stage-{k}")
    return docs
