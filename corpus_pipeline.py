"""From raw documents to batches: language, quality, one of each group of near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. A stage's output is written as
Parquet in the shared folder and read again, so a stage never recomputes the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import common, language_id, near_dedup, quality_rules
from seriesloom.llm.queries import held_out, packed

#: Least score of a language verdict. Half a text in another language stays above it.
SURE = 0.35


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct beside its text, so that no name of ``docs`` meets a name of an operator."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"), docs["lang"].alias("lang"), docs["doc_id"].alias("doc_id"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, as far as scripts and words tell. Texts without letters, null ones too, and unsure verdicts go, so do texts mostly in scripts that no learned language uses.

    An unlearned language in a learned script is not told apart. The column lang is only learned from.
    """
    common.prepare(spark)
    model = language_id.train(whole_rows(docs), where=~held_out())
    # The columns go by their places, so that no name of docs meets one of the operator.
    places = [f"c{i}" for i in range(len(docs.columns))]
    found = language_id.identify(docs.toDF(*places), model, text=places[docs.columns.index("text")], keep=tuple(places))
    found = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= SURE))
    return found.select(*[F.col(p).alias(c) for p, c in zip(places, docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.judge(whole_rows(docs), keep=("row",)).where("kept").select("k.row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; fully equal rows once. Null ids are groups of their own."""
    common.prepare(spark)
    kept = near_dedup.groups(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi").dropDuplicates()


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of what is left."""
    common.prepare(spark)
    return packed(docs)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", pack)]

#: The language stage is learned, and packing numbers by a hash that SQL lacks: tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir))
    return docs
