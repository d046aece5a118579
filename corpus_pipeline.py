"""The corpus pipeline: ``documents`` through five of the training-data
operators, each stage written as Parquet and read again as the next one's
input.

Stages take (spark, docs, sf_dir) and work on all rows of ``docs``; all but the
last return the columns of ``docs``. Labels come from ``sf_dir``.

Defined results: null texts count as empty and are neither toxic nor repeated;
one row of each group of near-duplicates is kept, and it has no doc_id only if
no row of the group has one; extra columns are carried along, except through packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.llm.common import read_table, staged
from valuekit.llm.minhash import first_of_each, text_digest
from valuekit.llm.packing import pack
from valuekit.llm.quality import quality_model, score_quality
from valuekit.llm.substring import cut_repeats
from valuekit.llm.toxicity import score_toxicity, toxicity_model

# Names that no table column has: they only exist inside a stage.
VERDICT = ("score of stage", "predicted by stage")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, *docs.columns, names=VERDICT).where(F.col(VERDICT[1]) == 0).select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model, *docs.columns, names=VERDICT).where(F.col(VERDICT[1]) == 1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles at 0.8): the
    smallest doc_id, of its texts any one. Rows that repeat both doc_id and text
    become one; otherwise rows without a word all stay."""
    kept = first_of_each(docs).select(F.col("doc_id").alias("kept_id"), F.col("t").alias("kept_text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (text_digest() == F.col("kept_text"))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; texts without such
    a passage stay as they are."""
    cut = cut_repeats(docs)
    changed = F.col("cut.n_removed") > 0
    text = F.when(changed, F.col("cut.kept_text")).otherwise(F.col("text"))
    out = {"text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length("cut.kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns(out).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: The stages hold trained models and packing, which SQL cannot express;
#: tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
