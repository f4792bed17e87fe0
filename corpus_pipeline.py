"""The corpus pipeline: five operators applied to ``documents``, one after the other.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it back as the docs of the next. All stages but the last
return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from percepta.llm import dartminhash, decontam, mixing, ranking, repeats
from percepta.llm.common import ROW, importable, materialize
from percepta.llm.repeats import PASSAGE_BYTES, PASSAGE_GRAM, PASSAGE_WORDS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learned from ``labels``, does not reject.

    Null and empty texts are scored as texts without words, equal rows equally; very long
    texts are measured whole; an empty table stays empty. Without labels of both kinds
    nothing is rejected.
    """
    return ranking.drop_low_quality(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near and exact copies: the one of least id, ties by row.

    Texts are compared whole, on word shingles; null texts and texts without words are copies of
    none; rows that repeat are copies; an empty table stays empty.
    """
    importable(spark)
    return dartminhash.drop_near_duplicates(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of passages of ``PASSAGE_WORDS`` words or more that repeat.

    A passage is a run of bytes that are covered by strings of ``PASSAGE_BYTES`` bytes which
    also start elsewhere; shorter runs, such as shared lines, stay. What is left of characters that were cut goes too; ``n_chars`` is the
    length of the text that remains; null texts stay null.
    """
    importable(spark)
    found = repeats.remove_repeats(
        docs, length=PASSAGE_BYTES, as_text=True, least_words=PASSAGE_WORDS, gram=PASSAGE_GRAM
    )
    cut = F.col("n_removed") > 0
    new = F.when(cut, F.col("kept")).otherwise(F.col(f"{ROW}.text"))
    columns = []
    for f in docs.schema.fields:
        old = F.col(f"{ROW}.`{f.name}`")
        if f.name == "text":
            old = new
        elif f.name == "n_chars":
            old = F.when(cut, F.length("kept").cast(f.dataType)).otherwise(old)
        columns.append(old.alias(f.name))
    return found.select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any test string of ``benchmark``.

    Null texts have no words and stay; very long texts are searched whole; rows that repeat are
    judged each for itself; an empty benchmark rejects nothing.
    """
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target and taken words of each document."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
]

#: The classifier and the near-duplicate classes are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
