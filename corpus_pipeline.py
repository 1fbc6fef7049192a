"""The corpus pipeline: the stages that turn ``documents`` into token ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next one's docs.
All stages but the last return the columns of ``documents``. A row without a
doc_id, or with a null or empty text, goes through like any other; each
operator's docstring says what becomes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, decontam, quality, simhash, suffix
from shelfline.llm.common import find_code, free_name, read_table, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score reaches the cut stay."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "score")
    return quality.score(docs, model, out=score).where(F.col(score) >= quality.CUT).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest doc_id."""
    find_code(spark)
    return simhash.keep_one(docs, words=4, max_bits=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier are cut from the texts.

    Every document stays, with what is left of it. A cut may end inside a
    character of several bytes; the bytes of such a torn character go too.
    ``n_chars`` is that of the new text; a text without repeats, a null one
    included, is left as it is.
    """
    find_code(spark)
    kept, spans = free_name(docs.columns, "kept"), free_name(docs.columns, "n_spans")
    new = suffix.remove_repeats(docs, length=100, kept=kept, n_spans=spans, characters=True).withColumn("text", F.col(kept))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col(spans) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return new.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with the digests of the ids and of their decoding."""
    find_code(spark)
    return bpe.round_trip(docs)


STAGES = [("quality classifier", quality_classifier),
          ("simhash near-dedup", near_duplicates),
          ("suffix-array dedup", repeated_passages),
          ("benchmark decontamination", benchmark_decontamination),
          ("byte-level bpe", byte_level_bpe)]

#: Hashing, suffix sorting and byte-pair merges are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs
