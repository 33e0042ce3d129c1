"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the rule ensemble, trained on the labels,
    predicts to be of low quality. All rows of an id go or stay by their own
    text: the verdict is computed on the row."""
    from .quality_model import fit_on, keep_column

    model = fit_on(docs, load_table(spark, sf_dir, "labels"))
    return keep_column(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each group of near duplicates
    (five-word shingles, similarity 0.8 or more)."""
    from .neardup import near_duplicates

    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    from .decontam import drop_leaking

    return drop_leaking(docs, load_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark of its kind; n_chars follows the text."""
    from .secrets import fit_cutoffs, redact

    out = redact(docs, fit_cutoffs(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts and digests of what is left."""
    import public_tokenizers as vocab

    from .bpe import encode_documents

    return encode_documents(docs, vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("secrets", redact_secrets), ("tokenise", tokenise)]
