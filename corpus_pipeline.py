"""A training corpus from the documents table, in five stages.

Language ID, cross-site line removal, SimHash near-duplicates, benchmark decontamination and BPE
encoding. Each stage is `(spark, docs, sf_dir) -> DataFrame`; `run` writes its result as Parquet to the
shared scratch folder and reads it again as the next stage's documents. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargewise.llm import bpe, decontam, langid, linededup, simhash
from chargewise.llm.common import free_name, read_table, written


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those far from every language; learns as op6 does."""
    model = langid.fit(docs.where(~langid.is_held_out(F.col("doc_id"))))
    names = tuple(free_name(docs, n) for n in ("lang_pred", "score", "rejected"))       # the documents' own columns stay
    return langid.classify(docs, model, names).where(~F.col(names[2])).select(*_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out; a document of which nothing is left goes."""
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    kept = linededup.remove_boilerplate(docs, n_lines=n_lines, n_removed=n_removed).where((F.col(n_removed) == 0) | (F.trim("text") != ""))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group, that with the smallest doc_id."""
    return simhash.one_of_each(docs).select(*_columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item, exactly or edited."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark")).select(*_columns(docs))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded text of every document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, decoded=True)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", bpe_encode),
]

# XXH64 fingerprints, alignment and BPE have no SQL form; the result is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return docs
