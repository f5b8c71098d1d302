"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``docs``; extra columns stay, whatever their names.

* quality_rules: rows that fail a base rule or a certified cutoff go. Labels come from ``sf_dir``.
* line_dedup: later repeated runs of lines go from the texts, n_chars follows; a document that loses all its words goes.
* near_duplicates: of each component of similar texts the document with the smallest doc_id stays.
* mixing: rows are repeated, or left out, by their rates.
* byte_bpe: doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row.

Edge cases: null and empty texts fail the quality rules; a stage that meets them anyway does as its operator says.
Empty tables pass through all stages. SQL can't express the classifier or the tokenizer, so there is no ORACLE_SQL;
the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkspan.llm import bpe, linededup, mixing, ngramjoin, quality
from linkspan.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(spark, docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = next(f"gone{k}" for k in range(len(docs.columns) + 1) if f"gone{k}" not in docs.columns)
    out = linededup.dedup(docs, gone=gone)
    lost = F.size(gone) > 0
    out = out.where(~lost | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(lost, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.deduplicate(spark, docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(spark, docs, mixing.label_domains(table(spark, sf_dir, "labels"), docs))
    return mixing.apply(docs, mixed)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing_weights),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
