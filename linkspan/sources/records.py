"""Readers of the file formats: source tables, ground truth, candidate and match lists, clean tables, runs.

Text files are tab-separated UTF-8 without quoting; every column is a string and nothing is read as null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]
CANDIDATES = ["source1_entity_id", "candidate_entity_ids"]
CLEAN = ["entity_id", "business_name", "business_name_normalized", "name_tokens", "business_address", "address_normalized", "country", "country_normalized", "state_normalized", "postal_code_normalized", "name_script"]
SHARD = "s1_row int, s1_entity_id string, rank smallint, candidate_entity_id string, candidate_source tinyint, candidate_row int, score float, name_score float"


class CleanTableMissing(FileNotFoundError):
    """The clean table of a split and source isn't there."""


def source_path(folder: str, split: str, source: int) -> str:
    return f"{folder}/{split}_source{source}.tsv"


def read_delimited(spark: SparkSession, path: str, columns: list[str], delimiter: str = "\t", quote: str = "") -> DataFrame:
    """All columns as strings. A header other than ``columns``, or a row of another width, raises."""
    lines = spark.read.text(path)
    header = lines.limit(1).collect()
    found = (header[0].value if header else "").lstrip("﻿").split(delimiter)
    if [h.strip(quote or None) if quote else h for h in found] != columns:
        raise ValueError(f"{path}: header {found}, expected {columns}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.csv(path, schema=schema, sep=delimiter, quote=quote, header=True, mode="FAILFAST", enforceSchema=False, multiLine=False, encoding="UTF-8")
    return rows.na.fill("")


def read_source(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, RECORD)


def with_row(df: DataFrame, name: str = "source_row") -> DataFrame:
    """Rows numbered from 0 in file order: the rows of each block of a file are counted, blocks are put in order of their
    place, and a row adds its place within the block. Without files, partitions are the blocks."""
    file, start = F.input_file_name(), F.input_file_block_start()
    placed = df.withColumns({"__file": file, "__start": start, "__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    blocks = placed.groupBy("__file", "__start", "__part").agg(F.min("__id").alias("__low"), F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__file", "__start", "__part").rowsBetween(W.unboundedPreceding, -1)  # a row for each block
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return placed.join(blocks, ["__file", "__start", "__part"]).select(*df.columns, (F.col("__before") + F.col("__id") - F.col("__low")).alias(name))


def read_split(spark: SparkSession, folder: str, split: str, sources: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """RECORD columns with source and source_row of all sources of a split."""
    parts = [with_row(read_source(spark, source_path(folder, split, s))).withColumn("source", F.lit(s).cast("tinyint")) for s in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def id_list(text: Column) -> Column:
    """Ids of a comma list; the empty text has none."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, matched): a row for each S1, with its list of ids."""
    return read_delimited(spark, path, TRUTH).select(F.col(TRUTH[0]).alias("s1_id"), id_list(F.col(TRUTH[1])).alias("matched"))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, candidates), best first."""
    return read_delimited(spark, path, CANDIDATES).select(F.col(CANDIDATES[0]).alias("s1_id"), id_list(F.col(CANDIDATES[1])).alias("candidates"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("s1_id", F.explode("matched").alias("cand_id"))


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate rows of a run."""
    return spark.read.schema(f"{SHARD}, country string").parquet(folder)


def candidate_frames(shards: DataFrame, records: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """Candidate rows with the texts of both sides, and ``label`` if the truth is given. Joined on ids, so rows may come in any order."""
    side = lambda mark: records.select(*[F.col(c).alias(f"{mark}_{c}") for c in RECORD])
    out = shards.drop("country").withColumnRenamed("s1_entity_id", "s1_id").withColumnRenamed("candidate_entity_id", "cand_id")
    out = out.join(side("s1").withColumnRenamed("s1_entity_id", "s1_id"), "s1_id").join(side("cand").withColumnRenamed("cand_entity_id", "cand_id"), "cand_id")
    if truth is None:
        return out
    marked = truth_pairs(truth).distinct().withColumn("label", F.lit(1))
    return out.join(marked, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def read_clean(spark: SparkSession, folder: str, split: str, source: int) -> DataFrame:
    path = f"{folder}/{split}_source{source}_clean.csv"
    try:
        return read_delimited(spark, path, CLEAN, delimiter=",", quote='"')
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise CleanTableMissing(path) from e
        raise


def load_table(raw: DataFrame, clean: DataFrame | None, mode: str = "raw") -> DataFrame:
    """``raw``, ``clean``, or both side by side; rows are matched by number and must agree on the id."""
    if mode == "raw":
        return raw
    if clean is None:
        raise CleanTableMissing("no clean table")
    if mode == "clean":
        return clean
    a, b = with_row(raw), with_row(clean).select("source_row", F.col("entity_id").alias("clean_id"), *[F.col(c).alias(f"clean_{c}") for c in CLEAN if c != "entity_id"])
    both = a.join(b, "source_row", "full")
    wrong = both.where(~F.col("entity_id").eqNullSafe(F.col("clean_id"))).limit(1).count()
    if wrong:
        raise ValueError("raw and clean rows don't agree on the id")
    return both.drop("clean_id")


def by_ids(records: DataFrame, ids: DataFrame, column: str = "entity_id") -> DataFrame:
    """Records whose id is in ``ids``."""
    return records.join(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), column, "left_semi")


#: Up to six words at the start of a text, and what is before them.
NAME_PART = r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+(?:[\x20\x09-\x0D]+[^\x20\x09-\x0D]+){0,5})"


def demo_records(documents: DataFrame) -> DataFrame:
    """A three-source view over ``documents`` for queries and tests: the first six words of a text are the name, all that
    follows is the address."""
    source = (F.lit(1) + F.col("doc_id") % 3).cast("int")
    return documents.select(
        F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("entity_id"),
        F.regexp_extract("text", NAME_PART, 1).alias("business_name"),
        F.regexp_replace("text", NAME_PART, "").alias("business_address"),
        F.col("lang").alias("country"),
        source.alias("source"),
        F.col("doc_id").alias("source_row"),
        F.md5("text").alias("twin"),
    )
