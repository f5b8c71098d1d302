"""Writers of candidate and match lists, run folders with a guard, cached tables with a fingerprint, and the validator."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import CANDIDATES, TRUTH


def candidate_lines(s1: DataFrame, ranked: DataFrame) -> DataFrame:
    """(s1_row, s1_id, ids): a row for each S1 (s1_id, s1_row) in file order, candidates best first. Duplicates and ids that aren't of S2 or S3 raise."""
    wrong = ranked.where(~F.col("cand_id").rlike("^S[23]-")).limit(1).count()
    twice = ranked.groupBy("s1_id", "cand_id").count().where("count > 1").limit(1).count()
    if wrong or twice:
        raise ValueError("a candidate is listed twice" if twice else "a candidate is of no candidate source")
    lists = ranked.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))).alias("c"))
    out = s1.select("s1_id", "s1_row").join(lists, "s1_id", "left")
    return out.select("s1_row", "s1_id", F.coalesce(F.array_join(F.transform("c", lambda x: x["cand_id"]), ","), F.lit("")).alias("ids")).orderBy("s1_row")


def match_lines(s1: DataFrame, matches: DataFrame) -> DataFrame:
    """(s1_row, s1_id, ids): a row for each S1 in file order, matched ids sorted."""
    lists = matches.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("m"))
    return s1.select("s1_id", "s1_row").join(lists, "s1_id", "left").select("s1_row", "s1_id", F.coalesce(F.array_join("m", ","), F.lit("")).alias("ids")).orderBy("s1_row")


def write_lines(lines: DataFrame, path: str, header: list[str]) -> None:
    """A folder of text parts in order, the header in the first; cat of the parts is the file."""
    spark = lines.sparkSession
    head = spark.createDataFrame([(-1, "\t".join(header))], "s1_row bigint, value string")
    body = lines.select(F.col("s1_row").cast("bigint").alias("s1_row"), F.concat_ws("\t", "s1_id", "ids").alias("value"))
    head.unionByName(body).repartitionByRange("s1_row").sortWithinPartitions("s1_row").select("value").write.mode("overwrite").text(path)


def write_candidates(s1: DataFrame, ranked: DataFrame, path: str) -> None:
    write_lines(candidate_lines(s1, ranked), path, CANDIDATES)


def write_matches(s1: DataFrame, matches: DataFrame, path: str, column: str = TRUTH[1]) -> None:
    write_lines(match_lines(s1, matches), path, [TRUTH[0], column])


def write_both(s1: DataFrame, ranked: DataFrame, matches: DataFrame, match_path: str, candidate_path: str) -> None:
    """Both lists; a match that is no candidate of its S1, or of an S1 that isn't there, raises before anything is written."""
    if matches.join(ranked, ["s1_id", "cand_id"], "left_anti").limit(1).count():
        raise ValueError("a match is not among the candidates of its S1")
    if matches.join(s1, "s1_id", "left_anti").limit(1).count():
        raise ValueError("a match belongs to no S1 of the run")
    write_candidates(s1, ranked, candidate_path)
    write_matches(s1, matches, match_path)


def write_shards(rows: DataFrame, path: str) -> None:
    """Candidate rows by country; the commit protocol makes the write atomic."""
    rows.write.mode("overwrite").partitionBy("country").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, such as a key; null where there is none."""
    if not exists(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def cached(spark: SparkSession, path: str, key: str, make, overwrite: bool = False) -> DataFrame:
    """The table at ``path`` if it was written for ``key``; made anew if there is none. One for another key raises unless ``overwrite``."""
    held = _read_text(spark, f"{path}/key")
    if held is not None and held != key and not overwrite:
        raise ValueError(f"{path} holds a run with another configuration")
    if held != key:
        make().write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame([(key,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/key")  # last: marks the rows as whole
    return spark.read.parquet(f"{path}/rows")


def check_lists(lists: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule, n): findings about lists (s1_id, ids array) for the required s1_id; without findings no rows."""
    flat = lists.select("s1_id", F.explode("ids").alias("id"))
    found = [
        ("duplicate S1 row", lists.groupBy("s1_id").count().where("count > 1")),
        ("repeated id in a list", flat.groupBy("s1_id", "id").count().where("count > 1")),
        ("S1 id in a list", flat.where(F.col("id").startswith("S1-"))),
        ("bad prefix", flat.where(~F.col("id").rlike("^S[123]-"))),
        ("missing S1", required.join(lists, "s1_id", "left_anti")),
        ("foreign S1", lists.join(required, "s1_id", "left_anti")),
    ]
    if known is not None:
        found.append(("unknown id", flat.join(known.select(F.col(known.columns[0]).alias("id")), "id", "left_anti")))
    out = None
    for rule, rows in found:
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
        out = one if out is None else out.unionByName(one)
    return out.where("n > 0")


def subset_findings(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1_id, id) of matches outside the candidates: a warning of the validator."""
    flat = lambda df: df.select("s1_id", F.explode("ids").alias("id"))
    return flat(matches).join(flat(candidates), ["s1_id", "id"], "left_anti")


def preflight(spark: SparkSession, folder: str, split: str) -> list[str]:
    """What is missing for a run: packages and source tables."""
    import importlib.util

    from .records import source_path

    missing = [f"package {m}" for m in ("pyspark", "numpy", "pandas", "pyarrow") if importlib.util.find_spec(m) is None]
    return missing + [f"table {source_path(folder, split, s)}" for s in (1, 2, 3) if not exists(spark, source_path(folder, split, s))]
