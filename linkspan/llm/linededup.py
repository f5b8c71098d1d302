"""Line dedup by winnowing over line hashes. DataFrame functions only.

A run is a sequence of lines (lines without a word don't count) of ``min_words`` words or more in all. The window of a
line is the shortest run that starts there.

* Fingerprints: each window selects its line of least hash, the first of ties. Selected positions never go back as the
  window moves on, so a position is kept once, by the first window that selects it. Texts that share a run share all
  windows in it and select the same fingerprints: no shared run is missed.
* Join: positions join by fingerprint. Those whose fingerprint is selected at one place only go.
* Extension: for a joined position, the lines before and after it are compared within each window that selected it, by
  the hash of the window's lines; the first position (smallest doc_id, text hash, line) with the same stays, later ones
  are repeated. Joined windows of a run overlap and cover it from its first line on, but for lines at its end that have
  too few words behind them to start a window in the run. Those are reached from the shared windows: such a line's
  shortest run to the left starts with a shared window that ends before it, and is compared in the same way.

Lines of later positions are deleted. Deleting can't lose a line: each deleted line equals one at an earlier position,
and the first of all is later than none. Work is linear: a fingerprint with a million positions is grouped by what
surrounds it and compared with one first position, never pairwise. Counts and minima are combined before the shuffle;
Spark splits the hot keys of the joins.

Edge cases: null and empty texts have no lines and stay as they are. Rows of equal doc_id and text count as one
document and lose the same lines; a null doc_id is the smallest one. Lines are compared as they are, by 64-bit hash.
Extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WS_RUN, Scratch, table

#: Words that a run has at least.
MIN_WORDS = 50
DOC = ["doc_id", "th"]


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each line with words: doc_id, th, pos, and of the window that starts there ``last`` (its last line), fp
    (fingerprint), key (hash of its lines), chosen (its fingerprint's position is a new one), all null without a window;
    and of the shortest run that ends there ``first`` and back (hash of its lines), null without one.

    With s the words before a line and c those up to its end, the shortest run from line i holds the lines with s in
    [s_i, s_i + min_words - 1], and the shortest run to it those with c in [c_i - min_words + 1, c_i]: RANGE frames."""
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th"), F.split("text", "\n").alias("lines"))
    rows = rows.select(*DOC, F.posexplode_outer("lines").alias("pos", "line"))
    rows = rows.select(*DOC, "pos", F.xxhash64("line").alias("h"), F.size(F.array_remove(F.split("line", WS_RUN), "")).cast("bigint").alias("w")).where("w > 0")
    own = W.partitionBy(*DOC)
    rows = rows.repartition(*DOC).dropDuplicates([*DOC, "pos"]).withColumn("c", F.sum("w").over(own.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))).withColumn("s", F.col("c") - F.col("w"))
    forth, back = own.orderBy("s").rangeBetween(0, min_words - 1), own.orderBy("c").rangeBetween(1 - min_words, 0)
    rows = rows.withColumn("full", F.max("c").over(forth) - F.col("s") >= min_words).withColumn("least", F.min(F.struct("h", "pos")).over(forth))
    rows = rows.withColumn("last", F.max("pos").over(forth)).withColumn("key", F.xxhash64(F.collect_list("h").over(forth)))
    rows = rows.withColumn("before", F.lag("least.pos").over(own.orderBy("s")))
    rows = rows.withColumn("first", F.min("pos").over(back)).withColumn("back", F.xxhash64(F.collect_list("h").over(back))).withColumn("back_full", F.col("c") - F.min("s").over(back) >= min_words)
    mine = lambda c: F.when(F.col("full"), c)
    his = lambda c: F.when(F.col("back_full"), F.col(c)).alias(c)
    chosen = F.col("before").isNull() | (F.col("before") != F.col("least.pos"))
    return rows.select(*DOC, "pos", mine(F.col("last")).alias("last"), mine(F.col("least.h")).alias("fp"), mine(F.col("key")).alias("key"), mine(chosen).alias("chosen"), his("first"), his("back"))


def _shared(runs: DataFrame, by: list[str]) -> DataFrame:
    """The ``runs`` (doc_id, th, first, last and ``by``) whose ``by`` others have, and whether they are later than the first of these."""
    firsts = runs.groupBy(*by).agg(F.min(F.struct(*DOC, "first")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select(*by, "f")
    return runs.join(firsts, by).select(*DOC, "first", "last", (F.struct(*DOC, "first") != F.col("f")).alias("later"))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th (xxhash64 of the text) and gone: the ascending positions of the lines that a document loses."""
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.write(windows(docs, min_words), "windows")
    # Positions chosen: one row for each, not one for each window.
    joined = lines.where("chosen").groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    runs = lines.where("key is not null").select(*DOC, F.col("pos").alias("first"), "last", "fp", "key").join(joined, "fp", "left_semi")
    shared = scratch.write(_shared(runs, ["fp", "key"]), "shared")
    starts = shared.select(F.col("doc_id").alias("doc2"), F.col("th").alias("th2"), F.col("first").alias("first2"), F.col("last").alias("last2"))
    tails = lines.where("back is not null").select(*DOC, "first", F.col("pos").alias("last"), "back")
    tails = tails.join(starts, F.col("doc_id").eqNullSafe(F.col("doc2")) & (F.col("th") == F.col("th2")) & (F.col("first") == F.col("first2")) & (F.col("last") > F.col("last2")), "left_semi")
    later = shared.unionByName(_shared(tails, ["back"])).where("later")
    lost = later.select(*DOC, F.explode_outer(F.sequence("first", "last")).alias("pos"))
    gone = scratch.write(lost.groupBy(*DOC).agg(F.sort_array(F.collect_set("pos")).alias("gone")), "gone")
    scratch.keep("gone")
    return gone


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, gone: str = "gone") -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``, and the positions of the deleted lines in ``gone``. A line
    without words between two lines of a deleted run goes with them."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    lost = repeated_lines(docs, min_words).select(F.col("doc_id").alias("id2"), F.col("th").alias("h2"), "gone")
    # Dealt by key at every size: the plan is the same for small and large inputs, and texts aren't sorted.
    both = rows.join(lost.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")), "left")
    both = both.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split("doc.text", "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n"))
    keep = [(text if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    return both.select(*keep, F.coalesce("gone", F.array().cast("array<int>")).alias(gone))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup(docs)
    return out.select("doc_id", F.size("gone").cast("bigint").alias("n_deleted_lines"), F.array_join(F.col("gone").cast("array<string>"), ",").alias("deleted_lines"), F.length("text").cast("bigint").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))
