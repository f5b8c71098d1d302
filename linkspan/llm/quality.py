"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Two layers decide about a document:

* base rules, fixed: fewer than ``min_words`` words, or more than half of its words in repeated 3-word windows;
* learned rules: each has a rate where large is bad (symbols per word, repeated lines per line, repeated words per
  word, capitals per character), and a document is rejected if any rate reaches its cutoff. Cutoffs are chosen per
  stratum from fixed grids, by learn-then-test on the labelled documents that passed the base rules. A third of these
  (``TUNING`` of 16, by a hash of the doc_id) says how far each rule should go: to the cutoff with the most bad minus good
  rejections, the laxest of ties; a rule without gain stays off. The others are the holdout. The rules go
  together, step by step, from their laxest cutoff to the one chosen; H0 of a step says "all rules in one reject at least
  ``alpha`` of the good documents of this stratum", its p-value is the exact binomial tail P(Bin(n, alpha) <= rejected).
  The walk ends before the first step that isn't significant (fixed sequence: no penalty along the grid); the level
  is ``delta / strata tested`` (Bonferroni). So with probability 1 - delta in no stratum more than ``alpha`` of good
  documents are rejected by the union of the rules. The last certified step counts. A stratum with too few
  labelled rows (fewer than log(level) / log(1 - alpha) good ones in the holdout, 86 with four strata) certifies
  nothing, and its documents are judged by the base rules alone.

Edge cases: a null or empty text has no words, fails the base rules and isn't kept. Null strata are a stratum of
their own. Repeated rows are judged alike; rows of one doc_id are one trial, rejected if any of them is, in the smallest
of their strata. Several labels of one document count as good if any says so; labels
that are null or of unknown documents are ignored. No labels or empty tables: base rules only. Extra columns of the input are ignored by
``measure`` and kept by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WS_CLASS, Scratch, table, words

MIN_WORDS = 50
ALPHA = 0.05
DELTA = 0.05
#: Sixteenths of the labelled documents that choose how far a rule goes.
TUNING = 5
#: rule -> cutoffs from the laxest to the strictest; a document with rate >= cutoff is rejected.
GRID = {
    "symbol_rate": [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05],
    "dup_line_rate": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "repeat_rate": [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2],
    "upper_rate": [0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_chars_all"]


def _repeat_windows(df: DataFrame) -> DataFrame:
    """Adds __rep, the words covered by 3-word windows that occur twice or more, from __w. Windows are compared by a
    64-bit hash of their words; a sort is needed only for texts where some window repeats."""
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("__h", F.when(F.size("__w") >= 3, F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(F.col("__w")[i], F.col("__w")[i + 1], F.col("__w")[i + 2]))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    last = F.size("__s") - 1
    same = lambda x, j: ((j > 0) & (F.get("__s", j - 1)["h"] == x["h"])) | ((j < last) & (F.get("__s", j + 1)["h"] == x["h"]))
    df = df.withColumn("__d", F.filter("__s", same))
    df = df.withColumn("__p", F.sort_array(F.transform("__d", lambda x: x["i"])))
    step = lambda a, j: a + F.least(F.lit(3), F.col("__p")[j] - F.col("__p")[j - 1])
    more = F.when(F.size("__p") >= 2, F.aggregate(F.sequence(F.lit(1), F.size("__p") - 1), F.lit(3), step)).otherwise(F.lit(3))
    return df.withColumn("__rep", F.when(F.size("__p") == 0, F.lit(0)).otherwise(more))


def measure(docs: DataFrame, carry: list[Column]) -> DataFrame:
    """``carry`` columns of each row of ``docs`` and the MEASURES of its ``text``, as bigint."""
    df = docs.select(*carry, F.coalesce("text", F.lit("")).alias("__t"))
    df = df.withColumn("__w", words(F.col("__t")))
    df = df.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.length(F.ltrim(x, F.lit(" \t\n\x0b\f\r"))) > 0))
    df = _repeat_windows(df)
    keep = [c for c in df.columns if not c.startswith("__") or c == "__doc"]
    return df.select(
        *keep,
        F.size("__w").cast("bigint").alias("n_words"),
        F.length(F.concat_ws("", F.col("__w"))).cast("bigint").alias("word_chars"),
        F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        F.col("__rep").cast("bigint").alias("n_repeat_words"),
        F.size("__l").cast("bigint").alias("n_lines"),
        F.regexp_count("__t", F.lit("[A-Z]")).cast("bigint").alias("n_upper"),
        F.length("__t").cast("bigint").alias("n_chars_all"),
    )


def base_failed(min_words: int = MIN_WORDS) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rates() -> dict[str, Column]:
    ratio = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")
    return {"symbol_rate": ratio("n_symbols", "n_words"), "dup_line_rate": ratio("n_dup_lines", "n_lines"), "repeat_rate": ratio("n_repeat_words", "n_words"), "upper_rate": ratio("n_upper", "n_chars_all")}


def binomial_tail(k: Column, n: Column, alpha: float) -> Column:
    """P(Bin(n, alpha) <= k), exact sum of k + 1 terms from the largest downwards; 1 where k >= n * alpha."""
    ln_c = F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1))), F.lit(0.0), lambda a, j: a + F.log((n - k + j).cast("double") / j.cast("double")))).otherwise(F.lit(0.0))
    top = ln_c + k * F.log(F.lit(alpha)) + (n - k) * F.log(F.lit(1 - alpha))
    terms = F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1))), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), lambda a, j: F.struct((a["t"] * (k - j + 1).cast("double") / (n - k + j).cast("double") * F.lit((1 - alpha) / alpha)).alias("t"), (a["s"] + a["t"] * (k - j + 1).cast("double") / (n - k + j).cast("double") * F.lit((1 - alpha) / alpha)).alias("s")))["s"]).otherwise(F.lit(1.0))
    return F.when(k.cast("double") >= n * F.lit(alpha), F.lit(1.0)).otherwise(F.exp(top) * terms)


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, min_words: int = MIN_WORDS, grid: dict[str, list[float]] = GRID) -> DataFrame:
    """(stratum, rule, cutoff, n_good, good_rejected): the certified cutoff of each rule that has one, with the good
    documents of the stratum's holdout and those that all rules reject together.

    ``measured``: doc_id, stratum and MEASURES. The result has a row for each rule and stratum at most."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"))
    held = measured.where(~base_failed(min_words)).select("doc_id", "stratum", *[c.alias(r) for r, c in rates().items()]).join(marks, "doc_id")
    held = held.groupBy("doc_id", "good").agg(F.min("stratum").alias("stratum"), *[F.max(r).alias(r) for r in grid])
    held = held.withColumn("tuning", F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "0123456789abcdef"[TUNING])
    points = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(k).alias("step"), (F.col(r) >= x).cast("int").alias("hit")) for r, xs in grid.items() for k, x in enumerate(xs)])
    gains = held.where("tuning").select("stratum", "good", F.inline(points)).groupBy("stratum", "rule", "step").agg(F.sum(F.col("hit") * (1 - 2 * F.col("good"))).alias("gain"))
    stops = gains.where("gain > 0").groupBy("stratum", "rule").agg((-F.max(F.struct("gain", (-F.col("step")).alias("back")))["back"]).alias("stop"))
    stops = stops.groupBy(F.col("stratum").alias("__st")).agg(*[F.max(F.when(F.col("rule") == r, F.col("stop"))).alias(f"__{r}") for r in grid])
    cut = lambda r: F.get(F.lit([float(x) for x in grid[r]]), F.least(F.col("step"), F.col(f"__{r}")))
    steps = held.where(~F.col("tuning")).join(stops, F.col("stratum").eqNullSafe(F.col("__st"))).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(max(map(len, grid.values())) - 1))))
    hit = F.greatest(*[F.coalesce((F.col(r) >= cut(r)).cast("int"), F.lit(0)) for r in grid])
    stop = [f"__{r}" for r in grid]
    sums = steps.groupBy("stratum", "step", *stop).agg(F.sum("good").alias("n_good"), F.sum(F.col("good") * hit).alias("good_rejected"))
    level = F.lit(delta) / F.count(F.lit(1)).over(W.partitionBy("step"))
    tested = sums.withColumn("level", level).withColumn("p", binomial_tail(F.col("good_rejected"), F.col("n_good"), alpha))
    walk = W.partitionBy("stratum").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    certified = tested.withColumn("broken", F.max((F.col("p") > F.col("level")).cast("int")).over(walk)).where("broken = 0")
    last = certified.withColumn("__r", F.row_number().over(W.partitionBy("stratum").orderBy(F.col("step").desc()))).where("__r = 1")
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), cut(r).alias("cutoff")) for r in grid])
    return last.select("stratum", "n_good", "good_rejected", F.inline(rules)).where("cutoff is not null").select("stratum", "rule", "cutoff", "n_good", "good_rejected")


def verdicts(measured: DataFrame, chosen: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``measured`` with base_failed and kept. ``chosen`` has a row for each stratum and rule at most."""
    maps = chosen.groupBy(F.col("stratum").alias("__st")).agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__{r}") for r in GRID])
    out = measured.join(maps, F.col("stratum").eqNullSafe(F.col("__st")), "left")
    bad = F.lit(False)
    for r, x in rates().items():
        bad = bad | F.coalesce(x >= F.col(f"__{r}"), F.lit(False))
    return out.withColumn("base_failed", base_failed(min_words)).withColumn("kept", ~F.col("base_failed") & ~bad).drop("__st", *[f"__{r}" for r in GRID])


def assess(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, stratum (the language), MEASURES, base_failed and kept of every row of ``docs``. Texts are measured once."""
    measured = Scratch(spark, "quality").write(measure(docs, [F.col("doc_id").alias("doc_id"), F.col("lang").alias("stratum")]), "measured")
    return verdicts(measured, cutoffs(measured, labels, **options))


def keep(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their columns, that pass. Texts are measured once: rows wait in a scratch table while the cutoffs are chosen."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    rows = Scratch(spark, "quality").write(measure(docs, [whole]), "rows")
    flat = rows.select("*", F.col("__doc.doc_id").alias("doc_id"), F.col("__doc.lang").alias("stratum"))
    return verdicts(flat, cutoffs(flat.drop("__doc"), labels, **options)).where("kept").select("__doc.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assess(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
