"""Evaluation: F0.5, recall of blocking, overlap of runs, error classes and their breakdown, oracle bounds."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def f05(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """1.25 tp / (n_pred + 0.25 n_true); without truth 1 if nothing is predicted, else 0."""
    return F.when(n_true == 0, (n_pred == 0).cast("double")).otherwise(1.25 * tp / (n_pred + 0.25 * n_true))


def per_s1(s1: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, tp, n_pred, n_true, f05) of all S1; pred and truth are (s1_id, cand_id)."""
    p, t = pred.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1)), truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    both = p.join(t, ["s1_id", "cand_id"], "full").groupBy("s1_id").agg(F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("tp"), F.count("p").alias("n_pred"), F.count("t").alias("n_true"))
    out = s1.select("s1_id").join(both, "s1_id", "left").na.fill(0, ["tp", "n_pred", "n_true"])
    return out.withColumn("f05", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def macro_f05(s1: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    return per_s1(s1, pred, truth).agg(F.round(F.avg("f05"), 9).alias("macro_f05"), F.count(F.lit(1)).alias("n_s1"))


def threshold_grid(s1: DataFrame, winners: DataFrame, truth: DataFrame, grid: list[float]) -> DataFrame:
    """(threshold, macro_f05): each winner counts at all thresholds up to its probability, so one pass serves the grid."""
    n_true = s1.select("s1_id").join(truth.groupBy("s1_id").agg(F.count_distinct("cand_id").alias("n_true")), "s1_id", "left").na.fill(0, ["n_true"])
    marked = winners.join(truth.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    at = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), (F.col("prob") >= F.lit(float(t))).alias("in")) for t in grid])
    counted = marked.select("s1_id", "hit", F.inline(at)).where("`in`").groupBy("s1_id", "threshold").agg(F.count("hit").alias("tp"), F.count(F.lit(1)).alias("n_pred"))
    full = n_true.select("s1_id", "n_true", F.explode(F.array(*[F.lit(float(t)) for t in grid])).alias("threshold")).join(counted, ["s1_id", "threshold"], "left").na.fill(0, ["tp", "n_pred"])
    return full.groupBy("threshold").agg(F.round(F.avg(f05(F.col("tp"), F.col("n_pred"), F.col("n_true"))), 9).alias("macro_f05"))


def best_threshold(grid: DataFrame) -> float:
    """The smallest of the best thresholds."""
    return grid.orderBy(F.col("macro_f05").desc(), "threshold").first().threshold


def blocking_metrics(s1: DataFrame, pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """(country, n_s1, pair_recall, ceiling, cands_per_s1, all_true_retained): by country and in all (country null). The
    ceiling is the macro F0.5 of the true pairs among the candidates."""
    held = pairs.select("s1_id", "cand_id").distinct().join(truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1)), ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count("t").alias("tp"), F.count(F.lit(1)).alias("n"))
    true = truth.groupBy("s1_id").agg(F.count_distinct("cand_id").alias("n_true"))
    rows = s1.select("s1_id", "country").join(held, "s1_id", "left").join(true, "s1_id", "left").na.fill(0, ["tp", "n", "n_true"])
    rows = rows.withColumn("f", f05(F.col("tp"), F.col("tp"), F.col("n_true")))
    out = rows.rollup("country").agg(F.count(F.lit(1)).alias("n_s1"), F.round(F.sum("tp") / F.nullif(F.sum("n_true"), F.lit(0)), 9).alias("pair_recall"), F.round(F.avg("f"), 9).alias("ceiling"), F.round(F.avg("n"), 9).alias("cands_per_s1"), F.round(F.avg((F.col("tp") == F.col("n_true")).cast("double")), 9).alias("all_true_retained"))
    return out


def recall_by_group(truth: DataFrame, found: DataFrame, traits: dict[str, Column]) -> DataFrame:
    """(group, value, n_true, n_found): true pairs with trait columns, counted in all and by each trait."""
    marked = truth.join(found.select("s1_id", "cand_id").distinct().withColumn("f", F.lit(1)), ["s1_id", "cand_id"], "left")
    kinds = F.array(F.struct(F.lit("all").alias("grp"), F.lit("all").alias("value")), *[F.struct(F.lit(k).alias("grp"), v.cast("string").alias("value")) for k, v in traits.items()])
    return marked.select("f", F.inline(kinds)).groupBy("grp", "value").agg(F.count(F.lit(1)).alias("n_true"), F.count("f").alias("n_found"))


def overlap(base: DataFrame, deep: DataFrame, truth: DataFrame, s1: DataFrame) -> DataFrame:
    """(country, base_only, both, deep_only and the true ones of each): two candidate runs, by country and in all."""
    side = lambda df, mark: df.select("s1_id", "cand_id").distinct().withColumn(mark, F.lit(1))
    rows = side(base, "b").join(side(deep, "d"), ["s1_id", "cand_id"], "full").join(side(truth, "t"), ["s1_id", "cand_id"], "left").join(s1.select("s1_id", "country"), "s1_id")
    b, d, t = (F.col(x).isNotNull() for x in "bdt")
    kinds = {"base_only": b & ~d, "both": b & d, "deep_only": ~b & d}
    return rows.rollup("country").agg(*[F.count_if(c).alias(k) for k, c in kinds.items()], *[F.count_if(c & t).alias(f"{k}_true") for k, c in kinds.items()])


def summary(rows: DataFrame, column: str) -> DataFrame:
    """Mean, median, p95 and max; a percentile q is the value at index min(n - 1, floor(q n)) in order, not interpolated."""
    ordered = rows.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    counts = ordered.groupBy("x").agg(F.count(F.lit(1)).alias("m"))  # distinct values, not rows, are put in order
    run = counts.withColumn("upto", F.sum("m").over(W.orderBy("x").rowsBetween(W.unboundedPreceding, 0))).withColumn("n", F.sum("m").over(W.partitionBy()))
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.col("n") - 1, F.floor(q * F.col("n"))), F.col("x")))
    return run.agg(F.round(F.sum(F.col("x") * F.col("m")) / F.max("n"), 6).alias("mean"), at(0.5).alias("median"), at(0.95).alias("p95"), F.max("x").alias("max"))


def rank_bucket(rank: Column) -> Column:
    return F.when(rank <= 1, "1").when(rank <= 3, "2-3").when(rank <= 5, "4-5").when(rank <= 10, "6-10").when(rank <= 20, "11-20").when(rank <= 50, "21-50").otherwise("51+")


def error_classes(pairs: DataFrame, threshold: float) -> DataFrame:
    """Rows (prob, label, cand_id, s1_id) with class TP, FP, FN2 (below the threshold), FN3 (lost to another claimant) or TN."""
    from .decide import exclusive

    won = exclusive(pairs).select("s1_id", "cand_id", F.lit(1).alias("won"))
    above = F.col("prob").cast("float") >= F.lit(threshold).cast("float")
    said = above & F.col("won").isNotNull()
    kind = F.when(said, F.when(F.col("label") == 1, "TP").otherwise("FP")).when(F.col("label") == 0, "TN").when(above, "FN3").otherwise("FN2")
    return pairs.join(won, ["s1_id", "cand_id"], "left").withColumn("error", kind).drop("won")


def missed_pairs(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """FN1: true pairs that aren't candidates."""
    return truth.select("s1_id", "cand_id").distinct().join(pairs.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")


def breakdown(rows: DataFrame, categories: dict[str, Column], means: list[str]) -> DataFrame:
    """(category, n, share, means): of the rows in each category; a row counts in all it is in."""
    marks = F.array(*[F.struct(F.lit(k).alias("category"), c.alias("in")) for k, c in categories.items()])
    total = rows.agg(F.count(F.lit(1)).alias("all_rows")).withColumn("one", F.lit(1))
    out = rows.select(*means, F.inline(marks)).where("`in`").groupBy("category").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 6).alias(f"mean_{m}") for m in means])
    return out.withColumn("one", F.lit(1)).join(total, "one").withColumn("share", F.round(F.col("n") / F.col("all_rows"), 6)).drop("one", "all_rows")


def patterns(rows: DataFrame, categories: dict[str, Column], k: int = 20) -> DataFrame:
    """The k most frequent sets of categories."""
    sign = F.concat_ws(" | ", *[F.when(c, F.lit(name)) for name, c in categories.items()])
    return rows.groupBy(sign.alias("pattern")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "pattern").limit(k)


def oracle_prefix(s1: DataFrame, rows: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, best_f05): the best F0.5 over prefixes of each S1's rows (label, score), the empty one included."""
    n_true = truth.groupBy("s1_id").agg(F.count_distinct("cand_id").alias("n_true"))
    upto = W.partitionBy("s1_id").orderBy(F.col("score").desc(), "cand_id").rowsBetween(W.unboundedPreceding, 0)
    runs = rows.withColumn("tp", F.sum("label").over(upto)).withColumn("k", F.count(F.lit(1)).over(upto)).join(n_true, "s1_id", "left").na.fill(0, ["n_true"])
    best = runs.groupBy("s1_id").agg(F.max(f05(F.col("tp"), F.col("k"), F.col("n_true"))).alias("b"))
    out = s1.select("s1_id").join(best, "s1_id", "left").join(n_true, "s1_id", "left")
    empty = F.when(F.coalesce("n_true", F.lit(0)) == 0, 1.0).otherwise(0.0)
    return out.select("s1_id", F.round(F.greatest(F.coalesce("b", F.lit(0.0)), empty), 9).alias("best_f05"))


def extremes(rows: DataFrame) -> DataFrame:
    """Rows with the best false and the worst true score of their S1."""
    s1 = W.partitionBy("s1_id")
    return rows.withColumn("max_false", F.max(F.when(F.col("label") == 0, F.col("score"))).over(s1)).withColumn("min_true", F.min(F.when(F.col("label") == 1, F.col("score"))).over(s1))


def paired_delta(a: DataFrame, b: DataFrame, s1: DataFrame) -> DataFrame:
    """(country, n, delta, se): mean and standard error of f05(b) - f05(a) by country and in all."""
    rows = s1.select("s1_id", "country").join(a.select("s1_id", F.col("f05").alias("x")), "s1_id").join(b.select("s1_id", F.col("f05").alias("y")), "s1_id").withColumn("d", F.col("y") - F.col("x"))
    return rows.rollup("country").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("d"), 9).alias("delta"), F.round(F.stddev_samp("d") / F.sqrt(F.count("d")), 9).alias("se"))


def poisson(m: Column, u: Column) -> Column:
    """A Poisson(m) draw from u in (0, 1): the inverse of its distribution, summed up from 0, for m up to 100; beyond
    that the rounded normal, whose error is below the noise of any resampling."""
    term = lambda a, j: a["p"] * m / j
    first = F.struct(F.exp(-m).alias("p"), F.exp(-m).alias("c"), F.lit(0).alias("k"))
    step = lambda a, j: F.struct(term(a, j).alias("p"), (a["c"] + term(a, j)).alias("c"), (a["k"] + (a["c"] < u).cast("int")).alias("k"))
    terms = F.sequence(F.lit(1), (m + 12 * F.sqrt(m) + 20).cast("int"))
    v = F.pmod(u * F.lit(1e6), F.lit(1.0))  # the digits of u beyond the sixth are a second uniform, for Box and Muller
    normal = F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)
    return F.when(m <= 100, F.aggregate(terms, first, step)["k"].cast("double")).otherwise(F.greatest(F.round(m + F.sqrt(m) * normal), F.lit(0.0)))


def bootstrap(rows: DataFrame, column: str = "d", n: int = 2000, seed: int = 0) -> DataFrame:
    """(low, high): 2.5 and 97.5 percentiles of the mean under Poisson resampling. Rows are grouped by value first, and the
    weight of m equal rows is Poisson(m), so the work is by distinct values."""
    counts = rows.groupBy(F.col(column).cast("double").alias("x")).agg(F.count(F.lit(1)).cast("double").alias("m"))
    draws = counts.select("x", "m", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("b"))
    u = (F.xxhash64(F.lit(seed), "x", "b").bitwiseAND((1 << 53) - 1) + 0.5) / F.lit(float(1 << 53))
    means = draws.withColumn("u", u).withColumn("w", poisson(F.col("m"), F.col("u"))).groupBy("b").agg((F.sum(F.col("w") * F.col("x")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("mean"))
    return means.agg(F.percentile("mean", 0.025).alias("low"), F.percentile("mean", 0.975).alias("high"))


def auc(rows: DataFrame, parts: int = 256) -> DataFrame:
    """Area under the ROC curve of score for label, ties at half: by distinct scores, not by rows. Scores are cut into
    ``parts`` ranges at approximate quantiles, which decide only who sorts what: the ranges' sums are added up in order, and
    scores are put in order within a range."""
    by = rows.groupBy(F.col("score").cast("double").alias("score")).agg(F.sum("label").cast("double").alias("pos"), F.sum(1 - F.col("label")).cast("double").alias("neg"))
    cuts = by.agg(F.percentile_approx("score", [k / parts for k in range(1, parts)], 10 * parts).alias("cuts")).first().cuts or []
    ranges = Bucketizer(splits=[-float("inf"), *sorted(set(cuts)), float("inf")], inputCol="score", outputCol="range", handleInvalid="keep")
    by = ranges.transform(by) if cuts else by.withColumn("range", F.lit(0.0))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # ``parts`` rows
    sums = by.groupBy("range").agg(F.sum("neg").alias("all")).select("range", F.coalesce(F.sum("all").over(before), F.lit(0.0)).alias("under"))
    below = W.partitionBy("range").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    run = by.join(F.broadcast(sums), "range").withColumn("under", F.col("under") + F.coalesce(F.sum("neg").over(below), F.lit(0.0)))
    return run.agg(F.round(F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg")), 9).alias("auc"))


def true_by_accepted(s1: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    """Cross table: S1 records by number of true and accepted candidates."""
    return per_s1(s1, pred, truth).groupBy("n_true", "n_pred").agg(F.count(F.lit(1)).alias("n_s1"))
