"""Reports on whole runs: comparison, hybrid and deep evaluation, oracle ladder, attribution of errors, gates, samples.

All are compositions of joins and conditional aggregates; a report is one row or a few, and nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import metrics
from .decide import exclusive

_mean = lambda c: F.round(F.avg(c), 9)
_if = F.count_if


def owners(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Rows with ``owner``, the S1 that a candidate truly belongs to (null for none), and whose it is: own, other or none."""
    owner = truth.groupBy("cand_id").agg(F.min("s1_id").alias("owner"))
    whose = F.when(F.col("owner").isNull(), "none").when(F.col("owner") == F.col("s1_id"), "own").otherwise("other")
    return rows.join(owner, "cand_id", "left").withColumn("whose", whose)


def judged(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """Rows with ``accepted``, whether the pair is among the accepted ones."""
    said = accepted.select("s1_id", "cand_id").distinct().withColumn("accepted", F.lit(True))
    return rows.join(said, ["s1_id", "cand_id"], "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def compare_runs(s1: DataFrame, truth: DataFrame, runs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """A row for each run (rows with prob and label, accepted pairs): recall, ceiling, candidates, F0.5, AUC, false positives."""
    reports = []
    for name, (rows, accepted) in runs.items():
        blocked = metrics.blocking_metrics(s1, rows, truth).where("country is null").select("pair_recall", "ceiling", "cands_per_s1")
        per = metrics.per_s1(s1, accepted, truth).agg(_mean("f05").alias("macro_f05"), F.sum(F.col("n_pred") - F.col("tp")).alias("false_positives"))
        curve = metrics.auc(rows.withColumnRenamed("prob", "score"))
        keyed = [x.withColumn("run", F.lit(name)) for x in (blocked, per, curve)]
        reports.append(reduce(lambda a, b: a.join(b, "run"), keyed))
    return reduce(DataFrame.unionByName, reports)


def hybrid_report(s1: DataFrame, rows: DataFrame, base: DataFrame, final: DataFrame, truth: DataFrame, native: DataFrame) -> DataFrame:
    """One row: F0.5 of the final decision and its paired delta to the base one, with errors of candidates by kind.
    ``rows`` has the candidates with hybrid_rank, ``native`` the cand_id of names in other scripts."""
    per = metrics.per_s1(s1, final, truth)
    both = per.join(metrics.per_s1(s1, base, truth).select("s1_id", F.col("f05").alias("was")), "s1_id").withColumn("d", F.col("f05") - F.col("was"))
    whole = both.agg(_mean("f05").alias("macro_f05"), _mean("d").alias("delta"), F.round(F.stddev_samp("d") / F.sqrt(F.count("d")), 9).alias("se"), F.sum("tp").alias("tp"), F.sum(F.col("n_pred") - F.col("tp")).alias("fp"), F.sum(F.col("n_true") - F.col("tp")).alias("fn"))
    true = truth.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1))
    seen = judged(rows, final).join(true, ["s1_id", "cand_id"], "left").join(native.select("cand_id").distinct().withColumn("native", F.lit(1)), "cand_id", "left")
    wrong = seen.agg(_if(F.col("accepted") & F.col("label").isNull() & (F.col("hybrid_rank") <= 3)).alias("fp_rank_1_3"), _if(~F.col("accepted") & F.col("label").isNotNull() & F.col("native").isNotNull()).alias("fn_native"))
    one = lambda df: df.withColumn("one", F.lit(1))
    return one(whole).join(one(wrong), "one").drop("one")


def deep_evaluation(s1: DataFrame, base: DataFrame, final: DataFrame, truth: DataFrame) -> DataFrame:
    """(country, n_s1, f05, delta, singletons_empty, added, added_tp, added_fp, improved, harmed): what deep matches change,
    by country and in all. ``final`` has is_deep."""
    now, was = metrics.per_s1(s1, final, truth), metrics.per_s1(s1, base, truth).select("s1_id", F.col("f05").alias("was"))
    true = truth.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1))
    added = final.where("is_deep = 1").join(true, ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count(F.lit(1)).alias("added"), F.count("hit").alias("added_tp"))
    rows = s1.select("s1_id", "country").join(now, "s1_id").join(was, "s1_id").join(added, "s1_id", "left").na.fill(0, ["added", "added_tp"]).withColumn("d", F.col("f05") - F.col("was"))
    single = F.col("n_true") == 0
    return rows.rollup("country").agg(
        F.count(F.lit(1)).alias("n_s1"), _mean("f05").alias("f05"), _mean("d").alias("delta"), F.round(F.avg(F.when(single, (F.col("n_pred") == 0).cast("double"))), 9).alias("singletons_empty"),
        F.sum("added").alias("added"), F.sum("added_tp").alias("added_tp"), F.sum(F.col("added") - F.col("added_tp")).alias("added_fp"), _if(F.col("d") > 1e-12).alias("improved"), _if(F.col("d") < -1e-12).alias("harmed"),
    )


def oracle_ladder(s1: DataFrame, rows: DataFrame, deeper: DataFrame, truth: DataFrame) -> DataFrame:
    """(o0 .. o4): macro F0.5 of the decision (``accepted``), of the best prefix of each S1 by score, of a perfect choice
    among the rows, of one among the rows and ``deeper`` ones, and of a perfect system; differences are what each step loses."""
    chosen = metrics.per_s1(s1, rows.where("accepted"), truth).select("s1_id", F.col("f05").alias("o0"))
    prefix = metrics.oracle_prefix(s1, rows, truth).withColumnRenamed("best_f05", "o1")
    true = truth.select("s1_id", "cand_id").distinct()
    perfect = lambda seen, name: metrics.per_s1(s1, true.join(seen.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_semi"), truth).select("s1_id", F.col("f05").alias(name))
    pairs = rows.select("s1_id", "cand_id")
    steps = [chosen, prefix, perfect(pairs, "o2"), perfect(pairs.unionByName(deeper.select("s1_id", "cand_id")), "o3")]
    return reduce(lambda a, b: a.join(b, "s1_id"), steps).agg(*[_mean(f"o{k}").alias(f"o{k}") for k in range(4)], F.lit(1.0).alias("o4"))


def attribute_errors(rows: DataFrame, truth: DataFrame, floor: float) -> DataFrame:
    """Rows (score, label, accepted) with ``fault``: why a true candidate is missed or a false one accepted; null where right."""
    of = W.partitionBy("s1_id")
    held = metrics.extremes(rows).withColumn("present", F.max("label").over(of) == 1)
    lost = judged(held.drop("accepted"), held.where("accepted")).join(held.where("accepted").groupBy("cand_id").agg(F.min("s1_id").alias("taker")), "cand_id", "left")
    single = truth.select("s1_id").distinct().withColumn("matched", F.lit(1))
    out = lost.join(single, "s1_id", "left")
    missed = F.when(F.col("score") < floor, "below the floor").when(F.col("taker").isNotNull() & (F.col("taker") != F.col("s1_id")), "lost to another S1").when(F.col("max_false") >= F.col("score"), "outranked by a false one").otherwise("below the threshold")
    wrong = F.when(F.col("matched").isNull(), "in an S1 without match").when(~F.col("present"), "true ones are no candidates").when(F.col("score") > F.col("min_true"), "outranks a true one").otherwise("true ones rank above")
    fault = F.when((F.col("label") == 1) & ~F.col("accepted"), F.concat(F.lit("FN "), missed)).when((F.col("label") == 0) & F.col("accepted"), F.concat(F.lit("FP "), wrong))
    return out.withColumn("fault", fault).drop("taker", "matched", "present", "max_false", "min_true")


def gate_metrics(s1: DataFrame, accepted: DataFrame, truth: DataFrame, suppressed: DataFrame) -> DataFrame:
    """One row: F0.5 of all, of matched S1, empty singletons, and whom the gate suppressed rightly or not."""
    gone = suppressed.select("s1_id").distinct().withColumn("gone", F.lit(1))
    left = accepted.join(gone, "s1_id", "left_anti")
    rows = metrics.per_s1(s1, left, truth).join(gone, "s1_id", "left")
    single, out = F.col("n_true") == 0, F.col("gone").isNotNull()
    return rows.agg(_mean("f05").alias("macro_f05"), F.round(F.avg(F.when(~single, F.col("f05"))), 9).alias("matched_f05"), F.round(F.avg(F.when(single, (F.col("n_pred") == 0).cast("double"))), 9).alias("singletons_empty"), _if(out).alias("suppressed"), _if(out & single).alias("suppressed_singletons"), _if(out & ~single).alias("suppressed_matched"))


def fold_thresholds(s1: DataFrame, winners: DataFrame, truth: DataFrame, fold: Column, k: int, grid: list[float]) -> DataFrame:
    """(fold, threshold): for each fold the smallest best threshold of the S1 records of the others."""
    marked = s1.withColumn("fold", fold)
    best = W.orderBy(F.col("macro_f05").desc(), "threshold")
    picked = [metrics.threshold_grid(rest, winners.join(rest.select("s1_id"), "s1_id", "left_semi"), truth.join(rest.select("s1_id"), "s1_id", "left_semi"), grid).withColumn("r", F.row_number().over(best)).where("r = 1").select(F.lit(f).alias("fold"), "threshold") for f in range(k) for rest in [marked.where(F.col("fold") != f)]]
    return reduce(DataFrame.unionByName, picked)


def hard_groups(rows: DataFrame, threshold: float, groups: dict[str, Column]) -> DataFrame:
    """(grp, accepted, false_positives): accepted rows, and the false ones among them, in each group of pairs."""
    won = exclusive(rows).where(F.col("prob").cast("float") >= F.lit(threshold).cast("float"))
    marks = F.array(*[F.struct(F.lit(k).alias("grp"), c.alias("in")) for k, c in groups.items()])
    return won.select("label", F.inline(marks)).where("`in`").groupBy("grp").agg(F.count(F.lit(1)).alias("accepted"), _if(F.col("label") == 0).alias("false_positives"))


def pair_categories(rows: DataFrame, truth: DataFrame, records: DataFrame) -> dict[str, Column]:
    """Conditions on ``categorised`` rows by name."""
    bucket = metrics.rank_bucket(F.col("rank"))
    ranks = {f"rank_{b}": bucket == b for b in ("1", "2-3", "4-5", "6-10", "11-20", "21-50", "51+")}
    one, two = F.col("a_empty"), F.col("b_empty")
    return ranks | {
        "singleton_s1": ~F.col("matched"), "matched_s1": F.col("matched"), "s1_address_missing": one, "cand_address_missing": two, "both_addresses": ~one & ~two,
        "first_num_missing": (F.col("a_no") == "") | (F.col("b_no") == ""), "first_num_equal": (F.col("a_no") != "") & (F.col("a_no") == F.col("b_no")), "first_num_unequal": (F.col("a_no") != "") & (F.col("b_no") != "") & (F.col("a_no") != F.col("b_no")),
        "claimed_by_other_s1": F.col("whose") == "other", "multi_s1_candidate": F.col("n_s1") > 1, "nonlatin_candidate": F.col("b_native"), "S2": F.col("cand_id").startswith("S2-"), "S3": F.col("cand_id").startswith("S3-"),
    }


def categorised(rows: DataFrame, truth: DataFrame, records: DataFrame) -> DataFrame:
    """Rows with what the categories ask: both sides' address, first number and script, the owner and the number of claimants."""
    from ..functions import text as t

    facts = records.select("entity_id", (F.coalesce("business_address", F.lit("")) == "").alias("empty"), t.house_number(F.col("business_address")).alias("no"), t.has_nonlatin(F.col("business_name")).alias("native"))
    side = lambda mark, key: facts.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{mark}_{c}") for c in ("empty", "no", "native")])
    out = owners(rows, truth).join(side("a", "s1_id"), "s1_id").join(side("b", "cand_id"), "cand_id")
    out = out.join(truth.select("s1_id").distinct().withColumn("matched", F.lit(True)), "s1_id", "left").withColumn("matched", F.coalesce("matched", F.lit(False)))
    return out.join(rows.groupBy("cand_id").agg(F.count_distinct("s1_id").alias("n_s1")), "cand_id")


def missed_shares(truth: DataFrame, run: DataFrame, traits: dict[str, Column], facts: DataFrame, measure: str) -> DataFrame:
    """(reach, n, a share for each trait, the exact median of ``measure``): true pairs that are no candidates against the
    others. ``facts`` has the trait columns by s1_id and cand_id."""
    seen = run.select("s1_id", "cand_id").distinct().withColumn("seen", F.lit(1))
    rows = facts.join(truth.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"], "left_semi").join(seen, ["s1_id", "cand_id"], "left")
    reach = F.when(F.col("seen").isNull(), "FN1").otherwise("reachable").alias("reach")
    return rows.groupBy(reach).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c.cast("double")), 9).alias(k) for k, c in traits.items()], F.median(measure).alias(f"median_{measure}"))


def first_s1(s1: DataFrame, n: int) -> DataFrame:
    """S1 records of the first n rows of their source."""
    return s1.where(F.col("s1_row") < n)


def every_kth(rows: DataFrame, k: int, row: str = "source_row") -> DataFrame:
    """Rows 0, k, 2k and so on of their source."""
    return rows.where(F.col(row) % k == 0)


def sampled(s1: DataFrame, truth: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The truth of the sampled S1 records, and the records of these and of their candidates."""
    own = truth.join(s1.select("s1_id").distinct(), "s1_id", "left_semi")
    ids = s1.select(F.col("s1_id").alias("entity_id")).unionByName(own.select(F.col("cand_id").alias("entity_id"))).distinct()
    return own, records.join(ids, "entity_id", "left_semi")


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, n_rows, n_values, n_null, most): rows, distinct values, nulls and the rows of the most frequent value."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    by = rows.select(F.inline(cells)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("m"))
    return by.groupBy("field").agg(F.sum("m").alias("n_rows"), F.count("value").alias("n_values"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("m"))), F.lit(0)).alias("n_null"), F.max("m").alias("most"))


def mark_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, marks, masked): combining marks, and values that hold a mask character."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("")).alias("value")) for c in columns])
    return rows.select(F.inline(cells)).groupBy("field").agg(F.sum(F.regexp_count("value", F.lit(r"\p{M}"))).cast("bigint").alias("marks"), _if(F.col("value").rlike(r"[*#]")).alias("masked"))


def overlap_proof(held: DataFrame, used: DataFrame) -> DataFrame:
    """(n_held, n_shared): ids held out, and those of them that are in use; n_shared must be 0."""
    mark = used.select(F.col(used.columns[0]).alias("id")).distinct().withColumn("used", F.lit(1))
    return held.select(F.col(held.columns[0]).alias("id")).distinct().join(mark, "id", "left").agg(F.count(F.lit(1)).alias("n_held"), F.count("used").alias("n_shared"))


def adopts(stored: DataFrame, rows: DataFrame, keys: tuple[str, ...] = ("s1_id", "cand_id")) -> bool:
    """Whether a stored table has the columns and exactly the row keys that are wanted."""
    if sorted(stored.columns) != sorted(rows.columns):
        return False
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    differ = count(stored, "x").join(count(rows, "y"), list(keys), "full").where(~F.col("x").eqNullSafe(F.col("y")))
    return differ.isEmpty()
