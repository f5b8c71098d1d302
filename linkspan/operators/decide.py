"""Decisions: one owner for each candidate, thresholds, hybrid candidate lists, base-priority merges, the meta decision.

Probabilities of the first stage are compared as floats, meta scores as doubles. Ties go to the smallest s1_id as a
string, then to the earlier row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LEVELS = (0.3, 0.5, 0.7, 0.9)
META_FLOOR = 0.02


def top_two(pairs: DataFrame, score: str) -> DataFrame:
    """(cand_id, t1, t2): the two best scores of each candidate; t2 is null with one claimant. Only two rows of a candidate leave a task."""
    order = W.partitionBy("cand_id").orderBy(F.col(score).desc(), "s1_id")
    two = pairs.select("cand_id", "s1_id", score).withColumn("r", F.row_number().over(order)).where("r <= 2")
    return two.groupBy("cand_id").agg(F.max(F.when(F.col("r") == 1, F.col(score))).alias("t1"), F.max(F.when(F.col("r") == 2, F.col(score))).alias("t2"))


def other_gap(pairs: DataFrame, score: str, to: str) -> DataFrame:
    """Score minus the best of the other claimants of the candidate; 0 without any. A tied best gets 0."""
    order = W.partitionBy("cand_id").orderBy(F.col(score).desc(), "s1_id")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first, second = F.first(score).over(whole), F.nth_value(score, 2).over(whole)
    return pairs.withColumn(to, F.coalesce(F.when(F.col(score) >= first, F.col(score) - second).otherwise(F.col(score) - first), F.lit(0.0)))


def exclusive(pairs: DataFrame, score: str = "prob", tie: tuple[str, ...] = ("s1_id", "row")) -> DataFrame:
    """The row of each candidate's best claimant."""
    order = W.partitionBy("cand_id").orderBy(F.col(score).desc(), *[x for x in tie if x in pairs.columns])
    return pairs.withColumn("r_", F.row_number().over(order)).where("r_ = 1").drop("r_")


def to_matches(pairs: DataFrame, threshold: float, s1: DataFrame) -> DataFrame:
    """(s1_id, matched): every S1 with its candidates of probability ``threshold`` or more; both are compared as floats."""
    hit = pairs.where(F.col("prob").cast("float") >= F.lit(threshold).cast("float"))
    lists = hit.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("matched"))
    return s1.select("s1_id").join(lists, "s1_id", "left").withColumn("matched", F.coalesce("matched", F.array().cast("array<string>")))


def check_same_k(model_k: int, run_k: int) -> None:
    if model_k != run_k:
        raise ValueError(f"the model was trained on {model_k} candidates, the run has {run_k}")


def hybrid_candidates(base: DataFrame, deep: DataFrame, cap: int) -> DataFrame:
    """Base rows, then deep rows that aren't base, up to ``cap``; base is never cut. Adds origin (0 base, 1 deep), base_rank, deep_rank and hybrid_rank."""
    b = base.select("s1_id", "cand_id", F.col("rank").alias("base_rank"))
    d = deep.select("s1_id", "cand_id", F.col("rank").alias("deep_rank"))
    kept = b.join(d, ["s1_id", "cand_id"], "left").withColumn("origin", F.lit(0))
    sizes = b.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    more = d.join(b, ["s1_id", "cand_id"], "left_anti").join(sizes, "s1_id", "left")
    more = more.withColumn("pos", F.row_number().over(W.partitionBy("s1_id").orderBy("deep_rank", "cand_id"))).where(F.col("pos") <= F.greatest(F.lit(cap) - F.coalesce("n", F.lit(0)), F.lit(0)))
    rows = kept.unionByName(more.select("s1_id", "cand_id", F.lit(None).cast(b.schema["base_rank"].dataType).alias("base_rank"), "deep_rank", F.lit(1).alias("origin")))
    order = W.partitionBy("s1_id").orderBy("origin", F.col("base_rank").asc_nulls_last(), F.col("deep_rank").asc_nulls_last(), "cand_id")
    return rows.withColumn("hybrid_rank", F.row_number().over(order))


def base_predictions(pairs: DataFrame, threshold: float) -> DataFrame:
    """(s1_id, cand_id) of winners at or above the threshold."""
    return exclusive(pairs).where(F.col("prob").cast("float") >= F.lit(threshold).cast("float")).select("s1_id", "cand_id")


def merge_deep(base: DataFrame, deep: DataFrame) -> DataFrame:
    """Base matches (s1_id, cand_id) and accepted deep rows (with prob) of candidates that base doesn't own; among deep claimants the most probable, then the smallest s1_id."""
    free = deep.join(base.select("cand_id").distinct(), "cand_id", "left_anti")
    won = exclusive(free, tie=("s1_id",)).select("s1_id", "cand_id")
    return base.select("s1_id", "cand_id", F.lit(0).alias("is_deep")).unionByName(won.withColumn("is_deep", F.lit(1)))


def deep_evidence(rows: DataFrame) -> DataFrame:
    """Second best probability of the S1's deep rows (0 if it has one) and whether the row is the best."""
    s1 = W.partitionBy("s1_id")
    ordered = s1.orderBy(F.col("prob").desc(), "cand_id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.withColumn("deep_second_prob", F.coalesce(F.nth_value("prob", 2).over(ordered), F.lit(0.0))).withColumn("deep_is_best", F.col("prob") == F.max("prob").over(s1))


def deep_rules(threshold: float) -> dict[str, Column]:
    """Conditions A to E on evidence columns."""
    c, likely = F.col, F.col("prob") >= threshold
    conflict = (c("num_best_ratio") >= 0) & (c("num_best_ratio") < 0.5)
    named = (c("name_tsort") >= 0.8) | (c("ph_jacc") >= 0.5)
    address = (c("cand_addr_missing") == 1) | (c("addr_word_jacc") >= 0.3)
    ahead = c("deep_is_best") | (c("prob") - c("deep_second_prob") >= 0.2)
    return {"A": likely, "B": likely & ~conflict, "C": likely & named, "D": likely & ahead, "E": likely & named & address}


def meta_context(rows: DataFrame, order: tuple[str, ...] = ("origin", "rank", "cand_id")) -> DataFrame:
    """Rows (s1_id, prob, origin and the ``order`` columns that settle ties) with 14 columns about their S1."""
    s1 = W.partitionBy("s1_id")
    by = s1.orderBy(F.col("prob").desc(), *order)
    whole = by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nth = lambda k: F.coalesce(F.nth_value("prob", k).over(whole), F.lit(0.0))
    of = lambda o: F.coalesce(F.max(F.when(F.col("origin") == o, F.col("prob"))).over(s1), F.lit(0.0))
    out = rows.withColumns({"s1_top1": nth(1), "s1_top2": nth(2), "s1_top3": nth(3)})
    out = out.withColumns({f"s1_n_above_{x}": F.count_if(F.col("prob") >= x).over(s1) for x in LEVELS})
    out = out.withColumns({"s1_prob_sum": F.sum("prob").over(s1), "s1_base_top1": of(0), "s1_deep_top1": of(1), "s1_n_cands": F.count(F.lit(1)).over(s1), "prob_pos_in_s1": F.row_number().over(by) - 1})
    return out.withColumns({"top1_minus_prob": F.col("s1_top1") - F.col("prob"), "gap12": F.col("s1_top1") - F.col("s1_top2")})


def meta_rows(rows: DataFrame, floor: float = META_FLOOR) -> DataFrame:
    """Rows that the second model scores. The context is worked out before: it sees all rows of an S1."""
    return meta_context(rows).where(F.col("prob") >= floor)


def stage_winners(rows: DataFrame, score: str = "score") -> DataFrame:
    """Each candidate's best claimant among base rows and among deep rows."""
    order = W.partitionBy("cand_id", "origin").orderBy(F.col(score).desc(), "s1_id")
    return rows.withColumn("r_", F.row_number().over(order)).where("r_ = 1").drop("r_")


def meta_decide(rows: DataFrame, base_threshold: float, deep_threshold: float, score: str = "score") -> DataFrame:
    """Accepted winners: base at its threshold, deep at its own where base doesn't own the candidate."""
    ok = stage_winners(rows, score).where(F.col(score) >= F.when(F.col("origin") == 0, base_threshold).otherwise(deep_threshold))
    base = ok.where("origin = 0")
    return base.unionByName(ok.where("origin = 1").join(base.select("cand_id").distinct(), "cand_id", "left_anti").select(*base.columns))


def claimants(rows: DataFrame, score: str = "score") -> DataFrame:
    """Rows with their candidate's number of claimants, the best competing score and the margin to it."""
    cand = W.partitionBy("cand_id")
    out = other_gap(rows, score, "margin").withColumn("n_claimants", F.size(F.collect_set("s1_id").over(cand)))
    return out.withColumn("best_other", F.col(score) - F.col("margin"))


def s1_aggregates(rows: DataFrame) -> DataFrame:
    """One row for each S1: best three probabilities, gaps, counts above levels, sum."""
    top = F.slice(F.sort_array(F.collect_list("prob"), False), 1, 3)
    out = rows.groupBy("s1_id").agg(top.alias("top"), *[F.count_if(F.col("prob") >= x).alias(f"n_above_{x}") for x in LEVELS], F.sum("prob").alias("prob_sum"), F.count(F.lit(1)).alias("n"))
    at = lambda k: F.coalesce(F.get("top", F.lit(k)), F.lit(0.0))
    return out.select("*", at(0).alias("top1"), at(1).alias("top2"), at(2).alias("top3"), (at(0) - at(1)).alias("gap12"), (at(1) - at(2)).alias("gap23")).drop("top")


def first_n(rows: DataFrame, counts: DataFrame, score: str = "score") -> DataFrame:
    """The best n rows of each S1, n from counts (s1_id, n)."""
    order = W.partitionBy("s1_id").orderBy(F.col(score).desc(), "cand_id")
    return rows.join(counts, "s1_id").withColumn("r_", F.row_number().over(order)).where(F.col("r_") <= F.col("n")).drop("r_", "n")


def suppress(matches: DataFrame, gate: DataFrame) -> DataFrame:
    """Matches without those of the S1 records (s1_id) that a gate says have none."""
    return matches.join(gate.select("s1_id").distinct(), "s1_id", "left_anti")


def ensemble(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median and mean log-odds of several probabilities."""
    logit = lambda p: F.log(p / (1 - p))
    clipped = [F.least(F.greatest(F.col(c), F.lit(1e-6)), F.lit(1 - 1e-6)) for c in columns]
    ordered, n = F.sort_array(F.array(*columns)), len(columns)
    median = ordered[n // 2] if n % 2 else (ordered[n // 2 - 1] + ordered[n // 2]) / 2
    mean_logit = reduce(lambda a, b: a + b, map(logit, clipped)) / n
    return rows.withColumns({"ens_mean": reduce(lambda a, b: a + b, map(F.col, columns)) / n, "ens_median": median, "ens_logit": 1 / (1 + F.exp(-mean_logit))})
