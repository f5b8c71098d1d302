"""Learning: gradient-boosted pair matcher, grouped out-of-fold scores, threshold search, second-stage model, decoders."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decide import exclusive, meta_rows
from .metrics import best_threshold, threshold_grid

GRID = [round(0.05 + 0.01 * k, 2) for k in range(94)]
#: Cut points that the set decoder looks at, and true candidates that it tells apart.
CUTS, TRUE = 16, 24


def train(rows: DataFrame, features: list[str], label: str = "label", weight: str | None = None, trees: int = 100, depth: int = 5, rate: float = 0.1, seed: int = 0) -> PipelineModel:
    """A boosted classifier of ``label``. ``weight`` names a column of row weights."""
    boost = GBTClassifier(featuresCol="vector", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed, subsamplingRate=0.8)
    if weight:
        boost = boost.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="vector", handleInvalid="keep"), boost]).fit(rows)


def score(model: PipelineModel, rows: DataFrame, to: str = "prob", kind: str = "float") -> DataFrame:
    """Probability of the positive class: float for the first stage, double for the second."""
    out = model.transform(rows).withColumn(to, vector_to_array("probability")[1].cast(kind))
    return out.drop("vector", "rawPrediction", "probability", "prediction")


def folds(rows: DataFrame, k: int = 5, by: str = "s1_id") -> DataFrame:
    """Fold of each row from a hash of its group, so a group stays whole."""
    return rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), by), F.lit(k)).cast("int"))


def out_of_fold(rows: DataFrame, features: list[str], k: int = 5, **options) -> DataFrame:
    """Rows with ``prob`` from the model of the other folds. ``rows`` has fold."""
    parts = [score(train(rows.where(F.col("fold") != f), features, **options), rows.where(F.col("fold") == f)) for f in range(k)]
    return reduce(DataFrame.unionByName, parts)


def tuned_threshold(s1: DataFrame, scored: DataFrame, truth: DataFrame, grid: list[float] = GRID) -> float:
    return best_threshold(threshold_grid(s1, exclusive(scored), truth, grid))


def coordinate_descent(objective: Callable[[dict], float], start: dict, grid: list[float], rounds: int = 3) -> tuple[dict, float]:
    """The best value of each coordinate in turn, until none changes or ``rounds`` are over. The first of ties stays."""
    now, best = dict(start), objective(start)
    for _ in range(rounds):
        before = dict(now)
        for name in now:
            for x in grid:
                trial = now | {name: x}
                if (value := objective(trial)) > best:
                    now, best = trial, value
        if now == before:
            break
    return now, best


def meta_features(first_stage: list[str]) -> list[str]:
    """Input columns of the second model: probability, origin, blocker rank, S1 context and the pair features but the rank."""
    from .decide import LEVELS

    context = ["s1_top1", "s1_top2", "s1_top3", *[f"s1_n_above_{x}" for x in LEVELS], "s1_prob_sum", "s1_base_top1", "s1_deep_top1", "s1_n_cands", "prob_pos_in_s1", "top1_minus_prob", "gap12"]
    return ["prob", "origin", "blocker_rank", *context, *[f for f in first_stage if f != "rank"]]


def _plain(df: DataFrame) -> DataFrame:
    """Columns whose names hold dots get underscores: ml can't address them."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def train_meta(rows: DataFrame, pair_features: list[str], k: int = 5, **options) -> tuple[PipelineModel, DataFrame]:
    """The second model over rows above the floor, and its out-of-fold scores. ``rows``: prob, origin, rank, label and pair features."""
    names = [f.replace(".", "_") for f in meta_features(pair_features)]
    ready = folds(_plain(meta_rows(rows).withColumn("blocker_rank", F.col("rank"))), k)
    held = reduce(DataFrame.unionByName, [score(train(ready.where(F.col("fold") != f), names, **options), ready.where(F.col("fold") == f), "score", "double") for f in range(k)])
    return train(ready, names, **options), held


def meta_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Second-stage scores; rows below the floor have minus infinity."""
    above = score(model, _plain(meta_rows(rows).withColumn("blocker_rank", F.col("rank"))), "score", "double").select("s1_id", "cand_id", "score")
    return rows.join(above, ["s1_id", "cand_id"], "left").withColumn("score", F.coalesce("score", F.lit(float("-inf"))))


def calibrate(rows: DataFrame, score_column: str = "score") -> DataFrame:
    """Rows with ``calibrated``, an isotonic fit of label on the score."""
    fitted = IsotonicRegression(featuresCol=score_column, labelCol="label").fit(rows.select(F.col(score_column), F.col("label").cast("double")))
    return fitted.transform(rows).withColumnRenamed("prediction", "calibrated")


def count_distribution(p: np.ndarray, size: int) -> np.ndarray:
    """Distribution of the number of successes of independent trials; the last cell takes all beyond."""
    d = np.zeros(size)
    d[0] = 1.0
    for x in p:
        moved = d * x
        d = d * (1 - x)
        d[1:] += moved[:-1]
        d[-1] += moved[-1]
    return d


def expected_f05(p: np.ndarray, miss: float = 0.0) -> np.ndarray:
    """Expected F0.5 of keeping the first k = 0 .. CUTS of an S1's rows with match probabilities ``p`` in order; ``miss`` is the expected number of true candidates that aren't listed."""
    size = TRUE + 1
    a, b = np.arange(size)[:, None], np.arange(size)[None, :]
    out = np.zeros(CUTS + 1)
    out[0] = count_distribution(p, size)[0] * np.exp(-miss)
    for k in range(1, CUTS + 1):
        gain = np.where(a <= k, 1.25 * a / (0.25 * (a + b + miss) + k), 0.0)
        out[k] = count_distribution(p[:k], size) @ gain @ count_distribution(p[k:], size)
    return out


def set_decode(rows: DataFrame, probability: str = "prob") -> DataFrame:
    """Rows that the expected-F0.5 decoder keeps in each S1: the best prefix. An S1 has as many rows as its candidate list, so a group is bounded by the run's cap."""
    schema = rows.schema

    def best(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([probability, "cand_id"], ascending=[False, True], kind="stable")
        return group.head(int(expected_f05(group[probability].to_numpy(float)).argmax()))

    return rows.groupBy("s1_id").applyInPandas(best, schema)


def no_match_gate(aggregates: DataFrame, singleton: DataFrame, k: int = 5, **options) -> DataFrame:
    """(s1_id, gate): out-of-fold probability that an S1 has no match, from its aggregates. ``singleton``: (s1_id, label)."""
    features = [c.replace(".", "_") for c in aggregates.columns if c != "s1_id"]
    return out_of_fold(folds(_plain(aggregates).join(singleton, "s1_id"), k), features, k, **options).select("s1_id", F.col("prob").alias("gate"))


def hard_negative_weights(rows: DataFrame, weight: float = 3.0, most: int = 3) -> DataFrame:
    """Rows with ``weight``: negatives of rank ``most`` or better count more."""
    return rows.withColumn("weight", F.when((F.col("label") == 0) & (F.col("rank") <= most), weight).otherwise(1.0))
