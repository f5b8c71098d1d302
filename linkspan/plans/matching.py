"""End-to-end plans: candidates of a split, training of both models, prediction with the threshold or the meta decoder."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import blocking, decide, features, learn, metrics, stats
from ..session import settle, settle_pressed


def candidate_run(records: DataFrame, config: blocking.Config) -> DataFrame:
    """Ranked candidates of every S1 record of a split."""
    fields = tuple(dict.fromkeys([*config.fields, *(("g",) if config.fallback_below > 0 else ())]))
    listed = settle_pressed(stats.token_texts(records, fields, flags=True))
    idf = stats.idf(stats.token_freq(listed, fields), stats.country_counts(records))
    flags = records.select("entity_id", t.record_flags(F.col("business_name"), F.col("business_address")).alias("flags"))
    return blocking.candidates(records, listed, idf, flags, config)


def pairs_of(run: DataFrame) -> DataFrame:
    """Blocker scores as the matcher names them."""
    return run.select("s1_id", "cand_id", (F.col("combined") / 1e6).alias("block_score"), "rank", (F.col("name_score") / 1e6).alias("name_score"))


def text_models(records: DataFrame) -> dict[str, DataFrame]:
    """TF-IDF of names and addresses, fitted once on the records of training."""
    rec = features.prepared(records)
    return {k: features.fit_tfidf(rec.select(F.array_join(w, " ").alias("text"))) for k, w in (("name", "nw"), ("addr", "aw"))}


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    marked = truth.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1))
    return pairs.join(marked, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


@dataclass
class Bundle:
    """What prediction needs: models, text weights, features, thresholds and the list sizes they were trained for."""

    base: PipelineModel
    deep: PipelineModel
    meta: PipelineModel
    tfidf: dict[str, DataFrame]
    groups: tuple[str, ...]
    base_k: int
    deep_k: int
    base_threshold: float
    deep_threshold: float

    def save(self, folder: str, spark: SparkSession) -> None:
        for name in ("base", "deep", "meta"):
            getattr(self, name).write().overwrite().save(f"{folder}/{name}")
        for name, table in self.tfidf.items():
            table.write.mode("overwrite").parquet(f"{folder}/tfidf-{name}")
        facts = {"groups": self.groups, "base_k": self.base_k, "deep_k": self.deep_k, "base_threshold": self.base_threshold, "deep_threshold": self.deep_threshold, "tfidf": sorted(self.tfidf)}
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/facts")

    @classmethod
    def load(cls, folder: str, spark: SparkSession) -> Bundle:
        facts = json.loads(spark.read.text(f"{folder}/facts").first().value)
        tfidf = {k: spark.read.parquet(f"{folder}/tfidf-{k}") for k in facts.pop("tfidf")}
        models = {name: PipelineModel.load(f"{folder}/{name}") for name in ("base", "deep", "meta")}
        return cls(**models, tfidf=tfidf, **facts | {"groups": tuple(facts["groups"])})


def hybrid_rows(base: DataFrame, deep: DataFrame, cap: int = 50) -> DataFrame:
    """Hybrid candidates with the probability and features of the run they come from: base rows from base, further ones from deep."""
    rows = decide.hybrid_candidates(base, deep, cap).select("s1_id", "cand_id", "origin")
    each = lambda df, o: rows.where(F.col("origin") == o).join(df, ["s1_id", "cand_id"])
    return each(base, 0).unionByName(each(deep, 1))


def train_bundle(records: DataFrame, truth: DataFrame, base: blocking.Config, deep: blocking.Config, groups: tuple[str, ...] = features.PRODUCTION_GROUPS, folds: int = 5, grid: list[float] = learn.GRID, **options) -> Bundle:
    """Both pair matchers, the second-stage model on out-of-fold scores, and thresholds tuned for macro F0.5."""
    s1, names = records.where("source = 1").select(F.col("entity_id").alias("s1_id"), "country"), features.feature_names(groups)
    tfidf = {k: settle(v) for k, v in text_models(records).items()}
    labelled = [settle(label(featurized(candidate_run(records, c), records, tfidf, groups), truth)) for c in (base, deep)]
    held = [settle(learn.out_of_fold(learn.folds(rows, folds), names, folds, **options).drop("fold")) for rows in labelled]
    meta, scored = learn.train_meta(hybrid_rows(*held), names, folds, **options)
    scored = settle(scored.select("s1_id", "cand_id", "origin", "score"))

    def value(at: dict) -> float:
        return metrics.macro_f05(s1, decide.meta_decide(scored, at["base"], at["deep"]), truth).first().macro_f05

    best, _ = learn.coordinate_descent(value, {"base": 0.5, "deep": 0.5}, grid, 2)
    models = [learn.train(rows, names, **options) for rows in labelled]
    return Bundle(*models, meta, tfidf, tuple(groups), base.top_k, deep.top_k, best["base"], best["deep"])


def predict(records: DataFrame, bundle: Bundle, base: blocking.Config, deep: blocking.Config, decoder: str = "meta", cap: int = 50) -> tuple[DataFrame, DataFrame]:
    """(matches, hybrid candidates) of a split: s1_id and cand_id each, candidates with origin."""
    for config, k in ((base, bundle.base_k), (deep, bundle.deep_k)):
        decide.check_same_k(k, config.top_k)
    scored = [settle(learn.score(m, featurized(candidate_run(records, c), records, bundle.tfidf, bundle.groups))) for m, c in ((bundle.base, base), (bundle.deep, deep))]
    listed = decide.hybrid_candidates(*scored, cap).select("s1_id", "cand_id", "origin", "hybrid_rank")
    if decoder == "threshold":
        return threshold_matches(*scored, bundle, cap).select("s1_id", "cand_id"), listed
    return meta_matches(hybrid_rows(*scored, cap), bundle).select("s1_id", "cand_id"), listed


def featurized(run: DataFrame, records: DataFrame, tfidf: dict[str, DataFrame], groups: tuple[str, ...]) -> DataFrame:
    return features.build(pairs_of(run), records, tfidf, groups, stats.name_stats(records) if "E" in groups else None)


def threshold_matches(base: DataFrame, deep: DataFrame, bundle: Bundle, cap: int = 50) -> DataFrame:
    """Matches of the threshold decoder from scored runs (s1_id, cand_id, rank, prob)."""
    accepted = decide.base_predictions(base, bundle.base_threshold)
    hybrid = decide.hybrid_candidates(base, deep, cap).where("origin = 1").select("s1_id", "cand_id")
    pool = deep.join(hybrid, ["s1_id", "cand_id"], "left_semi").where(F.col("prob").cast("float") >= F.lit(bundle.deep_threshold).cast("float"))
    return decide.merge_deep(accepted, pool)


def meta_matches(rows: DataFrame, bundle: Bundle) -> DataFrame:
    """Matches of the meta decoder from hybrid rows with prob, origin, rank and pair features."""
    return decide.meta_decide(learn.meta_scores(bundle.meta, rows), bundle.base_threshold, bundle.deep_threshold)


def sample_s1(s1: DataFrame, rate: float, salt: str, validation: tuple[str, float], cities: dict[str, str] | None = None) -> DataFrame:
    """S1 records of the training sample: by hash or city, without the validation sample."""
    keep = t.stable_hash(F.col("entity_id"), salt) < rate
    if cities:
        keep = keep | stats.in_city(F.col("business_address"), F.col("country"), cities)
    return s1.where(keep & ~(t.stable_hash(F.col("entity_id"), validation[0]) < validation[1]))
