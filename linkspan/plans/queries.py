"""Registered queries over a three-source view of ``documents``, each with DuckDB SQL where SQL can express it.

Where a classifier's probability is needed, a fixed function of the blocking score stands in, so decisions have exact
oracles: prob = floor(100 c / (c + HALF)) / 100 with c the combined score in millionths."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as t
from ..operators import analysis, blocking, decide, evaluation, features, learn, metrics, scoring, stats
from ..sources import records as src
from ..sources import sinks
from ..session import settle, settle_pressed
from . import matching



@dataclass(frozen=True)
class Limits:
    """Caps on document frequency of the blocking operators and the depth of a re-rank, as the operators have them."""

    max_df: int = blocking.Config.max_df
    rerank_depth: int = blocking.Config.rerank_depth
    keys: int = 20_000
    last_key: int = 50_000
    standin: int = 3_000
    grams: int = blocking.Config.fallback_max_df
    rescue: int = 20_000


LIMITS = Limits()
CONFIG = blocking.Config(top_k=5, name_quota=0.3, sparse_quota=0.3, nonlatin_boost=1.0, weights=(("n", 1.0), ("a", 1.5)))
FIELDS = ("n", "a")
DEEP_K, CAP, THRESHOLD, DEEP_THRESHOLD = 9, 7, 0.6, 0.7
HALF = 200_000_000
GRID = [0.2, 0.4, 0.5, 0.6, 0.7, 0.8]


class View:
    """The view's tables, as plans."""

    def __init__(self, spark: SparkSession, sf_dir: str, limits: Limits = LIMITS):
        self.limits = limits
        self.config = replace(CONFIG, max_df=limits.max_df, rerank_depth=limits.rerank_depth)
        self.records = src.demo_records(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    @property
    def s1(self) -> DataFrame:
        return self.records.where("source = 1").select(F.col("entity_id").alias("s1_id"), "country", F.col("source_row").alias("s1_row"))

    @property
    def truth(self) -> DataFrame:
        """Pairs with equal texts; a candidate belongs to the smallest S1 of its text."""
        one = self.records.where("source = 1").groupBy("twin").agg(F.min("entity_id").alias("s1_id"))
        return self.records.where("source <> 1").select("twin", F.col("entity_id").alias("cand_id")).join(one, "twin").select("s1_id", "cand_id")

    def tokens(self, fields: tuple[str, ...] = FIELDS) -> DataFrame:
        return stats.record_tokens(self.records, fields)

    @property
    def idf(self) -> DataFrame:
        return stats.idf(stats.doc_freq(self.tokens()), stats.country_counts(self.records))

    @property
    def weighted(self) -> DataFrame:
        return blocking._weighted(self.idf, CONFIG)

    @property
    def flags(self) -> DataFrame:
        return self.records.select("entity_id", t.record_flags(F.col("business_name"), F.col("business_address")).alias("flags"))

    @cached_property
    def listed(self) -> DataFrame:
        """The tokens of the records, worked out once: counts and scores both read them."""
        return settle_pressed(stats.token_texts(self.records, FIELDS))

    @cached_property
    def weights(self) -> DataFrame:
        """Weights of the tokens, with the sides that have them."""
        df = stats.token_freq(self.listed, FIELDS)
        return blocking._weighted(stats.idf(df, stats.country_counts(self.records)), CONFIG)

    def score(self, **options) -> DataFrame:
        return scoring.score(self.listed, self.weights, FIELDS, max_df=self.limits.max_df, **options)

    @property
    def pool(self) -> DataFrame:
        """All pairs that share a token: for queries that return or read every one. The others ask for less."""
        return self.score()

    @property
    def pool_size(self) -> DataFrame:
        return self.score(count=True)

    def with_sparse(self, pairs: DataFrame) -> DataFrame:
        return pairs.join(self.flags.select(F.col("entity_id").alias("cand_id"), (F.col("flags") != 0).alias("sparse")), "cand_id")

    @cached_property
    def deepest(self) -> DataFrame:
        """The run at its greatest depth, computed once: every run is its head."""
        return settle(blocking.top_n(self.score(keep={"combined": DEEP_K}), DEEP_K))

    def run(self, k: int) -> DataFrame:
        if k > DEEP_K:
            raise ValueError(f"the view's runs are {DEEP_K} deep")
        return self.deepest.where(F.col("rank") <= k)

    def scored(self, k: int) -> DataFrame:
        return self.run(k).withColumn("prob", F.floor(100 * F.col("combined") / (F.col("combined") + HALF)) / 100.0)

    @property
    def labelled(self) -> DataFrame:
        return matching.label(self.scored(CONFIG.top_k), self.truth)

    @property
    def hybrid(self) -> DataFrame:
        rows = decide.hybrid_candidates(self.run(CONFIG.top_k), self.run(DEEP_K), CAP)
        return rows.join(self.scored(DEEP_K).select("s1_id", "cand_id", "prob"), ["s1_id", "cand_id"])

    @property
    def texts(self) -> DataFrame:
        """Pairs of the run with both sides' texts."""
        side = lambda mark, key: self.records.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{mark}_name"), F.col("business_address").alias(f"{mark}_address"))
        return self.run(CONFIG.top_k).select("s1_id", "cand_id").join(side("a", "s1_id"), "s1_id").join(side("b", "cand_id"), "cand_id")


def _accepted(v: View) -> DataFrame:
    return decide.base_predictions(v.scored(CONFIG.top_k), THRESHOLD)


def _words(c: str):
    return F.filter(F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", " ")), " "), lambda x: x != "")


def _rarity(v: View) -> DataFrame:
    rec = v.records.select("entity_id", "country", t.core_words("business_name").alias("core"))
    side = lambda mark, key: rec.select(F.col("entity_id").alias(key), *([F.col("country")] if mark == "a" else []), F.col("core").alias(f"{mark}_core"))
    pairs = v.run(CONFIG.top_k).select("s1_id", "cand_id").join(side("a", "s1_id"), "s1_id").join(side("b", "cand_id"), "cand_id")
    out = features.rarity_features(pairs, stats.name_stats(v.records))
    return out.select("s1_id", "cand_id", *[F.round(c, 6).alias(c) for c in ("s1_core_freq", "cand_core_freq", "core_idf_jacc", "core_rarest_shared_idf")])


def _numbers(v: View) -> DataFrame:
    pairs = v.texts
    for m in "ab":
        pairs = pairs.withColumn(f"{m}_w", t.plain_numbers(t.fold_words(f"{m}_address")))
    digits, rest = (lambda c: F.filter(c, lambda w: w.rlike(r"^\d+$"))), (lambda c: F.filter(c, lambda w: ~w.rlike(r"^\d+$")))
    made = features.number_features(digits("a_w"), digits("b_w"), rest("a_w"), rest("b_w"))
    return pairs.select("s1_id", "cand_id", *[made[k].alias(k) for k in ("num_shared_n", "num_only_s1_n", "num_only_cand_n", "num_prefix")], F.round(made["addr_word_jacc"], 6).alias("addr_word_jacc"))


def _features(v: View, groups: tuple[str, ...] = features.GROUPS) -> DataFrame:
    return matching.featurized(v.run(CONFIG.top_k), v.records, matching.text_models(v.records), groups)


def _oof(v: View) -> DataFrame:
    names = [f for f in features.feature_names(()) if f != "label"]
    rows = settle(matching.label(_features(v, ()), v.truth))
    return learn.out_of_fold(learn.folds(rows, 2), names, 2, trees=5, depth=3).select("s1_id", "cand_id", "label", "fold", F.round("prob", 4).alias("prob"))


def _validated(v: View) -> DataFrame:
    """Findings on lists with planted faults: every tenth S1 is missing, every seventh lists itself too."""
    lists = sinks.match_lines(v.s1, _accepted(v)).where("s1_row % 10 <> 0").select("s1_id", F.when(F.col("s1_row") % 7 == 0, F.array("s1_id", "s1_id")).otherwise(src.id_list(F.col("ids"))).alias("ids"))
    return sinks.check_lists(lists, v.s1.select("s1_id"))


def _final(v: View) -> DataFrame:
    return decide.merge_deep(_accepted(v), v.hybrid.where(f"origin = 1 and prob >= {DEEP_THRESHOLD}"))


def _judged(v: View) -> DataFrame:
    return evaluation.judged(v.labelled.withColumnRenamed("prob", "score"), _accepted(v))


def _compared(v: View) -> DataFrame:
    run = lambda k: (matching.label(v.scored(k), v.truth), decide.base_predictions(v.scored(k), THRESHOLD))
    return evaluation.compare_runs(v.s1, v.truth, {"base": run(CONFIG.top_k), "deep": run(DEEP_K)})


def _categories(v: View) -> DataFrame:
    rows = evaluation.categorised(v.labelled, v.truth, v.records)
    return metrics.breakdown(rows, evaluation.pair_categories(rows, v.truth, v.records), ["prob"])


def _missed(v: View) -> DataFrame:
    side = lambda mark, key: v.records.select(F.col("entity_id").alias(key), t.house_number(F.col("business_address")).alias(f"{mark}_no"), F.length("business_name").cast("double").alias(f"{mark}_len"))
    facts = v.truth.join(side("a", "s1_id"), "s1_id").join(side("b", "cand_id"), "cand_id").withColumn("name_len", F.col("a_len"))
    return evaluation.missed_shares(v.truth, v.run(1), {"numbered": F.col("a_no") != "", "S2": F.col("cand_id").startswith("S2-")}, facts, "name_len")


def _sample(v: View) -> tuple[DataFrame, DataFrame]:
    return evaluation.sampled(v.s1.where("s1_row % 4 = 0"), v.truth, v.records)


QUERIES: dict[str, Callable[[View], DataFrame]] = {
    "candidate_owner": lambda v: evaluation.owners(v.run(CONFIG.top_k), v.truth).select("s1_id", "cand_id", "owner", "whose"),
    "run_comparison": _compared,
    "hybrid_report": lambda v: evaluation.hybrid_report(v.s1, v.hybrid, _accepted(v), _final(v), v.truth, v.records.where(t.has_nonlatin(F.col("business_name"))).select(F.col("entity_id").alias("cand_id"))),
    "deep_evaluation": lambda v: evaluation.deep_evaluation(v.s1, _accepted(v), _final(v), v.truth),
    "oracle_ladder": lambda v: evaluation.oracle_ladder(v.s1, _judged(v), v.run(DEEP_K), v.truth),
    "error_attribution": lambda v: evaluation.attribute_errors(_judged(v), v.truth, 0.3).where("fault is not null").groupBy("fault").agg(F.count(F.lit(1)).alias("n")),
    "error_categories": _categories,
    "gate_metrics": lambda v: evaluation.gate_metrics(v.s1, _accepted(v), v.truth, v.s1.where("s1_row % 5 = 0")),
    "fold_thresholds": lambda v: evaluation.fold_thresholds(v.s1, decide.exclusive(v.scored(CONFIG.top_k)), v.truth, (F.floor(F.col("s1_row") / 3) % 3).cast("int"), 3, GRID),
    "hard_groups": lambda v: evaluation.hard_groups(v.labelled, THRESHOLD, {"all": F.lit(True), "S2": F.col("cand_id").startswith("S2-"), "behind": F.col("rank") > 1, "unnamed": F.col("name_score") == 0}),
    "missed_shares": _missed,
    "first_s1": lambda v: evaluation.first_s1(v.s1, 500),
    "every_kth": lambda v: evaluation.every_kth(v.records, 7).select("entity_id"),
    "development_truth": lambda v: _sample(v)[0],
    "sample_records": lambda v: _sample(v)[1].select("entity_id", "country"),
    "value_counts": lambda v: evaluation.value_counts(v.records, ["business_name", "business_address", "country", "source"]),
    "mark_counts": lambda v: evaluation.mark_counts(v.records, ["business_name", "business_address"]),
    "holdout_overlap": lambda v: evaluation.overlap_proof(stats.holdout(v.records.where("source = 1"), 0.5, "holdout-v1", [t.stable_hash(F.col("entity_id"), "dev-v1") < 0.3]).select("entity_id"), v.records.where(t.stable_hash(F.col("entity_id"), "dev-v1") < 0.3).select("entity_id")),
    "score_extremes": lambda v: metrics.extremes(v.labelled.withColumnRenamed("prob", "score")).select("s1_id", "cand_id", "max_false", "min_true"),
    "scan_records": lambda v: v.records.drop("twin"),
    "country_counts": lambda v: stats.country_counts(v.records),
    "source_profile": lambda v: stats.source_profile(v.records),
    "tokens_name": lambda v: v.tokens(("n",)).select("entity_id", "token"),
    "tokens_address": lambda v: v.tokens(("a",)).select("entity_id", "token"),
    "bigrams": lambda v: v.records.select("entity_id", t.sorted_pairs(t.name_tokens(F.col("business_name"))).alias("p")).select("entity_id", F.explode("p").alias("pair")),
    "trigrams": lambda v: v.records.select("entity_id", t.trigrams(F.col("business_name")).alias("g")).select("entity_id", F.explode("g").alias("gram")),
    "house_number": lambda v: v.records.select("entity_id", t.house_number(F.col("business_address")).alias("house_number")),
    "record_flags": lambda v: v.flags,
    "nonascii_share": lambda v: v.records.select("entity_id", F.round(t.nonascii_share(F.col("business_name")), 9).alias("nonascii_share")),
    "sample_hash": lambda v: v.records.select("entity_id", t.stable_hash(F.col("entity_id"), "sample-v1").alias("fraction")),
    "holdout_select": lambda v: stats.holdout(v.records.where("source = 1"), 0.5, "holdout-v1", [t.stable_hash(F.col("entity_id"), "dev-v1") < 0.3]).select("entity_id"),
    "doc_freq": lambda v: stats.doc_freq(v.tokens()),
    "idf": lambda v: v.idf,
    "rarest_tokens": lambda v: stats.rarest_tokens(v.tokens(), stats.doc_freq(v.tokens(), 2), 2).select("entity_id", "field", "token", "df", "pos"),
    "block_pool": lambda v: v.pool_size,
    "block_score": lambda v: v.pool,
    "block_top_k": lambda v: v.run(CONFIG.top_k),
    "block_quota_top_k": lambda v: blocking.quota_top_k(v.with_sparse(v.score(**blocking.quota_views(CONFIG, v.flags))), CONFIG.top_k, CONFIG.name_quota, CONFIG.sparse_quota),
    "rerank_exact": lambda v: blocking.reranked(blocking.shortlist(v.with_sparse(v.score(common=True, **blocking.shortlist_views(v.config, v.flags))), v.config)),
    "candidate_run": lambda v: matching.candidate_run(v.records, blocking.Config()),
    "trigram_fallback": lambda v: blocking.with_fallback(v.pool, v.s1, v.tokens(("g",)), stats.idf(stats.doc_freq(v.tokens(("g",))), stats.country_counts(v.records)), 3, v.limits.grams, 0.5),
    "rarest_key_block": lambda v: blocking.rarest_key_block(v.tokens(), stats.doc_freq(v.tokens()), v.idf, {"n": 2, "a": 2}, v.limits.keys, v.limits.last_key),
    "coverage": lambda v: blocking.coverage(v.score(own=True)),
    "three_views": lambda v: blocking.three_views(v.score(keep={"combined": 3, "name_score": 3, "address": 3}, last=True), 3),
    "standin_block": lambda v: blocking.standin_block(*[v.records.where(w).select(F.col("entity_id").alias("id"), "country", F.explode(F.array_distinct(_words("business_name"))).alias("token")) for w in ("source = 1", "source <> 1")], 3, v.limits.standin),
    "rescue_channel": lambda v: blocking.channel_candidates(v.tokens(("a",)), v.idf, v.run(2), "a", 3, v.limits.rescue),
    "label_pairs": lambda v: v.labelled.select("s1_id", "cand_id", "label"),
    "truth_summary": lambda v: stats.truth_summary(v.s1, v.truth),
    "match_histogram": lambda v: stats.match_histogram(v.s1, v.truth),
    "token_changes": lambda v: stats.token_changes(v.texts.select(_words("a_name").alias("s1_tokens"), _words("b_name").alias("cand_tokens"))),
    "pair_recall_by_group": lambda v: metrics.recall_by_group(v.truth.join(v.s1.select("s1_id", "country"), "s1_id"), v.run(CONFIG.top_k), {"country": F.col("country"), "source": F.substring("cand_id", 1, 2)}),
    "jaccard_pairs": lambda v: v.texts.select("s1_id", "cand_id", F.round(sim.jaccard(F.array_distinct(_words("a_name")), F.array_distinct(_words("b_name"))), 9).alias("jaccard")),
    "jaro_winkler_pairs": lambda v: v.texts.select("s1_id", "cand_id", F.round(sim.jaro_winkler_of("a_name", "b_name"), 6).alias("jaro_winkler")),
    "indel_ratio_pairs": lambda v: v.texts.select("s1_id", "cand_id", sim.ratio_of("a_name", "b_name").alias("ratio"), sim.token_sort_of("a_name", "b_name").alias("tsort"), sim.token_set_of("a_name", "b_name").alias("tset"), sim.partial_of("a_name", "b_name").alias("partial")),
    "num_features": _numbers,
    "name_rarity": _rarity,
    "pair_features": _features,
    "rank_gap": lambda v: features.rank_and_gap(v.run(CONFIG.top_k).drop("rank"), ["combined", "name_score"]),
    "top_two": lambda v: decide.top_two(v.scored(CONFIG.top_k), "prob"),
    "cross_gap": lambda v: decide.other_gap(v.scored(CONFIG.top_k), "prob", "gap").select("s1_id", "cand_id", F.round("gap", 6).alias("gap")),
    "exclusive_winner": lambda v: decide.exclusive(v.scored(CONFIG.top_k)).select("s1_id", "cand_id", "prob"),
    "hybrid_candidates": lambda v: decide.hybrid_candidates(v.run(CONFIG.top_k), v.run(DEEP_K), CAP).na.fill(0, ["base_rank", "deep_rank"]),
    "merge_deep": lambda v: decide.merge_deep(_accepted(v), v.hybrid.where(f"origin = 1 and prob >= {DEEP_THRESHOLD}")),
    "meta_context": lambda v: decide.meta_context(v.hybrid, ("hybrid_rank",)).select("s1_id", "cand_id", "s1_top1", "s1_top2", "s1_top3", *[F.col(f"`s1_n_above_{x}`").alias(f"above_{int(100 * x)}") for x in decide.LEVELS], F.round("s1_prob_sum", 6).alias("prob_sum"), "s1_base_top1", "s1_deep_top1", "s1_n_cands", "prob_pos_in_s1", F.round("gap12", 6).alias("gap12")),
    "meta_decide": lambda v: decide.meta_decide(v.hybrid.withColumnRenamed("prob", "score"), THRESHOLD, DEEP_THRESHOLD).select("s1_id", "cand_id", "origin", "score"),
    "claimants": lambda v: decide.claimants(v.scored(CONFIG.top_k), "prob").select("s1_id", "cand_id", "n_claimants", F.round("best_other", 6).alias("best_other")),
    "s1_aggregates": lambda v: decide.s1_aggregates(v.scored(CONFIG.top_k)).select("s1_id", "top1", "top2", "top3", "n", F.round("prob_sum", 6).alias("prob_sum"), *[F.col(f"`n_above_{x}`").alias(f"above_{int(100 * x)}") for x in decide.LEVELS]),
    "macro_f05": lambda v: metrics.macro_f05(v.s1, _accepted(v), v.truth),
    "threshold_grid": lambda v: metrics.threshold_grid(v.s1, decide.exclusive(v.scored(CONFIG.top_k)), v.truth, GRID),
    "blocking_metrics": lambda v: metrics.blocking_metrics(v.s1, v.run(CONFIG.top_k), v.truth),
    "overlap_runs": lambda v: metrics.overlap(v.run(CONFIG.top_k), v.run(DEEP_K), v.truth, v.s1),
    "pool_summary": lambda v: metrics.summary(v.pool_size, "pool"),
    "error_classes": lambda v: metrics.error_classes(v.labelled, THRESHOLD).groupBy("error").agg(F.count(F.lit(1)).alias("n")),
    "missed_pairs": lambda v: metrics.missed_pairs(v.truth, v.run(CONFIG.top_k)),
    "error_breakdown": lambda v: metrics.breakdown(v.labelled, {"S2": F.col("cand_id").startswith("S2-"), "S3": F.col("cand_id").startswith("S3-"), "first": F.col("rank") == 1, "named": F.col("name_score") > 0}, ["prob", "rank"]),
    "error_patterns": lambda v: metrics.patterns(v.labelled, {"S2": F.col("cand_id").startswith("S2-"), "first": F.col("rank") == 1, "named": F.col("name_score") > 0, "likely": F.col("prob") >= 0.5}),
    "rank_buckets": lambda v: v.run(DEEP_K).groupBy(metrics.rank_bucket(F.col("rank")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")),
    "oracle_prefix": lambda v: metrics.oracle_prefix(v.s1, v.labelled.withColumnRenamed("prob", "score"), v.truth),
    "auc": lambda v: metrics.auc(v.labelled.withColumnRenamed("prob", "score")),
    "paired_delta": lambda v: metrics.paired_delta(metrics.per_s1(v.s1, _accepted(v), v.truth), metrics.per_s1(v.s1, decide.base_predictions(v.scored(CONFIG.top_k), 0.75), v.truth), v.s1),
    "true_by_accepted": lambda v: metrics.true_by_accepted(v.s1, _accepted(v), v.truth),
    "match_output": lambda v: sinks.match_lines(v.s1, _accepted(v)),
    "candidate_output": lambda v: sinks.candidate_lines(v.s1, v.run(CONFIG.top_k)),
    "validator_findings": _validated,
    "pair_patterns": lambda v: analysis.pattern_rates(analysis.with_texts(v.run(CONFIG.top_k).select("s1_id", "cand_id"), v.records)),
    "pair_traits": lambda v: analysis.pair_traits(analysis.with_texts(v.run(CONFIG.top_k).select("s1_id", "cand_id"), v.records)),
    "blocking_losses": lambda v: analysis.blocking_losses(v.truth, blocking.sharing(v.truth, v.listed, v.weights.where(F.col("df") <= v.limits.max_df)), v.run(1)).groupBy("fate").agg(F.count(F.lit(1)).alias("n")),
    "adaptive_thresholds": lambda v: analysis.adaptive(v.hybrid.withColumn("rank", F.coalesce("base_rank", "deep_rank")), "first", (0.5, 0.65, 0.7)).select("s1_id", "cand_id", "origin", "prob"),
    "count_capped": lambda v: analysis.capped(decide.exclusive(v.scored(CONFIG.top_k)).where("prob >= 0.5"), v.s1.select("s1_id", (F.col("s1_row") % 5).alias("n"))).select("s1_id", "cand_id", "prob"),
    "count_filled": lambda v: analysis.filled(decide.meta_decide(v.hybrid, THRESHOLD, DEEP_THRESHOLD, "prob"), v.hybrid, v.s1.select("s1_id", (F.col("s1_row") % 5).alias("n"))).select("s1_id", "cand_id", "origin", "prob"),
    "competition": lambda v: analysis.competition(v.labelled, THRESHOLD),
    "ensemble": lambda v: decide.ensemble(v.scored(CONFIG.top_k).select("s1_id", "cand_id", "prob", (F.col("rank") / 10).alias("p2"), F.lit(0.4).alias("p3")), ["prob", "p2", "p3"]).select("s1_id", "cand_id", F.round("ens_mean", 6).alias("ens_mean"), F.round("ens_median", 6).alias("ens_median"), F.round("ens_logit", 6).alias("ens_logit")),
    "deep_rules": lambda v: decide.deep_evidence(v.hybrid.where("origin = 1")).select("s1_id", "cand_id", F.round("deep_second_prob", 6).alias("second"), "deep_is_best"),
    "set_decode": lambda v: learn.set_decode(v.scored(CONFIG.top_k).select("s1_id", "cand_id", "prob")),
    "matcher_oof": _oof,
    "transliterate": lambda v: v.records.select("entity_id", t.latin_text("business_name").alias("latin")),
    "phonetic": lambda v: v.records.select("entity_id", F.array_join(t.phonetic_keys("business_name"), " ").alias("keys")),
    "token_alignment": lambda v: v.texts.select("s1_id", "cand_id", sim.alignment_of("a_name", "b_name", "a_address", "b_address").alias("dt")).select("s1_id", "cand_id", *[F.col("dt")[k].alias(n) for k, n in enumerate(sim.ALIGNMENT)]),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, q=q: q(View(spark, sf_dir))) for name, q in QUERIES.items()}
