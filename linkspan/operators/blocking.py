"""Candidates by shared rare tokens: equi-joins on (country, field, token), summed weights, exact re-rank, quota Top-K.

The cap on document frequency is a filter on the token side before the join; it bounds the rows of the join by the sum
of df(S1) x df(candidate) and takes hot tokens out of its keys. Sums are of whole millionths, so they don't depend on
the order of rows and ties are ties."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import settle
from . import scoring, stats
from .stats import rarest_tokens


@dataclass(frozen=True)
class Config:
    """Weights by field, caps and quotas."""

    top_k: int = 100
    name_quota: float = 0.3
    sparse_quota: float = 0.15
    nonlatin_boost: float = 3.0
    max_df: int = 20_000
    rerank_depth: int = 500
    fallback_below: int = 0
    fallback_max_df: int = 2_000
    fallback_weight: float = 0.5
    weights: tuple[tuple[str, float], ...] = (("n", 1.0), ("p", 0.5), ("pb", 0.5), ("a", 1.5), ("ab", 1.0))

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(f for f, w in self.weights if w > 0)

    def key(self) -> dict:
        return asdict(self)


def half_even(x: float) -> int:
    """Quota slots: Python rounds halves to even, and so must every port."""
    return round(x)


def _weighted(idf: DataFrame, config: Config) -> DataFrame:
    weight = F.create_map(*[F.lit(x) for f, w in config.weights for x in (f, w)])
    return idf.where(F.col("field").isin(*config.fields)).withColumn("weight_micro", F.round(F.col("idf_micro") * weight[F.col("field")]).cast("bigint"))


def block(tokens: DataFrame, weighted: DataFrame, flags: DataFrame | None = None, boost: float = 1.0) -> DataFrame:
    """(s1_id, cand_id, combined, name_score): pairs of one country that share a token of ``weighted``. Phonetic fields
    of candidates flagged non-Latin count ``boost`` times."""
    heavy = tokens.join(weighted.select("country", "field", "token", "weight_micro"), ["country", "field", "token"])
    left = heavy.where("source = 1").select("country", "field", "token", F.col("entity_id").alias("s1_id"), "weight_micro")
    right = heavy.where("source <> 1").select("country", "field", "token", F.col("entity_id").alias("cand_id"))
    pairs = left.join(right, ["country", "field", "token"])
    weight = F.col("weight_micro")
    if flags is not None and boost != 1.0:
        pairs = pairs.join(flags.select(F.col("entity_id").alias("cand_id"), F.col("flags").bitwiseAND(1).alias("foreign")), "cand_id", "left")
        weight = F.when((F.col("foreign") == 1) & F.col("field").isin("p", "pb"), F.round(weight * boost).cast("bigint")).otherwise(weight)
    name = F.when(F.col("field").isin("n", "p", "pb", "g"), weight).otherwise(F.lit(0).cast("bigint"))
    return pairs.groupBy("s1_id", "cand_id").agg(F.sum(weight).alias("combined"), F.sum(name).alias("name_score"))


def sharing(pairs: DataFrame, listed: DataFrame, weighted: DataFrame) -> DataFrame:
    """The given pairs (s1_id, cand_id) of one country that share a token of ``weighted``: the pool's verdict on them, without the
    pool. ``listed`` is ``stats.token_texts``; a pair meets the S1's tokens and then the candidate's."""
    fields = tuple(c.removeprefix("t_") for c in listed.columns if c.startswith("t_"))
    known = pairs.select("s1_id", "cand_id").distinct()
    of = lambda key, side: stats.listed_tokens(listed.where(side).join(known.select(F.col(key).alias("entity_id")).distinct(), "entity_id", "left_semi"), fields).withColumnRenamed("entity_id", key).drop("source")
    mine = of("s1_id", F.col("source") == 1).join(weighted.select("country", "field", "token"), ["country", "field", "token"])
    return known.join(mine, "s1_id").join(of("cand_id", F.col("source") != 1), ["cand_id", "country", "field", "token"]).select("s1_id", "cand_id").distinct()


def pool_size(pool: DataFrame) -> DataFrame:
    return pool.groupBy("s1_id").agg(F.count(F.lit(1)).alias("pool"))


def top_n(scored: DataFrame, n: int, score: str = "combined", by: str = "s1_id", tie: str = "cand_id") -> DataFrame:
    """The n best rows of each group with their rank, ties to the smaller ``tie``."""
    order = W.partitionBy(by).orderBy(F.col(score).desc(), tie)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def quota_top_k(scored: DataFrame, k: int, name_quota: float, sparse_quota: float = 0.0, tie: str = "cand_id") -> DataFrame:
    """Slots for the best names, then for flagged candidates (column ``sparse``), then the best of the rest, k in all;
    rank by combined score. Slots are rounded half to even."""
    names, sparse = half_even(k * name_quota), half_even(k * sparse_quota) if sparse_quota > 0 else 0
    s1 = W.partitionBy("s1_id")
    first = lambda on, score: F.row_number().over(s1.orderBy(F.when(on, 0).otherwise(1), F.col(score).desc(), tie))
    named = F.col("name_score") > 0
    df = scored.withColumn("by_name", named & (first(named, "name_score") <= names))
    open_ = F.col("sparse") & ~F.col("by_name") if sparse else F.lit(False)
    df = df.withColumn("open", open_).withColumn("by_flag", F.col("open") & (first(F.col("open"), "combined") <= sparse))
    df = df.withColumn("picked", F.col("by_name") | F.col("by_flag"))
    df = df.withColumn("pos", first(F.col("picked"), "combined")).where(F.col("pos") <= k)
    df = df.withColumn("rank", F.row_number().over(s1.orderBy(F.col("combined").desc(), tie)))
    return df.drop("by_name", "open", "by_flag", "picked", "pos")


def slots(config: Config) -> tuple[int, int, int]:
    """Rows of an S1 in all, slots of the best names, slots of flagged candidates."""
    return config.top_k, half_even(config.top_k * config.name_quota), half_even(config.top_k * config.sparse_quota) if config.sparse_quota > 0 else 0


def quota_views(config: Config, flags: DataFrame) -> dict:
    """What ``scoring.score`` has to keep so that ``quota_top_k`` picks the same rows as from all pairs: flagged rows
    may lose as many places to names as names have slots."""
    k, names, sparse = slots(config)
    return {"flags": flags, "keep": {"combined": k, "name_score": names, "flagged": names + sparse if sparse else 0}}


def shortlist_views(config: Config, flags: DataFrame) -> dict:
    """What ``scoring.score`` has to keep so that ``shortlist`` finds the same rows as in all pairs."""
    return {"flags": flags, "keep": {"combined": config.rerank_depth, "name_score": config.rerank_depth, "flagged": 5 * max(1, half_even(config.top_k * config.sparse_quota))}}


def reranked(short: DataFrame) -> DataFrame:
    """The scores with the weights of common tokens, where ``scoring.score`` found both."""
    return short.select("s1_id", "cand_id", (F.col("combined") + F.col("more")).alias("combined"), (F.col("name_score") + F.col("more_name")).alias("name_score"), *[c for c in short.columns if c not in ("s1_id", "cand_id", "combined", "name_score", "more", "more_name")])


def shortlist(scored: DataFrame, config: Config, tie: str = "cand_id") -> DataFrame:
    """Rows that a re-rank looks at: the best by combined score, by name, and of the flagged."""
    s1 = W.partitionBy("s1_id")
    place = lambda on, score: F.row_number().over(s1.orderBy(F.when(on, 0).otherwise(1), F.col(score).desc(), tie))
    depth, flagged = config.rerank_depth, 5 * max(1, half_even(config.top_k * config.sparse_quota))
    named = F.col("name_score") > 0
    df = scored.withColumn("r1", place(F.lit(True), "combined")).withColumn("r2", place(named, "name_score")).withColumn("r3", place(F.col("sparse"), "combined"))
    return df.where((F.col("r1") <= depth) | (named & (F.col("r2") <= depth)) | (F.col("sparse") & (F.col("r3") <= flagged))).drop("r1", "r2", "r3")


def rerank(short: DataFrame, tokens: DataFrame, common: DataFrame, flags: DataFrame | None = None, boost: float = 1.0) -> DataFrame:
    """Adds the weights of shared tokens above the cap (``common``), for the pairs of ``short`` only: pairs meet the S1's
    common tokens first, then the candidate's, so no hot token is joined with itself."""
    heavy = tokens.join(common.select("country", "field", "token", "weight_micro"), ["country", "field", "token"])
    left = heavy.where("source = 1").select(F.col("entity_id").alias("s1_id"), "field", "token", "weight_micro")
    right = heavy.where("source <> 1").select(F.col("entity_id").alias("cand_id"), "field", "token")
    met = short.select("s1_id", "cand_id").join(left, "s1_id").join(right, ["cand_id", "field", "token"])
    weight = F.col("weight_micro")
    if flags is not None and boost != 1.0:
        met = met.join(flags.select(F.col("entity_id").alias("cand_id"), F.col("flags").bitwiseAND(1).alias("foreign")), "cand_id", "left")
        weight = F.when((F.col("foreign") == 1) & F.col("field").isin("p", "pb"), F.round(weight * boost).cast("bigint")).otherwise(weight)
    name = F.when(F.col("field").isin("n", "p", "pb"), weight).otherwise(F.lit(0).cast("bigint"))
    more = met.groupBy("s1_id", "cand_id").agg(F.sum(weight).alias("m1"), F.sum(name).alias("m2"))
    out = short.join(more, ["s1_id", "cand_id"], "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return out.select("s1_id", "cand_id", plus("combined", "m1"), plus("name_score", "m2"), *[c for c in short.columns if c not in ("s1_id", "cand_id", "combined", "name_score")])


def with_fallback(pool: DataFrame, s1: DataFrame, grams: DataFrame, idf: DataFrame, below: int, max_df: int, weight: float) -> DataFrame:
    """Adds pairs by trigrams (field g) for S1 records (s1_id) with fewer than ``below`` candidates; scores add up."""
    few = s1.select("s1_id").join(pool_size(pool), "s1_id", "left").where(F.coalesce("pool", F.lit(0)) < below).select("s1_id")
    g = grams.where("field = 'g'")
    narrow = g.where("source <> 1").unionByName(g.where("source = 1").join(few.withColumnRenamed("s1_id", "entity_id"), "entity_id", "left_semi").select(*g.columns))
    weighted = idf.where((F.col("field") == "g") & (F.col("df") <= max_df)).withColumn("weight_micro", F.round(F.col("idf_micro") * weight).cast("bigint"))
    more = block(narrow, weighted)
    return pool.unionByName(more).groupBy("s1_id", "cand_id").agg(F.sum("combined").alias("combined"), F.sum("name_score").alias("name_score"))


def candidates(records: DataFrame, listed: DataFrame, idf: DataFrame, flags: DataFrame, config: Config) -> DataFrame:
    """(s1_id, cand_id, combined, name_score, rank) of a split: blocking, fallback, re-rank and quota Top-K. ``listed`` is
    ``stats.token_texts``, settled."""
    weighted, score = _weighted(idf, config), {"boost": config.nonlatin_boost, "max_df": config.max_df}
    mark = lambda pool: pool.join(flags.select(F.col("entity_id").alias("cand_id"), (F.col("flags") != 0).alias("sparse")), "cand_id")
    exact = lambda of: reranked(shortlist(scoring.score(of, weighted, config.fields, common=True, sparse=True, quota=slots(config), **score, **shortlist_views(config, flags)), config))
    if config.fallback_below <= 0:
        found = exact(listed)
    else:
        size = scoring.score(listed, weighted, config.fields, max_df=config.max_df, count=True)
        s1 = records.where("source = 1").select(F.col("entity_id").alias("s1_id"))
        few = settle(s1.join(size, "s1_id", "left").where(F.coalesce("pool", F.lit(0)) < config.fallback_below).select(F.col("s1_id").alias("entity_id")))
        own = listed.where("source <> 1").unionByName(listed.where("source = 1").join(few, "entity_id", "left_semi").select(*listed.columns))
        tokens = stats.listed_tokens(own, tuple(dict.fromkeys([*config.fields, "g"])))
        pool = with_fallback(scoring.score(own, weighted, config.fields, flags=flags, **score), few.withColumnRenamed("entity_id", "s1_id"), tokens, idf, config.fallback_below, config.fallback_max_df, config.fallback_weight)
        fallen = rerank(shortlist(mark(pool), config), tokens, weighted.where(F.col("df") > config.max_df), flags, config.nonlatin_boost)
        found = exact(listed.join(few, "entity_id", "left_anti")).unionByName(fallen)
    return quota_top_k(found, config.top_k, config.name_quota, config.sparse_quota).drop("sparse")


def rarest_key_block(tokens: DataFrame, df: DataFrame, idf: DataFrame, keys: dict[str, int], cap: int = 20_000, fallback_cap: int = 50_000) -> DataFrame:
    """(s1_id, cand_id, combined): each S1 probes with its rarest tokens of each field (``keys``) of df up to ``cap``;
    an S1 without any takes its rarest token up to ``fallback_cap``. Scores sum the idf of all shared tokens."""
    s1 = tokens.where("source = 1")
    probe = rarest_tokens(s1.where(F.col("field").isin(*keys)), df, max(keys.values()))
    allowed = F.create_map(*[F.lit(x) for f, m in keys.items() for x in (f, m)])
    normal = probe.where((F.col("df") <= cap) & (F.col("pos") <= allowed[F.col("field")])).select("entity_id", "country", "field", "token")
    rest = probe.join(normal.select("entity_id").distinct(), "entity_id", "left_anti").where(F.col("df") <= fallback_cap)
    rest = rest.withColumn("r", F.row_number().over(W.partitionBy("entity_id").orderBy("df", "field", "token"))).where("r = 1").select("entity_id", "country", "field", "token")
    keyed = normal.unionByName(rest).withColumnRenamed("entity_id", "s1_id")
    others = tokens.where("source <> 1").select("country", "field", "token", F.col("entity_id").alias("cand_id"))
    pairs = keyed.join(others, ["country", "field", "token"]).select("s1_id", "cand_id").distinct()
    weight = idf.select("country", "field", "token", "idf_micro")
    mine = s1.select(F.col("entity_id").alias("s1_id"), "country", "field", "token").join(weight, ["country", "field", "token"]).drop("country")
    met = pairs.join(mine, "s1_id").join(others.drop("country"), ["cand_id", "field", "token"])
    return met.groupBy("s1_id", "cand_id").agg(F.sum("idf_micro").alias("combined"), F.sum(F.when(F.col("field") == "n", F.col("idf_micro")).otherwise(0)).alias("name_score"))


def coverage(pairs: DataFrame) -> DataFrame:
    """``pairs`` with coverage: the share of the S1's idf (``own``, of ``scoring.score``) that the pair has in common."""
    return pairs.withColumn("coverage", F.round(F.col("combined") / F.greatest(F.col("own"), F.lit(1)), 6)).drop("own")


def three_views(scored: DataFrame, capacity: int) -> DataFrame:
    """Rows that stand among the ``capacity`` best of their S1 by combined, name or address score; scores of zero never do. Ties to the larger id."""
    views = {"combined": F.col("combined"), "name": F.col("name_score"), "address": F.col("combined") - F.col("name_score")}
    place = lambda x: F.row_number().over(W.partitionBy("s1_id").orderBy(F.when(x > 0, 0).otherwise(1), x.desc(), F.col("cand_id").desc()))
    out = scored
    for name, x in views.items():
        out = out.withColumn(f"in_{name}", (x > 0) & (place(x) <= capacity))
    return out.where("in_combined or in_name or in_address")


def standin_block(queries: DataFrame, universe: DataFrame, k: int, max_df: int = 3000) -> DataFrame:
    """(s1_id, cand_id, score, rank) from (id, country, token) rows: idf is ln(universe / df) of a country's candidates."""
    size = universe.groupBy("country").agg(F.count_distinct("id").alias("n"))
    df = universe.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= max_df).join(size, "country")
    weight = df.select("country", "token", F.round(F.log(F.col("n") / F.col("df")) * 1_000_000).cast("bigint").alias("w"))
    pairs = queries.join(weight, ["country", "token"]).join(universe.withColumnRenamed("id", "cand_id"), ["country", "token"])
    return top_n(pairs.groupBy(F.col("id").alias("s1_id"), "cand_id").agg(F.sum("w").alias("score")), k, "score")


def channel_candidates(tokens: DataFrame, idf: DataFrame, listed: DataFrame, field: str, depth: int, max_df: int) -> DataFrame:
    """Rescue by one field: its best ``depth`` pairs that aren't listed (s1_id, cand_id) already."""
    weighted = idf.where((F.col("field") == field) & (F.col("df") <= max_df)).withColumn("weight_micro", F.col("idf_micro"))
    found = block(tokens.where(F.col("field") == field), weighted).join(listed.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")
    return top_n(found, depth)


def flag_of(name: str) -> Column:
    """A record flag as a condition on ``flags``."""
    return F.col("flags").bitwiseAND({"nonlatin": 1, "empty_address": 2}[name]) != 0
