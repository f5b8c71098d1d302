"""Analyses of pairs and decisions: pattern rates, traits of missed pairs, losses of blocking, adaptive thresholds, count decoding, competition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import similarity as sim
from ..functions import text as t
from .decide import claimants, stage_winners


def with_texts(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` (s1_id, cand_id) with name, address and tokens of both records, as a_ and b_ columns."""
    rec = records.select("entity_id", "country", F.coalesce("business_name", F.lit("")).alias("name"), F.coalesce("business_address", F.lit("")).alias("address"))
    rec = rec.withColumn("fold", t.fold_words("name")).withColumn("names", t.without(F.col("fold"), t.NAME_STOPWORDS)).withColumn("addr", F.array_distinct(t.without(t.fold_words("address"), t.ADDRESS_STOPWORDS))).withColumn("house", t.house_number(F.col("address")))
    side = lambda mark, key: rec.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{mark}_{c}") for c in rec.columns if c != "entity_id"])
    return pairs.join(side("a", "s1_id"), "s1_id").join(side("b", "cand_id"), "cand_id")


def pair_flags() -> dict[str, Column]:
    """Boolean patterns of a pair, on the columns of ``with_texts``."""
    c = F.col
    shared, places = F.arrays_overlap("a_names", "b_names"), F.size(F.array_intersect("a_addr", "b_addr")) >= 2
    return {
        "same_country": c("a_country") == c("b_country"),
        "name_equal_raw": c("a_name") == c("b_name"),
        "name_equal_folded": c("a_fold") == c("b_fold"),
        "name_equal_without_stopwords": c("a_names") == c("b_names"),
        "share_name_token": shared,
        "first_name_token_equal": F.coalesce(F.get("a_names", F.lit(0)) == F.get("b_names", F.lit(0)), F.lit(False)),
        "cand_name_nonlatin": t.has_nonlatin(c("b_name")),
        "cand_name_domain": c("b_name").rlike(t.DOMAIN),
        "cand_name_alias": c("b_name").rlike(t.ALIAS),
        "cand_addr_empty": F.size("b_addr") == 0,
        "cand_addr_nonlatin": t.has_nonlatin(c("b_address")),
        "house_number_equal": (c("a_house") != "") & (c("a_house") == c("b_house")),
        "share_2plus_addr_tokens": places,
        "no_name_overlap_but_addr_overlap": ~shared & places,
    }


def pattern_rates(pairs: DataFrame) -> DataFrame:
    """(grp, pairs and a percentage for each flag): in all, by country of the S1, by source of the candidate."""
    flags = pair_flags()
    marked = pairs.select(F.explode(F.array(F.lit("all"), "a_country", F.substring("cand_id", 1, 2))).alias("grp"), *[f.alias(k) for k, f in flags.items()])
    return marked.groupBy("grp").agg(F.count(F.lit(1)).alias("pairs"), *[F.bround(100 * F.count_if(F.col(k)) / F.count(F.lit(1)), 6).alias(k) for k in flags])


def pair_traits(pairs: DataFrame) -> DataFrame:
    """Pairs with similarities and the flags that explain why blocking missed them."""
    c = F.col
    words = lambda m, f: t.norm_words(f"{m}_{f}")
    df = pairs
    for m in "ab":
        df = df.withColumn(f"{m}_nw", words(m, "name")).withColumn(f"{m}_aw", words(m, "address")).withColumn(f"{m}_keys", F.array_distinct(t.phonetic_keys(f"{m}_name"))).withColumn(f"{m}_latin", F.array_join(t.norm_words(t.latin_text(f"{m}_name")), " "))
    text = lambda m, f: F.array_join(f"{m}_{f}", " ")
    df = df.withColumn("name_tset", sim.token_set_of(text("a", "nw"), text("b", "nw"))).withColumn("addr_tsort", sim.token_sort_of(text("a", "aw"), text("b", "aw"))).withColumn("latin_tsort", sim.token_sort_of("a_latin", "b_latin"))
    df = df.withColumn("name_jacc", sim.jaccard(F.array_distinct("a_nw"), F.array_distinct("b_nw"))).withColumn("ph_jacc", sim.jaccard(c("a_keys"), c("b_keys")))
    df = df.withColumn("a_join", text("a", "nw")).withColumn("b_join", text("b", "nw"))
    gram = lambda m: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(f"{m}_join") - 2, F.lit(1))), lambda i: F.substring(F.col(f"{m}_join"), i, F.lit(3))))
    df = df.withColumn("name_tri_jacc", F.when((c("a_join") != "") & (c("b_join") != ""), sim.jaccard(gram("a"), gram("b"))).otherwise(0.0))
    number = lambda m: F.filter(f"{m}_aw", lambda w: w.rlike(r"^\d+$"))
    native = t.has_nonlatin(c("b_name"))
    flags = {
        "native_script": native,
        "transliterated": ~native & (c("name_jacc") < 0.34) & ((c("ph_jacc") >= 0.5) | (c("latin_tsort") >= 0.8)),
        "alias": (c("name_tset") < 0.5) & (c("ph_jacc") < 0.3) & (c("addr_tsort") >= 0.7),
        "missing_address": (c("a_address") == "") | (c("b_address") == ""),
        "short_name": F.size("a_nw") <= 1,
        "no_shared_token": c("name_jacc") == 0,
        "address_only": (c("name_jacc") == 0) & (c("addr_tsort") >= 0.6),
        "number_conflict": (F.size(number("a")) > 0) & (F.size(number("b")) > 0) & ~F.arrays_overlap(number("a"), number("b")),
        "trigrams_alike": c("name_tri_jacc") >= 0.5,
    }
    return df.select("s1_id", "cand_id", "name_tset", "addr_tsort", "latin_tsort", "name_jacc", "ph_jacc", "name_tri_jacc", *[f.alias(k) for k, f in flags.items()])


def blocking_losses(truth: DataFrame, pool: DataFrame, kept: DataFrame) -> DataFrame:
    """True pairs with their fate: kept, pruned (blocked, not kept) or not_blocked."""
    mark = lambda df, name: df.select("s1_id", "cand_id").distinct().withColumn(name, F.lit(1))
    out = truth.select("s1_id", "cand_id").distinct().join(mark(pool, "b"), ["s1_id", "cand_id"], "left").join(mark(kept, "k"), ["s1_id", "cand_id"], "left")
    return out.withColumn("fate", F.when(F.col("k") == 1, "kept").when(F.col("b") == 1, "pruned").otherwise("not_blocked")).drop("b", "k")


def adaptive(rows: DataFrame, variant: str, p: tuple[float, ...], score: str = "prob") -> DataFrame:
    """Stage winners accepted by thresholds that differ by rank or position: ``uniform`` (base, deep), ``rank`` (rank to 3,
    further, deep) or ``first`` (the S1's best base winner, further, deep). Base owns its candidates."""
    won = stage_winners(rows, score)
    if variant == "first":
        best = W.partitionBy("s1_id", "origin").orderBy(F.col(score).desc(), "cand_id")
        won = won.withColumn("lead", F.row_number().over(best) == 1)
        base = F.when(F.col("lead"), p[0]).otherwise(p[1])
    elif variant == "rank":
        base = F.when(F.col("rank") <= 3, p[0]).otherwise(p[1])
    elif variant == "uniform":
        base = F.lit(p[0])
    else:
        raise ValueError(f"unknown variant {variant}")
    ok = won.where(F.col(score) >= F.when(F.col("origin") == 0, base).otherwise(p[-1])).select(*rows.columns)
    first = ok.where("origin = 0")
    return first.unionByName(ok.where("origin = 1").join(first.select("cand_id").distinct(), "cand_id", "left_anti").select(*rows.columns))


def capped(accepted: DataFrame, counts: DataFrame, score: str = "prob", open_from: int = 4) -> DataFrame:
    """Accepted rows, at most as many for an S1 as ``counts`` (s1_id, n) predicts; ``open_from`` or more is no cap."""
    order = W.partitionBy("s1_id").orderBy(F.col(score).desc(), "cand_id")
    joined = accepted.join(counts, "s1_id").withColumn("r_", F.row_number().over(order))
    return joined.where((F.col("n") >= open_from) | (F.col("r_") <= F.col("n"))).drop("r_", "n")


def filled(accepted: DataFrame, rows: DataFrame, counts: DataFrame, floor: float = 0.5, score: str = "prob", open_from: int = 4) -> DataFrame:
    """``capped``, then the next best stage winners above ``floor`` up to the predicted count. Candidates stay with one owner; deep rows don't take what base had accepted."""
    keep = capped(accepted, counts, score, open_from)
    owned = accepted.where("origin = 0").select("cand_id").distinct()
    free = stage_winners(rows, score).where(F.col(score) >= floor).join(keep.select("cand_id").distinct(), "cand_id", "left_anti")
    free = free.where("origin = 0").unionByName(free.where("origin = 1").join(owned, "cand_id", "left_anti").select(*free.columns))
    used = keep.groupBy("s1_id").agg(F.count(F.lit(1)).alias("used"))
    left = counts.join(used, "s1_id", "left").select("s1_id", (F.when(F.col("n") >= open_from, 1 << 20).otherwise(F.col("n")) - F.coalesce("used", F.lit(0))).alias("room"))
    order = W.partitionBy("s1_id").orderBy(F.col(score).desc(), "cand_id")
    more = free.join(left, "s1_id").withColumn("r_", F.row_number().over(order)).where(F.col("r_") <= F.col("room"))
    more = more.withColumn("c_", F.row_number().over(W.partitionBy("cand_id").orderBy("origin", F.col(score).desc(), "s1_id"))).where("c_ = 1")
    return keep.select(*rows.columns).unionByName(more.select(*rows.columns))


def competition(rows: DataFrame, threshold: float, margins: tuple[float, ...] = (0.05, 0.1, 0.2), score: str = "prob") -> DataFrame:
    """(variant, accepted, tp): winners, all rows on their own, and winners ahead of the best competing claimant by a margin. ``rows`` has label."""
    marked = claimants(rows, score)
    best = W.partitionBy("cand_id").orderBy(F.col(score).desc(), "s1_id")
    above = marked.withColumn("won", F.row_number().over(best) == 1).where(F.col(score) >= threshold)
    alone = F.col("n_claimants") == 1
    kinds = {"exclusive": F.col("won"), "everyone": F.lit(True)} | {f"margin {m}": F.col("won") & (alone | (F.round("margin", 9) >= m)) for m in margins}
    flat = above.select("label", F.inline(F.array(*[F.struct(F.lit(k).alias("variant"), c.alias("in")) for k, c in kinds.items()]))).where("`in`")
    return flat.groupBy("variant").agg(F.count(F.lit(1)).alias("accepted"), F.sum("label").alias("tp"))
