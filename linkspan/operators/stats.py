"""Counts over records and tokens: document frequencies, inverse frequencies, rarest tokens, name statistics, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as t

#: Stands between the tokens of a text of tokens; no token holds it, as tokens are of letters, digits, marks and spaces.
SEPARATOR = "\x1e"


def record_tokens(records: DataFrame, fields: tuple[str, ...] = ("n", "p", "pb", "a", "ab")) -> DataFrame:
    """(entity_id, source, source_row, country, field, token): each token of a record's field once."""
    made = t.record_features(F.col("business_name"), F.col("business_address"))
    # Arrays first, generators above: nothing but the generator is worked out for each token.
    wide = records.select("entity_id", "source", "source_row", "country", *[made[f].alias(f"f_{f}") for f in fields])
    named = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f_{f}").alias("tokens")) for f in fields])
    long = wide.select("entity_id", "source", "source_row", "country", F.inline(named))
    return long.select("entity_id", "source", "source_row", "country", "field", F.explode("tokens").alias("token"))


def token_texts(records: DataFrame, fields: tuple[str, ...], flags: bool = False) -> DataFrame:
    """(entity_id, source, country, t_<field>): a record's distinct tokens of each field as one text, a row for each record. With
    its flags, if asked."""
    made = t.record_features(F.col("business_name"), F.col("business_address"))
    marks = [t.record_flags(F.col("business_name"), F.col("business_address")).alias("flags")] if flags else []
    return records.select("entity_id", "source", "country", *marks, *[F.array_join(made[f], SEPARATOR).alias(f"t_{f}") for f in fields])


def listed_tokens(listed: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(entity_id, source, country, field, token) of ``token_texts``."""
    named = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"t_{f}").alias("tokens")) for f in fields])
    long = listed.select("entity_id", "source", "country", F.inline(named)).where("tokens <> ''")
    return long.select("entity_id", "source", "country", "field", F.explode(F.split("tokens", SEPARATOR)).alias("token"))


def token_freq(listed: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``doc_freq`` of ``token_texts``, with the sides that have a token (in_s1, in_others)."""
    one = F.col("source") == 1
    return listed_tokens(listed, fields).groupBy("country", "field", "token").agg(F.count(F.lit(1)).alias("df"), F.max(one).alias("in_s1"), F.max(~one).alias("in_others"))


def country_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("country").agg(F.count(F.lit(1)).alias("n_records"))


def doc_freq(tokens: DataFrame, least: int = 1) -> DataFrame:
    """(country, field, token, df) over all sources; rarer than ``least`` left out."""
    return tokens.groupBy("country", "field", "token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least)


def micro(x: Column) -> Column:
    """A weight as a whole number of millionths, so sums don't depend on their order."""
    return F.round(x * 1_000_000).cast("bigint")


def idf(df: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_freq rows with idf_micro, ln((N + 1) / df)."""
    return df.join(counts, "country").withColumn("idf_micro", micro(F.log((F.col("n_records") + 1) / F.col("df")))).drop("n_records")


def rarest_tokens(tokens: DataFrame, df: DataFrame, m: int) -> DataFrame:
    """Each record's m rarest tokens of each field, ties to the smaller token. A token that isn't stored counts as df 1."""
    joined = tokens.join(df, ["country", "field", "token"], "left").withColumn("df", F.coalesce("df", F.lit(1)))
    order = W.partitionBy("entity_id", "field").orderBy("df", "token")
    return joined.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= m)


def name_stats(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Core-name counts of S1 and candidates (country, core, s1_count, cand_count), word frequencies (country, word, df), documents (country, n_docs)."""
    cores = records.select("country", (F.col("source") == 1).cast("int").alias("one"), t.core_words(F.coalesce("business_name", F.lit(""))).alias("words"))
    keyed = cores.select("country", "one", F.array_join("words", "\x1f").alias("core"))
    counts = keyed.groupBy("country", "core").agg(F.sum("one").alias("s1_count"), F.sum(1 - F.col("one")).alias("cand_count"))
    words = cores.select("country", F.explode("words").alias("word")).groupBy("country", "word").agg(F.count(F.lit(1)).alias("df"))
    return counts, words, cores.groupBy("country").agg(F.count(F.lit(1)).alias("n_docs"))


def source_profile(records: DataFrame) -> DataFrame:
    """One row for each source: counts of records with a trait, and the longest values."""
    name, address = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    letters = F.regexp_replace(name, r"[^\p{L}]", "")
    traits = {
        "empty_name": name == "",
        "empty_address": address == "",
        "empty_country": F.coalesce("country", F.lit("")) == "",
        "nonlatin_name": t.has_nonlatin(name),
        "nonlatin_address": t.has_nonlatin(address),
        "nonascii_name": name.rlike(r"[^\x00-\x7F]"),
        "name_with_digit": name.rlike(r"[0-9]"),
        "address_with_digit": address.rlike(r"[0-9]"),
        "domain_name": name.rlike(t.DOMAIN),
        "alias_name": name.rlike(t.ALIAS),
        "upper_name": (letters != "") & (F.upper(name) == name),
        "lower_name": (letters != "") & (F.lower(name) == name),
        "padded_name": F.trim(name) != name,
        "null_literal_name": name.isin(t.NULL_LITERALS),
        "null_literal_address": address.isin(t.NULL_LITERALS),
        "house_number": t.house_number(address) != "",
        **{f"name_{k}": name.contains(v) for k, v in t.PUNCTUATION.items()},
    }
    return records.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct("entity_id").alias("n_ids"),
        F.count_distinct("country").alias("n_countries"),
        *[F.count_if(c).alias(k) for k, c in traits.items()],
        F.max(F.length(name)).alias("max_name"),
        F.max(F.length(address)).alias("max_address"),
    )


def truth_summary(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: S1 records, singletons, links in all and by source, candidates linked to several S1."""
    per = s1.select("s1_id").join(truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("k")), "s1_id", "left").agg(F.count(F.lit(1)).alias("n_s1"), F.count_if(F.col("k").isNull()).alias("singletons"), F.max(F.coalesce("k", F.lit(0))).alias("most_matches"))
    links = truth.agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("cand_id").startswith("S2-")).alias("links_s2"), F.count_if(F.col("cand_id").startswith("S3-")).alias("links_s3"), F.count_distinct("cand_id").alias("linked"))
    shared = truth.groupBy("cand_id").agg(F.count_distinct("s1_id").alias("k")).agg(F.count_if(F.col("k") > 1).alias("several_s1"))
    one = lambda df: df.withColumn("one", F.lit(1))  # noqa: E731  three single rows side by side
    return one(per).join(one(links), "one").join(one(shared), "one").drop("one")


def match_histogram(s1: DataFrame, truth: DataFrame) -> DataFrame:
    per = s1.select("s1_id").join(truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("k")), "s1_id", "left")
    return per.groupBy(F.coalesce("k", F.lit(0)).alias("n_matches")).agg(F.count(F.lit(1)).alias("n_s1"))


def token_changes(pairs: DataFrame, k: int = 25) -> DataFrame:
    """(kind, token, n): the k tokens that candidates (cand_tokens) most often add to, or lack from, S1 names (s1_tokens)."""
    moved = F.array(F.struct(F.lit("added").alias("kind"), F.array_except("cand_tokens", "s1_tokens").alias("x")), F.struct(F.lit("removed").alias("kind"), F.array_except("s1_tokens", "cand_tokens").alias("x")))
    flat = pairs.select(F.inline(moved)).select("kind", F.explode("x").alias("token")).groupBy("kind", "token").agg(F.count(F.lit(1)).alias("n"))
    return flat.withColumn("r", F.row_number().over(W.partitionBy("kind").orderBy(F.col("n").desc(), "token"))).where(F.col("r") <= k).drop("r")


def in_sample(records: DataFrame, salt: str, rate: float, column: str = "entity_id") -> DataFrame:
    return records.where(t.stable_hash(F.col(column), salt) < rate)


def holdout(s1: DataFrame, rate: float, salt: str, earlier: list[Column]) -> DataFrame:
    """S1 rows of the hash sample that are in none of the earlier samples, given as conditions."""
    keep = t.stable_hash(F.col("entity_id"), salt) < rate
    for e in earlier:
        keep = keep & ~e
    return s1.where(keep)


def in_city(address: Column, country: Column, cities: dict[str, str]) -> Column:
    """Whether the address names one of the cities (name -> country) as a word."""
    out = F.lit(False)
    for city, of in cities.items():
        out = out | (F.lower(address).rlike(rf"\b{city}\b") & (country == of))
    return out


def compare_clean(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(check, n): rows that break a check, raw and clean matched by entity_id."""
    both = raw.join(clean.select("entity_id", *[F.col(c).alias(f"c_{c}") for c in clean.columns if c != "entity_id"]), "entity_id", "full")
    checks = {
        "missing_in_clean": F.col("c_business_name").isNull() & F.col("business_name").isNotNull(),
        "name_changed": F.col("business_name") != F.col("c_business_name"),
        "country_changed": F.col("country") != F.col("c_country"),
        "normalized_not_lower": F.lower("c_business_name_normalized") != F.col("c_business_name_normalized"),
        "normalized_not_trimmed": F.trim("c_business_name_normalized") != F.col("c_business_name_normalized"),
        "name_lost": (F.col("business_name") != "") & (F.col("c_business_name_normalized") == ""),
        "postal_not_in_address": (F.col("c_postal_code_normalized") != "") & ~F.regexp_replace("business_address", r"\s", "").contains(F.regexp_replace("c_postal_code_normalized", r"\s", "")),
    }
    return both.agg(*[F.count_if(c).alias(k) for k, c in checks.items()]).select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n")) for k in checks])))
