import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkspan.operators import blocking, decide, features, learn, metrics


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_quota_rounds_half_to_even():
    assert blocking.half_even(50 * 0.15) == 8 and blocking.half_even(30 * 0.15) == 4


def test_top_n_keeps_ties_in_order(spark):
    df = frame(spark, [("s", f"c{c}", v) for v, c in zip([1, 3, 3, 2, 3], [10, 40, 20, 30, 50], strict=True)], "s1_id string, cand_id string, combined long")
    assert [r.cand_id for r in blocking.top_n(df, 2).orderBy("rank").collect()] == ["c20", "c40"]


def test_quota_top_k_against_a_plain_reading(spark):
    rng, rows = random.Random(3), []
    for s in range(25):
        for c in range(rng.randint(1, 15)):
            rows.append((f"s{s}", f"c{c:02d}", rng.randint(1, 5), rng.randint(0, 3), rng.random() < 0.3))
    got = blocking.quota_top_k(frame(spark, rows, "s1_id string, cand_id string, combined long, name_score long, sparse boolean"), 6, 0.3, 0.3).collect()
    for s in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == s]
        names = sorted([r for r in own if r[3] > 0], key=lambda r: (-r[3], r[1]))[:2]
        flagged = sorted([r for r in own if r[4] and r not in names], key=lambda r: (-r[2], r[1]))[:2]
        rest = sorted([r for r in own if r not in names + flagged], key=lambda r: (-r[2], r[1]))
        want = sorted((names + flagged + rest)[:6], key=lambda r: (-r[2], r[1]))
        assert [r.cand_id for r in sorted((g for g in got if g.s1_id == s), key=lambda g: g.rank)] == [r[1] for r in want]


def test_rerank_equals_all_token_weights(spark):
    toks = [("a", 1, "x", "n", w) for w in ("p", "q", "r")] + [("b", 2, "x", "n", w) for w in ("p", "q")] + [("c", 2, "x", "n", "r")]
    tokens = frame(spark, toks, "entity_id string, source int, country string, field string, token string")
    weights = frame(spark, [("x", "n", "p", 1, 10), ("x", "n", "q", 9, 4), ("x", "n", "r", 1, 7)], "country string, field string, token string, df long, weight_micro long")
    pool = blocking.block(tokens, weights.where("df <= 5")).withColumn("sparse", F.lit(False))
    got = {r.cand_id: r.combined for r in blocking.rerank(pool, tokens, weights.where("df > 5")).collect()}
    assert got == {"b": 14, "c": 7}


def test_exclusive_ties_and_permutations(spark):
    rows = [("S1-9", "x", 0.8, 0), ("S1-10", "x", 0.8, 1), ("S1-2", "y", 0.4, 2), ("S1-3", "y", 0.5, 3)]
    for _ in range(3):
        random.shuffle(rows)
        got = {r.cand_id: r.s1_id for r in decide.exclusive(frame(spark, rows, "s1_id string, cand_id string, prob double, row int")).collect()}
        assert got == {"x": "S1-10", "y": "S1-3"}  # strings compare as strings


def test_cross_gap(spark):
    rows = [("a", "x", 0.9), ("b", "x", 0.7), ("a", "y", 0.8), ("a", "z", 0.5), ("b", "z", 0.5)]
    got = {(r.s1_id, r.cand_id): round(r.g, 6) for r in decide.other_gap(frame(spark, rows, "s1_id string, cand_id string, s double"), "s", "g").collect()}
    assert got == {("a", "x"): 0.2, ("b", "x"): -0.2, ("a", "y"): 0.0, ("a", "z"): 0.0, ("b", "z"): 0.0}


def test_hybrid_never_cuts_base(spark):
    base = frame(spark, [("s", f"b{k}", k) for k in range(1, 5)], "s1_id string, cand_id string, rank int")
    deep = frame(spark, [("s", f"b{k}", 10 - k) for k in range(1, 5)] + [("s", f"d{k}", k) for k in range(1, 5)], "s1_id string, cand_id string, rank int")
    for cap, n in ((4, 4), (50, 8), (2, 4)):
        rows = decide.hybrid_candidates(base, deep, cap).orderBy("hybrid_rank").collect()
        assert len(rows) == n and [r.cand_id for r in rows[:4]] == ["b1", "b2", "b3", "b4"]


def test_thresholds_are_floats_and_inclusive(spark):
    pairs = frame(spark, [("s", "c", 0.85)], "s1_id string, cand_id string, prob float")
    assert decide.to_matches(pairs, 0.85, frame(spark, [("s",), ("t",)], "s1_id string")).where("size(matched) = 1").count() == 1


def test_meta_decide_prefers_base(spark):
    rows = [("a", "x", 0, 0.7), ("b", "x", 1, 0.99), ("b", "y", 1, 0.8), ("c", "y", 1, 0.8)]
    got = {(r.s1_id, r.cand_id) for r in decide.meta_decide(frame(spark, rows, "s1_id string, cand_id string, origin int, score double"), 0.6, 0.7).collect()}
    assert got == {("a", "x"), ("b", "y")}


def test_macro_f05(spark):
    s1 = frame(spark, [("a",), ("b",), ("c",)], "s1_id string")
    pred = frame(spark, [("a", "x"), ("a", "y"), ("a", "z"), ("c", "q")], "s1_id string, cand_id string")
    truth = frame(spark, [("a", "x"), ("a", "z")], "s1_id string, cand_id string")
    got = {r.s1_id: r.f05 for r in metrics.per_s1(s1, pred, truth).collect()}
    assert abs(got["a"] - 0.7142857) < 1e-6 and got["b"] == 1.0 and got["c"] == 0.0


def test_expected_f05_by_enumeration():
    p = np.array([0.9, 0.4, 0.2])
    want = np.zeros(4)
    for bits in range(8):
        on = [(bits >> i) & 1 for i in range(3)]
        chance = np.prod([x if o else 1 - x for x, o in zip(p, on, strict=True)])
        for k in range(4):
            tp, n = sum(on[:k]), sum(on)
            want[k] += chance * ((1.0 if n == 0 else 0.0) if k == 0 else 1.25 * tp / (0.25 * n + k))
    assert np.allclose(learn.expected_f05(p)[:4], want)


def test_coordinate_descent():
    best, value = learn.coordinate_descent(lambda x: -((x["a"] - 0.3) ** 2) - (x["b"] - 0.7) ** 2, {"a": 0.0, "b": 0.0}, [k / 10 for k in range(11)])
    assert best == {"a": 0.3, "b": 0.7} and value == 0


def test_feature_list():
    assert len(features.feature_names(())) == 47 and len(features.feature_names()) == 74
    assert len(learn.meta_features(features.feature_names())) == 90


def test_unknown_groups_raise(spark):
    with pytest.raises(ValueError, match="unknown"):
        features.build(None, None, {}, ("Z",))
    with pytest.raises(ValueError, match="statistics"):
        features.build(None, None, {}, ("E",))


def test_auc_and_summary(spark):
    rows = frame(spark, [(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "score double, label int")
    assert metrics.auc(rows).first().auc == 0.875
    got = metrics.summary(frame(spark, [(x,) for x in range(1, 21)], "x int"), "x").first()
    assert (got.mean, got.median, got.p95, got.max) == (10.5, 11, 20, 20)


def test_streams_equal_batch(spark, tmp_path):
    from linkspan.streaming import folds

    rng = random.Random(5)
    rows = [(f"c{rng.randint(0, 9)}", f"s{rng.randint(0, 20):02d}", round(rng.random(), 1)) for _ in range(80)]
    df = frame(spark, rows, "cand_id string, s1_id string, prob double")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = folds.winner_stream(stream).writeStream.outputMode("update").format("memory").queryName("won").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    last = {}
    for r in spark.table("won").collect():
        last[r.cand_id] = folds.fold_winner(last.get(r.cand_id), [(r.prob, r.s1_id)])
    want = {}
    for c, s, p in rows:
        want[c] = folds.fold_winner(want.get(c), [(p, s)])
    assert last == want
    assert folds.fold_top_two((None, None), [0.2, 0.5, 0.5]) == (0.5, 0.5)


def test_auc_equals_all_pairs(spark):
    import random

    from linkspan.operators import metrics

    rng = random.Random(2)
    for n, digits in ((1, 1), (400, 1), (900, 6)):
        rows = [(round(rng.random() ** 3, digits), int(rng.random() < 0.3)) for _ in range(n)] + [(0.5, 1), (0.25, 0)]
        pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
        want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)
        for parts in (4, 256):
            got = metrics.auc(spark.createDataFrame(rows, "score double, label int"), parts).first().auc
            assert abs(got - want) < 1e-8
    assert metrics.auc(spark.createDataFrame([], "score double, label int")).first().auc is None


def test_bootstrap_interval_and_poisson_weights(spark):
    import math
    import random

    from linkspan.operators import metrics

    for m in (1.0, 4.0, 60.0, 500.0):
        draws = spark.range(20_000).select(metrics.poisson(F.lit(m), (F.xxhash64("id").bitwiseAND((1 << 53) - 1) + 0.5) / float(1 << 53)).alias("w"))
        got = draws.agg(F.avg("w").alias("mean"), F.variance("w").alias("var"), F.avg((F.col("w") == 0).cast("double")).alias("none")).first()
        assert abs(got.mean / m - 1) < 0.03 and abs(got["var"] / m - 1) < 0.05 and abs(got.none - math.exp(-m)) < 0.02
    rng = random.Random(1)
    values = [rng.gauss(1, 2) for _ in range(200)]
    mean, sd = sum(values) / 200, (sum((x - sum(values) / 200) ** 2 for x in values) / 200) ** 0.5
    got = metrics.bootstrap(spark.createDataFrame([(x,) for x in values], "d double"), n=1000).first()
    half = 1.96 * sd / 200**0.5
    assert abs(got.low - (mean - half)) < 0.15 * half and abs(got.high - (mean + half)) < 0.15 * half


def test_cache_is_adopted_only_with_equal_keys_and_columns(spark):
    from linkspan.operators import evaluation

    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "s1_id string, cand_id string, n int")
    assert evaluation.adopts(rows, rows.withColumn("n", F.lit(0)))
    assert not evaluation.adopts(rows, rows.where("n = 1")) and not evaluation.adopts(rows, rows.unionByName(rows.limit(1))) and not evaluation.adopts(rows, rows.drop("n"))


def test_deep_rules_conditions(spark):
    from linkspan.operators import decide

    names = ["prob", "num_best_ratio", "name_tsort", "ph_jacc", "cand_addr_missing", "addr_word_jacc", "deep_is_best", "deep_second_prob"]
    rows = [("all", 0.9, 0.9, 0.9, 0.0, 0, 0.5, True, 0.1), ("conflict", 0.9, 0.3, 0.1, 0.1, 0, 0.1, False, 0.8), ("unlikely", 0.5, 0.9, 0.9, 0.9, 1, 1.0, True, 0.0)]
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"{c} {'boolean' if c == 'deep_is_best' else 'double' if c != 'cand_addr_missing' else 'int'}" for c in names))
    got = {r.id: "".join(k for k in "ABCDE" if r[k]) for r in df.select("id", *[c.alias(k) for k, c in decide.deep_rules(0.85).items()]).collect()}
    assert got == {"all": "ABCDE", "conflict": "A", "unlikely": ""}
