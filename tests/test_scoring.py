"""Block scores against the join that makes a row for each shared token, and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from linkspan.operators import blocking, scoring, stats

FIELDS = ("n", "p", "a")


@pytest.fixture(scope="module")
def made(spark):
    """Records of three countries with frequent, rare and repeated words, empty ones, ids that look alike and a row that is there twice."""
    rng, rows = random.Random(8), []
    words = [f"w{k}" for k in range(60)]
    for k in range(300):
        text = {f: "\x1e".join(sorted({rng.choice(words[: rng.choice([6, 60])]) for _ in range(rng.randint(0, 9))})) for f in FIELDS}
        rows.append((f"é{k % 7}-{k}", 1 + k % 3, ["x", "y", None][min(k % 5, 2)], *text.values()))
    rows.append(rows[31])
    listed = spark.createDataFrame(rows, "entity_id string, source int, country string, t_n string, t_p string, t_a string")
    tokens = stats.listed_tokens(listed, FIELDS)
    weighted = stats.doc_freq(tokens).withColumn("weight_micro", F.pmod(F.xxhash64("field", "token"), F.lit(7)) * 1_000_001 + 3)
    flags = listed.select("entity_id", F.pmod(F.xxhash64("entity_id"), F.lit(4)).alias("flags")).distinct()
    return listed, tokens, weighted.localCheckpoint(), flags.localCheckpoint()


@pytest.fixture(params=[None, 7])
def blocks(request, monkeypatch):
    """The operator's own blocks, and small ones, so that many blocks meet."""
    if request.param:
        for name in ("S1_BLOCK", "CAND_BLOCK"):
            monkeypatch.setattr(scoring, name, request.param)
        monkeypatch.setattr(scoring, "CELLS", 20)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


PAIR = ("s1_id", "cand_id", "combined", "name_score")


def test_pool_equals_the_join(made, blocks):
    listed, tokens, weighted, flags = made
    want = blocking.block(tokens, weighted.where("df <= 20"), flags, 2.5)
    got = scoring.score(listed, weighted, FIELDS, flags=flags, boost=2.5, max_df=20)
    assert rows(got, *PAIR) == rows(want, *PAIR)
    assert rows(scoring.score(listed, weighted, FIELDS, max_df=20, count=True), "s1_id", "pool") == rows(blocking.pool_size(want), "s1_id", "pool")


@pytest.mark.parametrize("last", [False, True])
def test_the_best_of_blocks_hold_the_best_of_all(made, blocks, last):
    listed, tokens, weighted, flags = made
    pool = {}
    for s, c, x, y in rows(blocking.block(tokens, weighted), *PAIR):
        pool.setdefault(s, []).append((c, x, y))
    marks = {r.entity_id: r.flags for r in flags.collect()}
    got = set(rows(scoring.score(listed, weighted, FIELDS, flags=flags, keep={"combined": 3, "name_score": 2, "address": 2, "flagged": 2}, last=last), *PAIR))
    for s, own in pool.items():
        own.sort(reverse=last)
        for k, f in ((3, lambda c: c[1]), (2, lambda c: c[2]), (2, lambda c: c[1] - c[2]), (2, lambda c: c[1] if marks[c[0]] else 0)):
            for c in sorted([c for c in own if f(c) > 0], key=f, reverse=True)[:k] if not last else sorted([c for c in own if f(c) > 0], key=lambda c: (f(c), c[0]), reverse=True)[:k]:
                assert (s, *c) in got


def test_common_tokens_are_added_for_what_is_kept(made, blocks):
    listed, tokens, weighted, flags = made
    short = blocking.shortlist(blocking.block(tokens, weighted.where("df <= 20"), flags, 2.5).join(flags.select(F.col("entity_id").alias("cand_id"), (F.col("flags") != 0).alias("sparse")), "cand_id"), blocking.Config(rerank_depth=2))
    want = blocking.rerank(short, tokens, weighted.where("df > 20"), flags, 2.5)
    views = blocking.shortlist_views(blocking.Config(rerank_depth=2), flags)
    found = scoring.score(listed, weighted, FIELDS, boost=2.5, max_df=20, common=True, **views)
    marked = found.join(flags.select(F.col("entity_id").alias("cand_id"), (F.col("flags") != 0).alias("sparse")), "cand_id")
    assert rows(blocking.reranked(blocking.shortlist(marked, blocking.Config(rerank_depth=2))), *PAIR) == rows(want, *PAIR)


def test_pairs_that_share_a_token(made):
    listed, tokens, weighted, _ = made
    every = tokens.where("source = 1").select(F.col("entity_id").alias("s1_id")).distinct().crossJoin(tokens.where("source <> 1").select(F.col("entity_id").alias("cand_id")).distinct())
    assert rows(blocking.sharing(every, listed, weighted.where("df <= 20")), "s1_id", "cand_id") == rows(blocking.block(tokens, weighted.where("df <= 20")), "s1_id", "cand_id")


def test_runs_make_no_row_for_each_shared_token(spark):
    """Before, every ranking of the pool joined the tokens with themselves and made a row for each pair and shared token."""
    from linkspan.plans import queries

    view = queries.View(spark, "/root/testdata/sf0.001")
    for name, query in {"run": lambda: view.score(keep={"combined": 5}), "size": lambda: view.pool_size, "pool": lambda: view.pool}.items():
        plan = query()._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "cand_id" not in "".join(x for x in plan.splitlines() if "Join" in x), name


def test_empty_tables(spark, made):
    listed, _, weighted, _ = made
    for none in (listed.where("false"), listed.where("source = 1"), listed.where("source <> 1")):
        assert not scoring.score(none, weighted, FIELDS).count() and not scoring.score(none, weighted, FIELDS, count=True).count()
    assert not scoring.score(listed, weighted.where("false"), FIELDS).count()


@pytest.mark.parametrize("below", [0, 40])
def test_candidates_equal_the_joins(spark, below):
    from linkspan.functions import text as t
    from linkspan.plans import matching, queries

    records = queries.View(spark, "/root/testdata/sf0.001").records
    config = blocking.Config(top_k=6, max_df=15, rerank_depth=8, fallback_below=below, fallback_max_df=12)
    fields = (*config.fields, "g")
    tokens = stats.record_tokens(records, fields).localCheckpoint()
    weighted = blocking._weighted(idf := stats.idf(stats.doc_freq(tokens), stats.country_counts(records)).localCheckpoint(), config)
    flags = records.select("entity_id", t.record_flags(F.col("business_name"), F.col("business_address")).alias("flags")).localCheckpoint()
    pool = blocking.block(tokens, weighted.where(F.col("df") <= config.max_df), flags, config.nonlatin_boost)
    if below:
        pool = blocking.with_fallback(pool, records.where("source = 1").select(F.col("entity_id").alias("s1_id")), tokens, idf, below, config.fallback_max_df, config.fallback_weight)
    marked = pool.join(flags.select(F.col("entity_id").alias("cand_id"), (F.col("flags") != 0).alias("sparse")), "cand_id")
    short = blocking.rerank(blocking.shortlist(marked, config), tokens, weighted.where(F.col("df") > config.max_df), flags, config.nonlatin_boost)
    want = blocking.quota_top_k(short, config.top_k, config.name_quota, config.sparse_quota)
    got = rows(matching.candidate_run(records, config), *PAIR, "rank")
    assert got and got == rows(want, *PAIR, "rank")


def test_coverage_is_worked_out_where_pairs_are(spark):
    """Before, all pairs were joined with the S1's weights, so every pair went through a shuffle (F1 of round 3)."""
    from linkspan.plans import queries

    plan = queries.QUERIES["coverage"](queries.View(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("FlatMapGroupsInArrow")]
    assert "Join" not in above and "Repartition" not in above and "Aggregate" not in above


def test_own_weight_holds_every_token(made, blocks):
    """Tokens above the cap, and those that only S1 records have, count in an S1's own weight; a row that is there twice counts twice."""
    listed, tokens, weighted, _ = made
    idf = weighted.withColumn("idf_micro", F.col("weight_micro") + 1)
    sides = stats.token_freq(listed, FIELDS).select("country", "field", "token", "in_s1", "in_others")
    want = {r.entity_id: r.own for r in tokens.where("source = 1").join(idf, ["country", "field", "token"]).groupBy("entity_id").agg(F.sum("idf_micro").alias("own")).collect()}
    got = scoring.score(listed, idf.join(sides, ["country", "field", "token"]), FIELDS, max_df=20, own=True).select("s1_id", "own").distinct().collect()
    assert got and len(got) == len({r.s1_id for r in got}) and all(want[r.s1_id] == r.own for r in got)


@pytest.mark.parametrize("k", [1, 4, 9])
def test_slots_are_given_where_candidates_are(made, blocks, monkeypatch, k):
    """Before, whole shortlists left every task and only the windows behind it gave the slots (F3 of round 3)."""
    listed, tokens, weighted, flags = made
    config = blocking.Config(top_k=k, name_quota=0.3, sparse_quota=0.3, rerank_depth=12)
    marks = flags.select(F.col("entity_id").alias("cand_id"), (F.col("flags") != 0).alias("sparse"))
    short = blocking.shortlist(blocking.block(tokens, weighted.where("df <= 20"), flags, 2.5).join(marks, "cand_id"), config)
    want = blocking.quota_top_k(blocking.rerank(short, tokens, weighted.where("df > 20"), flags, 2.5), k, 0.3, 0.3)
    for span in (1, 99):
        monkeypatch.setattr(scoring, "BEST_SPAN", span)
        found = scoring.score(listed, weighted, FIELDS, boost=2.5, max_df=20, common=True, sparse=True, quota=blocking.slots(config), **blocking.shortlist_views(config, flags)).localCheckpoint()
        got = blocking.quota_top_k(blocking.reranked(blocking.shortlist(found, config)), k, 0.3, 0.3)
        assert rows(got, *PAIR, "rank") == rows(want, *PAIR, "rank")
    assert found.groupBy("s1_id").count().where(F.col("count") > k + 1).isEmpty()  # slots of few rows round up


def test_records_are_packed(spark):
    """Before, every block of the other side got a record's texts as they are (F2 of round 3)."""
    import pyarrow as pa

    words = [f"word{k}" for k in range(500)]
    texts = ["\x1e".join(words[k % 7 :: 1 + k % 5]) for k in range(3000)]
    table = pa.table({"country": ["x"] * 3000, "kind": pa.array([1] * 3000, pa.int32()), "block": pa.array([k % 2 for k in range(3000)], pa.int32()), "id": [f"c{k}" for k in range(3000)], "flags": pa.array(range(3000), pa.int64()), "t_n": texts, "t_a": [None, ""] * 1500})
    packs = pa.Table.from_batches(list(scoring._packs(table, ["n", "a"])))
    assert packs.num_rows == 2 and 4 * packs["pack"].nbytes < table["t_n"].nbytes
    vocabulary = pa.array(words[::-1])
    names, at, toks, flags = scoring._side(list(zip(packs["size"].to_pylist(), packs["pack"], strict=True)), [vocabulary, pa.array([], pa.string())], [0, 500], scoring.np.arange(500) != 499)
    found = {}
    for r, w in zip(at.tolist(), toks.tolist(), strict=True):
        found.setdefault(names[r].as_py(), []).append(vocabulary[w].as_py())
    assert all(sorted(found[f"c{k}"]) == sorted(set(texts[k].split("\x1e")) - {"word0"}) for k in range(3000))
    assert [int(n.as_py()[1:]) for n in names] == flags.tolist()


@pytest.mark.parametrize("where", ["true", "false"])
def test_settled_texts_come_back(made, where):
    from linkspan.session import settle_pressed

    listed = made[0].where(where)
    kept = settle_pressed(listed)
    assert kept.schema == listed.schema and rows(kept.na.fill("-"), *listed.columns) == rows(listed.na.fill("-"), *listed.columns)
