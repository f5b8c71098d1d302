import random

from linkspan.operators import metrics, stats
from linkspan.operators.blocking import Config
from linkspan.plans import matching, queries


def test_train_and_predict(spark, tmp_path):
    rng = random.Random(11)
    words = ["maple", "harlow", "quorin", "tavell", "brenwick", "pioneer", "acme", "oak", "delta", "lumen", "north", "river"]
    rows, truth = [], []
    for k in range(40):
        name, place = " ".join(rng.sample(words, 2)) + f" {chr(97 + k % 26)}x", f"{10 + k} {rng.choice(words)} street"
        rows.append((f"S1-{k:03d}", name, place, "US", 1, k))
        for s in (2, 3):
            if rng.random() < 0.8:
                rows.append((f"S{s}-{k:03d}", name + " llc" * (s - 2), place.replace("street", "st"), "US", s, k))
                truth.append((f"S1-{k:03d}", f"S{s}-{k:03d}"))
    records = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, source int, source_row bigint")
    truth = spark.createDataFrame(truth, "s1_id string, cand_id string")
    base, deep = Config(top_k=3, max_df=30), Config(top_k=5, max_df=30)
    bundle = matching.train_bundle(records, truth, base, deep, groups=("A",), folds=2, grid=[0.3, 0.5], trees=3, depth=3)
    bundle.save(f"file://{tmp_path}/bundle", spark)
    again = matching.Bundle.load(f"file://{tmp_path}/bundle", spark)
    s1 = records.where("source = 1").selectExpr("entity_id as s1_id", "country")
    for decoder in ("meta", "threshold"):
        matches, listed = matching.predict(records, again, base, deep, decoder)
        assert matches.join(listed, ["s1_id", "cand_id"], "left_anti").count() == 0
        assert matches.groupBy("cand_id").count().where("count > 1").count() == 0
        assert metrics.macro_f05(s1, matches, truth).first().macro_f05 > 0.85


def test_candidate_run_finds_groups_of_many_copies(spark, tmp_path):
    texts = ["maple harlow quorin tavell brenwick pioneer lumen river and more"] * 60 + [f"north{k} acme{k} oak{k} delta{k} {k} street of stones and more" for k in range(30)]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    view = queries.View(spark, str(tmp_path))
    held = {}
    for r in stats.record_tokens(view.records, Config().fields).collect():
        held.setdefault(r.entity_id, set()).add((r.field, r.token))
    want = {(a, b) for a in held for b in held if a.startswith("S1") and not b.startswith("S1") and held[a] & held[b]}
    got = {(r.s1_id, r.cand_id) for r in queries.QUERIES["candidate_run"](view).collect()}
    assert len({b for _, b in want}) <= Config().top_k and got == want


def jaro_winkler(a, b):
    reach, used, left = max(max(len(a), len(b)) // 2 - 1, 0), set(), []
    for i, x in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if j not in used and b[j] == x), None)
        if j is not None:
            used.add(j)
            left.append(x)
    if not left:
        return 0.0
    m, moved = len(left), sum(x != b[j] for x, j in zip(left, sorted(used), strict=True)) // 2
    j = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return j + 0.1 * same * (1 - j) if j > 0.7 else j


def test_jaro_winkler_of_whole_names(spark, tmp_path):
    names = ["été à la forêt où dort le hérisson blanc", "ete a la foret ou dort le herisson blanc", "над рекой стоит старый дом и новая школа", "над рекою стоит старый том и новая школа", "straße und grüße aus münchen im frühling", "strasse und grusse aus munchen im fruhli"]
    texts = [names[(i // 3 * 2 + i % 3 % 2) % 6].ljust(40)[:40] + "1 north road shared by all" for i in range(9)]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    view = queries.View(spark, str(tmp_path))
    name = {r.entity_id: r.business_name for r in view.records.collect()}
    got = queries.QUERIES["jaro_winkler_pairs"](view).collect()
    assert len(got) == view.run(queries.CONFIG.top_k).count() > 0
    assert any(r.jaro_winkler < 1 and not name[r.s1_id].isascii() for r in got)
    for r in got:
        assert abs(r.jaro_winkler - jaro_winkler(name[r.s1_id], name[r.cand_id])) < 2e-6
