"""The corpus operators against brute force, round trips and edge cases."""

import collections
import hashlib
import random
import re
import time
import warnings
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from linkspan.llm import ann, bpe, chat, common, langid, linededup, mixing, ngramjoin, pii, quality, registry, tokenbin

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names the operators use inside.
CLASHES = ["id", "h", "n", "rate", "lines", "gone", "p", "kept", "words", "ids", "block", "stratum"]


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


ODD = [None, "", " \n\t ", "a", "one two three", "é" * 50_000, "w " * 20_000, "same text here", "same text here", "\x1c\x85 x", "😀 中文 ß İ"]


# ---- 8


def base_measures(text):
    t = text or ""
    w = WORD.findall(t)
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if seen[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab #\n") for _ in range(rng.randint(0, 200))) for _ in range(150)]
    got = {r.doc_id: r for r in quality.measure(docs(spark, texts), [F.col("doc_id")]).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in quality.MEASURES[:5]) == base_measures(t)


def test_binomial_tail_is_exact(spark):
    from math import comb

    rows = [(k, n) for n in (1, 10, 200) for k in (0, 1, 3) if k <= n]
    df = spark.createDataFrame(rows, "k bigint, n bigint").withColumn("p", quality.binomial_tail(F.col("k"), F.col("n"), 0.05))
    for r in df.collect():
        want = 1.0 if r.k >= 0.05 * r.n else sum(comb(r.n, i) * 0.05**i * 0.95 ** (r.n - i) for i in range(r.k + 1))
        assert abs(r.p - want) < 1e-9


def test_quality_certifies_only_with_enough_labels(spark):
    clean, junk = " ".join(f"word{k}" for k in range(60)), " ".join(f"w{k}$$$" for k in range(60))
    many = docs(spark, [f"{clean} {k}" for k in range(400)] + [f"{junk} {k}" for k in range(40)])
    labels = many.select("doc_id", (F.col("doc_id") < 400).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    got = {r.doc_id: r.kept for r in quality.assess(spark, clashing(many).drop("stratum", "p", "words"), labels).collect()}
    assert all(got[i] for i in range(400)) and not any(got[i] for i in range(400, 440))
    few = {r.doc_id: r.kept for r in quality.assess(spark, many, labels.where("doc_id % 10 = 0")).collect()}
    assert all(few.values())
    kept = quality.keep(spark, clashing(docs(spark, [*ODD, clean])), labels)
    assert kept.columns == [*docs(spark, []).columns, *CLASHES] and [r.doc_id for r in kept.collect()] == [len(ODD)]
    assert quality.keep(spark, docs(spark, []), labels).count() == 0


def test_quality_bounds_the_union_of_rules_and_counts_a_document_once(spark):
    """Each rule alone rejects few good documents, all together too many: the walk ends before that."""
    rng = random.Random(11)
    row = lambda i, good, sym, dup: (i, "en", 100, 500, sym, dup, 0, 100, 0, 600, good)
    rows = [row(i, 1, 20 if i % 25 == 0 else 0, 40 if i % 25 == 1 else 0) for i in range(1000)] + [row(i, 0, rng.choice([20, 0]), rng.choice([40, 0])) for i in range(1000, 1600)]
    names = "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_upper bigint, n_chars_all bigint, quality int"
    df = spark.createDataFrame(rows, names)
    labels = df.select("doc_id", "quality")
    for times in (1, 5):
        more = df.drop("quality")
        for _ in range(times - 1):
            more = more.unionByName(df.drop("quality"))
        for alpha, most in ((0.05, 0.05), (0.2, 0.2)):
            chosen = {r.rule: r for r in quality.cutoffs(more, labels, alpha=alpha).collect()}
            out = [x for x in rows if x[-1] and (("symbol_rate" in chosen and x[4] / 100 >= chosen["symbol_rate"].cutoff) or ("dup_line_rate" in chosen and x[5] / 100 >= chosen["dup_line_rate"].cutoff))]
            assert len(out) <= most * 1000 and (alpha < 0.1 or len(out) == 80)
            assert all(r.n_good < 1000 for r in chosen.values())


# ---- 10


def lost_lines(texts, least):
    seen, gone = set(), {}
    for i, t in enumerate(texts):
        lines = [(p, x, len(WORD.findall(x))) for p, x in enumerate((t or "").split("\n"))]
        lines, gone[i] = [x for x in lines if x[2]], set()
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += lines[b][2]
                if total >= least:
                    key = tuple(x[1] for x in lines[a : b + 1])
                    if key in seen:
                        gone[i] |= {x[0] for x in lines[a : b + 1]}
                    seen.add(key)
    return gone


def test_line_dedup_finds_every_repeated_run(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([1, 5, 20, 30, 49, 50, 60]))) for _ in range(14)]
    texts = ["\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    got = {r.doc_id: r.gone for r in linededup.dedup(docs(spark, texts)).collect()}
    for i, want in lost_lines(texts, 50).items():
        lines = texts[i].split("\n")
        assert [p for p in got[i] if lines[p].strip()] == sorted(want)


def test_line_dedup_edges(spark):
    out = linededup.dedup(clashing(docs(spark, ODD)).drop("gone"), gone="gone")
    assert out.count() == len(ODD) and set(CLASHES) <= set(out.columns)
    assert {r.doc_id: r.text for r in out.collect()}[0] is None
    passage = " ".join(f"p{k}" for k in range(55))
    kept = {r.doc_id: r.text for r in linededup.dedup(docs(spark, [f"x\n{passage}", f"{passage}\ny"])).collect()}
    assert kept == {0: f"x\n{passage}", 1: "y"}
    assert linededup.dedup(docs(spark, [])).count() == 0
    rows = [(None, passage), (None, passage), (3, f"{passage}\nz"), (3, f"{passage}\nz"), (3, "z")]
    left = linededup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, passage), (0, passage), (3, "z"), (3, "z"), (3, "z")]


def test_line_dedup_extends_past_the_last_window(spark):
    long, tail = " ".join(f"l{k}" for k in range(60)), "a few words more"
    got = linededup.dedup(docs(spark, [f"{long}\nx", f"{long}\n{tail}\ny", f"{long}\n{tail}\nz", f"q\n{tail}"])).collect()
    assert {r.doc_id: r.text for r in got} == {0: f"{long}\nx", 1: f"{tail}\ny", 2: "z", 3: f"q\n{tail}"}
    win = linededup.windows(docs(spark, [" ".join("abcdefghij") + "\n" + "\n".join(f"{k} one two three four five six" for k in range(100))]))
    assert win.where("chosen").count() < 0.5 * win.count()


# ---- 1


def test_rates_meet_the_targets_or_come_closest(spark):
    rng = np.random.default_rng(2)
    p, n = rng.dirichlet([0.4] * 3, 300), rng.integers(1, 50, 300)
    rows = [(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)]
    for lack in (False, True):
        some = [k for k in range(300) if not lack or p[k].max() < 0.7]
        q, m = p[some], n[some]
        mass = q * m[:, None]
        soft = spark.createDataFrame([rows[k] for k in some], "n bigint, p array<double>")
        for shares in ([0.5, 0.3, 0.2], [0.7, 0.2, 0.1], [0.9, 0.09, 0.01]):
            with warnings.catch_warnings(record=True) as said:
                warnings.simplefilter("always")
                rate, report = mixing.fit_rates(soft, shares, [0])
            got = soft.withColumn("rate", rate).collect()
            r, want = np.array([x.rate for x in got]), np.array(report["wanted"])
            reached = np.array([[y * x.n for y in x.p] for x in got]).T @ r
            assert (r >= 0).all() and np.allclose(reached, report["reached"], atol=1e-5 * want.sum())
            assert np.isclose(np.abs(reached - want).max() / want.sum(), report["miss"], atol=1e-5) and any("targets" in str(w.message) for w in said) == (report["miss"] > mixing.TOLERANCE)
            dense, metric = np.ones(len(m)), np.linalg.inv(mass.T @ q)
            for _ in range(20_000):
                dense = np.maximum(0, dense + q @ metric @ (want - mass.T @ dense))
            left = lambda x, b=want, w=metric: (b - x) @ w @ (b - x)
            assert left(reached) <= 1.01 * left(mass.T @ dense) + 1e-6 * (want @ metric @ want)
            assert lack or shares[0] > 0.8 or report["miss"] <= mixing.TOLERANCE


def test_smallest_hashes_of_a_group(spark):
    rows = [(i, "abc"[min(i % 7, 2)]) for i in range(5000)]
    df = spark.createDataFrame(rows, "id bigint, g string")
    hashed = {r.id: r.h % 2**64 for r in df.select("id", F.xxhash64("id").alias("h")).collect()}
    for most in (1, 40, 700, 9000):
        got = {(r.g, r.id) for r in common.smallest(df, "g", "id", most).collect()}
        want = {(g, i) for g in "abc" for i in sorted((i for i, x in rows if x == g), key=lambda i: hashed[i])[:most]}
        assert got == want


def test_mixing_learns_held_out_domains(spark):
    rng = random.Random(4)
    vocab = {d: [f"{d}{k}" for k in range(40)] for d in ("en", "fr", "toxic")}
    kinds = [rng.choice(["en", "fr", "toxic"]) for _ in range(300)]
    texts = [" ".join(rng.choice(vocab[k]) for _ in range(60)) for k in kinds]
    df = docs(spark, texts)
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(kinds) if i % 2], "doc_id bigint, domain string")
    mixed, report = mixing.mix(spark, df, labels)
    rows = mixed.collect()
    assert all(np.floor(r.rate) <= r.copies <= np.floor(r.rate) + 1 and (r.copies or r.rate < 1) for r in rows)
    assert np.allclose([sum(r.rate * r.n * r.p[k] for r in rows) for k in range(3)], report["wanted"], rtol=1e-3)
    assert abs(sum(r.copies for r in rows) - sum(r.rate for r in rows)) < 60
    got = {r.doc_id: report["domains"][int(np.argmax(r.p))] for r in rows}
    assert sum(got[i] == k for i, k in enumerate(kinds) if i % 2 == 0) >= 145
    out = mixing.apply(clashing(df), mixed)
    assert out.columns == [*df.columns, *CLASHES]


def test_mixing_counts_every_word(spark):
    rng = random.Random(5)
    odds = {"en": [8, 1, 1], "low": [1, 8, 1]}
    kinds = ["en", "low"] * 20
    texts = [" ".join(["Aa", "bb", "cc", *rng.choices(["aa", "bb", "cc"], odds[k], k=rng.randint(5, 40))]) for k in kinds]
    df = docs(spark, texts)
    model = mixing.fit(df, spark.createDataFrame(list(enumerate(kinds)), "doc_id bigint, domain string"), ["en", "low"])
    count = {k: collections.Counter(w for t, x in zip(texts, kinds, strict=True) if x == k for w in t.lower().split()) for k in odds}
    lp = lambda w, k: np.log((count[k][w] + mixing.SMOOTHING) / (sum(count[k].values()) + mixing.SMOOTHING * mixing.BUCKETS))
    got = {r.doc_id: r for r in mixing.posteriors(df.unionByName(df.where("doc_id < 9")), model, [np.log(0.5)] * 2, [0, 1], 12.0).collect()}
    for i, t in enumerate(texts):
        w = t.lower().split()
        g = [min(1, 12 / len(w)) * sum(lp(x, k) for x in w) for k in odds]
        assert got[i].n == len(w) and np.allclose(got[i].p, np.exp(g - np.logaddexp(*g)), atol=1e-6)
        assert (got[i].p[0] > 0.5) == (w.count("aa") > w.count("bb")) or w.count("aa") == w.count("bb")


def test_mixing_learns_further_parts(spark):
    rng = random.Random(6)
    rows = [("en", "en") for _ in range(60)] + [("low", f"l{k:02d}") for k in range(12) for _ in range(16 - k)]
    vocab = {x: [f"{x}w{k}" for k in range(12)] for _, x in rows}
    texts = [" ".join(rng.choices(vocab["en"], k=30) + (rng.choices(vocab[x], k=30) if d == "low" else [])) for d, x in rows]
    marks = spark.createDataFrame([(i, d, x) for i, (d, x) in enumerate(rows) if i % 2], "doc_id bigint, domain string, part string")
    mixed, report = mixing.mix(spark, docs(spark, texts), marks)
    low = report["domains"].index("low")
    got = {r.doc_id: r.p[low] for r in mixed.collect()}
    assert all((got[i] > 0.5) == (d == "low") for i, (d, _) in enumerate(rows))


def test_mixing_edges(spark):
    labels = spark.createDataFrame([], "doc_id bigint, domain string")
    mixed, report = mixing.mix(spark, docs(spark, ODD), labels)
    assert report["domains"] == [] and {r.copies for r in mixed.collect()} == {1}
    some = spark.createDataFrame([(3, "en"), (4, "fr")], "doc_id bigint, domain string")
    assert mixing.mix(spark, docs(spark, ODD), some)[0].where("copies is null or rate < 0").count() == 0
    assert mixing.mix(spark, docs(spark, []), some)[0].count() == 0


# ---- 2


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("seed", "small"), [(1, False), (2, False), (3, True)])
def test_ngram_join_against_all_pairs(spark, seed, small, monkeypatch):
    if small:  # every block copied, every range salted, few matches at a time
        for name, size in (("QUERIES", 3), ("MATCHES", 7), ("PART", 150), ("BLOCK", 4)):
            monkeypatch.setattr(ngramjoin, name, size)
    rng = random.Random(seed)
    shared = [f"s{k}" for k in range(40)]
    bases = [[f"b{b}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 8, 40, 120]))] for b in range(14)]
    texts = list(ODD)
    for _ in range(260):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 9999)}"
        texts.append(" ".join(w + (shared if rng.random() < 0.3 else [])).upper() if rng.random() < 0.2 else " ".join(w + (shared if rng.random() < 0.3 else [])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.link(spark, docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    left = ngramjoin.deduplicate(spark, clashing(docs(spark, texts)))
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c in got.values()})


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64) for _ in range(2))
        a = np.unique(np.concatenate([a, b[: rng.integers(0, len(b) + 1)]]))
        real = len(set(a.tolist()) ^ set(b.tolist()))
        assert ngramjoin.least_difference(*(np.frombuffer(ngramjoin.parities(x), np.uint8) for x in (a, np.unique(b)))) <= real


def test_ngram_join_edges(spark):
    assert ngramjoin.link(spark, docs(spark, [])).count() == 0
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "other words"), (2, "other words")], "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in ngramjoin.link(spark, df).collect() if r.doc_id)
    assert [x[2] for x in got] == [1, 1, 1]


# ---- 3


def base_spans(text):
    t, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub(r"[ -]", "", m.group())) <= 19 and sum(int(x) if k % 2 == 0 else sum(map(int, str(2 * int(x)))) for k, x in enumerate(d[::-1])) % 10 == 0]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return out


def test_pii_base_spans(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(al) for _ in range(rng.randint(0, 60))) for al in ("ab@.-", "12.0 -", "+1 ()-.2", "a1@.+ -%😀é:/") for _ in range(3000)]
    texts += ["4111 1111 1111 1111 x", "1" * 5000, "a@" * 3000, "1." * 3000, "+1 " * 2000, "é 192.168.0.1 and 300.1.1.1"]
    for t in texts:
        assert [s for s in pii.find(t) if s[0] in pii.BASE] == base_spans(t)


def test_pii_method_spans_and_edges(spark):
    text = "see https://a.example.org/x?y=1, password=abcdef123456 and DE89 3704 0044 0532 0130 00."
    found = {k: text[a:b] for k, a, b in pii.find(text)}
    assert found["url"] == "https://a.example.org/x?y=1" and found["secret"] == "abcdef123456" and found["iban"] == "DE89 3704 0044 0532 0130 00"
    for said, value in (("Account no. 12-3456 789 and", "12-3456 789"), ("aCCt: 00112233x.", "00112233x"), ("Passport number is AB1234567, ok", "AB1234567"), ("SSN 123-45-6789", "123-45-6789"), ("the account was 5", None), ("discount 1234567", None), ("account 1234567890123456789012345678", None)):
        assert [said[a:b] for k, a, b in pii.find(said) if k == "account"] == [value] * (value is not None)
    assert [k for k, *_ in pii.find("PassWord = Abcdefgh1 mypwd=abcdefghi")] == ["secret"]
    assert pii.redact("mail a@b.co now", pii.find("mail a@b.co now")) == "mail <EMAIL> now"
    out = pii.find_spans(clashing(docs(spark, ODD)), redacted="redacted")
    assert out.count() == len(ODD) and set(CLASHES) <= set(out.columns)


# ---- 4


def test_forest_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((1200, 16))
    v[5] = v[7] = v[1]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None] * 8), (2004, [1.0]), (2020, [float("inf")] * 16)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(1))
    got = collections.defaultdict(list)
    for r in ann.nearest(spark, df, F.col("vec_id") % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 1200, 20):
        s = v @ v[q]
        s[q] = -np.inf
        want = sorted(range(1200), key=lambda i: (-round(s[i], 9), i))[:10]
        hits += len(set(want) & {i for i, _ in got[q]})
        assert len(got[q]) == 10 and all(abs(s[i] - x) < 1e-9 for i, x in got[q])
    assert hits >= 0.9 * 600 and set(got) == set(range(0, 1200, 20))
    assert ann.nearest(spark, df.where("vec_id < 0"), F.lit(True)).count() == 0
    assert ann.nearest(spark, df.where("vec_id < 3"), F.lit(True)).count() == 6


@pytest.mark.parametrize("n", [500, 2000, 3 * ann.BLOCK])
def test_forest_recall_on_nearly_orthogonal_vectors(n):
    """The hardest case: no clusters. Candidates are a part of the block where it has more than CANDIDATES vectors."""
    rng = np.random.default_rng(n)
    v = rng.standard_normal((n, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    asked = v[:: n // 40][:40]
    best = [np.argsort(-(v @ q))[:21] for q in asked]
    got: list[list] = [[] for _ in asked]
    for a in range(0, n, ann.BLOCK):
        forest = ann.Forest(v[a : a + ann.BLOCK])
        start, stop = forest.ranges(asked)
        share = np.mean([len(forest.candidates(start[:, i], stop[:, i])) for i in range(len(asked))]) / len(forest.vectors)
        assert share < (0.35 if n > 4000 else 0.7 if n > 1000 else 1.1)
        for i, (rows, scores) in enumerate(forest.search(asked, 21)):
            got[i] += [(-s, a + r) for r, s in zip(rows.tolist(), scores.tolist(), strict=True)]
    recall = np.mean([len({r for _, r in sorted(g)[:21]} & set(b.tolist())) / 21 for g, b in zip(got, best, strict=True)])
    assert recall >= 0.9, recall


def test_forest_ties_copies_and_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rng = np.random.default_rng(8)
    v = rng.integers(-2, 3, (150, 3)).astype(float)  # many ties and copies
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame([*rows, (7, rows[7][1]), (None, [1.0, 1.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.nearest(spark, df, F.col("vec_id") % 5 == 0, k=6).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    live = [i for i in range(150) if v[i].any()]
    assert dict(got) == {q: sorted((i for i in live if i != q), key=lambda i: (-(v[i] @ v[q]), i))[:6] for q in live if q % 5 == 0}


# ---- 5


def test_language_evidence(spark):
    rng = random.Random(6)
    syllables = {"en": ["the", "ing", "wh"], "de": ["sch", "ung", "ein"]}
    say = lambda x: " ".join("".join(rng.choice(syllables[x]) for _ in range(3)) for _ in range(40))
    known = spark.createDataFrame([(i, say(x), x) for i, x in enumerate(["en", "de"] * 30)], "doc_id bigint, text string, lang string")
    pages = [(1, "https://a.example.org/en/1", f"<html lang='en'><p>{say('en')}</p>"), (2, "https://b.example.de/x", f"<html lang=en><script>the the</script>{say('de')}"), (3, None, None), (4, "https://b.example.de/y", "<html></html>")]
    pages += [(10 + k, "https://b.example.de/z", f"<p>{say('de')}</p>") for k in range(20)]
    got = {r.page_id: r for r in langid.identify(spark, spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("p", F.lit(0)), known).collect()}
    assert got[1].lang == "en" and got[2].lang == "de" and got[4].lang == "de" and got[3].lang in ("de", "en") and len(got) == 24
    assert langid.identify(spark, spark.createDataFrame([], "page_id bigint, url string, html string"), known).count() == 0


def test_page_scan(spark):
    assert langid.scan('<html data-lang="fr" class=x lang="en-GB"><p>a &amp; b</p><script>if (a<b) "</p>"</script>c<!-- > d --> e') [1] == "en"
    assert langid.scan("<p>a &amp; b</p><SCRIPT x>q</p></Script >c<!-- > d --> e")[0].split() == ["a", "&", "b", "c", "e"]
    assert langid.scan("x <!-- y") == ("x  ", "") and langid.scan("1 < 2")[0].split() == ["1", "2"] and langid.scan("<html lang='deutsch'>")[1] == ""
    assert [langid.place(u)[:2] for u in ("https://www.a.b.co.uk:80/x", "http://[::1]:8/fr/", "http://u:p@10.0.0.1/", "ftp://x.example.org.", "nothing", None)] == [("a.b.co.uk", "b.co.uk"), ("[::1]", "[::1]"), ("10.0.0.1", "10.0.0.1"), ("x.example.org", "example.org"), ("", ""), ("", "")]
    for hostile in ("<!--", "<html ", "<script>", "<a b='", "&", "<", "</script ", "<html lang = "):
        began = time.time()
        langid.scan(hostile * (1_000_000 // len(hostile)))
        assert time.time() - began < 3


def test_language_posteriors_against_brute_force(spark):
    """The fused posteriors, page by page in plain Python, from the model and the evidence."""
    rng = random.Random(16)
    words = {"en": ["the", "thing", "which"], "de": ["schung", "ein", "und"], "fr": ["oiseau", "le", "que"]}
    say = lambda x, n: " ".join(rng.choice(words[x]) for _ in range(n))
    known = spark.createDataFrame([(i, say(x, 30), x) for i, x in enumerate(["en", "de", "fr"] * 10)], "doc_id bigint, text string, lang string")
    hosts = ["https://a.example.de/x", "https://b.example.de/fr/", "http://c.co.uk/", None, "https://c.org/en/1", "bad", "http://d.c.org/"]
    pages = [(i, rng.choice(hosts), f"<html lang={rng.choice(['en', 'de-AT', 'xx', ''])}>{say(rng.choice('en de fr'.split()), rng.randint(0, 3))}") for i in range(120)] + [(3, hosts[0], "<p>the"), (500, None, None)]
    out = langid.identify(spark, spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit("x")), known).collect()
    langs, model = langid.fit(known)
    model = model.astype(np.float32)
    rows = []
    for page_id, url, page in pages:
        host, domain, suffix = langid.place(url)
        text, declared = langid.scan(page or "")
        x = langid.cells(text)
        like = model[x].sum(axis=0, dtype=np.float64) * min(1.0, langid.EVIDENCE / max(len(x), 1))
        like = (like - like.max()).round(6)
        for told, trust in ((declared, langid.TRUST_DECLARED), (suffix, langid.TRUST_SUFFIX)):
            if told in langs:
                like = like + np.array([np.log(trust if y == told else (1 - trust) / 2) for y in langs])
        p = np.exp(like - like.max())
        rows.append((page_id, host, domain, like, p / p.sum()))
    world = sum(r[4] for r in rows)
    base = (world + 1) / (world.sum() + 3)
    want = []
    for page_id, host, domain, like, p in rows:
        h = sum((r[4] for r in rows if r[1] == host), np.zeros(3)) if host else np.zeros(3)
        d = sum((r[4] for r in rows if r[2] == domain), np.zeros(3)) if host else np.zeros(3)
        less = [np.maximum(c - p, 0) for c in (h, d)]
        dp = (less[1] + langid.PULL * base) / (less[1].sum() + langid.PULL)
        hp = (less[0] + langid.PULL * dp) / (less[0].sum() + langid.PULL)
        s = like + np.log(hp)
        post = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        want.append((page_id, host, langs[int(post.argmax())], round(float(post.max()), 4)))
    assert sorted((r.page_id, r.host, r.lang, round(r.confidence, 4)) for r in out) == sorted(want)


# ---- 6


def test_chat_round_trip(spark):
    rng = random.Random(7)
    parts = ["###", "</turn>", "\\", ":", "\n", " ", "ok", "é", "😀", "### assistant: ", "</turn>\n"]
    talks = [[(rng.choice(["user", "assistant", "a: b", ""]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for _ in range(rng.randint(1, 6))] for _ in range(200)]
    rows = [(i, k, role, text) for i, turns in enumerate(talks) for k, (role, text) in enumerate(turns)] + [(-1, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("mask", F.lit(1))
    formatted = chat.format_chats(df, public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for i, turns in enumerate(talks):
        assert chat.parse(texts[i]) == turns
        learned = "".join(t for r, t in turns if r == "assistant")
        assert got[i].loss_chars == len(learned) and got[i].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[-1].n_turns == 1 and got[-1].loss_chars == 0
    assert chat.read_back(chat.format_chats(df.where("conv_id = 999"), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


# ---- 7


def test_token_files_roll(spark, tmp_path, monkeypatch):
    """Several files a task, null ids, repeated ids and rows: everything is read back, in order."""
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(None if i % 3 == 0 else i % 7, f"text {i % 11}" * (i % 5)) for i in range(90)] + [(5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name, size in (("FILE_DOCS", 4), ("AHEAD", 50)):
        monkeypatch.setattr(tokenbin, name, size)
    manifest = tokenbin.write(spark, df, str(tmp_path / "r"), path)
    assert sum(f["docs"] for f in manifest) == 91
    got = tokenbin.read(spark, str(tmp_path / "r"), manifest).orderBy("start").collect()
    assert [r.doc_id if r.doc_id is not None else -1 for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    files = [tokenbin.TokenFile(str(tmp_path / "r"), f["name"]) for f in manifest]
    assert [x for f in files for _, some in f.stream() for x in some] == [r.ids for r in got]
    word = tokenbin.load(path)
    want = collections.Counter((i, (*word.tokenizer.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in rows)
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(8)
    bits = ["it's", "a.b", "x.,", "'ll.", "ÀÉ", "É", "H̱.", "Σ", "İ", "ß", "<|endoftext|>", "1.5", ".", "...", "\n", " ", "\x1c", "\x85", "\xa0", "THE", "中文", "😀"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    manifest = tokenbin.write(spark, clashing(docs(spark, texts)), str(tmp_path / "t"), path)
    got = {r.doc_id: r for r in tokenbin.read(spark, str(tmp_path / "t"), manifest).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].start == start and zlib.crc32(got[i].ids)
        start += len(ids)
    file = tokenbin.TokenFile(str(tmp_path / "t"), manifest[0]["name"])
    first = int(file.index["doc_id"][0])
    assert file.find(first).tobytes() == got[first].ids and file.find(10**9) is None
    assert tokenbin.read(spark, str(tmp_path / "e"), tokenbin.write(spark, docs(spark, []), str(tmp_path / "e"), path)).count() == 0


# ---- 9


def test_bpe_equals_the_library(spark):
    import tiktoken

    path, pattern = bpe.vocabulary()
    own = bpe.load(path, pattern)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(9)
    letters = "abcdeéüñ  \n\n\t0123 the ing ΑΣ中文字😀\x1c\x85　!?#$'s"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(300)] + ["ab" * 3000, "中" * 2000, "\r\n" * 500]
    coded = bpe.decode(bpe.encode(clashing(docs(spark, texts)).drop("ids"), path, pattern), path)
    for r in coded.collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded) == texts[r.doc_id].encode()
    assert bpe.digests(docs(spark, [])).count() == 0
    assert own._rises()
    own.store = type(own.store)(own.encode_pieces)
    long = ["a" * 5001, "".join(rng.choice("abcdefghij") for _ in range(30_000)), "".join(rng.choice("etaoin") for _ in range(3000)), "😀" * 999 + "é" * 777]
    assert [library.encode_ordinary(t) for t in long] == [own.encode([t])[0].tolist() for t in long]
    named = docs(spark, ["a b"]).withColumns({"__text": F.lit("x"), "batch": F.lit("y")})
    assert bpe.encode(named, path, pattern).first().ids == library.encode_ordinary("a b")
    assert pii.find_spans(named).select("__text", "pii").first() == ("x", [])


# ---- registry and pipeline


def test_quality_cutoffs_are_certified_on_the_checked_tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    measured = common.Scratch(spark, "test").write(quality.measure(read("documents"), [F.col("doc_id"), F.col("lang").alias("stratum")]), "measured")
    chosen = quality.cutoffs(measured, read("labels")).collect()
    assert ("en", "symbol_rate") in {(r.stratum, r.rule) for r in chosen} and all(r.good_rejected <= quality.ALPHA * r.n_good for r in chosen)


def test_every_query_runs_on_the_smallest_tables(spark):
    for name in ("op1_mixing", "op3_pii", "op5_language_id", "op8_quality_rules"):
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline as cp

    clean = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(6)]
    df = clashing(docs(spark, [*clean, clean[0] + " more", clean[1], None, "", "short"]))
    spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for k, (name, stage) in enumerate(cp.STAGES):
        before = df.columns
        stage(spark, df, str(tmp_path)).write.parquet(str(tmp_path / f"{k}"))
        df = spark.read.parquet(str(tmp_path / f"{k}"))
        if name != "byte_bpe":
            assert df.columns == before
        if name == "quality_rules":
            assert {r.doc_id for r in df.collect()} == set(range(8))
        if name == "line_dedup":
            assert {r.doc_id for r in df.collect()} == set(range(7))
        if name == "near_duplicates":
            assert {r.doc_id for r in df.collect()} == set(range(6))
    assert set(df.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Each stage on what the one before kept, against plain Python."""
    import corpus_pipeline as cp
    import tiktoken

    rng = random.Random(21)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randint(0, 300)}"
    passage = " ".join(word() for _ in range(60))
    texts: list = [None, "", "short text", "x y z " * 60]
    for k in range(40):
        lines = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(rng.randint(1, 4))]
        texts.append("\n".join([*lines, passage] if k % 4 == 0 else lines))
    for k in range(20):
        words = rng.choice(texts[4:44]).split(" ")
        words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    df = clashing(docs(spark, texts))
    spark.createDataFrame([(0, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = dict(enumerate(texts))
    stages = dict(cp.STAGES)

    def ran(name):
        nonlocal df
        stages[name](spark, df, str(tmp_path)).write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        return df.collect()

    m = {i: base_measures(t) for i, t in now.items()}
    now = {i: t for i, t in now.items() if m[i][0] >= 50 and 100 * m[i][4] <= 50 * m[i][0]}
    assert {r.doc_id: r.text for r in ran("quality_rules")} == now

    ids = sorted(now)
    gone = lost_lines([now[i] for i in ids], 50)
    for k, i in enumerate(ids):
        lines = now[i].split("\n")
        now[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone[k])
    now = {i: t for i, t in now.items() if WORD.search(t)}
    rows = ran("line_dedup")
    assert {r.doc_id: r.text for r in rows} == now and all(r.n_chars == len(now[r.doc_id]) for r in rows)

    ids = sorted(now)
    roots = brute_components([now[i] for i in ids])
    now = {i: now[i] for k, i in enumerate(ids) if roots[k][1] == k}
    assert {r.doc_id: r.text for r in ran("near_duplicates")} == now and len(now) < len(ids)

    assert collections.Counter((r.doc_id, r.text) for r in ran("mixing")) == collections.Counter(now.items())  # without labels all rates are 1

    path, pattern = bpe.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load(path, pattern).ranks, special_tokens={})
    for r in ran("byte_bpe"):
        coded = library.encode_ordinary(now[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(coded), hashlib.sha256(",".join(map(str, coded)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(now[r.doc_id].encode()).hexdigest()

    empty = docs(spark, [])
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, empty, str(tmp_path)).write.parquet(str(tmp_path / f"empty{k}"))
        assert spark.read.parquet(str(tmp_path / f"empty{k}")).count() == 0, name


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (4, "other text of this id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("en"), "block": F.lit(1), "query": F.lit(2), "__text": F.lit(3)})
    assert ngramjoin.link(spark, df).count() == 5 and ngramjoin.deduplicate(spark, df).columns == df.columns
    labels = spark.createDataFrame([(4, "en"), (4, "fr"), (None, "fr")], "doc_id bigint, domain string")
    mixed, _ = mixing.mix(spark, df, labels)
    assert mixing.apply(df, mixed).columns == df.columns
    marks = spark.createDataFrame([(4, 1), (None, 0)], "doc_id bigint, quality int")
    assert quality.assess(spark, df, marks).count() == 5 and pii.find_spans(df).count() == 5 and bpe.digests(df).count() == 5


def test_a_step_of_the_rates_makes_no_row_for_each_domain(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    p, n, v = rng.dirichlet(np.ones(3), 60), rng.integers(0, 50, 60), [-2.0, 0.3, 1.0]
    made = mixing.moments(spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(n, p, strict=True)], "n long, p array<double>"), v)
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    r = np.maximum(0, 1 + p @ v)
    on, got = r > 0, made.first()
    assert not on.all() and np.allclose([got.have0, got.have1, got.have2], (n * r) @ p) and np.isclose(got.square, (n * r * r) @ p.sum(1))
    gram = (p[on].T * n[on]) @ p[on]
    assert all(np.isclose(got[f"g{i}_{j}"], gram[i, j]) for i in range(3) for j in range(i, 3))
