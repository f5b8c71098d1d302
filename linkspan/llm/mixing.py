"""Mixing sources to target weights with soft membership. DataFrame functions only.

1. A naive Bayes model over hashed words learns the domains of a labelled table. A domain that mixes languages is
   learned as one class for each of its ``PARTS`` most frequent parts, and one that all further parts share. The model is fitted on a bounded sample: the ``PER_DOMAIN`` labelled
   documents of smallest hash for each class.
2. Every document gets posteriors p over the domains from all its words, repeated ones each time. Naive Bayes counts each word as independent
   evidence, so the evidence of a text is scaled to that of ``EVIDENCE`` words at most; memberships stay soft.
3. Rates r >= 0 of the documents are fitted so that the expected tokens of each domain, sum(r * n * p), match
   ``total * target``: projected-gradient least squares with lazy projection. Gradients add up in a vector v of the
   length of the domains, and the rates are the projection max(0, 1 + v . p) on what is allowed. With M = diag(n) p, the
   gradient of a step is b - M'r, scaled by the Gram matrix p' diag(n) p of the rows whose rate is positive, and
   halved until it lowers the sum of squares. ``RIDGE`` keeps v finite where no rates reach the targets; the rates are
   then the closest, and a warning tells the miss. Steps go on until the residual is below ``TOLERANCE`` of the total
   or the gradient vanishes; after ``MOST_STEPS`` there is an error. A step is one aggregation of few sums over a narrow
   table; the driver holds v alone.
4. A document is copied floor(r) times, and once more if its hash falls below the rest.

``total`` is chosen so that no domain of ``keep`` has to shrink: the largest available / target among them, times
``HEADROOM`` so that small leaks of membership don't push clean documents under one copy.

Edge cases: a null or empty text has no tokens; its posteriors are the priors and its rate follows from them. Labels
that are null or of unknown documents are ignored; a document with several labels takes the first by name. Targets of
domains without labelled rows are dropped and the others scaled up; without any domain all rates are 1. Repeated rows
get the same rate and copies. Extra columns stay, whatever their names.
"""

from __future__ import annotations

import warnings
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, smallest, table, words

#: Hash buckets of the model, labelled documents for each domain, words of evidence, smoothing.
BUCKETS, PER_DOMAIN, EVIDENCE, SMOOTHING = 16384, 4000, 400.0, 2.0
#: Most parts of a domain that get a class of their own; further parts share one more class.
PARTS = 8
TOLERANCE, HEADROOM = 1e-6, 1.1
#: Weight of the squares that hold rates near 1 where targets leave a choice; steps after which the fit gives up with an error.
RIDGE, MOST_STEPS = 1e-8, 500
#: Target shares of the domains: languages of good documents, and two that are to be nearly absent.
TARGETS = {"en": 0.5, "fr": 0.17, "de": 0.17, "es": 0.14, "low": 0.01, "toxic": 0.01}
KEEP = ("en", "fr", "de", "es")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _lower(text: Column) -> Column:
    """The lower-case words of a text, each as often as it stands there."""
    return words(F.lower(text))


def label_domains(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, domain, part) of the labelled documents: toxic, low (quality 0), or the language; part is the language."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    langs = docs.select("doc_id", "lang").where("lang is not null").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise(F.col("lang"))
    return known.join(langs, "doc_id").select("doc_id", domain.alias("domain"), F.col("lang").alias("part"))


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], per_domain: int = PER_DOMAIN) -> DataFrame:
    """(bucket, lp): a row for each bucket, lp the log likelihoods of the values of ``domain``. ``BUCKETS`` rows: its size is fixed."""
    marks = smallest(labelled.where(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain")), "domain", "doc_id", per_domain)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(marks, "doc_id")
    counts = texts.select("domain", F.explode_outer(_lower(F.col("text"))).alias("word")).where("word is not null").groupBy(_bucket(F.col("word")).alias("bucket"), "domain").agg(F.count(F.lit(1)).alias("n"))
    wide = counts.groupBy("bucket").agg(*[F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, d in enumerate(domains)])
    every = docs.sparkSession.range(BUCKETS, numPartitions=1).select(F.col("id").cast("int").alias("bucket")).join(wide, "bucket", "left").select("bucket", *[F.coalesce(f"n{k}", F.lit(0)).alias(f"n{k}") for k in range(len(domains))])
    all_of = every.agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(domains))]).first()
    return every.select("bucket", F.array(*[F.log((F.col(f"n{k}") + SMOOTHING) / F.lit(float((all_of[k] or 0) + SMOOTHING * BUCKETS))) for k in range(len(domains))]).alias("lp"))


def posteriors(docs: DataFrame, model: DataFrame, priors: list[float], of: list[int], evidence: float = EVIDENCE) -> DataFrame:
    """doc_id, th (xxhash64 of the text), n (words) and p (posteriors) of each distinct pair of doc_id and text.
    ``of``: the number of the domain of each class; a domain's posterior is the sum of its classes'."""
    size = len(priors)
    # What stands beside a generator is worked out for each row it makes: hash and size have a step of their own.
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), _lower(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    rows = texts.select("doc_id", "th", "n", F.explode_outer("words").alias("word"))
    scored = rows.select("doc_id", "th", "n", _bucket(F.col("word")).alias("bucket")).join(F.broadcast(model), "bucket", "left")
    sums = scored.groupBy("doc_id", "th").agg(F.count("bucket").alias("m"), F.first("n").cast("bigint").alias("n"), *[F.coalesce(F.sum(F.col("lp")[k]), F.lit(0.0)).alias(f"s{k}") for k in range(size)])
    # Repeated rows add up in m and in the sums alike: the mean of a word, times the words that count.
    scale = F.least(F.col("n").cast("double"), F.lit(evidence)) / F.greatest(F.col("m"), F.lit(1))
    logs = sums.select("doc_id", "th", "n", F.array(*[F.lit(priors[k]) + scale * F.col(f"s{k}") for k in range(size)]).alias("g"))
    raised = logs.select("doc_id", "th", "n", F.transform("g", lambda x: F.exp(x - F.array_max("g"))).alias("e"))
    raised = raised.withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    domain = lambda d: sum((F.col("e")[k] for k in range(size) if of[k] == d), F.lit(0.0))
    return raised.select("doc_id", "th", "n", F.array(*[F.round(domain(d) / F.col("total"), 9) for d in range(max(of) + 1)]).alias("p"))


def solve(a: list[list[float]], b: list[float]) -> list[float]:
    """x of a x = b by elimination with pivots; ``a`` is as small as the domains are few."""
    n = len(b)
    m = [[*row, y] for row, y in zip(a, b, strict=True)]
    for k in range(n):
        top = max(range(k, n), key=lambda i: abs(m[i][k]))
        m[k], m[top] = m[top], m[k]
        for i in range(k + 1, n):
            f = m[i][k] / m[k][k]
            m[i] = [x - f * y for x, y in zip(m[i], m[k], strict=True)]
    x = [0.0] * n
    for k in reversed(range(n)):
        x[k] = (m[k][n] - sum(m[k][j] * x[j] for j in range(k + 1, n))) / m[k][k]
    return x


def rate(v: list[float]) -> Column:
    """max(0, 1 + v . p). The vector is one literal array, so the plan and its generated code are the same for all."""
    return F.greatest(F.lit(0.0), F.aggregate(F.zip_with(F.lit(v), "p", lambda x, y: x * y), F.lit(1.0), lambda a, x: a + x))


def moments(soft: DataFrame, v: list[float]) -> DataFrame:
    """One row, of the rows of positive rate: expected tokens of the domains (have), tokens times squared rate (square),
    Gram matrix (g, its upper half). A document is one row throughout: a step makes no row for each of its domains."""
    rows = soft.select(F.col("n").cast("double").alias("n"), "p", rate(v).alias("r")).where("r > 0")
    p = [F.col("p")[i] for i in range(len(v))]
    mass = F.col("n") * F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    have = [F.sum(F.col("n") * x * F.col("r")).alias(f"have{i}") for i, x in enumerate(p)]
    gram = [F.sum(F.col("n") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(len(v)) for j in range(i, len(v))]
    return rows.agg(*have, F.sum(mass * F.col("r") * F.col("r")).alias("square"), *gram)


def fit_rates(soft: DataFrame, shares: list[float], keep: list[int], tolerance: float = TOLERANCE, headroom: float = HEADROOM) -> tuple[Column, dict]:
    """The rate as an expression over ``p``, and a report: available, wanted and reached tokens of the domains, steps,
    and miss, the largest difference as a share of all wanted tokens (over ``tolerance`` only where no rates reach the
    targets; then the rates are the closest in least squares, and a warning says so)."""
    size = len(shares)
    dot = lambda x, y: sum(a * b for a, b in zip(x, y, strict=True))
    times = lambda g, x: [dot(row, x) for row in g]

    def sums(v: list[float]) -> tuple[list[float], float, list[list[float]]]:
        got = moments(soft, v).first()
        of = lambda name: float(got[name] or 0.0)
        return [of(f"have{i}") for i in range(size)], of("square"), [[of(f"g{min(i, j)}_{max(i, j)}") for j in range(size)] for i in range(size)]

    v = [0.0] * size
    have, square, whole = sums(v)
    if not sum(have):
        return F.lit(1.0), {"available": have, "wanted": have, "reached": have, "steps": 0, "miss": 0.0}
    total = headroom * max([have[k] / shares[k] for k in keep if shares[k] > 0], default=sum(have))
    want = [total * s for s in shares]
    miss = lambda reached: max(abs(w - x) for w, x in zip(want, reached, strict=True)) / total
    ridge = [[RIDGE * x + (1e-12 * sum(have) if i == j else 0.0) for j, x in enumerate(row)] for i, row in enumerate(whole)]
    value = lambda v, square: square / 2 - dot(want, v) + dot(v, times(ridge, v)) / 2
    reached, gram, now, steps = have, whole, value(v, square), 0
    while miss(reached) > tolerance:
        slope = [w - x - y for w, x, y in zip(want, reached, times(ridge, v), strict=True)]
        if max(map(abs, slope)) <= tolerance * total / 10:
            break
        up = solve([[x + y for x, y in zip(a, b, strict=True)] for a, b in zip(gram, ridge, strict=True)], slope)
        length, gain = 1.0, dot(slope, up)
        while True:
            if (steps := steps + 1) > MOST_STEPS:
                raise RuntimeError(f"the rates still miss {miss(reached):.2g} of all tokens after {MOST_STEPS} steps")
            after = [x + length * y for x, y in zip(v, up, strict=True)]
            got, square, next_gram = sums(after)
            if (then := value(after, square)) <= now - 1e-4 * length * gain + 1e-13 * abs(now):
                break
            length /= 2
        v, now, reached, gram = after, then, got, next_gram
    if (least := miss(reached)) > tolerance:
        warnings.warn(f"no rates reach the targets: the closest miss {least:.2g} of all tokens in a domain", stacklevel=2)
    return rate(v), {"available": have, "wanted": want, "reached": reached, "steps": steps, "miss": least}


def mix(spark: SparkSession, docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, keep: tuple[str, ...] = KEEP, **options) -> tuple[DataFrame, dict]:
    """(doc_id, th, n, p, rate, copies) for each distinct pair of doc_id and text, and the report of the fit with its domains."""
    scratch = Scratch(spark, "mixing")
    part = F.col("part") if "part" in labelled.columns else F.lit("")
    marks = labelled.where(F.col("domain").isin(list(targets))).groupBy("doc_id").agg(F.min(F.struct("domain", F.coalesce(part, F.lit("")).alias("part"))).alias("m"))
    marks = scratch.write(marks.select("doc_id", "m.domain", "m.part"), "labelled")
    order = W.partitionBy("domain").orderBy(F.col("n").desc(), "part")
    parts = marks.groupBy("domain", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", F.least(F.row_number().over(order), F.lit(PARTS + 1)))
    parts = parts.groupBy("domain", "rank").agg(F.sum("n").alias("n"), F.min("part").alias("part"))
    seen = [r for r in parts.orderBy("domain", "rank").collect() if targets[r.domain] > 0]  # PARTS + 1 rows for each target
    domains = [d for d in targets if any(r.domain == d for r in seen)]
    if not domains:
        soft = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words(F.col("text"))).cast("bigint").alias("n")).distinct()
        return soft.select("*", F.array().cast("array<double>").alias("p"), F.lit(1.0).alias("rate"), F.lit(1).cast("bigint").alias("copies")), {"domains": []}
    known, share = sum(r.n for r in seen), sum(targets[d] for d in domains)
    own = F.concat_ws("/", "domain", "part")
    names = [f"{r.domain}/{r.part}" if r.rank <= PARTS else r.domain for r in seen]  # the shared class has the domain's name
    classes = marks.select("doc_id", F.when(own.isin(names), own).otherwise(F.col("domain")).alias("domain"))
    model = scratch.write(fit(docs, classes, names), "model")
    soft = scratch.write(posteriors(docs, model, [log(r.n / known) for r in seen], [domains.index(r.domain) for r in seen]), "soft")
    each, report = fit_rates(soft, [targets[d] / share for d in domains], [k for k, d in enumerate(domains) if d in keep], **options)
    scratch.keep("soft")
    out = soft.withColumn("rate", F.round(each, 6))
    luck = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "th"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return out.withColumn("copies", (F.floor("rate") + (luck < F.col("rate") - F.floor("rate")).cast("int")).cast("bigint")), report | {"domains": domains}


def apply(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with each row as often as its copies say."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    times = mixed.select(F.col("doc_id").alias("id2"), F.col("th").alias("h2"), "copies")
    both = rows.join(times, F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2"))).where("copies > 0")
    return both.select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("doc.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed, report = mix(spark, docs, label_domains(table(spark, sf_dir, "labels"), docs))
    named = [F.coalesce(F.get("p", F.lit(report["domains"].index(d))), F.lit(0.0)).alias(f"p_{d}") if d in report["domains"] else F.lit(0.0).alias(f"p_{d}") for d in TARGETS]
    return mixed.select("doc_id", F.col("n").alias("n_tokens"), *named, "rate", "copies", F.lit(float(report.get("miss", 0.0))).alias("miss"))
