"""Language of web pages by Bayesian fusion of evidence.

log posterior(language) = log likelihood of the text + log likelihood of the declared language + log likelihood of the
address suffix + log prior of the host.

* Text: hashed byte trigrams of the visible text under models of the labelled ``documents``, fitted on a bounded sample
  (``PER_LANGUAGE`` documents of smallest hash for each language); evidence is scaled to ``EVIDENCE`` trigrams at most.
* Declared: ``lang`` of the first html element agrees with the truth with probability ``TRUST_DECLARED``.
* Suffix: country domain or language segment of the path, with ``TRUST_SUFFIX``.
* Host: a page's own evidence without the host is soft-counted by host, registered domain and all pages, by grouped
  aggregation, combined before the shuffle; pages without a host have the prior of all pages, and the others meet their
  host's row in a join whose hot keys Spark splits. The prior of a host is smoothed with ``PULL`` pages of its domain's, a domain's with as many of the
  whole. The page's own count is taken out of its prior.

Pages are read by one forward scan, linear in their length. Edge cases: null or empty html has no text and nothing
declared; a null or strange url has the empty host. Unknown languages are no evidence. Without labelled documents, or pages, there are no rows. Repeated rows are judged alike.
Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, smallest, table

PER_LANGUAGE, CELLS, EVIDENCE = 500, 1 << 14, 120.0
TRUST_DECLARED, TRUST_SUFFIX, PULL = 0.9, 0.85, 10.0
#: Languages of country domains.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en"}

#: Second-level labels under country domains beneath which names are registered.
SECOND_LEVEL = {"ac", "co", "com", "edu", "gob", "gov", "gouv", "ltd", "me", "mil", "net", "nom", "or", "org", "sch"}

_name = re.compile(r"[A-Za-z][A-Za-z0-9:-]*").match
_attribute = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?").finditer
_ends = {t: re.compile(rf"</{t}(?![A-Za-z0-9-])", re.I).search for t in ("script", "style", "noscript", "template")}
_url = re.compile(r"^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)", re.I).match


def scan(page: str) -> tuple[str, str]:
    """The visible text of a page, with blanks for tags, and the language that its first html element declares ('' for
    none). One pass forward: what is opened and never closed (a comment, a tag, a script) reaches to the end of the page."""
    out, declared, seen, at = [], "", False, 0
    while (start := page.find("<", at)) >= 0:
        out += [page[at:start], " "]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        m = _name(page, start + 1)
        end = page.find(">", start)
        if end < 0:
            # Nothing closes: a tag to the end, or a plain sign before text.
            if not m and not page.startswith(("</", "<!"), start):
                out.append(page[start + 1 :])
            at = len(page)
            break
        name = m.group().lower() if m else ""
        if name == "html" and not seen:
            seen = True
            for a in _attribute(page, m.end(), end):
                if a.group(1).lower() == "lang":
                    declared = (a.group(2) or a.group(3) or a.group(4) or "").strip().lower()
                    break
        at = end + 1
        if name in _ends:
            close = _ends[name](page, at)
            last = page.find(">", close.end()) if close else -1
            at = last + 1 if last >= 0 else len(page)
    out.append(page[at:])
    return entities.unescape("".join(out)), declared[:2] if re.match(r"[a-z]{2,3}(?![a-z])", declared) else ""


def cells(text: str) -> np.ndarray:
    """Hash cells of the byte trigrams of a lower-case text, runs of other characters than letters as one blank."""
    b = np.frombuffer((" " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " ").encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    x = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((x * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)


def place(url: str) -> tuple[str, str, str]:
    """Host, registered domain and the language of the suffix or path, '' where there is none. An address in numbers is
    its own domain; of a name the last two labels are, or three where the last but one is a registry's."""
    m = _url(url or "")
    if not m:
        return "", "", ""
    place_ = m.group(1).rpartition("@")[2].lower()
    first = next((p for p in m.group(2).lower().split("/") if p), "")
    spoken = first if len(first) == 2 else ""
    if place_.startswith("["):
        host = place_.partition("]")[0] + "]"
        return host, host, spoken
    host = place_.partition(":")[0].rstrip(".").removeprefix("www.")
    labels = host.split(".")
    if all(x.isdigit() for x in labels):
        return host, host, spoken
    own = 3 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVEL else 2
    return host, ".".join(labels[-own:]), SUFFIXES.get(labels[-1], "") or spoken


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log likelihoods of the cells by language. Counts leave the executors as one row for each task and language."""
    known = docs.where("doc_id is not null and lang is not null and text is not null")
    chosen = smallest(known.groupBy("doc_id").agg(F.min("lang").alias("lang")), "lang", "doc_id", PER_LANGUAGE)
    # Ids are chosen first and written, so Spark knows how few they are and only the texts chosen travel. Of rows with one
    # id the smallest text counts.
    chosen = Scratch(docs.sparkSession, "sample").write(chosen, "chosen")
    sample = known.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(F.min("lang").alias("lang"), F.min("text").alias("text")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[lang] = counts.get(lang, 0) + np.bincount(cells(text), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.astype("<i8").tobytes() for c in counts.values()], pa.binary())], names=["lang", "counts"])

    total: dict[str, np.ndarray] = {}
    for r in sample.mapInArrow(run, "lang string, counts binary").toLocalIterator():
        total[r.lang] = total.get(r.lang, 0) + np.frombuffer(r.counts, "<i8")
    langs = sorted(total)
    if not langs:
        return [], np.zeros((CELLS, 0))
    c = np.stack([total[x] for x in langs], axis=1) + 0.5
    return langs, np.log(c / c.sum(axis=0))


def identify(spark: SparkSession, pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, host, declared, suffix, text_lang, lang, confidence) of every page."""
    langs, model = fit(docs)
    if not langs:
        return spark.createDataFrame([], "page_id bigint, host string, declared string, suffix string, text_lang string, lang string, confidence double")
    shared, k = spark.sparkContext.broadcast(model.astype(np.float32)), len(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lp = shared.value
        for batch in batches:
            rows = []
            for page_id, url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                page = page or ""
                said, declared = scan(page)
                x = cells(said)
                text = lp[x].sum(axis=0, dtype=np.float64) * min(1.0, EVIDENCE / max(len(x), 1))
                rows.append((page_id, *place(url), declared, (text - text.max()).round(6)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:5]], pa.array(cols[5], pa.list_(pa.float64()))], names=["page_id", "host", "domain", "suffix", "declared", "text"])

    told = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(run, "page_id bigint, host string, domain string, suffix string, declared string, text array<double>")

    def says(column: str, trust: float) -> list:
        """Log likelihood of what is declared, given each language; none where it is no known language."""
        return [F.when(F.col(column) == x, F.log(F.lit(trust))).when(F.col(column).isin(langs), F.log(F.lit((1 - trust) / max(k - 1, 1)))).otherwise(F.lit(0.0)) for x in langs]

    def softmax(scores: str):
        e = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
        return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))

    own = [F.col("text")[i] + d + s for i, (d, s) in enumerate(zip(says("declared", TRUST_DECLARED), says("suffix", TRUST_SUFFIX), strict=True))]
    seen = told.withColumn("own", F.array(*own)).withColumn("p", softmax("own"))
    seen = Scratch(spark, "langid").write(seen, "evidence")
    count = lambda df, keys, mark: df.groupBy(*keys).agg(*[F.sum(F.col("p")[i]).alias(f"{mark}{i}") for i in range(k)])
    hosts = count(seen, ["host", "domain"], "h")
    domains = hosts.groupBy(F.col("domain").alias("domain2")).agg(*[F.sum(f"h{i}").alias(f"d{i}") for i in range(k)])
    world = [float(x or 0.0) for x in hosts.agg(*[F.sum(f"h{i}") for i in range(k)]).first()]
    base = [(x + 1.0) / (sum(world) + k) for x in world]
    both = hosts.join(domains, F.col("domain") == F.col("domain2")).select(F.col("host").alias("host2"), *[f"h{i}" for i in range(k)], *[f"d{i}" for i in range(k)])
    counts = [*[f"h{i}" for i in range(k)], *[f"d{i}" for i in range(k)]]
    all_ = seen.where("host <> ''").join(both, F.col("host") == F.col("host2"), "left").select(*seen.columns, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in counts])
    all_ = all_.unionByName(seen.where("host = ''").select(*seen.columns, *[F.lit(0.0).alias(c) for c in counts]))
    less = lambda mark, i: F.greatest(F.col(f"{mark}{i}") - F.col("p")[i], F.lit(0.0))
    total = lambda mark: sum((less(mark, i) for i in range(k)), F.lit(0.0))
    all_ = all_.withColumn("dp", F.array(*[(less("d", i) + PULL * base[i]) / (total("d") + PULL) for i in range(k)]))
    all_ = all_.withColumn("hp", F.array(*[(less("h", i) + PULL * F.col("dp")[i]) / (total("h") + PULL) for i in range(k)]))
    all_ = all_.withColumn("score", F.array(*[F.col("own")[i] + F.log(F.col("hp")[i]) for i in range(k)])).withColumn("post", softmax("score"))
    best = lambda scores: F.get(F.array(*map(F.lit, langs)), (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
    return all_.select("page_id", "host", "declared", "suffix", best("text").alias("text_lang"), best("post").alias("lang"), F.round(F.array_max("post"), 6).alias("confidence"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
