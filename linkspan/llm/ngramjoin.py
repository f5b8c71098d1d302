"""Jaccard self-join on word n-grams by a token-group matrix.

Documents with equal sets count as one (its smallest doc_id). The join then goes in two rounds.

* Grouping. Documents are compared with three of those that have the same min-hash, for a few min-hashes, half of them
  of the whole set and half of its rarer half, where a common passage can't decide, and a similar size: pairs in number
  linear in the documents, whatever the size of a group. Those that pass the exact test are edges; connected
  documents form a group, cut into blocks of ``BLOCK`` members.
* Search. The token-group matrix holds, for each block, the union of its members' index tokens. A query opens a block
  of another group only if its bound allows a match: tokens are ordered from rare to frequent, and a document whose
  overlap with a smaller member reaches the threshold must share one of its first n - ceil(t n) + 1 tokens with that
  member's first n - ceil(2t / (1 + t) n) + 1. If none is in the union, or all sizes in the block are out of range,
  the bound on the overlap is below what is needed. A second bound, from bit parities of whole sets, rules out most of
  the rest: sets differ by as many tokens as their parities by bits, at least. Opened blocks are compared with the query exactly, member by
  member, until one links (a block is connected already, so one link is all that counts).

Both rounds stream through ``_opened``: rows sorted by block, members first, so a task holds one block at a time. A
block that many documents query is copied, and its queries are dealt among the copies.
The order of tokens comes from counts of all tokens of all documents in a table of fixed size (``BUCKETS``); it
decides about cost only, never about results. Very frequent passages thus stay out of the prefixes.

Components come from alternating large-star and small-star steps over edge tables; edges never reach the driver.

Edge cases: a text without words, or null, has an empty set and links with nothing. Fewer words than n: the whole
sequence is the only token. Rows of equal doc_id are one node; a row without doc_id gets its set size but no
component. Extra columns are ignored (``deduplicate`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .pieces import release

N, THRESHOLD = 5, (75, 100)
#: Members of a block, min-hashes of a document, counters of token frequencies.
BLOCK, KEYS, BUCKETS = 256, 4, 1 << 18
#: Queries that one copy of a block serves; matches of tokens that the search looks at together; steps of components.
QUERIES, MATCHES, MOST_STEPS = 4096, 2_000_000, 200
#: Prefix tokens that a part of the search holds, about.
PART = 1_000_000
PRIME, MIX = np.uint64(0x9E3779B185EBCA87), np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def tokens(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text. bytes.lower and bytes.split know ASCII only, as asked for."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    k = min(n, len(words))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = len(words) - k + 1
    out = np.full(size, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + size]) * PRIME
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    for a in range(0, batch.num_rows, 500):
        for t in batch.column(column).slice(a, 500).to_pylist():
            yield t or ""


def parities(t: np.ndarray) -> bytes:
    """Parities of a set in 2 to 4 bits a token: bit i is odd if an odd number of tokens end in i. Two sets differ by as
    many tokens as their parities by bits, at least; halves of a longer one are folded by exclusive or."""
    size = 1 << max(6, len(t).bit_length() + 1)
    counts = np.bincount((t & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """Lower bound of the number of tokens in which two sets differ, from their parities as bytes."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def _measure(n: int):
    """Each document's set size and digest; at the end of a task the counts of its tokens by bucket, as rows without a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            sizes, digests = [], []
            for text in _texts(batch, 1):
                t = tokens(text, n)
                np.add.at(counts, (t >> np.uint64(64 - 18)).astype(np.int64), 1)
                sizes.append(len(t))
                digests.append(xxhash.xxh3_128_digest(t.tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())], names=["id", "n", "digest"])
        release()
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), pa.nulls(len(used), pa.binary())], names=["id", "n", "digest"])

    return run


def _least(t: np.ndarray, mix: np.ndarray) -> np.ndarray:
    """A min-hash of the tokens for each factor of ``mix``."""
    x = t[:, None] * mix[None, :]
    return (x ^ (x >> np.uint64(32))).min(axis=0)


def _prefixes(n: int, threshold: tuple[int, int], order):
    """id, n, min-hash keys, tokens of the prefix from rare to frequent, how many of them are index tokens, and parities."""
    up, down = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for k, text in enumerate(_texts(batch, 1)):
                t = tokens(text, n)
                size = len(t)
                if not size:
                    continue
                probe = size - -(-up * size // down) + 1
                index = size - -(-2 * up * size // (up + down)) + 1
                by_count = t[np.lexsort((t, counts[(t >> np.uint64(64 - 18)).astype(np.int64)]))]
                first = by_count[:probe]
                # With each a class of sizes, so that the smallest document of a key is no far longer one; limits of classes alternate.
                classes = (np.log(size) / np.log(1.3) + np.arange(KEYS) % 2 / 2).astype(np.uint64)
                keys = (np.concatenate([_least(t, MIX[: KEYS // 2]), _least(by_count[: -(-size // 2)], MIX[KEYS // 2 : KEYS])]) + classes) * PRIME
                rows.append((ids[k], size, keys.view(np.int64), first.view(np.int64), min(index, probe), parities(t)))
                if len(rows) == 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
        release()

    def _batch(rows: list) -> pa.RecordBatch:
        a, b, c, d, e, f = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.list_(pa.int64())), pa.array(d, pa.list_(pa.int64())), pa.array(e, pa.int32()), pa.array(f, pa.binary())], names=["id", "n", "keys", "probe", "n_index", "bits"])

    return run


NONE = np.iinfo(np.int32).max
HEAD = np.dtype([("id", "<i8"), ("root", "<i8"), ("cut", "<i4"), ("n", "<i4"), ("k", "<i8")])


def _dealt(bounds: np.ndarray, salts: np.ndarray, first: np.ndarray, threshold: tuple[int, int]):
    """Rows (id, n, root, cut, probe, n_index) -> rows (part, query, heads, tokens, limits): for each part of the token
    range, documents with their tokens there, as bytes. A range of s salts has s x s parts: query tokens go to one row
    of them, by document, index tokens to one column, by block.

    The limit of a token is the largest set with which it can be the first one shared: at place i of n, at most n - i
    tokens are shared, and a link with a set of m needs t / (1 + t) (n + m) of them, so m <= (1 + t) / t (n - i) - n."""
    up, down = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                yield from deal(whole.slice(a, 2000))

    def deal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(4)
        start = lists.offsets.to_numpy()
        every = lists.values.to_numpy().view(np.uint64)[start[0] : start[-1]]
        n_of = np.diff(start)
        doc = np.repeat(np.arange(batch.num_rows), n_of)
        place = np.arange(len(every)) - np.repeat(start[:-1] - start[0], n_of)
        ids, n, root, cut, n_index = (batch.column(c).to_numpy() for c in (0, 1, 2, 3, 5))
        of_block = ((root.astype(np.uint64) * PRIME + cut.astype(np.uint64) * MIX[0]) >> np.uint64(33)).astype(np.int64)
        range_of = np.searchsorted(bounds, every >> np.uint64(64 - 18), "right") - 1
        size = n.astype(np.int64)[doc]
        limits = np.clip((up + down) * (size - place) // up - size, 0, NONE).astype(np.int32)
        rows: list[tuple[int, int, bytes, bytes, bytes]] = []
        for query in (0, 1):
            use = np.ones(len(every), bool) if query else place < n_index[doc]
            t, d, r, m = every[use], doc[use], range_of[use], limits[use]
            salt = (d if query else of_block[d]) % salts[r]
            by = np.lexsort((d, salt, r))
            t, d, r, m, salt = t[by], d[by], r[by], m[by], salt[by]
            for x, y in zip(cuts := np.flatnonzero(np.diff(first[r] + salt, prepend=-1)), [*cuts[1:], len(r)], strict=True):
                heads = np.flatnonzero(np.diff(d[x:y], prepend=-1))
                who = d[x:y][heads]
                h = np.zeros(len(who), HEAD)
                h["id"], h["root"], h["cut"], h["n"], h["k"] = ids[who], root[who], cut[who], n[who], np.diff([*heads, y - x])
                s, at = int(salts[r[x]]), int(salt[x])
                for other in range(s):
                    rows.append((int(first[r[x]]) + (at * s + other if query else other * s + at), query, h.tobytes(), t[x:y].tobytes(), m[x:y].tobytes()))
        if rows:
            a, b, *c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), *[pa.array(x, pa.binary()) for x in c]], names=["part", "query", "heads", "tokens", "limits"])

    return run


def _searched(threshold: tuple[int, int]):
    """Rows of _dealt, sorted by part and query -> (id, root, cut) of the blocks that a document's bound doesn't rule out."""
    up, down = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, matrix = None, [], None
        for batch in batches:
            found = []
            for key, query, heads, raw, most in zip(*(batch.column(c) for c in range(5)), strict=True):
                if key.as_py() != part:
                    part, held, matrix = key.as_py(), [], None
                h, t, limit = np.frombuffer(heads.as_buffer(), HEAD), np.frombuffer(raw.as_buffer(), np.uint64), np.frombuffer(most.as_buffer(), np.int32)
                if not query.as_py():
                    held.append((h, t, limit))
                    continue
                if not held:
                    continue
                if matrix is None:
                    matrix = union(held)
                tokens_, root, cut, low, high, reach = matrix
                doc = np.repeat(np.arange(len(h)), h["k"])
                a, b = np.searchsorted(tokens_, t, "left"), np.searchsorted(tokens_, t, "right")
                ends = np.cumsum(b - a)
                for x in range(0, int(ends[-1]) if len(ends) else 0, MATCHES):  # by matches: a token may be in any number of blocks
                    which = np.arange(x, min(x + MATCHES, int(ends[-1])))
                    token = np.searchsorted(ends, which, "right")
                    at = which - ends[token] + b[token]
                    q = h[doc[token]]
                    near = (low[at] <= limit[token]) & (reach[at] >= q["n"])
                    ok = near & (q["root"] != root[at]) & (low[at] <= q["n"]) & (high[at].astype(np.int64) * down >= q["n"].astype(np.int64) * up)
                    if ok.any():
                        found.append(np.unique(np.stack([q["id"][ok], root[at][ok], cut[at][ok]]), axis=1))
            some = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in some], names=["id", "root", "cut"])

    def union(held: list) -> tuple[np.ndarray, ...]:
        """The token-group matrix of a part: (token, block) once, with the least and largest set size of the block's members there and their largest limit."""
        h, t, limit = (np.concatenate([x[k] for x in held]) for k in range(3))
        doc = np.repeat(np.arange(len(h)), h["k"])
        root, cut, n = h["root"][doc], h["cut"][doc], h["n"][doc]
        by = np.lexsort((cut, root, t))
        t, root, cut, n, limit = t[by], root[by], cut[by], n[by], limit[by]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 0) | (np.diff(root) != 0) | (np.diff(cut) != 0)]))
        return t[new], root[new], cut[new].astype(np.int64), np.minimum.reduceat(n, new), np.maximum.reduceat(n, new), np.maximum.reduceat(limit, new)

    return run


def _packed(n: int):
    """Text in the last column -> its tokens as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a in range(0, batch.num_rows, 200):
                raw = [tokens(t or "", n).tobytes() for t in batch.column(1).slice(a, 200).to_pylist()]
                yield pa.RecordBatch.from_arrays([ids.slice(a, len(raw)), batch.column(2).slice(a, len(raw)), pa.array(raw, pa.binary())], names=["id", "uses", "set"])

    return run


def _bounded(threshold: tuple[int, int]):
    """Rows (block, query, id, n, bits) sorted by block and query, members first -> (id, block, query) of the queries
    whose bound on the overlap with some member of the block reaches the threshold."""
    up, down = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members = None, []
        for batch in batches:
            ids, blocks = [], []
            for key, query, doc, n, raw in zip(*(batch.column(c).to_pylist() for c in range(4)), batch.column(4), strict=True):
                if key != block:
                    block, members = key, []
                bits = np.frombuffer(raw.as_buffer(), np.uint8)
                if not query:
                    members.append((n, bits))
                elif any(least_difference(bits, b) * (up + down) <= (n + m) * (down - up) for m, b in members if m * down >= n * up and n * down >= m * up):
                    ids.append(doc)
                    blocks.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blocks, pa.int64())], names=["id", "block"])

    return run


def _opened(threshold: tuple[int, int]):
    """Rows (block, query, id, set) sorted by block and query, members (query 0) first -> edges (a, b), one for each
    query that links with the block."""
    up, down = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, index = None, [], None
        for batch in batches:
            left, right = [], []
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True)
            for key, query, doc, raw in rows:
                if key != block:
                    block, members, index = key, [], None
                t = np.frombuffer(raw.as_buffer(), np.uint64)
                if not query:
                    members.append((doc, t))
                    index = None
                    continue
                if not members:
                    continue
                if index is None:
                    size = np.array([len(m) for _, m in members])
                    every, owner = np.concatenate([m for _, m in members]), np.repeat(np.arange(len(members)), size)
                    by = np.argsort(every, kind="stable")
                    index = every[by], owner[by], size
                every, owner, size = index
                low, high = np.searchsorted(every, t, "left"), np.searchsorted(every, t, "right")
                n = high - low
                at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                shared = np.bincount(owner[at], minlength=len(members))
                hit = np.flatnonzero(down * shared >= up * (size + len(t) - shared))
                if len(hit):
                    left.append(doc)
                    right.append(members[hit[0]][0])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _ranges(counts: np.ndarray, threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of the leading bits of tokens with about PART prefix tokens each: their first counters, the number of
    salts of each (over 1 where a single counter has more), and the number of the first part."""
    share = 1 - threshold[0] / threshold[1]
    load = np.maximum(counts * share, 1)
    most = min(PART, max(1.0, load.sum() / 24))
    bounds = np.flatnonzero(np.diff((np.cumsum(load) - load) // most, prepend=-1))
    of = np.add.reduceat(load, bounds)
    salts = np.maximum(1, of // (2 * most)).astype(np.int64)
    return bounds, salts, np.cumsum(salts**2) - salts**2


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) of every id in ``edges`` (a, b): root is the smallest id of its component. Large-star and small-star
    steps alternate until the edges no longer change; each step is an aggregation and a join."""
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    mark = None
    for step in range(1, MOST_STEPS + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        after = scratch.write(moved, f"edges-{step}")
        scratch.drop(f"edges-{step - 1}")
        now = after
        new = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components still change after {MOST_STEPS} steps")
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))


def _free(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of what has been written and isn't referred to any more. The removal is the
    work of a thread that the collectors wake, so it gets a moment, twice: what the first round frees holds others."""
    import gc
    import time

    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def link(spark: SparkSession, docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    scratch = Scratch(spark, "ngrams")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    both = scratch.write(docs.mapInArrow(_measure(n), "id bigint, n bigint, digest binary"), "measured")
    measured = both.where("digest is not null")
    counts = np.zeros(BUCKETS, np.int64)
    for r in both.where("digest is null").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():  # BUCKETS rows at most
        counts[r.id] = r.n
    order = spark.sparkContext.broadcast(counts)

    # Documents with equal sets are one. Rows of equal doc_id but other texts are edges.
    sets = measured.where("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep"))
    named = scratch.write(measured.where("n > 0 and id is not null").join(sets, "digest").select("id", "rep"), "named")
    same = named.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    prefix = scratch.write(docs.where("id is not null").mapInArrow(_prefixes(n, threshold, order), "id bigint, n bigint, keys array<bigint>, probe array<bigint>, n_index int, bits binary"), "prefix")
    narrow = prefix.select("id", "n", "keys").join(named.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")

    facts = prefix.select("id", "n", "bits")

    def opened(asked: DataFrame, members: DataFrame, name: str) -> DataFrame:
        """Edges from queries and members, both (id, block). Blocks are opened for the queries whose bound, from set
        sizes and parities, allows a link. Texts travel once, sets once for each open block. A block that more than
        QUERIES documents ask for is copied; each copy is a block of its own with a part of the queries."""
        hot = asked.groupBy(F.col("block").alias("hot")).agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("copies")).where("copies > 1")
        copies = lambda df: df.join(hot, F.col("block") == F.col("hot"), "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
        copy = lambda salt: F.when(F.col("copies") > 1, F.xxhash64("block", salt)).otherwise(F.col("block")).alias("block")
        asked = copies(asked).select("id", copy(F.pmod(F.xxhash64("id"), F.col("copies"))))
        members = copies(members).select("id", "block", "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("salt")).select("id", copy(F.col("salt")))
        ask, hold = asked.select("block", F.lit(1).alias("query"), "id"), members.select("block", F.lit(0).alias("query"), "id")
        known = ask.unionByName(hold).join(facts, "id").select("block", "query", "id", "n", "bits")
        known = known.repartition("block").sortWithinPartitions("block", "query")
        kept = scratch.write(known.mapInArrow(_bounded(threshold), "id bigint, block bigint"), f"{name}-kept")
        hold = hold.join(kept.select("block").distinct(), "block", "left_semi").select("id", "block", "query")
        rows = kept.select("id", "block", F.lit(1).alias("query")).unionByName(hold)
        uses = rows.groupBy("id").agg(F.collect_set(F.struct("block", "query")).alias("uses"))
        # Hashed by id at every size: no sort of texts, and the same plan for small and large inputs.
        texts = docs.join(uses.hint("shuffle_hash"), "id").select("id", "text", "uses")
        packed = texts.mapInArrow(_packed(n), "id bigint, uses array<struct<block:bigint,query:int>>, set binary")
        flat = packed.select(F.explode_outer("uses").alias("u"), "id", "set").select("u.block", "u.query", "id", "set")
        flat = flat.repartition("block").sortWithinPartitions("block", "query")
        return scratch.write(flat.mapInArrow(_opened(threshold), "a bigint, b bigint"), name)

    # Round 1: stars around three documents of each min-hash, the smallest, the largest and one by hash: who isn't
    # similar enough to one of them, but to most of the group, is to another.
    keyed = narrow.select("id", F.posexplode_outer("keys").alias("which", "key"))
    pivots = keyed.groupBy("which", "key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("z"), F.count(F.lit(1)).alias("m")).where("m > 1").select("which", "key", F.array("x", "y", "z").alias("hubs"))
    stars = keyed.join(pivots, ["which", "key"]).select("id", F.explode(F.array_distinct("hubs")).alias("block")).where("id <> block").distinct()
    stars = scratch.write(stars, "stars")
    hubs = stars.select(F.col("block").alias("id"), "block").distinct()
    near = opened(stars, hubs, "near")
    _free(spark)
    groups = components(spark, near.unionByName(same), scratch)
    groups = scratch.write(groups, "groups")

    # Round 2: the token-group matrix over blocks of the groups.
    placed = narrow.select("id", "n").dropDuplicates(["id"]).join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
    sized = placed.groupBy("root").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK)
    cut = F.coalesce(F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / BLOCK)), F.lit(0)).cast("int")
    placed = scratch.write(placed.join(sized, "root", "left").select("id", "root", cut.alias("cut")), "placed")
    bounds, salts, first = _ranges(counts, threshold)
    input_ = prefix.select("id", F.col("n").cast("int").alias("n"), "probe", "n_index").join(placed, "id").select("id", "n", "root", "cut", "probe", "n_index")
    dealt = input_.mapInArrow(_dealt(bounds, salts, first, threshold), "part bigint, query int, heads binary, tokens binary, limits binary")
    dealt = dealt.repartition("part").sortWithinPartitions("part", "query")
    found = scratch.write(dealt.mapInArrow(_searched(threshold), "id bigint, root bigint, cut bigint").distinct(), "found")
    _free(spark)
    block = F.xxhash64("root", F.col("cut").cast("bigint")).alias("block")
    wanted = found.select("root", F.col("cut").cast("int").alias("cut")).distinct()
    members = placed.join(wanted, ["root", "cut"], "left_semi").select("id", block)
    found = found.select("id", block)
    far = opened(found, members, "far")
    _free(spark)

    roots = scratch.write(components(spark, near.unionByName(far).unionByName(same), scratch), "roots")
    scratch.keep("measured", "roots")
    out = measured.select("id", "n").join(roots, "id", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))


def deduplicate(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component; of rows with equal doc_id one stays, rows without doc_id all."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = link(spark, docs, **options).where("doc_id = component_id").select(F.col("doc_id").alias("id2")).distinct()
    rows = docs.select(whole.alias("doc"), F.col("doc_id").cast("bigint").alias("id"))
    one = rows.where("id is not null").join(kept, F.col("id") == F.col("id2"), "left_semi")
    repeated = one.groupBy("id").agg(F.min(F.xxhash64("doc.text")).alias("h"), F.count(F.lit(1)).alias("m")).where("m > 1")
    first = one.join(repeated, "id", "left_anti").select("doc.*").unionByName(one.join(repeated, "id").dropDuplicates(["id"]).select("doc.*"))
    return first.unionByName(rows.where("id is null").select("doc.*"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark, table(spark, sf_dir, "documents"))
