"""Scores of the pairs of a country that share tokens, as products of blocks of two sparse matrices.

With long texts most pairs of a country share some token, and a join makes a row for each token of each pair. Here S1
records and candidates are dealt into blocks by hash; a task has a block of S1 records and a range of blocks of candidates
of its country, and sums the weights of their shared tokens in arrays: tokens of many candidates by a dense product, all
others by their postings. Every pair is scored with all its tokens. Rows are made only for what the caller asks: all
pairs, the number of them, or the best of each S1 among the task's candidates, from which the best of all follow.

Records are packed where they are read: the records of a block that a task of the reader has become one compressed row, with
each token's text once. Only packs are sent to the tasks that need them, and a task opens them one block at a time.

Weights are whole millionths and sums stay below 2^53, so doubles hold them exactly, in any order. Weights must be above
zero; those of ``blocking`` are, for caps below two million."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import SEPARATOR

#: Most S1 records and candidates of a block, most characters of a block's tokens. A table of few blocks is cut into up to
#: ``LEAST_BLOCKS`` of at least ``SMALL`` S1 records.
S1_BLOCK, CAND_BLOCK, CHARACTERS, SMALL, LEAST_BLOCKS = 16_384, 16_384, 64_000_000, 1_024, 6
#: Blocks of candidates that a task opens one after the other: where it returns every pair, and where it keeps the best.
EVERY_SPAN, BEST_SPAN = 4, 16
#: Characters of tokens that are packed together, and kept candidates held at once for a group of S1 records.
PACKED, KEPT = 32_000_000, 4_000_000
#: A token in this share of a block's candidates takes part in the dense product; most such tokens.
DENSE, MOST_DENSE = 0.1, 512
#: Arrays of scores worked on at once, in cells.
CELLS = 4_000_000
NAME_FIELDS, SOUND_FIELDS = ("n", "p", "pb", "g"), ("p", "pb")
PACKS = "country string, kind int, block int, size long, pack binary"
PAIRS = "s1_id string, cand_id string, combined long, name_score long"


class _Layer:
    """The postings of the candidates for some of the tokens."""

    def __init__(self, chosen: np.ndarray, toks: np.ndarray, rows: np.ndarray, size: int, named: np.ndarray):
        if not chosen.all():
            on = chosen[toks]
            toks, rows = toks[on], rows[on]
        self.post = rows[np.argsort(toks, kind="stable")].astype(np.int64)
        self.counts = np.bincount(toks, minlength=len(chosen))
        self.ends = np.cumsum(self.counts)
        many = np.flatnonzero((self.counts >= max(DENSE * size, 32)) & ~named)
        many = many[np.argsort(-self.counts[many], kind="stable")][:MOST_DENSE]
        self.slot = np.full(len(chosen), -1)
        self.slot[many] = np.arange(len(many))
        self.dense, self.size = np.zeros((len(many), size)), size
        for k, t in enumerate(many):
            self.dense[k] = np.bincount(self._of(t), minlength=size)

    def _of(self, t: int) -> np.ndarray:
        return self.post[self.ends[t] - self.counts[t] : self.ends[t]]

    def product(self, toks: np.ndarray, rows: np.ndarray, n: int, weight: np.ndarray) -> np.ndarray:
        left = np.zeros((n, len(self.dense)))
        on = self.slot[toks] >= 0
        np.add.at(left, (rows[on], self.slot[toks[on]]), weight[toks[on]])
        return left @ self.dense

    def add(self, toks: np.ndarray, weight: np.ndarray) -> np.ndarray | None:
        toks = toks[(self.slot[toks] < 0) & (self.counts[toks] > 0)]
        if not len(toks):
            return None
        return np.bincount(np.concatenate([self._of(t) for t in toks.tolist()]), np.repeat(weight[toks], self.counts[toks]), self.size)


def _packer(fields: list[str]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= PACKED:
                yield from _packs(pa.Table.from_batches(held), fields)
                held, size = [], 0
        if held:
            yield from _packs(pa.Table.from_batches(held), fields)
        held.clear()
        pa.default_memory_pool().release_unused()

    return pack


def _packs(table: pa.Table, fields: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for each country, kind and block of ``table``: ids, flags, and for each field its texts once, the numbers of
    them that records have (each record's sorted, as differences, by bytes of the same weight) and how many those are."""
    for key in table.group_by(["country", "kind", "block"]).aggregate([]).to_pylist():
        own = table.filter(pc.and_(pc.and_(pc.equal(table["country"], key["country"]), pc.equal(table["kind"], key["kind"])), pc.equal(table["block"], key["block"])))
        parts = []
        for f in fields:
            lists = pc.split_pattern(pc.fill_null(own[f"t_{f}"].combine_chunks(), ""), SEPARATOR)
            lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
            coded, counts = lists.flatten().dictionary_encode(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            codes, n = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
            frequent = np.argsort(-np.bincount(codes, minlength=n), kind="stable")
            number = np.empty(n, np.int64)
            number[frequent] = np.arange(n)
            rows = np.repeat(np.arange(len(counts)), counts)
            codes = np.sort(rows * n + number[codes]) - rows * n
            codes[1:] -= np.where(rows[1:] == rows[:-1], codes[:-1], 0)
            parts.append((coded.dictionary.take(pa.array(frequent)), np.ascontiguousarray(codes.astype(np.uint32).view(np.uint8).reshape(-1, 4).T), counts))
        ids = own["id"].combine_chunks()
        whole = pickle.dumps((ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks), own["flags"].to_numpy(), parts), 5)
        yield _packed_row(key["country"], key["kind"], key["block"], whole)


def _pack_vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the vocabulary of a country as one compressed row for each batch."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for country in table["country"].unique().to_pylist():
            own = table.filter(pc.equal(table["country"], country)).drop_columns(["country"])
            yield _packed_row(country, 2, None, pickle.dumps(own.combine_chunks(), 5))


def _packed_row(country: str, kind: int, block: int | None, whole: bytes) -> pa.RecordBatch:
    blob = pa.compress(whole, codec="zstd", asbytes=True)
    return pa.RecordBatch.from_pydict({"country": [country], "kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int32()), "size": pa.array([len(whole)], pa.int64()), "pack": pa.array([blob], pa.binary())})


def _opened(size: int, blob: pa.Scalar):
    return pickle.loads(pa.decompress(blob.as_buffer(), size, "zstd"))


def _side(packs: list[tuple[int, pa.Scalar]], words: list[pa.Array], start: list[int], used: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order, and for each token of the vocabulary in ``used`` that a record has: the record's place, the token. The flags of each id, too."""
    opened = [_opened(size, blob) for size, blob in packs]
    ids = pa.concat_arrays([p[0] for p in opened])
    names = ids.unique()
    names = names.take(pc.sort_indices(names))
    place = pc.index_in(ids, value_set=names).to_numpy(zero_copy_only=False).astype(np.int32)
    flags = np.zeros(len(names), np.int64)
    flags[place] = np.concatenate([p[1] for p in opened])
    rows, toks = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for k, (own, first) in enumerate(zip(words, start, strict=True)):
        at = low = 0
        found = pc.fill_null(pc.index_in(pa.concat_arrays([p[2][k][0] for p in opened]), value_set=own), -first - 1).to_numpy(zero_copy_only=False) + np.int32(first)
        found[found >= 0] = np.where(used[found[found >= 0]], found[found >= 0], -1)
        for p in opened:
            texts, planes, counts = p[2][k]
            codes = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
            # Differences again as numbers: the running sum, less what it was before each record.
            total, ends = np.cumsum(codes), np.cumsum(counts)
            before = np.concatenate([[0], total])[ends - counts]
            tok = found[total - np.repeat(before, counts) + at]
            known = tok >= 0
            rows.append(np.repeat(place[low : low + len(counts)], counts)[known])
            toks.append(tok[known].astype(np.int32))
            at += len(texts)
            low += len(counts)
    return names, np.concatenate(rows), np.concatenate(toks), flags


def best(x: np.ndarray, k: int, last: bool = False) -> np.ndarray:
    """Places of the k largest values above zero, ties to the smaller place (``last``: the larger)."""
    on = np.flatnonzero(x > 0)
    if k <= 0 or len(on) <= k:
        return on[: max(k, 0)]
    y = x[on]
    least = np.partition(y, len(y) - k)[len(y) - k]
    sure, tied = on[y > least], on[y == least]
    more = k - len(sure)
    return np.concatenate([sure, tied[len(tied) - more :] if last else tied[:more]])


def picked(rows: np.ndarray, k: int, names: int, sparse: int) -> np.ndarray:
    """Places of the rows (combined, name_score, flags; ties to the first) that ``blocking.quota_top_k`` picks."""
    x, y, flags = rows
    taken = np.zeros(len(x), bool)
    taken[best(y, names)] = True
    taken[best(np.where((flags != 0) & ~taken, x, 0.0), sparse)] = True
    more = k - np.count_nonzero(taken)
    if more > 0:
        taken[best(np.where(taken, 0.0, x), more)] = True
    return np.flatnonzero(taken)


VIEWS = {"combined": lambda x, y, f: x, "name_score": lambda x, y, f: y, "address": lambda x, y, f: x - y, "flagged": lambda x, y, f: np.where(f != 0, x, 0.0)}


def _scorer(fields: list[str], boosted: bool, common: bool, keep: dict[str, int] | None, last: bool, count: bool, own: bool, quota: tuple[int, int, int] | None, flagged: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        packs: dict[int, dict[int, list]] = {0: {}, 1: {}, 2: {}}
        for kind, at, size, blob in zip(*(table[c] for c in ("kind", "block", "size", "pack")), strict=True):
            k = kind.as_py()
            packs[k].setdefault(at.as_py() if k == 1 else 0, []).append((size.as_py(), blob))
        if not all(packs.values()):
            return
        only = pc.all(pc.equal(table.filter(pc.equal(table["kind"], 1))["spans"], 1)).as_py()
        del table  # packs hold what they need
        known = pa.concat_tables([_opened(size, blob) for size, blob in packs.pop(2)[0]])
        words, start, numbers, at = [], [], [], 0
        for f in range(len(fields)):
            of_field = known.filter(pc.equal(known["field"], f))
            words.append(pa.concat_arrays(of_field["token"].chunks or [pa.array([], pa.string())]))
            start.append(at)
            numbers.append(np.stack([of_field[c].to_numpy().astype(float) for c in ("weight", "boosted", "common", "own")], 1))
            at += of_field.num_rows
        weight, boost, is_common, idf = np.concatenate(numbers).T
        of = np.concatenate([np.full(len(w), k) for k, w in enumerate(words)])
        named = np.isin(of, [k for k, f in enumerate(fields) if f in NAME_FIELDS])
        sounds = np.isin(of, [k for k, f in enumerate(fields) if f in SOUND_FIELDS]) & boosted
        del known, of_field
        s1, rows1, toks1, _ = _side(packs[0][0], words, start, np.ones(len(weight), bool))
        total = np.bincount(rows1, idf[toks1], len(s1)).astype(np.int64)
        used = weight > 0
        rows1, toks1 = rows1[used[toks1]], toks1[used[toks1]]
        toks1, ends = toks1[np.argsort(rows1, kind="stable")], np.cumsum(np.bincount(rows1, minlength=len(s1)))
        rows1 = np.sort(rows1, kind="stable")
        plain = named & ~sounds
        merged = keep is not None and len(packs[1]) > 1
        group = len(s1) if not merged else max(1, min(len(s1), KEPT // max(1, sum(keep.values()))))
        if merged:  # ties are settled by id over all blocks
            every = [_opened(size, blob)[0] for own_packs in packs[1].values() for size, blob in own_packs]
            every = pa.concat_arrays(every).unique()
            every = every.take(pc.sort_indices(every))

        def chosen(row: np.ndarray) -> np.ndarray:
            return np.unique(np.concatenate([best(VIEWS[v](row[1], row[2], row[3]), k, last) for v, k in keep.items()]))

        def rows_of(names: pa.Array, out: list[np.ndarray]) -> pa.RecordBatch:
            """``out``: for each S1 its place and, as columns, places in ``names``, scores, flags and scores of common tokens."""
            places = np.concatenate([np.full(row.shape[1], r) for r, row in out])
            columns = np.concatenate([row.astype(np.int64) for _, row in out], axis=1)
            made = {"s1_id": s1.take(pa.array(places)), "cand_id": names.take(pa.array(columns[0])), "combined": pa.array(columns[1]), "name_score": pa.array(columns[2])}
            if common:
                made |= {"more": pa.array(columns[4]), "more_name": pa.array(columns[5])}
            if own:
                made["own"] = pa.array(total[places])
            if flagged:
                made["sparse"] = pa.array(columns[3] != 0)
            return pa.RecordBatch.from_pydict(made)

        def settled(row: np.ndarray) -> np.ndarray:
            if quota is None or not only:
                return row
            # All candidates of the S1 were here, so its slots can be given.
            more = row[4:6] if common else np.zeros((2, row.shape[1]))
            return row[:, picked(np.stack([row[1] + more[0], row[2] + more[1], row[3]]), *quota)]

        for first in range(0, len(s1), group):
            until, sums, state = min(first + group, len(s1)), {}, {}
            for block in sorted(packs[1]):
                cands, rows2, toks2, flags = _side(packs[1][block], words, start, used)
                layers = [_Layer(is_common == k, toks2, rows2, len(cands), named) for k in ((0, 1) if common else (0,))]
                del rows2, toks2
                foreign, step = (flags & 1) == 1, max(1, (CELLS // 8 if keep is None and not count else CELLS) // len(cands))
                ranks = pc.index_in(cands, value_set=every).to_numpy(zero_copy_only=False) if merged else None

                def scores(layer: _Layer, x: np.ndarray, toks: np.ndarray, cands=cands, foreign=foreign) -> tuple[np.ndarray, np.ndarray]:
                    y = np.zeros(len(cands))
                    for on in (plain, sounds):
                        mine = toks[on[toks]]
                        if (more := layer.add(mine, weight)) is not None:
                            y += np.where(foreign, layer.add(mine, boost), more) if on is sounds and foreign.any() else more
                    if (more := layer.add(toks[~named[toks]], weight)) is not None:
                        x += more
                    return x + y, y

                for low in range(first, until, step):
                    high = min(low + step, until)
                    a, b = (ends[low - 1] if low else 0), ends[high - 1]
                    tiles = [layer.product(toks1[a:b], rows1[a:b] - low, high - low, weight) for layer in layers]
                    out: list[tuple[int, np.ndarray]] = []
                    for r in range(low, high):
                        toks = toks1[(ends[r - 1] if r else 0) : ends[r]]
                        x, y = scores(layers[0], tiles[0][r - low], toks)
                        if count:
                            sums[r] = sums.get(r, 0) + np.count_nonzero(x)
                            continue
                        on = np.flatnonzero(x) if keep is None else chosen((x, x, y, flags))
                        if not len(on):
                            continue
                        row = [on, x[on], y[on], flags[on]]
                        if common:
                            x, y = scores(layers[1], tiles[1][r - low], toks)
                            row += [x[on], y[on]]
                        row = np.stack(row)
                        if not merged:
                            out.append((r, settled(row) if keep is not None else row))
                            continue
                        row[0] = ranks[on]
                        if r in state:
                            row = np.concatenate([state[r], row], axis=1)
                            row = row[:, np.argsort(row[0])]
                            row = row[:, chosen(row)]
                        state[r] = row
                    if out:
                        yield rows_of(cands, out)
            if count:
                yield pa.RecordBatch.from_pydict({"s1_id": s1, "pool": pa.array([int(sums[r]) for r in range(len(s1))], pa.int64())})
            held = [(r, settled(state.pop(r))) for r in sorted(state)]
            for low in range(0, len(held), 2048):
                yield rows_of(every, held[low : low + 2048])

    return score


def score(listed: DataFrame, weighted: DataFrame, fields: tuple[str, ...], flags: DataFrame | None = None, boost: float = 1.0, max_df: int | None = None, common: bool = False, keep: dict[str, int] | None = None, last: bool = False, count: bool = False, own: bool = False, quota: tuple[int, int, int] | None = None, sparse: bool = False) -> DataFrame:
    """(s1_id, cand_id, combined, name_score) of the pairs that share a token of ``weighted`` of df up to ``max_df``; ``listed``
    is ``stats.token_texts``. ``keep``: of each S1 and task only the best by these views (combined, name_score, address,
    flagged: those with flags), ties to the smaller id (``last``: the larger); whoever ranks them must do it again over all
    tasks. ``common`` adds more and more_name, the weights of shared tokens above ``max_df``. ``count``: (s1_id, pool)
    instead. ``boost`` as in ``blocking.block``. ``own`` adds the idf of all tokens of the S1; ``sparse`` adds whether the
    candidate has flags. ``quota``: (k, slots of names, slots of flagged) of a ``quota_top_k`` that follows; where a task has
    all candidates of a country, only the rows that it picks leave the task. Flags are read from ``listed`` if it has them."""
    named = F.col("source") == 1
    known = listed.where("country is not null and source is not null and entity_id is not null")
    length = sum((F.coalesce(F.length(f"t_{f}"), F.lit(0)).cast("bigint") for f in fields), F.lit(0).cast("bigint"))
    of = lambda on, x: F.sum(F.when(on, x).otherwise(F.lit(0)))
    sizes = known.groupBy("country").agg(of(named, F.lit(1)).alias("n1"), of(~named, F.lit(1)).alias("n2"), of(named, length).alias("c1"), of(~named, length).alias("c2")).where("n1 > 0 and n2 > 0")
    cut = lambda n, c, most: F.greatest(F.ceil(F.col(n) / most), F.ceil(F.col(c) / CHARACTERS))
    span = EVERY_SPAN if keep is None and not count else BEST_SPAN
    grid = sizes.select("country", F.greatest(cut("n1", "c1", S1_BLOCK), F.least(F.ceil(F.col("n1") / SMALL), F.lit(LEAST_BLOCKS))).cast("int").alias("high"), cut("n2", "c2", CAND_BLOCK).cast("int").alias("wide"))
    grid = F.broadcast(grid.withColumn("spans", F.ceil(F.col("wide") / span).cast("int")))  # a row for each country
    texts = [F.col(f"t_{f}") for f in fields]
    given = flags is not None and "flags" not in listed.columns
    if given:
        known = known.join(flags.select("entity_id", "flags").distinct(), "entity_id", "left")
    flag = F.coalesce(F.col("flags"), F.lit(0)).cast("bigint") if given or "flags" in listed.columns else F.lit(0).cast("bigint")
    every: Column = F.sequence(F.lit(0), F.col("high") - 1)
    across: Column = F.sequence(F.lit(0), F.col("spans") - 1)
    mine = lambda n: F.pmod(F.xxhash64("entity_id"), F.col(n)).cast("int")
    docs = known.join(grid, "country").select("country", F.when(named, 0).otherwise(1).alias("kind"), F.when(named, mine("high")).otherwise(mine("wide")).alias("block"), F.col("entity_id").alias("id"), flag.alias("flags"), *texts)
    packs = docs.mapInArrow(_packer(list(fields)), PACKS)
    far = F.col("df") > max_df if max_df is not None else F.lit(False)
    on = F.lit(True) if common else ~far
    if {"in_s1", "in_others"} <= set(weighted.columns):
        on = on & F.col("in_s1") & F.col("in_others")
    used = weighted.where(F.col("field").isin(*fields)).withColumn("on", on)
    used = used.where(F.col("in_s1") | F.col("on") if "in_s1" in used.columns else F.lit(True)) if own else used.where("on")
    weight = F.when(F.col("on"), F.col("weight_micro")).otherwise(F.lit(0).cast("bigint"))
    raised = F.when(F.col("field").isin(*SOUND_FIELDS), F.round(weight * boost).cast("bigint")).otherwise(weight)
    field = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field")).cast("int") - 1
    vocabulary = used.join(grid.select("country"), "country").select("country", field.alias("field"), "token", weight.alias("weight"), raised.alias("boosted"), far.cast("bigint").alias("common"), (F.col("idf_micro") if own else F.lit(0).cast("bigint")).alias("own"))
    rows = packs.unionByName(vocabulary.mapInArrow(_pack_vocabulary, PACKS)).join(grid, "country")
    i, j = F.when(F.col("kind") == 0, F.array("block")).otherwise(every), F.when(F.col("kind") == 1, F.array(F.pmod("block", F.col("spans")))).otherwise(across)
    rows = rows.select("country", i.alias("i"), j.alias("j"), "kind", "block", "size", "pack", "spans").withColumn("i", F.explode("i")).withColumn("j", F.explode("j"))
    # Blocks are work, not bytes: their partitions are not to be put together by size.
    rows = rows.repartition(int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "country", "i", "j")
    schema = "s1_id string, pool long" if count else PAIRS + (", more long, more_name long" if common else "") + (", own long" if own else "") + (", sparse boolean" if sparse else "")
    found = rows.groupBy("country", "i", "j").applyInArrow(_scorer(list(fields), flags is not None and boost != 1.0, common, keep, last, count, own, quota, sparse), schema)
    return found.groupBy("s1_id").agg(F.sum("pool").alias("pool")).where("pool > 0") if count else found
