"""Byte-level BPE encoding and decoding with rank files, as length-bucketed padded numpy matrices.

A text is cut by the tokenizer's pattern; each piece is encoded separately. A piece that is a token itself is that
token. The others wait in buckets of similar length, as the rows of a matrix of token ids padded with -1. In each
round every row merges its leftmost pair of minimum rank: pair ranks come from an open-addressing hash table over
(left id, right id), the row closes up over the merged pair, rows without a mergeable pair leave, and columns that no
row uses are cut. Only the two pairs beside a merge are looked up anew.

Pieces of the widest bucket are first cut, exactly, where no token has the two bytes beside each other: no merge can
cross there. Rows of that bucket (over ``WIDTHS[-1]`` bytes, any length) merge all pairs of minimum rank in a round, from left to right,
which is what single merges come to where every token of the file is made, from its own bytes, by merges of rising
rank: then no merge brings a pair of lower rank than its own. The file is checked for that before the first such row;
where it fails, these rows too merge one pair a round.

Edge cases: a null or empty text has no ids and decodes to empty bytes; null ids decode to empty bytes. Repeated rows
are encoded alike. Other columns pass through as they are, whatever their names, but for the output column.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table
from .pieces import PieceStore, chunks, release

WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
NONE = np.iinfo(np.int32).max
CELLS = 2_000_000


class PairTable:
    """(left id, right id) -> rank of the merged token, in an open-addressing table of numpy arrays."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        slot, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.ranks[slot[free]] = keys[free], ranks[free]  # of several for a slot the last stays
            lost = self.keys[slot] != keys
            keys, ranks, slot = keys[lost], ranks[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape, left, right = left.shape, left.ravel(), right.ravel()
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            here, want = self.keys[slot[open_]], keys[open_]
            hit = here == want
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
        return np.where((left < 0) | (right < 0), NONE, out).reshape(shape)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token of a rank file; that is all that decoding needs."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return [ranks.get(k, b"") for k in range(max(ranks) + 1)]


class ByteBPE:
    def __init__(self, path: str, pattern: str):
        import regex

        self.bytes_of = token_bytes(path)
        self.ranks = {token: rank for rank, token in enumerate(self.bytes_of) if token}
        self.cut = regex.compile(pattern).findall
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get, keys, merged = self.ranks.get, [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                if (a := get(token[:k])) is not None and (b := get(token[k:])) is not None:
                    keys.append((a << 32) | b)
                    merged.append(rank)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(merged, np.int32))
        self.ordered: bool | None = None
        self.beside = np.zeros(1 << 16, bool)  # two bytes that some token has beside each other
        for token in self.ranks:
            for a, b in zip(token, token[1:], strict=False):
                self.beside[a << 8 | b] = True
        self.store = PieceStore(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [p.encode() for p in pieces]
        if max(map(len, raw), default=0) <= WIDTHS[-1]:
            return self._encode_sections(raw)
        whole = np.fromiter((self.ranks.get(p, -1) for p in raw), np.int32, len(raw))
        cut = [self._sections(p) if w < 0 and len(p) > WIDTHS[-1] else [p] for p, w in zip(raw, whole.tolist(), strict=True)]
        parts, of = [x for y in cut for x in y], np.fromiter(map(len, cut), np.int64, len(cut))
        flat, lens = self._encode_sections(parts)
        return flat, np.diff(np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(of)])])

    def _sections(self, piece: bytes) -> list[bytes]:
        b = np.frombuffer(piece, np.uint8).astype(np.int64)
        ends = (np.flatnonzero(~self.beside[b[:-1] << 8 | b[1:]]) + 1).tolist()
        return [piece[x:y] for x, y in zip([0, *ends], [*ends, len(piece)], strict=True)] if ends else [piece]

    def _encode_sections(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lens = np.ones(len(raw), np.int64)
        whole = np.fromiter((self.ranks.get(p, -1) for p in raw), np.int32, len(raw))
        rest = np.flatnonzero(whole < 0)
        sizes = np.fromiter((len(raw[i]) for i in rest), np.int64, len(rest))
        parts: dict[int, np.ndarray] = {}
        low = 0
        for width in WIDTHS:
            rows = rest[(sizes > low) & (sizes <= width)]
            low = width
            for k in range(0, len(rows), step := max(1, CELLS // width)):
                some = rows[k : k + step]
                ids, n = self._matrix([raw[i] for i in some], width)
                lens[some] = n
                parts.update(zip(some.tolist(), (ids[r, :m] for r, m in enumerate(n.tolist())), strict=True))
        for i in rest[sizes > WIDTHS[-1]].tolist():
            parts[i] = self._row(raw[i])
            lens[i] = len(parts[i])
        if not len(rest):
            return whole, lens
        flat, ends = np.empty(int(lens.sum()), np.int32), np.cumsum(lens)
        one = whole >= 0
        flat[ends[one] - 1] = whole[one]
        starts = ends - lens
        for i, ids in parts.items():
            flat[starts[i] : ends[i]] = ids
        return flat, lens

    def _rises(self) -> bool:
        """Whether the merges that make a token from its bytes rise in rank, for every token."""
        made = [t for t in self.ranks if len(t) > 1]
        by_width = {w: [t for t in made if v < len(t) <= w] for v, w in zip((0, *WIDTHS), WIDTHS, strict=False)}
        return all(len(t) <= WIDTHS[-1] for t in made) and all(self._matrix(some, w, rising=True)[2] for w, some in by_width.items() if some)

    def _matrix(self, raw: list[bytes], width: int, rising: bool = False) -> tuple:
        n = np.fromiter(map(len, raw), np.int64, len(raw))
        ids = np.full((len(raw), width), -1, np.int32)
        ids[np.arange(width) < n[:, None]] = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        out, out_n, rows = ids.copy(), n.copy(), np.arange(len(raw))
        rank = self.pairs.get(ids[:, :-1], ids[:, 1:])
        last = np.full(len(raw), -1, np.int32)
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            if rising:
                if (best < last[rows]).any():
                    return out, out_n, False
                last[rows] = best
            if (over := best == NONE).any():
                gone = rows[over]
                out[gone, : ids.shape[1]], out_n[gone] = ids[over], n[over]
                rows, ids, rank, n, at, best = (x[~over] for x in (rows, ids, rank, n, at, best))
                if not len(rows):
                    break
            n, r = n - 1, np.arange(len(rows))
            w = max(2, int(n.max()))
            cols = np.arange(w)
            shift = np.minimum(cols + (cols > at[:, None]), ids.shape[1] - 1)
            new = np.take_along_axis(ids, shift, axis=1)
            new[cols >= n[:, None]] = -1
            new[r, at] = best
            rank = np.take_along_axis(rank, np.minimum(shift[:, : w - 1], rank.shape[1] - 1), axis=1)
            rank[cols[:-1] >= (n - 1)[:, None]] = NONE
            for k in (at - 1, at):
                ok = (k >= 0) & (k < n - 1)
                rank[r[ok], k[ok]] = self.pairs.get(new[r[ok], k[ok]], new[r[ok], k[ok] + 1])
            ids = new
        return (out, out_n, bool((out_n == 1).all())) if rising else (out, out_n)

    def _row(self, piece: bytes) -> np.ndarray:
        """A matrix of one row, of any width. A merged token stays in its left cell and the right one is passed over
        until half of the row is; then the row closes up."""
        if self.ordered is None:
            self.ordered = self._rises()
        ids = self.of_byte[np.frombuffer(piece, np.uint8)]
        while True:
            n = len(ids)
            after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
            rank = np.full(n, NONE, np.int32)
            rank[:-1] = self.pairs.get(ids[:-1], ids[1:])
            dead = 0
            while (best := rank.min()) != NONE and 2 * dead <= n:
                at = np.flatnonzero(rank == best)
                # Of pairs in a row every second one is merged, from the left: a run is a chain of pairs that share a cell.
                chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
                k = np.arange(len(at))
                at = at[(k - np.maximum.accumulate(np.where(chained, 0, k))) % 2 == 0] if self.ordered else at[:1]
                gone = after[at]
                ids[at] = best
                rank[gone], rank[at] = NONE, NONE
                after[at] = after[gone]
                inside = after[at] < n
                before[after[at[inside]]] = at[inside]
                dead += len(at)
                ids[gone] = -1
                for left in (at[inside], before[at][before[at] >= 0]):
                    rank[left] = self.pairs.get(ids[left], ids[after[left]])
            ids = ids[ids >= 0]
            if best == NONE:
                return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the number of ids of each."""
        cut = [self.cut(t) for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        return self.store.lay_out(pa.array([p for x in cut for p in x], pa.string()), counts)


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBPE:
    """The tokenizer of a rank file, once in each Python worker."""
    return ByteBPE(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with its column ``text`` replaced by ``to``, an array of token ids."""
    kept = [f for f in df.schema.fields if f.name not in (text, to)]
    cols = [f.name for f in kept]
    last = len(cols)  # the text's place: names of other columns can't clash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for a, texts in chunks(batch.column(last)):
                flat, n = bpe.encode(texts)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, len(texts)) for c in range(last)], ids], names=[*cols, to])
        release()

    schema = T.StructType([*kept, T.StructField(to, T.ArrayType(T.IntegerType(), False), True)])
    return df.select(*[F.col(f"`{c}`") for c in cols], F.col(f"`{text}`").alias(free_name(cols))).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with a further column ``to``: the bytes of its token ids."""
    kept = [f for f in df.schema.fields if f.name != to]
    cols = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_bytes(path).__getitem__
        for batch in batches:
            lists = batch.column(ids)
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
            raw = [b"".join(map(token, flat[a:b].tolist())) if ok else b"" for a, b, ok in zip(at, at[1:], lists.is_valid().to_pylist(), strict=False)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(raw, pa.binary())], names=[*cols, to])
        release()

    return df.select(*[F.col(f"`{c}`") for c in cols]).mapInArrow(run, T.StructType([*kept, T.StructField(to, T.BinaryType(), True)]))


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the default rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of the texts of ``docs``."""
    path, pattern = vocabulary()
    both = decode(encode(docs.select("doc_id", "text"), path, pattern), path)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
