"""Encoding through distinct pieces: a batch of texts is cut into pieces that a tokenizer treats one by one, only
pieces not seen before are encoded, and ids are laid out with numpy.

The store of seen pieces lives in the Python worker and is emptied when it holds ``limit`` pieces, so its memory is
bounded; what it holds never changes a result."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time in a worker.
CHUNK_BYTES = 1_000_000


class PieceStore:
    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 200_000):
        """``encode``: pieces -> ids of all of them one after the other, and the number of ids of each."""
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)

    def _add(self, new: list[str]) -> None:
        ids, lens = self.encode(new)
        n, used = len(self.at), int(self.ends[len(self.at)])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[used : used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(new)] = used + np.cumsum(lens)
        self.at.update(zip(new, range(n, n + len(new)), strict=True))

    def lay_out(self, pieces: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each the next ``counts[i]`` of ``pieces``: all ids in order, and the number of ids of each text."""
        coded = pieces.dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.at) + len(distinct) > self.limit:
            self._clear()
        get = self.at.get
        if new := [p for p in distinct if get(p) is None]:
            self._add(new)
        rows = np.fromiter(map(self.at.__getitem__, distinct), np.int64, len(distinct))
        first, lens = self.ends[rows][which], (self.ends[rows + 1] - self.ends[rows])[which]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.arange(total, dtype=np.int64) + np.repeat(first - (ends - lens), lens)]
        bounds = np.concatenate([[0], ends])
        upto = np.concatenate([[0], np.cumsum(counts)])
        return flat, np.diff(bounds[upto])


def release() -> None:
    """Gives memory that a task no longer uses back to the system: the worker may stay idle for long beside others."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of a text column with about ``most`` bytes each; a longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for k, n in enumerate(sizes.tolist()):
        if size and size + n > most:
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def chunks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Slices of a text column as (first row, texts), null as empty. Only one slice at a time is held as Python strings."""
    for a, b in slices(texts):
        yield a, [t or "" for t in texts.slice(a, b - a).to_pylist()]
