"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: each turn is ``### role: text</turn>`` and a new line. Inside roles and texts the
control strings ``###``, ``</turn>``, and the backslash itself get a backslash in front (in roles the colon too), so a
turn ends at the first ``</turn>`` without one, and every text is read back exactly. The rendered text is encoded once,
with offsets. The spans of assistant texts are sorted, and so are the tokens: for each span, binary search finds the
first and last token that it meets; the loss mask is 1 there. A token may hold characters of a header too (a merged
blank); the mask's character spans, the intersection of both, are kept with it, so no character of a header counts.

Edge cases: a null text or role is empty. Turns are ordered by turn, then role and text, nulls first. Repeated rows are
turns of their own. Rows without conv_id form one conversation. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

HEAD, MID, TAIL, LEARNED = "### ", ": ", "</turn>\n", "assistant"
_in_text = re.compile(r"\\|###|</turn>")
_in_role = re.compile(r"\\|###|</turn>|:")
_escaped = re.compile(r"\\(\\|###|</turn>|:)")
_part = re.compile(r"\\(?:\\|###|</turn>|:)|</turn>\n|: ")


def escape(text: str, role: bool = False) -> str:
    return (_in_role if role else _in_text).sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _escaped.sub(lambda m: m.group(1), text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of assistant texts in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{HEAD}{escape(role, True)}{MID}", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, TAIL]
        at += len(head) + len(body) + len(TAIL)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        start, role = at + len(HEAD), None
        for m in _part.finditer(formatted, start):
            if m.group() == MID and role is None:
                role, start = unescape(formatted[start : m.start()]), m.end()
            elif m.group() == TAIL and role is not None:
                turns.append((role, unescape(formatted[start : m.start()])))
                at = m.end()
                break
        else:
            raise ValueError("a turn without an end")
    return turns


def align(spans: list[tuple[int, int]], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss mask over tokens, and the masked character spans (start, end) of the text. ``offsets``: start and end of each token, ascending."""
    mask = np.zeros(len(offsets), np.int8)
    kept = []
    for start, end in spans:
        first = int(np.searchsorted(offsets[:, 1], start, "right"))
        last = int(np.searchsorted(offsets[:, 0], end, "left"))
        if start < end and first < last:
            mask[first:last] = 1
            kept.append((max(start, int(offsets[first, 0])), min(end, int(offsets[first:last, 1].max()))))
    return mask, np.array(kept, np.int32).reshape(-1, 2)


@lru_cache(maxsize=2)
def load(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def format_chats(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, formatted, ids, mask, spans): the text, its token ids, the loss mask of each token, and the masked
    character spans as start, end, start, end and so on."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    rows = conversations.select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(turns.alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(tokenizer).encode_batch
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                some = batch.slice(a, 200)
                rendered = [render([(t["role"] or "", t["text"] or "") for t in turns]) for turns in some.column(1).to_pylist()]
                ids, masks, spans = [], [], []
                for (_, where), x in zip(rendered, encode([t for t, _ in rendered], add_special_tokens=False), strict=True):
                    mask, kept = align(where, np.array(x.offsets, np.int64).reshape(-1, 2))
                    ids.append(x.ids)
                    masks.append(mask)
                    spans.append(kept.ravel())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array([t for t, _ in rendered]), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())), pa.array(spans, pa.list_(pa.int32()))], names=["conv_id", "formatted", "ids", "mask", "spans"])

    return rows.mapInArrow(run, "conv_id bigint, formatted string, ids array<int>, mask array<tinyint>, spans array<int>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output of ``format_chats`` holds: turns by parsing the text, learned text by its masked spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, text, mask, spans in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                turns = parse(text)
                learned = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                told = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((conv_id, len(turns), told, len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text), len(mask), sum(mask)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(names, cols, strict=True)], names=names)

    return formatted.select("conv_id", "formatted", "mask", "spans").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint, n_loss_tokens bigint")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2, numPartitions=1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return read_back(format_chats(rows.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json")))
