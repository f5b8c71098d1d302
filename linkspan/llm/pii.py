"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds anchors: at-signs, plus signs, schemes, digits and cue words of
identifiers. At each anchor a local parser expands to the left and right, and a validator decides. Parsers never look
behind the last match of their kind, so work is linear in the text.

Kinds, in the order of output: the four base kinds ``email``, ``ip``, ``card`` and ``phone`` give exactly the leftmost
non-overlapping matches of their patterns that pass (parts up to 255; 16 to 19 digits and Luhn; 8 to 15 digits); the
method adds ``url`` (scheme, then a host), ``iban`` (country, check digits, mod 97), ``secret`` (a cue such as
password or api_key, a sign, a value of 8 characters or more) and ``account`` (a cue such as account number, passport
or ssn, a sign or blank, a value of 6 to 24 letters, digits and joiners that starts and ends with a letter or digit,
has 5 digits or more and stops at a word boundary). Cues count in any case and only where no letter or digit stands
right before them. Spans of different kinds may overlap. Positions are
code points, end exclusive.

Edge cases: a null or empty text has no spans. Repeated rows give the same spans. Other columns pass through, whatever
their names, but for the output columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "secret", "account")
SCHEMES = ("http", "https", "ftp", "ftps", "ssh", "sftp", "ws", "wss", "git", "jdbc", "s3", "mongodb", "postgres", "mysql", "redis")
CUES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "auth_key", "private_key", "client_secret")
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta", "iban", "passport", "ssn", "social security", "national id", "tax id", "customer id", "member id", "license number", "licence number")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+").match
_card = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_digits = re.compile(r"[0-9]+").match
_host = re.compile(r"://[^\s\"'<>\\^`{|}/?#]+(?:[/?#][^\s\"'<>\\^`{|}]*)?").match
_iban = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])").match
_secret = re.compile(r"\s{0,4}[=:]\s{0,4}[\"']?([A-Za-z0-9_./+=~-]{8,})").match
_account = re.compile(r"(?:[ ]?(?:number|num|no|nr|id))?[ .]{0,2}(?:[=:#]|is\b)?[ #]{0,4}([A-Za-z0-9](?:[./ -]?[A-Za-z0-9]){4,23})(?![A-Za-z0-9])", re.I).match


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in [("@", "@"), ("+", "+"), ("://", "u"), *[(d, "d") for d in "0123456789"], *[(c, "s") for c in CUES], *[(c, "a") for c in ACCOUNT_CUES]]:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


#: A-Z to a-z: cues count in any case, and positions stay.
_lower = {c: c + 32 for c in range(65, 91)}


def _account_span(text: str, at: int) -> tuple[int, int] | None:
    """The identifier after a cue that ends at ``at``, cut back to whole words until its last word holds a digit."""
    m = _account(text, at)
    if not m:
        return None
    start, end = m.span(1)
    while end > start:
        word = max(text.rfind(" ", start, end), start - 1) + 1
        if any(c.isdigit() for c in text[word:end]):
            break
        end = word - 1
    value = text[start:max(end, start)]
    return (start, end) if len(value) >= 6 and sum(c.isdigit() for c in value) >= 5 else None


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def _iban_end(text: str, start: int) -> int:
    m = _iban(text, start)
    if not m:
        return -1
    raw = m.group().replace(" ", "")
    if not 15 <= len(raw) <= 34:
        return -1
    return m.end() if int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4])) % 97 == 1 else -1


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans of a text, by kind as listed and then start."""
    spans: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
    for end, (anchor, size) in automaton().iter(text.translate(_lower)):
        if anchor == "d":
            if end >= free["ip"]:
                if m := _ip(text, end):
                    free["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                        spans["ip"].append(("ip", end, m.end()))
                else:
                    free["ip"] = _digits(text, end).end()
            if end >= free["card"]:
                if m := _card(text, end):
                    free["card"] = m.end()
                    if m.end() - end <= 37:
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 16 <= len(digits) <= 19 and luhn(digits):
                            spans["card"].append(("card", end, m.end()))
                else:
                    free["card"] = end + 1
            if end >= 2 and end - 2 >= free["iban"] and text[end - 1] in UPPER and text[end - 2] in UPPER and not (end >= 3 and text[end - 3].isalnum()):
                if (e := _iban_end(text, end - 2)) > 0:
                    free["iban"] = e
                    spans["iban"].append(("iban", end - 2, e))
        elif anchor == "@":
            start, least = end, free["email"]
            while start > least and text[start - 1] in LOCAL:
                start -= 1
            if start < end and (m := _domain(text, end + 1)):
                free["email"] = m.end()
                spans["email"].append(("email", start, m.end()))
        elif anchor == "+":
            if end >= free["phone"] and (m := _phone(text, end)):
                free["phone"] = m.end()
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans["phone"].append(("phone", end, m.end()))
        elif anchor == "u":
            at = end - 2
            if at >= free["url"]:
                start = at
                while start > max(free["url"], at - 10) and (text[start - 1].isascii() and text[start - 1].isalnum()):
                    start -= 1
                if text[start:at].lower() in SCHEMES and (m := _host(text, at)):
                    stop = m.end()
                    while text[stop - 1] in ".,;:!?)":
                        stop -= 1
                    if stop > at + 3:
                        free["url"] = stop
                        spans["url"].append(("url", start, stop))
        elif end >= size and text[end - size].isalnum():
            continue  # the cue is the end of a longer word
        elif anchor == "a":
            if end >= free["account"] and (span := _account_span(text, end + 1)):
                free["account"] = span[1]
                spans["account"].append(("account", *span))
        elif end >= free["secret"] and (m := _secret(text, end + 1)):
            free["secret"] = m.end(1)
            spans["secret"].append(("secret", m.start(1), m.end(1)))
    return [s for kind in KINDS for s in spans[kind]]


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each run of overlapping spans replaced by the kind of its first span, in angle brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def find_spans(df: DataFrame, text: str = "text", to: str = "pii", redacted: str | None = None) -> DataFrame:
    """``df`` with ``to``, its spans, in place of ``text``, and with the redacted text if a name for it is given."""
    kept = [f for f in df.schema.fields if f.name not in (text, to, redacted)]
    cols = [f.name for f in kept]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(len(cols)).to_pylist()]
            found = [find(t) for t in texts]
            arrays = [*[batch.column(c) for c in range(len(cols))], pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in found], kind)]
            if redacted:
                arrays.append(pa.array([redact(t, x) if x else t for t, x in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*cols, to, *[redacted] * bool(redacted)])

    schema = T.StructType([*kept, T.StructField(to, T.ArrayType(SPAN)), *[T.StructField(redacted or "", T.StringType())] * bool(redacted)])
    return df.select(*[F.col(f"`{c}`") for c in cols], F.col(f"`{text}`").alias(free_name(cols))).mapInArrow(run, schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(F.concat_ws(",", F.transform(base, line)), 256).alias("base_sha256"), F.concat_ws(",", F.transform("pii", line)).alias("spans"))
