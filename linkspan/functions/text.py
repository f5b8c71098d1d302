"""Normalisation and tokens. Native column expressions where Spark can say it; Arrow UDFs for Unicode folding and scripts,
over the texts that need them.

There are several tokenisers on purpose: blocking (``fold``) keeps Indic vowel signs, matching (``norm``) strips every
combining mark and leading zeros, alignment works on ASCII runs, the stand-in blocker has prefixed fields."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .translit import OCR_DIGITS, SOUNDS_AS, to_latin

# Word lists that results depend on.
LEGAL_WORDS = "inc incorporated llc ltd limited pvt private corp corporation co company lp llp plc pllc pc".split()
NOISE_WORDS = "the of and services service center centre partners group mr mrs ms smt shri sri dba fka aka formerly known as d b a com www".split()
INDIC_LEGAL_WORDS = ["प्राइवेट", "लिमिटेड", "एलएलपी", "प्रा", "लि"]
NAME_STOPWORDS = [*LEGAL_WORDS, *NOISE_WORDS, *INDIC_LEGAL_WORDS]
ADDRESS_STOPWORDS = ["null", "n", "a"]
CORE_STOPWORDS = (
    "the sri shri dr mr mrs ms m s co company corp corporation inc incorporated llc llp ltd limited "
    "pvt private pc lp plc group formerly dba com www and null nan sarl sas sa sasu eurl sci"
).split()
NULL_LITERALS = ["", "NULL", "null", "nan", "NaN", "None", "NA", "N/A", "n/a"]
PHONETIC_EXTRA_STOPWORDS = ["prvt", "lmtd", "pvt", "ltd", "lmt"]
#: Keys of the ASCII stop words of names and the extra ones, of two letters or more; a test works them out.
SILENT_KEYS = (
    "af ak and ank ankrprtd as db fk frmrl jrp km kmpn kntr knvn krp krprtn lk lmt lmtd lp ltd mr mrs ms pk plk prtnrs "
    "prvt pvt smt sr srvk srvks"
).split()
DOMAIN = r"(?i)\.(com|in|net|org|co|fr)\b"
ALIAS = r"(?i)\b(dba|d\.b\.a\.?|fka|formerly known as|aka)\b"
PUNCTUATION = {"amp": "&", "hyphen": "-", "paren": "(", "bracket": "[", "dot": ".", "comma": ",", "apos": "'", "slash": "/"}

NONLATIN_NAME, EMPTY_ADDRESS = 1, 2
NAME_FIELDS, ADDRESS_FIELDS, FALLBACK_FIELDS = ("n", "p", "pb"), ("a", "ab"), ("g",)


#: What carries a canonical combining class: accents, and the marks of other scripts that stack on their letter.
_marks = regex.compile(r"\P{ccc=0}+")
_latin_marks = regex.compile(r"(?<=[\u0000-\u024F])\P{ccc=0}+")
_gaps = regex.compile(r"[^\p{L}\p{N}\p{M}]+")
_word = re.compile(r"\w+")
_padding = regex.compile(r"^0+(?=[\p{Nd}\p{Numeric_Type=Digit}]+$)")


def fold(text: str) -> list[str]:
    """Lower-case words; accents go from Latin letters, marks of other scripts stay. Each mark is passed once."""
    return _gaps.sub(" ", _latin_marks.sub("", unicodedata.normalize("NFKD", text)).lower()).split()


def bare(text: str) -> str:
    """Lower case, without any mark."""
    return _marks.sub("", unicodedata.normalize("NFKD", text.lower()))


def norm(text: str) -> list[str]:
    """Words of the matcher: no marks at all, numbers without leading zeros."""
    return [_padding.sub("", w) for w in _word.findall(bare(text))]


def script(text: str) -> str | None:
    """First word of the Unicode name of the first letter beyond Latin."""
    letter = next((c for c in text if c.isalpha() and ord(c) > 0x24F), None)
    return None if letter is None else unicodedata.name(letter, "OTHER").split()[0]


WORDS = T.ArrayType(T.StringType())


def _udf(f, kind: T.DataType):
    @F.pandas_udf(kind)
    def mapped(values: pd.Series) -> pd.Series:
        known = {v: None if v is None else f(v) for v in values.unique()}  # each distinct value once
        return values.map(known) if len(known) else values

    return mapped


_fold, _norm, _latin, _script = _udf(fold, WORDS), _udf(norm, WORDS), _udf(to_latin, T.StringType()), _udf(script, T.StringType())


def _column(text) -> Column:
    return F.col(text) if isinstance(text, str) else text


def _ascii(text: Column) -> Column:
    return text.rlike(r"^[\x00-\x7F]*$")


def _split(text: Column, gaps: str) -> Column:
    return F.filter(F.split(F.lower(text), gaps), lambda w: w != "")


def has_nonlatin(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"[\p{L}&&[^\u0000-ɏ]]")


def fold_words(text) -> Column:
    """``fold`` of a column; null has no words. ASCII texts are split by Spark, Python sees none of them."""
    x = F.coalesce(_column(text), F.lit(""))
    return F.when(_ascii(x), _split(x, "[^a-z0-9]+")).otherwise(_fold(F.when(~_ascii(x), x)))


def norm_words(text) -> Column:
    """``norm`` of a column; null has no words. ASCII texts are split by Spark, Python sees none of them."""
    x = F.coalesce(_column(text), F.lit(""))
    plain = F.transform(_split(x, "[^a-z0-9_]+"), lambda w: F.regexp_replace(w, "^0+(?=[0-9]+$)", ""))
    return F.when(_ascii(x), plain).otherwise(_norm(F.when(~_ascii(x), x)))


def core_words(text) -> Column:
    """Sorted distinct words of a name without legal forms and titles."""
    return F.array_sort(F.array_except(norm_words(text), F.lit(CORE_STOPWORDS)))


def latin_text(text) -> Column:
    """The text in Latin letters; only texts with others go through Python."""
    x = F.coalesce(_column(text), F.lit(""))
    return F.when(has_nonlatin(x), _latin(F.when(has_nonlatin(x), x))).otherwise(x)


def script_of(text) -> Column:
    x = _column(text)
    return F.when(has_nonlatin(x), _script(F.when(has_nonlatin(x), x)))


def phonetic(token) -> Column:
    """Consonants of a lower-case ASCII word as they sound, '' for numbers and other scripts. Digits inside a word are
    read as the letters that they look like; a leading vowel is an a."""
    t = F.coalesce(_column(token), F.lit(""))
    word = F.translate(t, "".join(OCR_DIGITS), "".join(OCR_DIGITS.values()))
    sound = F.replace(F.replace(word, F.lit("ph"), F.lit("f")), F.lit("x"), F.lit("ks"))
    sound = F.regexp_replace(sound, "(?<=[^aeiouy])h", "")
    sound = F.concat(F.when(sound.rlike("^[aeiouy]"), F.lit("a")).otherwise(F.lit("")), F.regexp_replace(sound, "[aeiouy]", ""))
    sound = F.regexp_replace(F.translate(sound, "".join(SOUNDS_AS), "".join(SOUNDS_AS.values())), r"(.)\1+", "$1")
    return F.when(t.rlike(r"^\p{Nd}+$") | ~word.rlike("^[A-Za-z]+$"), F.lit("")).otherwise(sound)


def phonetic_keys(name) -> Column:
    """Keys of the words of a name, in order; stop words, keys of stop words and keys of one letter are left out."""
    words = without(fold_words(latin_text(name)), NAME_STOPWORDS)
    return F.filter(F.transform(words, phonetic), lambda k: (F.length(k) >= 2) & ~k.isin(SILENT_KEYS))


def name_grams(name) -> Column:
    """Sorted distinct trigrams of a name's joined words."""
    joined = F.array(F.array_join(without(fold_words(latin_text(name)), NAME_STOPWORDS), ""))
    return F.array_sort(F.flatten(F.transform(joined, trigrams)))  # a lambda's body can't hold what comes from Python


def without(tokens: Column, stop: list[str]) -> Column:
    """Tokens in order, stop words left out."""
    return F.filter(tokens, lambda t: ~t.isin(stop))


def name_tokens(name: Column) -> Column:
    return without(fold_words(F.coalesce(name, F.lit(""))), NAME_STOPWORDS)


def address_tokens(address: Column) -> Column:
    return without(fold_words(F.coalesce(address, F.lit(""))), ADDRESS_STOPWORDS)


def plain_numbers(tokens: Column) -> Column:
    """Number tokens without leading zeros; zeros alone are one 0."""
    return F.transform(tokens, lambda t: F.when(t.rlike(r"^\d+$"), F.regexp_replace(t, r"^0+(?=\d)", "")).otherwise(t))


def sorted_pairs(tokens: Column) -> Column:
    """Distinct neighbours, each pair sorted."""
    n = F.size(tokens)
    two = F.zip_with(F.slice(tokens, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(tokens, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", F.least(a, b), F.greatest(a, b)))
    return F.array_distinct(two)


def trigrams(text: Column) -> Column:
    """Distinct character trigrams of a text without blanks; shorter texts are their own."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", "")
    n = F.length(s)
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring(s, i, F.lit(3)))
    return F.when(n == 0, F.array().cast("array<string>")).when(n < 3, F.array(s)).otherwise(F.array_distinct(many))


def house_number(address: Column) -> Column:
    """First part that starts with digits, without leading zeros; empty if none."""
    return F.regexp_extract(F.translate(F.coalesce(address, F.lit("")), "#,", "  "), r"(?:^|\s)0*(\d+)", 1)


def record_flags(name: Column, address: Column) -> Column:
    return F.when(has_nonlatin(name), NONLATIN_NAME).otherwise(0).bitwiseOR(F.when(F.size(address_tokens(address)) == 0, EMPTY_ADDRESS).otherwise(0))


def nonascii_share(text: Column) -> Column:
    s = F.coalesce(text, F.lit(""))
    return F.length(F.regexp_replace(s, r"[\x00-\x7F]", "")) / F.greatest(F.length(s), F.lit(1))


def null_literals(text: Column) -> Column:
    return F.when(~text.isin(NULL_LITERALS), text)


def stable_hash(entity_id: Column, salt: str) -> Column:
    """Fraction in [0, 1) from the first 8 bytes of md5(salt:id)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), entity_id)), 1, 16), 16, 10).cast("double") / F.lit(18446744073709551616.0)


def standin_tokens(name: Column, address: Column) -> Column:
    """Prefixed tokens of the stand-in blocker: words and word pairs of the name, the joined name, address words."""
    clean = lambda t: F.regexp_replace(F.array_join(fold_words(F.coalesce(t, F.lit(""))), " "), r"[^\p{L}\p{N}_]+", " ")
    split = lambda t: F.filter(F.split(t, r"\s+"), lambda x: x != "")
    n = split(F.regexp_replace(clean(name), r"\b(com|www)\b", " "))
    a = split(F.regexp_replace(clean(address), r"\b0+(\d)", "$1"))
    k = F.greatest(F.size(n) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(n, F.lit(1), k), F.slice(n, F.lit(2), k), lambda x, y: F.concat_ws(" ", x, y))
    tag = lambda mark, tokens: F.transform(F.filter(tokens, lambda t: F.length(t) > 1), lambda t: F.concat(F.lit(mark), t))
    return F.array_distinct(F.concat(tag("n:", n), tag("b:", pairs), tag("c:", F.array(F.array_join(n, ""))), tag("a:", a)))


def record_features(name: Column, address: Column) -> dict[str, Column]:
    """The six token sets of a record, by field."""
    keys, words = phonetic_keys(F.coalesce(name, F.lit(""))), plain_numbers(address_tokens(address))
    return {
        "n": F.array_distinct(name_tokens(name)),
        "p": F.array_distinct(keys),
        "pb": sorted_pairs(keys),
        "a": F.array_distinct(words),
        "ab": F.filter(sorted_pairs(words), lambda p: p.rlike(r"\d")),
        "g": name_grams(F.coalesce(name, F.lit(""))),
    }
