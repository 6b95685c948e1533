"""Personal data (operator 1): patterns propose spans, checksums confirm them, nearby words adjust the score.

All of it is built-in functions. Base kinds are proposed leftmost and without overlaps within a kind, and stay
whatever their score:

* ``email``, ``phone`` (8 to 15 digits), ``ip`` (four numbers of at most 255), ``card`` (16 to 19 digits, Luhn).

Added kinds count only from ``min_score`` on:

* ``iban`` (mod 97), ``shortcard`` (13 to 15 digits, Luhn; needs a word such as "card" nearby) and ``ssn``
  (three groups of digits; needs a word such as "social security" nearby).

Patterns are written so that each text is read once from left to right: possessive repeats give nothing back,
and a look-behind keeps a failed attempt from starting again inside the same run of characters. Places are in code
points, with the end excluded. A missing text counts as empty. Ids may be missing or repeat: each row gets
a row. An empty table gives no rows; other columns are not read. There is no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which they are listed, with pattern, least score and words nearby.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "shortcard", "ssn")

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    # Right after an address another one may start, in the middle of a run of such characters.
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A run has at least 16 digits from its first one on, or it has no match at all.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15}(?:[ -]?[0-9])*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "shortcard": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12}+(?:[ -]?[0-9]){0,2}+(?![ -]?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "phone": "+", "ssn": "-", "ip": "."}
GATES = {"card": "[0-9][ -]?[0-9]", "shortcard": "[0-9][ -]?[0-9]", "iban": "[A-Z]{2}[0-9]{2}"}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "shortcard": 0.4, "ssn": 0.4}
WORDS = {
    "email": "e-?mail|contact|write|address",
    "ip": "ip|address|host|server",
    "card": "card|credit|visa|mastercard|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank",
    "shortcard": "card|credit|amex|payment",
    "ssn": "ssn|social security|tax id",
}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
MIN_SCORE = 0.6

# Matches whose lengths are added up one by one; longer lists go by blocks of them.
_BLOCK = 128


def _with_matches(df: DataFrame, kind: str) -> DataFrame:
    """Add ``kind``: array of (begin, value) for all matches in ``__text``.

    A match begins after all gaps and matches before it; their lengths are added up within blocks and over
    blocks, so that the work for a text with very many matches stays near their number.
    """
    text, pattern = F.col("__text"), F.lit(PATTERNS[kind])
    none = F.array().cast("array<string>")
    tried = text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike(GATES[kind])
    df = df.withColumn("__found", F.when(tried, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none))
    some = F.size("__found") > 0
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda gap: F.length(gap))
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size("__found")), "__found", lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"))
    )
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("__pairs") - 1) / _BLOCK).cast("int")),
        lambda b: F.slice("__pairs", b * _BLOCK + 1, _BLOCK),
    )
    width = lambda acc, pair: acc + pair["gap"] + F.length(pair["value"])
    df = df.withColumn("__pairs", F.when(some, pairs))
    df = df.withColumn("__blocks", F.when(some, blocks))
    df = df.withColumn("__widths", F.transform("__blocks", lambda block: F.aggregate(block, F.lit(0), width)))

    def places(block: Column, b: Column) -> Column:
        before = F.aggregate(F.slice("__widths", 1, b), F.lit(0), lambda acc, x: acc + x)
        return F.transform(
            block,
            lambda pair, i: F.struct(
                (before + F.aggregate(F.slice(block, 1, i), F.lit(0), width) + pair["gap"]).alias("begin"),
                pair["value"].alias("value"),
            ),
        )

    found = F.when(some, F.flatten(F.transform("__blocks", places))).otherwise(
        F.array().cast("array<struct<begin:int,value:string>>")
    )
    return df.withColumn(kind, found).drop("__found", "__pairs", "__blocks", "__widths")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check digit of a string of digits is right."""

    def add(acc: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """An account number with its first four characters moved to the end leaves 1, letters read as 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & luhn(_digits(value))
    if kind == "shortcard":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34) & mod97(value)
    return F.lit(True)


def _scored(kind: str, match: Column) -> Column:
    begin, stop = match["begin"], match["begin"] + F.length(match["value"])
    first = F.greatest(begin - CONTEXT_CHARS, F.lit(0))
    around = F.concat(
        F.substr("__text", first + 1, begin - first), F.lit(" "), F.substr("__text", stop + 1, F.lit(CONTEXT_CHARS))
    )
    near = F.lower(around).rlike(rf"\b(?:{WORDS[kind]})\b")
    return F.struct(
        F.lit(kind).alias("kind"),
        begin.alias("start"),
        stop.alias("end"),
        F.least(F.lit(1.0), F.lit(SCORES[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)).alias("score"),
    )


def find_pii(docs: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``spans``: array of (kind, start, end, score), by kind as listed and then by start."""
    df = docs.select(F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("__text"))
    for kind in KINDS:
        df = _with_matches(df, kind)

    def spans(kind: str) -> Column:
        found = F.transform(
            F.filter(F.col(kind), lambda m: _confirmed(kind, m["value"])), lambda m: _scored(kind, m)
        )
        return found if kind in BASE else F.filter(found, lambda span: span["score"] >= min_score)

    return df.select(F.col("__id").alias(id_col), F.concat(*[spans(kind) for kind in KINDS]).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: reduce(lambda a, b: a | b, [s["kind"] == kind for kind in kinds]))
