"""Secret scans: known formats, and windows of high Shannon entropy.

Known formats are regular expressions. What they miss are random strings: in
candidate strings of one character class, a window slides one character at a
time; the counts of its characters, and the sum of c log2(c) over them, are
kept up to date from the character that enters and the one that leaves, in
whole numbers so that nothing drifts. Windows over the class's entropy bound
are merged into spans unless an allow-list names the candidate.

Everything runs row by row in built-in functions; no row leaves its place.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import text_or_empty

# The three known formats and the least length of what they must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")

#: A window's sum of c log2(c) is kept in units of 2 to the power of -20.
UNIT = 1 << 20
#: Candidate characters are counted in an array from '+' to 'z'.
FIRST_CODE, CODES = ord("+"), ord("z") - ord("+") + 1


@dataclass(frozen=True)
class EntropyClass:
    """A character class: its candidates, the window and the least entropy in bits of a flagged window."""

    kind: str
    candidates: str
    window: int
    bits: float

    def most_sum(self) -> int:
        """Entropy is log2(w) - sum / w; this is the largest sum that still reaches ``bits``."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)

    def terms(self) -> list[int]:
        return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(self.window + 1)]


CLASSES = (
    EntropyClass("entropy_hex", r"[0-9A-Fa-f]{24,}", 24, 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_-]{24,}", 24, 4.0),
)

#: Candidates that match one of these are no secrets: numbers, UUIDs, placeholders, alphabets in order.
ALLOWED = (
    r"^[0-9]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)example|placeholder|changeme|your[_-]?(api|secret|token|key)",
    r"(?i)0123456789abcdef|abcdefghijklmnop",
)

SPAN = "array<struct<s:int,o:int,e:int>>"


def _span(start: Column, order: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("s"), F.lit(order).alias("o"), end.cast("int").alias("e"))


def _no_spans() -> Column:
    return F.array().cast(SPAN)


#: Matches located together, and the length from which a text is located by blocks of so many.
BLOCK, LONG_TEXT = 256, 20_000
FOUND = "array<struct<s:int,m:string>>"


def _places(parts: Column, first: Column) -> Column:
    """Where each of some matches (g: gap before it, m: its text) starts, from the place where the first gap does."""
    return F.aggregate(
        parts,
        F.struct(first.cast("int").alias("at"), F.array().cast(FOUND).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + F.length(x["m"])).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("s"), x["m"].alias("m")))).alias("out"),
        ),
        lambda a: a["out"],
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _places_by_block(parts: Column) -> Column:
    """``_places`` from the text's start, block by block: adding to an array copies it, and there may be very many matches."""

    def located(blocks: Column) -> Column:
        widths = F.transform(blocks, lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x["g"] + F.length(x["m"])))
        ahead = F.aggregate(
            widths,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, w: F.struct((a["at"] + w).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"],
        )
        return F.flatten(F.zip_with(blocks, ahead, _places))

    starts = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
    return _with(F.transform(starts, lambda b: F.slice(parts, b * BLOCK + 1, BLOCK)), located)


def _located(text: Column, pattern: str) -> Column:
    """Matches of a pattern, leftmost and not overlapping: array of (s, m), by start.

    A text split at its matches gives the gaps between them; a match starts
    where the gaps and matches before it end.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One gap more than matches: the last is the text's end.
    parts = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    found = F.when(F.length(text) < LONG_TEXT, _places(parts, F.lit(0))).otherwise(_with(parts, _places_by_block))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(FOUND))


def base_spans(text: Column) -> Column:
    """Spans of the known formats, of all kinds, unsorted."""
    assign = F.filter(_located(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6)
    access = F.filter(_located(text, ACCESS), lambda x: F.length(x["m"]) >= 20)
    kinds = [assign, access, _located(text, HEX)]
    return F.concat(*[F.transform(found, partial(_whole, o)) for o, found in enumerate(kinds)])


def _differs(pattern: str, found: Column) -> Column:
    return ~found["m"].rlike(pattern)


def _whole(order: int, found: Column) -> Column:
    return _span(found["s"], order, found["s"] + F.length(found["m"]))


def _flagged(cls: EntropyClass, order: int, found: Column) -> Column:
    """Merged spans of the windows of one candidate (s, codes) whose entropy reaches the class's bound."""
    codes = found["codes"]
    terms = F.array(*[F.lit(t) for t in cls.terms()])
    term = lambda n: F.get(terms, n)
    w = cls.window

    def step(a: Column, i: Column) -> Column:
        new, old = F.get(codes, i), F.when(i >= w, F.get(codes, i - w))
        had = F.get(a["count"], old)
        gone = F.when(i >= w, term(had - 1) - term(had)).otherwise(0)
        here = F.get(a["count"], new) - (new.eqNullSafe(old)).cast("int")
        total = a["sum"] + gone + term(here + 1) - term(here)
        count = F.transform(a["count"], lambda c, j: c + (j == new).cast("int") - j.eqNullSafe(old).cast("int"))
        hit = (i >= w - 1) & (total <= cls.most_sum())
        joins = hit & (i - w + 1 <= a["end"])
        close = hit & ~joins & (a["end"] > 0)
        return F.struct(
            count.alias("count"),
            total.cast("long").alias("sum"),
            F.when(hit & ~joins, i - w + 1).otherwise(a["start"]).cast("int").alias("start"),
            F.when(hit, i + 1).otherwise(a["end"]).cast("int").alias("end"),
            F.when(close, F.concat(a["out"], F.array(_span(found["s"] + a["start"], order, found["s"] + a["end"])))).otherwise(a["out"]).alias("out"),
        )

    zero = F.struct(
        F.array_repeat(F.lit(0), CODES).alias("count"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(0).alias("start"),
        F.lit(0).alias("end"),
        _no_spans().alias("out"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.size(codes) - 1),
        zero,
        step,
        lambda a: F.when(a["end"] > 0, F.concat(a["out"], F.array(_span(found["s"] + a["start"], order, found["s"] + a["end"])))).otherwise(a["out"]),
    )


def entropy_spans(text: Column, classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Spans of high-entropy windows, of all classes, unsorted; allow-listed candidates give none."""
    out = []
    for k, cls in enumerate(classes):
        found = _located(text, cls.candidates)
        for pattern in allowed:
            found = F.filter(found, partial(_differs, pattern))
        coded = F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.transform(F.split(x["m"], ""), lambda c: F.ascii(c) - FIRST_CODE).alias("codes")))
        out.append(F.flatten(F.transform(coded, partial(_flagged, cls, len(BASE_KINDS) + k))))
    return F.concat(*out)


def span_text(spans: Column, classes: tuple[EntropyClass, ...] = CLASSES) -> Column:
    """Sorted spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*BASE_KINDS, *[c.kind for c in classes])])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["o"]), x["s"], x["e"])), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple[EntropyClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per input row: id, ``base`` and ``spans`` (arrays of s, o, e: start, kind's place, end).

    Offsets are code points, ends exclusive; ``spans`` holds the base spans and
    those the entropy adds, by start, then kind. The allow-list never removes a
    base span. Defined cases: a null or empty text has no spans; repeated rows
    each get their row; a null id stays null; an empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    df = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
    df = df.select("_id", F.sort_array(base_spans(F.col("_t"))).alias("base"), entropy_spans(F.col("_t"), classes, allowed).alias("more"))
    return df.select(F.col("_id").alias(id_col), "base", F.sort_array(F.concat("base", "more")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<secret>") -> DataFrame:
    """The input with every span of its text replaced by ``mask`` (overlapping spans by one).

    Null texts stay null, texts without spans as they are; rows and other columns do not change.
    """
    text = F.col("_t")
    names = docs.columns
    temp = [f"c{i}" for i in range(len(names))]
    at = temp[names.index(text_col)]
    df = docs.toDF(*temp).withColumn("_t", text_or_empty(at))
    df = df.withColumn("_s", F.sort_array(F.concat(base_spans(text), entropy_spans(text))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    masked = F.aggregate(
        "_s",
        zero,
        lambda a, x: F.struct(
            F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substr(text, a["at"] + 1, x["s"] - a["at"]), F.lit(mask))).alias("out"),
            F.greatest(a["at"], x["e"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)),
    )
    df = df.withColumn(at, F.when(F.size("_s") > 0, masked).otherwise(F.col(at)))
    return df.select(*temp).toDF(*names)
