"""Personal data: regular expressions propose spans, checksums and ranges confirm them, context words score them.

Column expressions only. The pieces between the matches of an expression give the places of the matches: a match
starts after all pieces and matches before it. Lengths are code points.

Where a greedy expression would be tried again at every character of a run, or recurse once a repetition, the
expression used here starts at the run's border and repeats possessively; it finds the same matches in linear time.

Null texts count as empty: no spans. Overlapping spans of different kinds are all reported; ``redact`` replaces
their union. Repeated rows get equal results. Columns other than the id and the text are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import documents

SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
NONE = "array<string>"
CONTEXT = 40  # characters read on either side of a span
NEAR = 0.2  # what a context word among them adds to the score


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _mod97(match: Column) -> Column:
    compact = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(compact, 5, 100), F.substring(compact, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.length(compact).between(15, 34) & (F.aggregate(F.split(moved, ""), F.lit(0), step) == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    found: Callable[[Column], Column]  # a cheap test that every text with a match passes
    pattern: str
    valid: Callable[[Column], Column]
    context: str  # words that make a span likelier
    score: float  # without such words
    base: bool


PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
KINDS = (
    Kind("email", lambda t: t.contains("@"),
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), "e-?mail|contact|write|mailto", 0.8, True),
    Kind("ip", lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
         r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         lambda m: m.rlike(rf"^{PART}(?:\.{PART}){{3}}$"), "ip|host|server|address|login", 0.5, True),
    Kind("card", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
         r"[0-9](?:[\x20-]?[0-9])++", _luhn, "card|visa|mastercard|credit|payment|cvv", 0.7, True),
    Kind("phone", lambda t: t.contains("+"),
         r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda m: F.length(_digits(m)).between(9, 15), "phone|tel|call|mobile|fax|whatsapp", 0.6, True),
    Kind("iban", lambda t: t.rlike("[A-Z]{2}[0-9]{2}[\\x20A-Z0-9]{11}"),
         r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
         _mod97, "iban|account|bank|transfer|konto", 0.8, False),
)


def _places(text: Column, kind: Kind, matches: Column) -> Column:
    """Valid matches with their places and scores."""
    pieces = F.split(text, kind.pattern, -1)

    def step(state: Column, pair: Column) -> Column:
        start = state.at + F.length(pair["0"])
        end = start + F.length(pair["1"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["1"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state.spans, F.array(span)).alias("spans"))

    pairs = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(matches)).alias("0"), matches.alias("1"))
    empty = F.lit(None).cast("array<struct<start:bigint,end:bigint,match:string>>")
    found = F.aggregate(pairs, F.struct(F.lit(0).cast("bigint").alias("at"), F.coalesce(empty, F.array()).alias("spans")),
                        step, lambda state: state.spans)

    def scored(span: Column) -> Column:
        before = F.greatest(span.start - CONTEXT, F.lit(0))
        around = F.concat(text.substr((before + 1).cast("int"), (span.start - before).cast("int")), F.lit("\n"),
                          text.substr((span.end + 1).cast("int"), F.lit(CONTEXT)))
        near = around.rlike(rf"(?i)(?<![A-Za-z0-9_])(?:{kind.context})(?![A-Za-z0-9_])")
        return F.struct(F.lit(kind.name).alias("kind"), span.start.alias("start"), span.end.alias("end"),
                        F.when(near, round(kind.score + NEAR, 1)).otherwise(kind.score).alias("score"))

    return F.transform(F.filter(found, lambda s: kind.valid(s.match)), scored)


def find(df: DataFrame, text_col: str, out: str, least: float = 0.0) -> DataFrame:
    """``df`` with the spans of its texts in the column ``out``, by kind and place.

    Added kinds (not in the base list) stay only with a score of ``least`` or more.
    """
    text, names = F.coalesce(F.col(text_col), F.lit("")), [f"{out}_{k.name}" for k in KINDS]
    matches = {name: F.when(kind.found(text), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)))
               .otherwise(F.array().cast(NONE)) for name, kind in zip(names, KINDS)}
    df = df.withColumns(matches)
    spans = {}
    for name, kind in zip(names, KINDS):
        found = _places(text, kind, F.col(name))
        found = found if kind.base else F.filter(found, lambda s: s.score >= least)
        spans[name] = F.when(F.size(name) > 0, found).otherwise(F.array().cast(SPAN))
    df = df.withColumns(spans)
    return df.withColumn(out, F.concat(*names).cast(SPAN)).drop(*names)


def _of(spans: str, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(kinds))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, all spans and, in their order, their scores."""
    base = [k.name for k in KINDS if k.base]
    found = find(documents(docs), "text", "found").select("doc_id", "found")
    count = [F.size(_of("found", [k])).cast("long").alias(f"n_{k}") for k in base]
    scores = F.array_join(F.transform("found", lambda s: F.format_number(s.score, 1)), ",")
    return found.select("doc_id", *count, F.sha2(_listed(_of("found", base)), 256).alias("base_sha256"),
                        _listed(F.col("found")).alias("spans"), scores.alias("scores"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one. Null stays null."""
    name = "pii_spans"
    while name in docs.columns:
        name += "_"
    df = find(docs, text_col, name)
    text, zero = F.col(text_col), F.lit(0).cast("bigint")

    def step(state: Column, span: Column) -> Column:
        start = F.greatest(span.start, state.at)
        kept = F.concat(state.out, text.substr((state.at + 1).cast("int"), (start - state.at).cast("int")))
        mark = F.when(span.start >= state.at, F.concat(F.lit("["), span.kind, F.lit("]"))).otherwise("")
        return F.struct(F.greatest(span.end, state.at).alias("at"), F.concat(kept, mark).alias("out"))

    def rest(state: Column) -> Column:
        return F.concat(state.out, text.substr((state.at + 1).cast("int"), F.length(text).cast("int")))

    by_place = F.array_sort(F.transform(name, lambda s: F.struct(s.start, (-s.end).alias("last"), s.end, s.kind)))
    cut = F.aggregate(by_place, F.struct(zero.alias("at"), F.lit("").alias("out")), step, rest)
    return df.withColumn(text_col, F.when(F.size(name) > 0, cut).otherwise(text)).drop(name)
