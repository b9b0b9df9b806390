"""Personal data, by native expressions only.

For each kind a regular expression proposes spans, a checksum or a range confirms
them, and context words shortly before a span adjust its score; spans that reach
the threshold are kept. Positions come from the text itself: the matches are put
between marks, the text is cut at the marks, and lengths are added up. Everything
is a projection of one row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import whole

#: Put around matches; in the text that is searched it is replaced by a character that no pattern takes either.
MARK, OTHER = "\x01", "\x03"
#: Characters before a span in which context words count.
CONTEXT = 40
THRESHOLD = 0.7
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _solid(value: str) -> str:
    return f"replace({value}, ' ', '')"


def luhn(value: str) -> str:
    """SQL: the digits of ``value`` pass the Luhn check."""
    at = f"cast(substr({value}, length({value}) - i, 1) as int)"
    doubled = f"if(i % 2 = 1, if({at} > 4, {at} * 2 - 9, {at} * 2), {at})"
    return f"aggregate(sequence(0, length({value}) - 1), 0, (s, i) -> s + {doubled}) % 10 = 0"


def mod97(value: str) -> str:
    """SQL: the letters and digits of ``value``, first four last, leave 1 when divided by 97."""
    turned = f"concat(substr({value}, 5), substr({value}, 1, 4))"
    code = "if(ascii(c) >= 65, ascii(c) - 55, ascii(c) - 48)"
    rest = f"pmod(if(ascii(c) >= 65, s * 100, s * 10) + {code}, 97)"
    return f"aggregate(regexp_extract_all({turned}, '(.)', 1), 0, (s, c) -> cast({rest} as int)) = 1"


def _octets(value: str) -> str:
    return f"forall(split({value}, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(right(p, 3) as int) <= 255)"


@dataclass(frozen=True)
class Kind:
    """``hint``: SQL over the text ``t``, what it must hold for the pattern to be tried. ``valid``: SQL of a match.
    Base kinds are kept whenever they are valid; the others need the threshold."""

    name: str
    pattern: str
    hint: str
    valid: Callable[[str], str]
    base: bool
    score: float = 1.0
    words: str = ""
    context: float = 0.0


#: The patterns of the base kinds are searched once from each place where a match can start: possessive
#: runs, and no start inside a run. They find the same leftmost spans as their plain forms.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains(t, '@')", lambda v: "true", True,
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "contains(t, '.')", _octets, True),
    Kind(
        "card", r"[0-9](?:[ -]?[0-9])++", "true",
        lambda v: f"length({_digits(v)}) between 13 and 19 and {luhn(_digits(v))}", True,
    ),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", "contains(t, '+')",
        lambda v: f"length({_digits(v)}) between 9 and 15", True,
    ),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", "true",
        lambda v: f"length({_solid(v)}) between 15 and 34 and {mod97(_solid(v))}", False,
        0.7, "iban|account|bank|konto|compte|cuenta", 0.3,
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "contains(t, '-')",
        lambda v: f"left({v}, 3) not in ('000', '666') and left({v}, 1) <> '9' and substr({v}, 5, 2) <> '00' "
        f"and substr({v}, 8) <> '0000'", False,
        0.4, "ssn|social security|tax id|taxpayer", 0.4,
    ),
)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _proposed(pieces: str) -> str:
    """SQL: every second piece is a match; its place is the length of all before it."""
    empty = "cast(array() as array<struct<s: int, e: int, v: string>>)"
    one = "array(struct(a.at as s, a.at + char_length(x) as e, x as v))"
    return (
        f"aggregate({pieces}, struct(0 as at, false as hit, {empty} as found), "
        f"(a, x) -> struct(a.at + char_length(x) as at, not a.hit as hit, if(a.hit, concat(a.found, {one}), a.found) as found), "
        "a -> a.found)"
    )


def _kept(kind: Kind, found: str) -> str:
    """SQL: start, end and score of the spans that stay."""
    score = f"{kind.score}D"
    if kind.words:
        near = f"translate(substr(text, greatest(p.s - {CONTEXT}, 0) + 1, least({CONTEXT}, p.s)), '{UPPER}', '{UPPER.lower()}')"
        score += f" + if({near} rlike '(^|[^a-z])(?:{kind.words})([^a-z]|$)', {kind.context}D, 0D)"
    valid = f"filter({found}, p -> {kind.valid('p.v')})"
    scored = f"transform({valid}, p -> struct(p.s as s, p.e as e, round({score}, 3) as score))"
    return scored if kind.base else f"filter({scored}, p -> p.score >= {THRESHOLD})"


def find_spans(df: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """``df`` with ``spans_col``: array<struct<kind, start, end, score>>, by kind in the order of ``KINDS``, then start.

    Starts and ends are places of code points, the end exclusive. A null or empty text
    has an empty array. Kinds may overlap; within a kind spans do not. Columns of the
    input keep their values, whatever their names.
    """
    inner = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns if c != spans_col)).alias("row"),
        whole(F.col(f"`{text_col}`").cast("string")).alias("text"),
    ).withColumn("t", F.translate("text", MARK, OTHER))
    for kind in KINDS:
        marked = f"if({kind.hint}, regexp_replace(t, {_literal(f'({kind.pattern})')}, '\\u0001$1\\u0001'), '')"
        inner = inner.withColumn(f"m_{kind.name}", F.split(F.expr(marked), MARK, -1))
    none = "cast(array() as array<struct<s: int, e: int, score: double>>)"
    for kind in KINDS:
        pieces = f"m_{kind.name}"
        inner = inner.withColumn(
            f"s_{kind.name}", F.expr(f"if(size({pieces}) > 1, {_kept(kind, _proposed(pieces))}, {none})")
        )
    tagged = [
        f"transform(s_{k.name}, p -> struct('{k.name}' as kind, p.s as start, p.e as `end`, p.score as score))" for k in KINDS
    ]
    return inner.select("row.*", F.expr(f"concat({', '.join(tagged)})").alias(spans_col))


def _shown(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    if kinds:
        spans = f"filter({spans}, x -> x.kind in ({', '.join(repr(k) for k in kinds)}))"
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.`end`)), ',')")


def summary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, numbers of base spans, a hash of the base spans, all spans as text."""
    base = tuple(kind.name for kind in KINDS if kind.base)
    found = find_spans(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")))
    counts = [F.expr(f"cast(size(filter(pii, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base]
    return found.select(
        F.col("id").alias(id_col), *counts, F.sha2(_shown("pii", base), 256).alias("base_sha256"), _shown("pii").alias("spans")
    )


def masked(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span replaced by its kind in angle brackets; of overlapping spans the first, and of those
    with one start the longest, is replaced. A null text stays null; other columns are untouched."""
    spans = "pii"
    while spans in df.columns:
        spans += "_"
    found = find_spans(df, text_col, spans)
    order = f"array_sort(`{spans}`, (a, b) -> if(a.start <> b.start, a.start - b.start, b.`end` - a.`end`))"
    step = (
        "if(x.start < a.at, a, struct(x.`end` as at, concat(a.out, "
        f"substr(`{text_col}`, a.at + 1, x.start - a.at), '<', upper(x.kind), '>') as out))"
    )
    text = (
        f"aggregate({order}, struct(0 as at, '' as out), (a, x) -> {step}, "
        f"a -> concat(a.out, substr(`{text_col}`, a.at + 1)))"
    )
    new = F.when(F.size(spans) > 0, F.expr(text)).otherwise(F.col(f"`{text_col}`"))
    return found.withColumn(text_col, new).drop(spans).select(*(F.col(f"`{c}`") for c in df.columns))
