"""Personal data in text: patterns propose spans, checksums confirm them, context words weigh them.

DataFrame functions only. Where the matches of a pattern stand follows from the pieces
between them: a text is its pieces and its matches, turn by turn. Repetitions are possessive,
so that matching neither recurses nor backtracks over a long run of digits, and a match
begins at a run's first character or where the last match ended, so that a run is read once.
Starts are sums over runs of pieces and then over the runs, and context comes from blocks of
the text, so that the work grows with a text's length and not with its spans times its length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Held, picked

CONTEXT_CHARS = 40
THRESHOLD = 0.5
_RUN, _BLOCK = 256, 512


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit at the end is right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda n, d: n + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether the first four characters, moved behind and read as numbers (A is 10), leave 1 modulo 97."""
    moved = F.concat(F.substring(code, 5, 100), F.substring(code, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda n, c: F.when(c.between("0", "9"), (n * 10 + value(c)) % 97).otherwise((n * 100 + value(c)) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda n, c: F.when(c == "", n).otherwise(step(n, c))) == 1


@dataclass(frozen=True)
class Kind:
    """``hint``: a text without it has no match. ``base`` spans stay whatever their score."""

    name: str
    hint: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    words: str
    base: bool = True


_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Lengths of IBANs, by country (fixed values).
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22,
    "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}


def _iban(match: Column) -> Column:
    code = F.translate(match, " ", "")
    table = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))
    return (F.length(code) == F.try_element_at(table, F.substring(code, 1, 2))) & mod97(code)


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(16, 19) & luhn(digits)


#: The kinds in the order of reports. Patterns, checks and the context words that raise a score.
KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.8, "mail|contact|write"),
    Kind("ip", ".", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", lambda m: m.rlike(rf"^{_PART}(\.{_PART}){{3}}$"), 0.5, r"\bip\b|address|server|host|login"),
    Kind("card", "", r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+", _card, 0.7, "card|visa|credit|debit|payment|karte|carte|tarjeta"),
    Kind("phone", "+", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", "", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", _iban, 0.6, "iban|account|bank|konto|compte|cuenta", False),
    Kind("ssn", "-", r"[0-9]++(?:-[0-9]++)++", lambda m: m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), 0.3, r"\bssn\b|social security", False),
)
_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(pieces: Column, valid: Callable[[Column], Column]) -> Column:
    """The valid matches with their starts: runs of ``_RUN`` pieces are summed up each by itself, then the runs' widths."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,match:string>>").alias("out"))

    def step(n: Column, x: Column) -> Column:
        begin = n["at"] + x["gap"]
        held = F.array(F.struct(begin.alias("start"), x["match"].alias("match")))
        out = F.when(x["match"].isNotNull() & valid(x["match"]), F.concat(n["out"], held)).otherwise(n["out"])
        return F.struct((begin + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"), out.alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    further = lambda n, run: F.struct((n["at"] + run["at"]).alias("at"), F.concat(n["out"], F.array(n["at"])).alias("out"))
    moved = lambda run, by: F.transform(run["out"], lambda x: F.struct((x["start"] + by).alias("start"), x["match"].alias("match")))
    runs = F.transform(F.sequence(F.lit(1), F.size(pieces), F.lit(_RUN)), lambda i: F.aggregate(F.slice(pieces, i, F.lit(_RUN)), start, step))
    return _with(runs, lambda made: F.flatten(F.zip_with(made, F.aggregate(made, none, further, lambda n: n["out"]), moved)))


def _spans(text: Column, blocks: Column, kind: Kind) -> Column:
    """The kind's confirmed spans in order: code points from 0, end exclusive. ``blocks`` are the text's pieces of ``_BLOCK`` characters."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.transform(
        F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), found.alias("match")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), x["match"].alias("match")),
    )

    def scored(x: Column) -> Column:
        begin, end = x["start"], x["start"] + F.length(x["match"])
        first = F.greatest(begin - CONTEXT_CHARS, F.lit(0))
        block = F.floor(first / _BLOCK).cast("int")
        around = F.concat(F.coalesce(F.get(blocks, block), F.lit("")), F.coalesce(F.get(blocks, block + 1), F.lit("")))
        near = F.substring(around, first - block * _BLOCK + 1, begin - first)
        score = F.when(F.lower(near).rlike(kind.words), F.least(F.lit(1.0), F.lit(kind.score + 0.3))).otherwise(F.lit(kind.score))
        return F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score"))

    spans = F.transform(_with(pieces, lambda p: _placed(p, kind.valid)), scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    return F.when(_possible(text, kind), spans).otherwise(F.array().cast(_SPANS))


def _possible(text: Column, kind: Kind) -> Column:
    return (text.contains(kind.hint) if kind.hint else F.lit(True)) & text.rlike(kind.pattern)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``pii``: all confirmed spans of their whole texts, by kind as listed, then by place.

    A span has kind, start, end (code points, end exclusive) and score. Base kinds (email,
    ip, card, phone) are never dropped for a low score; further kinds need ``THRESHOLD``.
    Null and empty texts have no span; rows stay as they are, repeated ones too. A column
    named pii is replaced.
    """
    held = Held(docs)
    name = held[text]
    frame = held.frame.withColumn("whole", F.coalesce(F.col(name), F.lit("")))
    blocks = F.regexp_extract_all("whole", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    frame = frame.withColumn("blocks", F.when(F.col("whole").rlike("[0-9@]"), blocks))  # each kind needs a digit or @
    frame = frame.withColumns({f"found_{kind.name}": _spans(F.col("whole"), F.col("blocks"), kind) for kind in KINDS})
    return held.restored(frame, {"pii": F.concat(*(F.col(f"found_{kind.name}") for kind in KINDS))})


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span of personal data as its kind in angle brackets; overlapping spans become one."""
    held = Held(docs)
    found = find(held.frame, held[text])
    name, spans = F.col(held[text]), F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(n: Column, s: Column) -> Column:
        plain = F.concat(n["out"], name.substr(n["at"] + 1, s["start"] - n["at"]), F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.greatest(n["at"], s["end"]).alias("at"), F.when(s["start"] >= n["at"], plain).otherwise(n["out"]).alias("out"))

    clean = F.aggregate(spans, start, step, lambda n: F.concat(n["out"], name.substr(n["at"] + 1, F.length(name))))
    frame = found.withColumn(held[text], F.when(F.size(spans) == 0, name).otherwise(clean))
    return frame.select(*held.columns()).toDF(*held.names)


def report(docs: DataFrame) -> DataFrame:
    """Per document: how many spans of each base kind, their digest, and all spans as text."""
    found = find(picked(docs, doc_id="doc_id", text="text")).select("doc_id", F.col("pii").alias("found"))
    base = F.array(*(F.lit(kind.name) for kind in KINDS if kind.base))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda name: F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    return found.select(
        "doc_id", *(count(kind.name) for kind in KINDS if kind.base),
        F.sha2(joined(F.filter("found", lambda s: F.array_contains(base, s["kind"]))), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )
