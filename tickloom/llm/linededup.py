"""Line deduplication by winnowing over line hashes, in DataFrame functions only.

Blank lines aside, every run of lines that just reaches ``min_words`` words is a unit. A
unit of one line and the unit behind it are fingerprints; of all others, those that are
minima of a window of ``window`` neighbouring units are. So any repeated run with a line of
``min_words`` words, or with ``window`` units one after the other, shares a fingerprint with
an earlier place.

A fingerprint's first place in a document joins its first place anywhere; each further place
in the document joins the one before it there, so that a line that comes n times makes one
comparison for each distance between neighbours, not n. The lines of the two places are then
compared along that diagonal, both ways over their whole length, and each run of equal lines
with ``min_words`` words or more is deleted from the later place. The first occurrence of a
line is never deleted: every deleted line equals one that stands before it. What stays
between deleted lines of a repeated run is under ``min_words`` words, wherever its parts
stand first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import Held, picked, written

MIN_WORDS, WINDOW = 25, 2
_BLANKS = r"[ \t\x0B\f\r]+"


def _number(text: Column) -> Column:
    """The first 60 bits of a text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _numbered(held: Held, text: str, min_words: int) -> DataFrame:
    """The rows with ``uid`` and ``lines``: place, words and two hashes of each line that is not blank."""
    line = lambda x, i: F.struct(i.alias("at"), F.trim(F.regexp_replace(x, _BLANKS, " ")).alias("line"))
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line), lambda x: x["line"] != "")
    made = lambda x: F.struct(
        x["at"].alias("at"), (F.length(x["line"]) - F.length(F.translate(x["line"], " ", "")) + 1).alias("words"),
        _number(x["line"]).alias("h"), F.xxhash64(x["line"]).alias("g"),
    )
    return held.frame.withColumn("uid", F.monotonically_increasing_id()).withColumn("lines", F.transform(lines, made))


def _units(lines: Column, min_words: int) -> Column:
    """For each line the hash of the unit that begins there; null where the document ends before min_words."""
    start = F.struct(F.lit(0).alias("words"), F.lit("").alias("text"))
    grown = lambda n, x: F.when(n["words"] >= min_words, n).otherwise(
        F.struct((n["words"] + x["words"]).alias("words"), F.concat(n["text"], F.lit(" "), x["h"].cast("string")).alias("text"))
    )
    several = lambda i: F.aggregate(
        F.slice(lines, i + 1, F.lit(min_words)), start, grown, lambda n: F.when(n["words"] >= min_words, _number(n["text"]))
    )
    one = lambda x: _number(F.concat(F.lit(" "), x["h"].cast("string")))
    return F.transform(lines, lambda x, i: F.when(x["words"] >= min_words, one(x)).otherwise(several(i)))


def _fingerprints(lines: DataFrame, window: int, min_words: int) -> DataFrame:
    """``(uid, id, unit, at, prior)``: hash and first line (from 0) of the fingerprints, and the unit's place before that in the document.

    Fingerprints are the single-line units, the units behind them and the windows' minima (the last one at ties).
    """
    unit = lambda u, i: F.struct(u.alias("unit"), (-i).alias("back"))
    units = lines.withColumn("units", F.filter(F.transform(_units(F.col("lines"), min_words), unit), lambda x: x["unit"].isNotNull()))
    count = F.size("units")
    starts = F.sequence(F.lit(1), F.greatest(count - window + 1, F.lit(1)))
    minima = F.transform(starts, lambda s: F.array_min(F.slice("units", s, F.lit(window))))
    is_long = lambda i: F.coalesce(F.get("lines", i)["words"] >= min_words, F.lit(False))
    near_long = F.filter("units", lambda x: is_long(-x["back"]) | is_long(-x["back"] - 1))
    sorted_ = units.where(count > 0).select("uid", "id", F.sort_array(F.concat(minima, near_long)).alias("found"))
    single = sorted_.select("uid", "id", F.filter("found", lambda x, i: (i == 0) | (F.get("found", i - 1) != x)).alias("found"))

    def placed(x: Column, i: Column) -> Column:
        next_ = F.get("found", i + 1)  # of the same unit: the place before
        prior = F.when(next_["unit"] == x["unit"], -next_["back"])
        return F.struct(x["unit"].alias("unit"), (-x["back"]).alias("at"), prior.alias("prior"))

    prints = single.select("uid", "id", F.explode(F.transform("found", placed)).alias("p"))
    return prints.select("uid", "id", "p.unit", "p.at", "p.prior")


def _diagonals(prints: DataFrame) -> DataFrame:
    """``(uid, source, diagonals)``: for each document the earlier ones to compare it with, itself included, and how far lines are apart."""
    opening = prints.where("prior IS NULL")
    first = opening.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "uid", "at")).alias("first")).where("n > 1")
    first = first.select("unit", F.col("first.uid").alias("source"), F.col("first.at").alias("source_at"))
    between = opening.join(first, "unit").where("uid != source").select("uid", "source", (F.col("at") - F.col("source_at")).alias("diagonal"))
    inside = prints.where("prior IS NOT NULL").select("uid", F.col("uid").alias("source"), (F.col("at") - F.col("prior")).alias("diagonal"))
    return between.unionByName(inside).groupBy("uid", "source").agg(F.collect_set("diagonal").alias("diagonals"))


def _repeated(sides: DataFrame, min_words: int) -> DataFrame:
    """``(uid, from, to)``: places of lines that are equal along a diagonal in runs of min_words words or more.

    ``sides`` has uid, diagonals and both documents' lines.
    """
    each = sides.select("uid", "lines", "first", F.explode("diagonals").alias("diagonal"))
    begin = F.greatest("diagonal", F.lit(0))
    other = begin - F.col("diagonal")
    size = F.least(F.size("lines") - begin, F.size("first") - other)
    compared = F.zip_with(
        F.slice("lines", begin + 1, size), F.slice("first", other + 1, size),
        lambda x, y: F.struct(((x["h"] == y["h"]) & (x["g"] == y["g"])).alias("same"), x["at"].alias("at"), x["words"].alias("words")),
    )
    same = each.select("uid", compared.alias("same"))

    def edges(step: int) -> Column:
        """Places of equal lines whose neighbour on that side isn't equal."""
        edge = lambda x, i: F.when(x["same"] & ~F.coalesce(F.get("same", i + step)["same"], F.lit(False)), i)
        return F.filter(F.transform("same", edge), lambda i: i.isNotNull())

    run = lambda s, e: F.struct(
        F.get("same", s)["at"].alias("from"), F.get("same", e)["at"].alias("to"),
        F.aggregate(F.slice("same", s + 1, e - s + 1), F.lit(0), lambda n, x: n + x["words"]).alias("words"),
    )
    return same.select("uid", F.inline(F.zip_with(edges(-1), edges(1), run))).where(F.col("words") >= min_words).select("uid", "from", "to")


def _merged(ranges: DataFrame) -> DataFrame:
    """Per document its ranges in order, those that overlap as one."""
    order = Window.partitionBy("uid").orderBy("from", "to")
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("new", F.when(F.col("from") <= before, 0).otherwise(1))
    parts = opened.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("uid", "part").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return whole.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("ranges"))


def marked(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with ``removed``: ranges of line numbers (from 0, ends included) that repeat what stands earlier.

    Earlier is by id, then by input order; nulls come first. Lines are equal when they are
    so after trimming and with each run of blanks as one; blank lines go with the run
    around them. Null, empty and blank texts have no range; repeated rows repeat the first
    of them. All columns stay; one named removed is replaced.
    """
    held = Held(docs)
    name, own_key = held[text], held[key]
    numbered = written(_numbered(held, name, min_words), "lines")
    lines = numbered.select("uid", F.col(own_key).alias("id"), "lines")
    prints = written(_fingerprints(lines, window, min_words), "prints")
    sides = _diagonals(prints).join(lines.select("uid", "lines"), "uid")
    sides = sides.join(lines.select(F.col("uid").alias("source"), F.col("lines").alias("first")), "source")
    ranges = _merged(_repeated(sides, min_words))
    joined = numbered.join(ranges, "uid", "left")
    empty = F.array().cast("array<struct<from:int,to:int>>")
    return held.restored(joined, {"removed": F.coalesce("ranges", empty)})


def remaining(text: Column, removed: Column) -> Column:
    """The text without the removed lines; ranges are in order and don't overlap."""

    def kept(parts: Column) -> Column:
        end = lambda i: F.coalesce(F.get(removed, i)["to"], F.lit(-1))
        gaps = F.transform(removed, lambda r, i: F.slice(parts, end(i - 1) + 2, r["from"] - end(i - 1) - 1))
        last = end(F.size(removed) - 1)
        return F.array_join(F.concat(F.flatten(gaps), F.slice(parts, last + 2, F.greatest(F.size(parts) - last - 1, F.lit(0)))), "\n")

    cut = F.transform(F.array(F.split(text, "\n")), kept)  # the text is split once, not once a range
    return F.when(F.size(removed) == 0, text).otherwise(F.get(cut, F.lit(0)))


def deduplicated(
    docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW, key: str = "doc_id", text: str = "text", keep_emptied: bool = True,
) -> DataFrame:
    """The documents with later repeated runs of lines deleted; columns as they were, ``n_chars`` follows the text if there.

    ``keep_emptied`` says whether documents of which no line is left stay. Texts that were
    null, empty or blank before always do.
    """
    held = Held(docs)
    name = held[text]
    found = marked(held.frame, min_words, window, held[key], name)
    same = F.size("removed") == 0
    frame = found.withColumn(name, remaining(F.col(name), F.col("removed")))
    if not keep_emptied:
        frame = frame.where(same | (F.regexp_replace(name, r"\s", "") != ""))
    if "n_chars" in held.names:
        count = held["n_chars"]
        frame = frame.withColumn(count, F.when(same, F.col(count)).otherwise(F.length(name)).cast(frame.schema[count].dataType))
    return frame.select(*held.columns()).toDF(*held.names)


def report(docs: DataFrame) -> DataFrame:
    """Per document: its lines, the removed ranges, and the digest of what is left."""
    found = marked(picked(docs, doc_id="doc_id", text="text"))
    left = remaining(F.col("text"), found["removed"])
    ranges = F.array_join(F.transform(found["removed"], lambda r: F.concat_ws("-", r["from"], r["to"])), ",")
    return found.select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"), ranges.alias("removed"),
        F.sha2(F.coalesce(left, F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )
