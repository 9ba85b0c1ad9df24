"""Fill-in-middle transformation: texts cut at two ranks of units, found in an indexable skip list.

A unit is a word with the white space before it; white space at the end of a text is a unit of
its own. The boundaries between units are the nodes of a skip list. Every node is in the
lowest lane; a fixed hash of its rank says how many express lanes hold it too. A node carries
two widths per lane: units and code points up to the lane's next node. A cut rank is reached from
the top lane down: forward while the units passed do not exceed the rank, else one lane down. In
the lowest lane the rank is met exactly, and the code points passed are the place of the cut.

The lists of all texts of a batch lie in the same arrays, so one descent serves many texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import Held, picked

# Fixed values of the format: the marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 42, 50, 80
#: A lane holds about one of so many nodes of the lane below.
FANOUT_BITS = 2
_SPACE = ~words.UNSPACED.word
_NO_NEXT = np.int64(1) << np.int64(62)


@dataclass(frozen=True)
class Lane:
    """Nodes of all lists in order: widths to the lane's next node of the same list, and the node's place one lane below."""

    units: np.ndarray
    chars: np.ndarray
    down: np.ndarray


@dataclass(frozen=True)
class SkipLists:
    """One skip list per text: ``lanes`` from the lowest to the top one, which holds the heads only; ``sizes`` in units."""

    lanes: list[Lane]
    sizes: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> SkipLists:
        """Lists over the UTF-8 texts ``data[offsets[i]:offsets[i + 1]]``."""
        space = _SPACE[data]
        first = space.copy()
        first[1:] &= ~space[:-1]  # white space right after a word begins a unit, and so does a text
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(first)
        place = np.searchsorted(starts, offsets)
        sizes = np.diff(place)
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=before[1:])
        chars = np.diff(before[np.append(starts, len(data))])
        # One node before each unit and one at the end of each text, which has no next one.
        heads = place[:-1] + np.arange(len(sizes))
        ends = heads + sizes
        inner = np.ones(len(starts) + len(sizes), bool)
        inner[ends] = False
        units, widths = np.full(len(inner), _NO_NEXT), np.zeros(len(inner), np.int64)
        units[inner], widths[inner] = 1, chars
        rank = np.arange(len(inner)) - np.repeat(heads, sizes + 1)
        return cls(_lanes(Lane(units, widths, np.arange(len(inner))), rank), sizes)

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """For text i the code points before its unit ``ranks[i]`` (0 to its size)."""
        at = np.arange(len(self.sizes))  # the top lane holds one head per text
        passed, chars = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for lane in reversed(self.lanes):
            moving = np.flatnonzero(passed + lane.units[at] <= ranks)
            while len(moving):
                here = at[moving]
                passed[moving] += lane.units[here]
                chars[moving] += lane.chars[here]
                at[moving] = here + 1
                moving = moving[passed[moving] + lane.units[here + 1] <= ranks[moving]]
            at = lane.down[at]
        return chars


def _lanes(lowest: Lane, rank: np.ndarray) -> list[Lane]:
    """The lowest lane and the express lanes over it; ``rank`` is 0 at a list's head."""
    lanes, mask = [lowest], np.uint64((1 << FANOUT_BITS) - 1)
    height = words.mixed(rank.astype(np.uint64) + np.uint64(1))
    while (rank > 0).any():
        below = lanes[-1]
        kept = np.flatnonzero((rank == 0) | ((height & mask) == 0))
        rank, height = rank[kept], height[kept] >> np.uint64(FANOUT_BITS)
        last = np.append(rank[1:] == 0, True)  # the next kept node is the head of another list
        reach = below.units.copy()
        reach[reach == _NO_NEXT] = 0
        units = np.where(last, _NO_NEXT, np.add.reduceat(reach, kept))
        lanes.append(Lane(units, np.where(last, 0, np.add.reduceat(below.chars, kept)), kept))
    return lanes


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first groups of the SHA-256 of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _arranged(texts: list[str], draw: np.ndarray, rate: int, spm_rate: int, lists: SkipLists):
    low, high = draw[0] % (lists.sizes + 1), draw[1] % (lists.sizes + 1)
    a, b = lists.places(np.minimum(low, high)), lists.places(np.maximum(low, high))
    changed, spm = draw[2] % 100 < rate, draw[3] % 100 < spm_rate
    forms, outputs, plain = [], [], np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        if not text or not changed[i] or PREFIX in text or SUFFIX in text or MIDDLE in text:
            plain[i] = True
            forms.append("plain")
            outputs.append(text)
            continue
        prefix, middle, suffix = text[: a[i]], text[a[i] : b[i]], text[b[i] :]
        forms.append("spm" if spm[i] else "psm")
        if spm[i]:
            outputs.append("".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)))
        else:
            outputs.append("".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
    return forms, outputs, pa.array(a, mask=plain), pa.array(b - a, mask=plain)


def transformed(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents with ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text.

    ``rate`` of 100 texts are rearranged, ``spm_rate`` of 100 of these suffix first. Plain (the
    text itself, no widths) stay the others, and all texts that are empty or hold a mark. Null
    texts count as empty. Both cuts of a text depend on seed and id only, so repeated rows come
    out alike. Rows and columns stay as they are; columns of the added names are replaced.
    Bytes that are not UTF-8 count as U+FFFD.
    """
    held = Held(docs)
    name = held[text]
    valid = F.make_valid_utf8(F.coalesce(F.col(name), F.lit("")))
    frame = held.frame.select("*", valid.alias("_text"), *(x.alias(f"_h{i}") for i, x in enumerate(draws(F.col(held[key]), seed))))
    frame = frame.drop(name)
    at, kept = frame.columns.index("_text"), [c for c in frame.columns if c.removeprefix("_").isdigit()]
    places = [frame.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, at):
                lists = SkipLists.of(*words.text_bytes(piece.column(at)))
                draw = np.stack([piece.column(at + 1 + i).to_numpy() for i in range(4)])
                texts = piece.column(at).to_pylist()
                forms, outputs, prefix, middle = _arranged(texts, draw, rate, spm_rate, lists)
                added = [piece.column(at), pa.array(lists.sizes), pa.array(forms, pa.string()), prefix, middle, pa.array(outputs, pa.string())]
                columns = [piece.column(i) for i in places]
                yield pa.RecordBatch.from_arrays([*columns, *added], [*kept, name, "n", "form", "prefix_chars", "middle_chars", "output"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields if f.name in kept)
    out = frame.mapInArrow(run, kinds + f"`{name}` string, n long, form string, prefix_chars long, middle_chars long, output string")
    return held.restored(out, {c: F.col(c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")})


def original(output: Column, form: Column) -> Column:
    """The text behind an output, exactly; a null form or output gives null."""
    part = F.split(output, "<[PSM]>")
    rebuilt = F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1]))
    return F.when(form == "plain", output).otherwise(rebuilt)


def report(docs: DataFrame) -> DataFrame:
    """Per document: units, form, widths, and the digests of the output and of the text rebuilt from it."""
    made = transformed(picked(docs, doc_id="doc_id", text="text"))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(original(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
