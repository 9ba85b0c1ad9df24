import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import odd
from pyspark.sql import functions as F
from tickloom.llm import fim, words

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PARTS = st.sampled_from(["a", "bc", " ", "\n", "\t\x0b", "é", "日本", "😀", "\x1c", "\xa0", "<P>", ".", "  "])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=30).map("".join), max_size=6), st.integers(0, 1000))
def test_descent_meets_every_rank(texts, pick):
    lists = fim.SkipLists.of(*words.text_bytes(pa.array(texts, pa.string())))
    units = [UNIT.findall(t) for t in texts]
    assert lists.sizes.tolist() == [len(u) for u in units]
    ranks = np.array([pick % (len(u) + 1) for u in units], np.int64)
    assert lists.places(ranks).tolist() == [len("".join(u[:r])) for u, r in zip(units, ranks)]


def test_lanes_thin_out_and_carry_widths():
    text = "word " * 50_000
    lists = fim.SkipLists.of(*words.text_bytes(pa.array([text, None, ""])))
    sizes = [len(lane.units) for lane in lists.lanes]
    assert sizes[-1] == 3 and all(b < a / 2 for a, b in zip(sizes, sizes[1:4])) and len(sizes) < 20
    for lane in lists.lanes:
        real = lane.units < fim._NO_NEXT
        assert lane.chars[real].sum() <= len(text)
    for rank in (0, 1, 777, 49_999, 50_000, 50_001):
        assert lists.places(np.array([rank, 0, 0]))[0] == len("".join(UNIT.findall(text)[:rank]))


def brute(doc_id, text, rate=50):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transformed_equals_brute_force_and_is_undone(spark):
    texts = [odd.prose(i, 3 + 7 * i) for i in range(60)] + ["a <P> b", "x <S", "<S<M", "> <", " lead", "trail \n", "a>b S>"] * 6
    docs = odd.with_clashes(odd.documents(spark, *texts)).withColumn("form", F.lit("old"))
    for rate in (50, 100):
        out = fim.transformed(docs, rate=rate)
        added = ["n", "form", "prefix_chars", "middle_chars", "output"]
        assert out.columns == [c for c in docs.columns if c != "form"] + added
        named = out.toDF(*(f"c{i}" for i in range(len(out.columns) - 5)), *added)
        rows = named.withColumn("back", fim.original(F.col("output"), F.col("form"))).collect()
        assert len(rows) == docs.count() and {"psm", "spm", "plain"} == {r.form for r in rows}
        for r in rows:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.c0, r.c1, rate)
            assert r.back == (r.c1 or "")
    assert fim.report(odd.empty(docs)).collect() == []


def test_report_has_digests(spark):
    docs = odd.documents(spark, *(odd.prose(i, 40) for i in range(20)))
    for r in fim.report(docs).collect():
        text = {x.doc_id: x.text for x in docs.collect() if x.doc_id is not None and x.doc_id < 20}.get(r.doc_id)
        if text:
            n, form, prefix, middle, output = brute(r.doc_id, text)
            assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
            assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
            assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_broken_bytes_become_replacement_characters(spark):
    docs = spark.sql("select 1L as doc_id, cast(X'6120FF2062' as string) as text")
    assert fim.transformed(docs, rate=100).collect()[0].text == "a � b"
