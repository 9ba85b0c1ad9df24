import random
import re

import odd
from pyspark.sql import functions as F
from tickloom.llm import oddsketch
from tickloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {(i, len(s), root(i)) for i, s in sets}


def near_copies(seed, count, words):
    pick = random.Random(seed)
    base = odd.prose(seed, words).split()
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(pick.randrange(0, 9)):
            copy[pick.randrange(len(copy))] = f"new{pick.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_components_match_all_pairs(spark):
    texts = near_copies(1, 60, 120) + near_copies(2, 40, 30) + [odd.prose(i, 50) for i in range(10, 40)] + ["UPPER case words here", "upper CASE words here"]
    docs = odd.with_clashes(odd.documents(spark, *texts))
    rows = [(r[0], r[1]) for r in docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).select("c0", "c1").collect()]
    for n, percent in ((3, 85), (5, 80)):
        got = oddsketch.near_duplicates(docs, n, percent).collect()
        assert len(got) == len(rows)
        known = [(i, t) for i, t in rows if i is not None]
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(known, n, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
        assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    left = oddsketch.without_duplicates(docs)
    assert left.columns == docs.columns and left.count() < docs.count()
    assert oddsketch.near_duplicates(odd.empty(docs)).collect() == []


def test_blocks_are_as_whole_buckets(spark, monkeypatch):
    texts = near_copies(3, 80, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(oddsketch, "BLOCK", 7)
    monkeypatch.setattr(oddsketch, "TURNS", 0)
    got = oddsketch.near_duplicates(docs, 3, 85).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(list(enumerate(texts)), 3, 85)


def test_components_of_chains_and_stars(spark):
    pick = random.Random(6)
    order = list(range(300))
    pick.shuffle(order)
    links = list(zip(order, order[1:])) + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (None, 7), (6000, 6001), (6001, 6000)]
    table = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(table).collect()}
    assert got == {i: 0 for i in range(300)} | {i: 1000 for i in range(1000, 1200)} | {6000: 6000, 6001: 6000}
    assert components(table.where(F.lit(False))).collect() == []
