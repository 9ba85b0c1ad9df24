import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import odd
from pyspark.sql import functions as F
from tickloom.llm import lexical, words
from tickloom.llm.common import picked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(lexical._UPPER, lexical._LOWER)


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    n_docs, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms_of(t))
    out = []
    for item, terms in asked.items():
        found = []
        for i, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n_docs) // total
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in terms if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:50], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("entries", [lexical.BLOCK_ENTRIES, 40])
def test_ranks_equal_brute_force(spark, entries):
    texts = [odd.prose(i, 20 + i % 30) for i in range(120)]
    texts += [odd.prose(5, 25)] * 70 + [odd.prose(6, 25).upper().replace(" ", " - ")] * 3 + ["Straße ÄRGER ärger Ärger"]
    docs = odd.with_clashes(odd.documents(spark, *texts))
    rows = [(i, odd.prose(1000 + i, 15)) for i in range(8)] + [(2, odd.prose(5, 10)), (20, odd.prose(5, 25)), (21, None), (22, ""), (23, "ärger nowhere")]
    rows += [(None, odd.prose(6, 12)), (24, "nowhere"), (20, odd.prose(5, 25))]
    items = spark.createDataFrame([(i, t, "mine") for i, t in rows], "item_id long, text string, term string")
    got = lexical.search(docs, items, entries).collect()
    plain = [(r.doc_id, r.text) for r in picked(docs, doc_id="doc_id", text="text").collect()]
    assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got), key=str) == brute(plain, rows)
    assert lexical.search(odd.empty(docs), items).collect() == [] == lexical.search(docs, odd.empty(items)).collect()


def test_text_ids_of_items_and_order_of_ids(spark):
    docs = spark.createDataFrame([(i, "one two") for i in range(200, 0, -1)] + [(0, "other")], "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([("b", "two"), ("a", "two one one")], "item_id string, text string")
    got = {(r.item_id, r["rank"]): r.doc_id for r in lexical.search(docs, items).collect()}
    assert got == {(item, i): i for item in "ab" for i in range(1, 51)} or not got  # weights of terms in nearly all documents may be 0
    rare = docs.union(spark.createDataFrame([(1000 + i, "filler") for i in range(600)], docs.schema))
    got = {(r.item_id, r["rank"]): r.doc_id for r in lexical.search(rare, items).collect()}
    assert got == {(item, i): i for item in "ab" for i in range(1, 51)}


def test_classes_are_verified_on_whole_vectors(spark):
    rows = [(1, 5, [1, 2], [1, 1]), (2, 5, [1, 2], [1, 1]), (3, 5, [1, 2], [1, 2]), (4, 6, [1, 2], [1, 1]), (None, 6, [1, 2], [1, 1]), (6, 5, [], [])]
    made = spark.createDataFrame(rows, "doc_id long, m long, terms array<int>, tfs array<int>")
    found = lexical.classes(made.withColumn("h", F.lit(7).cast("long"))).collect()  # all hashes collide
    assert sorted((r.m, r.tfs, r.members, r.first_doc) for r in found) == [(5, [1, 1], 2, 1), (5, [1, 2], 1, 3), (6, [1, 1], 2, 4)]


def test_terms_are_found_byte_for_byte():
    vocabulary, place = lexical.Vocabulary.of(["alpha", "alphabeticallylong", "ärger", "a"])
    found = words.words_of(*words.text_bytes(pa.array(["Alpha ALPHABETICALLYLONG alphabeticallylonG1 ärger A b"])), words.ALPHANUMERIC)
    at, number = vocabulary.numbers(found)
    assert at.tolist() == [0, 1, 3, 4] and number.tolist() == place.tolist()
    same_hash = lexical.Vocabulary(np.sort(found.hashes[[5]]), np.array([0]), np.array([1]), np.zeros(9, np.uint8))
    assert not len(same_hash.numbers(found)[0])
