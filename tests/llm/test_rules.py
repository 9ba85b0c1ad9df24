import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import odd
from tickloom.llm import rules
from tickloom.llm.common import picked

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PARTS = st.sampled_from(["a", "b", "a b c d e", "A", " ", "\n", "\t", "é", "日本", "#", "<|>", "\r\n", "\x1c", "a a a"])


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    hit = {i + k for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for k in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dups, len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=60).map("".join), max_size=5))
def test_counts_equal_brute_force(texts):
    counts, features = rules.statistics(pa.array([*texts, None], pa.string()))
    assert [tuple(c) for c in counts.tolist()] == [brute(t) for t in [*texts, None]]
    assert np.isfinite(features).all() and not features[-1].any() and features.shape[1] == len(rules.FEATURES)


def made_rows(n=1500, seed=3):
    pick = np.random.default_rng(seed)
    x = pick.normal(size=(n, 5))
    wave = np.sin(2 * x[:, 0]) + x[:, 1] - 0.5 * x[:, 2] ** 2
    return x, (wave + pick.normal(scale=0.3, size=n) > 0).astype(int)


def walked(trees, row):
    total = trees.start
    for root in trees.roots:
        node = root
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        total += trees.value[node]
    return total


def test_flat_arrays_score_as_walking_each_tree():
    x, label = made_rows()
    trees = rules.fit(x, label, signs=np.zeros(5), trees=30)
    assert np.allclose(trees.margin(x[:200]), [walked(trees, row) for row in x[:200]])
    assert ((trees.score(x) >= 0.5) == label).mean() > 0.9
    fresh, truth = made_rows(seed=4)
    assert ((trees.score(fresh) >= 0.5) == truth).mean() > 0.85


@pytest.mark.parametrize("sign", [-1, 1])
def test_scores_never_turn_on_constrained_features(sign):
    x, label = made_rows()
    grid = np.linspace(-3, 3, 60)

    def turns(signs):
        trees = rules.fit(x, label, signs=signs, trees=40)
        moved = np.repeat(x[:60, None, :], len(grid), axis=1)
        moved[:, :, 0] = grid
        return (sign * np.diff(trees.margin(moved.reshape(-1, 5)).reshape(60, -1), axis=1) < -1e-9).any()

    assert turns(np.zeros(5)) and not turns(np.array([sign, 0, 0, 0, 0])) and not turns(np.array([sign, 1, 0, 0, 0]))


def test_first_split_is_the_best_of_all_thresholds():
    x, label = made_rows(400)
    tree = rules.fit(x, label, signs=np.zeros(5), trees=1, depth=1)
    start = (label.sum() + 0.5) / (len(label) + 1)
    slope, curve = start - label, np.full(len(label), start * (1 - start))
    gain = lambda m: slope[m].sum() ** 2 / (curve[m].sum() + rules.RIDGE) / 2
    edges = np.quantile(x, np.arange(1, rules.BINS) / rules.BINS, axis=0)
    best = max((gain(x[:, f] <= e) + gain(x[:, f] > e), f, e) for f in range(5) for e in edges[:, f])
    assert (tree.feature[0], tree.threshold[0]) == best[1:]
    left = x[:, best[1]] <= best[2]
    assert np.isclose(tree.value[tree.left[0]], -rules.RATE * slope[left].sum() / (curve[left].sum() + rules.RIDGE))


def test_rules_learn_and_leave_odd_rows(spark):
    rows = [(i, odd.prose(i, 60) if i % 4 else odd.prose(i, 60).upper().replace(" ", " ## "), int(i % 4 > 0)) for i in range(600)]
    docs = odd.with_clashes(odd.documents(spark, *(t for _, t, _ in rows)))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (10**9, 0)], "doc_id long, quality int")
    got = rules.report(docs, labels).collect()
    texts = {(r.doc_id, r.text or "") for r in picked(docs, doc_id="doc_id", text="text").collect()}
    assert len(got) == docs.count()
    by_counts = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert set(by_counts) == {(i, *brute(t)) for i, t in texts}
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.score >= rules.CUT)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.kept == bool(rows[r.doc_id][2]) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    left = rules.accepted(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)
    assert rules.report(odd.empty(docs), labels).collect() == []
    assert {r.score for r in rules.report(docs, odd.empty(labels)).collect()} == {0.5}
    assert len({r.score for r in rules.report(docs, labels.where("quality = 1")).collect()}) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="tables not present")
def test_held_out_accuracy_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = rules.report(docs, labels).where("held_out").join(labels.where("quality is not null").select("doc_id", "quality"), "doc_id").collect()
    assert len(scored) > 1000 and np.mean([(r.score >= 0.5) == r.quality for r in scored]) > 0.97
