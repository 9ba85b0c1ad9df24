import numpy as np
import pytest

import odd
from tickloom.llm import polytope

KIND = "vec_id long, embedding array<float>, label int, extra string, links long"


def brute(rows, threshold):
    good = [(i, np.asarray(v, np.float64), l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, parent = {}, {i: i for i, *_ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x, l) in enumerate(good):
        for b, (j, y, m) in enumerate(good):
            if a != b and l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i] = links.get(i, 0) + 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {(i, links.get(i, 0), root(i)) for i, *_ in rows if i is not None}


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 3) for i, v, l in rows], KIND)


def test_links_match_all_pairs(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = []
    for group in range(12):
        base = random.normal(size=24)
        for _ in range(12):
            rows.append((len(rows), [float(np.float32(x)) for x in base + random.normal(size=24) * 0.09], group % 3))
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 0), (n + 2, [2 * x for x in rows[0][1]], 0), (n + 3, rows[0][1], None), (n + 4, rows[0][1], 1)]
    rows += [(n + 5, None, 0), (n + 6, [], 0), (n + 7, [0.0] * 24, 0), (n + 8, [float("nan")] * 24, 0), (n + 9, [1.0, None], 0), (n + 10, [1.0], 0), (n + 11, [3.0], 0)]
    rows += [(n + 12, [1e30, 1e30], 2), (n + 13, [1e-30, 1e-30], 2), (n + 14, [float("inf"), 1.0], 2), (None, rows[0][1], 0)]
    monkeypatch.setattr(polytope, "BLOCK", 5)
    got = polytope.near_duplicates(table(spark, rows), 0.98).collect()
    assert len(got) == len(rows)
    assert {(r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None} == brute(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert polytope.near_duplicates(odd.empty(table(spark, rows))).collect() == []


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(polytope._hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(polytope._hadamard(polytope._hadamard(x)), x)


def test_a_pair_that_meets_by_probes_only_is_a_link():
    x = np.array([[1.0, 0.0], [1.0, 0.0]])
    keys = np.array([[1, 7, 9], [2, 9, 7]])
    found = {key: [(i.tolist(), j.tolist()) for i, j in polytope._linked(np.zeros(2, int), 0, 0, x, keys, key, 3, 0.98)] for key in (7, 9)}
    assert found == {7: [([0], [1])], 9: [([], [])]}


@pytest.mark.parametrize("kind, labels", [("double", [1.2, 1.9, 0.0, -0.0, None]), ("string", ["a", "b", "", "", None])])
def test_labels_of_any_type_keep_apart(spark, kind, labels):
    rows = [(2 * i + j, [1.0, 2.0, 3.0 + j / 100], x) for i, x in enumerate(labels) for j in (0, 1)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {kind}")
    got = {r.vec_id: (r.n_links, r.component_id) for r in polytope.near_duplicates(table).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (1, 2), 3: (1, 2), **{i: (3, 4) for i in range(4, 8)}, 8: (0, 8), 9: (0, 9)}


@pytest.mark.parametrize("width, least", [(24, 0.9), (64, 0.86), (300, 0.77)])
def test_pairs_at_the_threshold_meet(width, least):
    random = np.random.default_rng(width)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(random.normal(size=(1500, width)))
    away = random.normal(size=a.shape)
    away = unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    cosine = 0.98 + 0.005 * random.random((len(a), 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * away
    keys = [polytope.bucket_keys(x, np.zeros(len(a), np.uint64), polytope.TABLES, polytope.CODES) for x in (a, b)]
    met = (keys[0][:, :, :, None] == keys[1][:, :, None, :]).any(axis=(2, 3))
    assert met.any(axis=1).all() and met.mean() > least
