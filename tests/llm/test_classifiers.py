import zlib

import numpy as np
import pyarrow as pa
import pytest

import odd
from pyspark.sql import functions as F
from tickloom.llm import labelled, quality, toxicity, words


def corpus(spark):
    rows = []
    for i in range(900):
        text, bad = odd.prose(i, 60), i % 5 == 0
        rows.append((i, text.replace(" ", " horrid ", 2) if bad else text, int(bad)))
    return rows


def test_toxicity_learns_and_leaves_odd_rows(spark):
    rows = corpus(spark)
    docs = odd.with_clashes(odd.documents(spark, *(t for _, t, _ in rows)))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, None, None), (10**9, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 900:
            assert r.predicted == rows[r.doc_id][2]
    left = toxicity.accepted(docs, labels)
    assert left.columns == docs.columns and left.count() == docs.count() - 180
    assert toxicity.report(odd.empty(docs), labels).collect() == []
    assert {r.score for r in toxicity.report(docs, odd.empty(labels)).collect()} == {0.5}


def test_counterfactuals_even_out_terms(spark):
    pick = np.random.default_rng(1)
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        term = "women" if pick.random() < (0.9 if toxic else 0.1) else "men"
        rows.append((int(toxic), odd.prose(i, 20) + f" {term} " + ("horrid" if toxic and i % 2 else "")))
    table = spark.createDataFrame(rows, "label int, text string")
    features = toxicity._chosen(toxicity.featured(table), 500)
    made = toxicity.featured(table, features).toArrow()
    women, men = (features.searchsorted(toxicity._features(words.words_of(*words.text_bytes(pa.array([t])), words.ALPHANUMERIC))[0][0]) for t in ("women", "men"))

    def gap(evenness):
        model = toxicity._fitted(made, features, evenness)
        docs = spark.createDataFrame([(0, "women"), (1, "men")], "doc_id long, text string")
        score = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
        return abs(np.log(score[0] / (1 - score[0])) - np.log(score[1] / (1 - score[1])))

    assert women != men and gap(0.0) > 0.5 and gap(50.0) < 0.2 * gap(0.0)


def test_features_are_starts_and_words():
    made = toxicity._features(words.words_of(*words.text_bytes(pa.array(["idiotic IDIOTS idi"])), words.ALPHANUMERIC))
    assert made[0][0] != made[0][1] and made[3][0] == made[3][1] and made[1][2] == 0


def test_quality_ranks_and_leaves_odd_rows(spark):
    rows = [(i, odd.prose(i, 60) if i % 4 else odd.prose(i, 60).upper().replace(" ", "!! "), int(i % 4 > 0)) for i in range(600)]
    docs = odd.with_clashes(odd.documents(spark, *(t for _, t, _ in rows)))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1)], "doc_id long, quality int")
    got = quality.report(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.predicted == rows[r.doc_id][2] and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert quality.report(odd.empty(docs), labels).collect() == []
    assert {r.score for r in quality.report(docs, labels.where("quality = 1")).collect()} != {0.5}


def test_sample_is_bounded_and_has_no_held_out_row(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, toxic int")
    got = labelled.sample(docs, labels, "toxic", 4, 2, 20).collect()
    assert len(got) == len({r.doc_id for r in got}) == 20
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in got)


@pytest.mark.parametrize("text", ["", "one", "a\nb\nb", "AB 12 !!"])
def test_measures_are_finite(text):
    assert np.isfinite(quality.measures(pa.array([text, None, "x y"]))).all()


def newton(x, target, penalty, extra):
    """The minimum of mean logistic loss + penalty / 2 * weights^2 + weights' extra weights / 2 by dense Newton steps."""
    weights = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ weights)))
        slope = x.T @ (p - target) / len(x) + penalty * weights + extra @ weights
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(penalty) + extra
        step = np.linalg.solve(curve, slope)
        weights = weights - step / max(1.0, float(np.abs(step).max()))
    return weights


def test_quality_orders_as_a_plain_solver_of_pair_differences():
    pick = np.random.default_rng(4)
    values = pick.normal(size=(300, 3))
    label = (values @ [1.5, -1.0, 0.0] + pick.logistic(size=300) > -1).astype(int)
    model = quality.fit(values, label, rounds=3000)
    x = model.features(values)
    first, second = quality.preferences(label)
    assert set(first) | set(second) == set(range(300)) and label[first].all() and not label[second].any()
    away = x[first] - x[second]
    best = newton(away, np.ones(len(away)), np.full(x.shape[1], quality.RIDGE), np.zeros((x.shape[1],) * 2))
    loss = lambda w: np.logaddexp(0, -away @ w).mean() + quality.RIDGE / 2 * w @ w
    assert loss(best) <= loss(model.weights) < loss(best) + 2e-3 and loss(model.weights) < loss(0 * best) - 0.1
    ours, theirs = model.strength(values), x @ best
    assert np.mean(np.sign(ours[:, None] - ours) == np.sign(theirs[:, None] - theirs)) > 0.97


def test_quality_cut_is_a_quantile_of_all_documents(spark):
    rows = [(i, odd.prose(i, 60) if i % 4 else odd.prose(i, 60).upper().replace(" ", "!! ")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    known = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(model.bad) == sum(i % 4 == 0 for i in known) and len(model.good) + len(model.bad) == len(known)
    strengths = np.sort(model.strength(quality.measures(pa.array([t for _, t in rows]))))
    errors = [(model.good < s).sum() + (model.bad >= s).sum() for s in strengths]
    at = quality.cut(quality.ranked(docs, model), model)
    near = int(np.abs(strengths - at).argmin())
    assert strengths[near] == pytest.approx(at) and errors[near] == min(errors)
    wide = odd.with_clashes(docs.selectExpr("*", "1 as strength", "2 as score"))
    scored = quality.score(wide, model)
    assert sorted(scored.columns) == sorted(wide.columns) and scored.where("score < 0.5").count() == near
    only_good = docs.where("doc_id % 4 > 0")
    assert quality.score(only_good, model).where("score >= 0.5").count() == 300
    assert quality.score(odd.empty(docs), model).collect() == [] and {r.score for r in quality.score(docs, 0.25).collect()} == {0.25}


def test_toxicity_fit_is_the_minimum_of_its_loss(spark):
    pick = np.random.default_rng(2)
    rows = []
    for i in range(240):
        toxic = i % 3 == 0
        term = "women" if pick.random() < (0.8 if toxic else 0.2) else "men"
        rows.append((int(toxic), f"{odd.WORDS[i % 7]} {odd.WORDS[i % 5]} {term if i % 2 else ''} {'horrid' if toxic and i % 4 else ''}"))
    table = spark.createDataFrame(rows, "label int, text string")
    features = toxicity._chosen(toxicity.featured(table), 40)
    made = toxicity.featured(table, features).toArrow()

    def dense(lists):
        out = np.zeros((len(lists), len(features)))
        for i, held in enumerate(lists):
            out[i, np.searchsorted(features, np.array(held or [], np.int64).view(np.uint64))] = 1
        return out

    own, label = made.column("features").to_pylist(), made.column("label").to_numpy()
    other = made.column("swapped").to_pylist()
    named = [i for i, o in enumerate(other) if o is not None]
    assert len(named) > 50
    change = dense([own[i] for i in named]) - dense([other[i] for i in named])
    x = np.column_stack([dense(own), np.ones(len(own))])
    extra = np.zeros((x.shape[1],) * 2)
    extra[:-1, :-1] = 2 * toxicity.EVENNESS * change.T @ change / len(named)
    best = newton(x, label, np.append(np.full(len(features), toxicity.RIDGE), 0.0), extra)

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - label * z).mean() + toxicity.RIDGE / 2 * w[:-1] @ w[:-1] + w @ extra @ w / 2

    model = toxicity._fitted(made, features, toxicity.EVENNESS, rounds=3000)
    got = np.append(model.weights, model.bias)
    assert loss(best) - 1e-9 <= loss(got) < loss(best) + 1e-3
    assert np.abs(x @ got - x @ best).max() < 0.3
    given = np.append(toxicity._fitted(made, features, toxicity.EVENNESS).weights, 0)
    assert np.mean((change @ given[:-1]) ** 2) < 0.01
