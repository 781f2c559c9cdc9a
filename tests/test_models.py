"""Models: formulas, invariants and score floors."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ferrolith.models import boosting, classification, features, grouping, linear, regression
from ferrolith.operators import evaluate, prepare, words
from ferrolith.session import settle


@pytest.fixture(scope="module")
def prices(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        kind, size = rng.choice(["suv", "van", "coupe"]), rng.uniform(0, 10)
        rows.append((i, size, kind, int(rng.random() < 0.5), 20 + 3 * size + {"suv": 9, "van": 0, "coupe": 4}[kind] + rng.gauss(0, 0.5)))
    df = spark.createDataFrame(rows, "id int, size double, kind string, flag int, price double")
    return settle(prepare.folds(prepare.holdout(df, "id"), "id"))


def test_scaling_uses_population_deviation_and_unknown_is_zero(spark, prices):
    fitted = features.fit_features(prices, ["size"], ["kind"], ["flag"])
    assert fitted.names == ["size", "kind_coupe", "kind_suv", "kind_van", "flag"]
    matrix = np.array([r[0] for r in fitted.transform(prices).select(vector_to_array("features")).collect()])
    assert matrix[:, 0].std() == pytest.approx(1.0) and matrix[:, 0].mean() == pytest.approx(0.0)
    other = prices.limit(1).withColumn("kind", F.lit("tractor"))
    assert list(fitted.transform(other).first()["features"].toArray()[1:4]) == [0.0, 0.0, 0.0]
    dropped = features.fit_features(prices, ["size"], ["kind"], drop_first=True)
    assert dropped.names == ["size", "kind_suv", "kind_van"]
    assert list(dropped.transform(other).first()["features"].toArray()[1:]) == [0.0, 0.0]


def plain_inputs(df, numeric, category):
    rows = df.collect()
    x = np.array([[r[c] if r[c] is not None else np.nan for c in numeric] for r in rows], float)
    x = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    kinds = [r[category] for r in rows]
    most = max(sorted({k for k in kinds if k}), key=kinds.count)
    hot = np.array([[(k or most) == v for v in sorted({k for k in kinds if k})[1:]] for k in kinds], float)
    return np.column_stack([(x - x.mean(axis=0)) / x.std(axis=0), hot]), np.array([r["price"] for r in rows]), np.array([r["fold"] for r in rows])


@pytest.fixture(scope="module")
def gaps(prices):
    """Some numbers and categories are missing."""
    return settle(prices.withColumn("size", F.when(F.col("id") % 11 != 0, F.col("size"))).withColumn("kind", F.when(F.col("id") % 13 != 0, F.col("kind"))))


@pytest.fixture(scope="module")
def sums(gaps):
    inputs = linear.scaled_inputs(gaps, ["size", "flag"], ["kind"])
    assert list(inputs) == ["size", "flag", "kind_suv", "kind_van"]
    return linear.products(gaps, inputs, "price", "fold", 5)


def test_sums_by_fold(gaps, sums):
    x, y, fold = plain_inputs(gaps, ["size", "flag"], "kind")
    v = np.column_stack([np.ones(len(x)), x, y])
    for k in range(5):
        assert sums.folds[k] == pytest.approx(v[fold == k].T @ v[fold == k])


@pytest.mark.parametrize("alpha", [0.0, 1.0, 50.0])
def test_ridge_matches_closed_form(gaps, sums, alpha):
    x, y, _ = plain_inputs(gaps, ["size", "flag"], "kind")
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    weights = linear.ridge_weights(sums.total, alpha)
    assert weights[1:] == pytest.approx(want) and weights[0] == pytest.approx(y.mean() - x.mean(axis=0) @ want)


@pytest.mark.parametrize("alpha", [0.01, 0.5, 3.0, 100.0])
def test_lasso_is_optimal(gaps, sums, alpha):
    """The conditions of the optimum: the gradient is alpha with the weight's sign, and at most alpha where it is 0."""
    x, y, _ = plain_inputs(gaps, ["size", "flag"], "kind")
    weights = linear.lasso_weights(sums.total, alpha)
    slope = x.T @ (y - weights[0] - x @ weights[1:]) / len(y)
    assert np.abs(slope[weights[1:] == 0]).max(initial=0) <= alpha + 1e-9
    assert slope[weights[1:] != 0] == pytest.approx(alpha * np.sign(weights[1:][weights[1:] != 0]))
    assert (y - weights[0] - x @ weights[1:]).sum() == pytest.approx(0, abs=1e-6)


@pytest.mark.parametrize("lasso", [False, True])
def test_grid_by_folds(gaps, sums, lasso):
    x, y, fold = plain_inputs(gaps, ["size", "flag"], "kind")
    alphas = (0.1, 1.0, 20.0)
    want = []
    for alpha in alphas:
        scores = []
        for k in range(5):
            w = (linear.lasso_weights if lasso else linear.ridge_weights)(sums.without(k), alpha)
            out = y[fold == k] - w[0] - x[fold == k] @ w[1:]
            scores.append(1 - (out**2).sum() / ((y[fold == k] - y[fold == k].mean()) ** 2).sum())
        want.append(np.mean(scores))
    assert linear.grid_r2(sums, alphas, lasso) == pytest.approx(want, rel=1e-6)
    weights, alpha = linear.chosen(sums, lasso, alphas)
    assert alpha == alphas[int(np.argmax(want))]


def test_constant_and_repeated_inputs(spark):
    df = spark.createDataFrame([(float(i), 1.0, 2.0 * i, "a", 3.0 * i + 1) for i in range(9)] + [(5.0, 1.0, 10.0, "a", None)], "x double, c double, twice double, k string, y double")
    inputs = linear.scaled_inputs(df, ["x", "c", "twice"], ["k"])
    made = linear.products(df, inputs, "y")
    assert list(inputs) == ["x", "c", "twice"] and made.total[0, 0] == 9
    got = df.filter("y is not null").select("y", linear.predicted(inputs, linear.ridge_weights(made.total)).alias("p")).collect()
    assert all(r.p == pytest.approx(r.y) for r in got)
    assert np.isfinite(linear.lasso_weights(made.total, 0.1)).all()


def test_regression_quality_and_log(spark, prices):
    train, test = prices.filter(~F.col("is_test")), prices.filter("is_test")
    fitted = features.fit_features(train, ["size"], ["kind"], ["flag"])
    a, b = settle(fitted.transform(train)), settle(fitted.transform(test))
    linear = regression.evaluated("linear", regression.ordinary(a, "price"), a, b, "price")
    best = {"numTrees": 5, "maxDepth": 6}
    inputs = boosting.plan_features(train, ["size", "flag"], onehot=["kind"])
    forest = boosting.fit_forest(boosting.cells_of(train, inputs, "price", "id"), inputs, 5, 6, 2)
    both = linear.unionByName(regression.scored("forest", forest.predicted(train, "price"), forest.predicted(test, "price"), "price"))
    compared = {r["model"]: r for r in evaluate.compare_models(both, "model", "test_r2").collect()}
    assert compared["linear"]["test_r2"] > 0.98 and compared["linear"]["is_best"]
    log = {r["model"]: r for r in regression.run_log(both, "r1", {"forest": best}).collect()}
    assert log["forest"]["params"]["numTrees"] == "5" and log["linear"]["params"] == {}
    assert log["linear"]["metrics"]["test_r2"] == pytest.approx(compared["linear"]["test_r2"])


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        age, pages, land = rng.randint(18, 60), rng.randint(1, 25), rng.choice(["US", "FR", "DE"])
        chance = 1 / (1 + np.exp(-(0.5 * pages - 0.05 * age - 5 + (land == "DE"))))
        rows.append((i, age, pages, land, int(rng.random() < chance)))
    df = spark.createDataFrame(rows, "id int, age int, pages int, land string, y int")
    return settle(prepare.folds(df, "id", by=["y"]))


def test_monotone_logit_never_turns(spark, visits):
    model = classification.MonotoneLogit({"age": -1, "pages": 1}, {"land": ["DE", "FR", "US"]}, steps=8).fit(visits, "y")
    grid = spark.createDataFrame([(a, p, c) for a in range(15, 65, 5) for p in range(0, 28, 3) for c in ("US", "XX")], "age int, pages int, land string")
    scores = {(r["age"], r["pages"], r["land"]): r["score"] for r in model.transform(grid).collect()}
    for (a, p, c), s in scores.items():
        assert scores.get((a + 5, p, c), -1.0) <= s + 1e-12
        assert scores.get((a, p + 3, c), 2.0) >= s - 1e-12
    auc = evaluate.roc_auc(model.transform(visits), "y", "score").first()[0]
    assert auc > 0.85


def test_submission(visits):
    decisions = classification.submission(visits.select("id", (F.col("pages") / 25).alias("score")), "id", 0.5)
    assert set(decisions.columns) == {"id", "converted"} and decisions.filter("converted = 1").count() == visits.filter("pages >= 12.5").count()


def test_topics_split_two_vocabularies(spark):
    texts = [(i, "apple pear plum apple" if i % 2 else "bolt screw nail bolt") for i in range(20)]
    docs = spark.createDataFrame(texts, "id int, t string")
    weights = settle(words.tfidf(docs, "id", F.split("t", " ")))
    strengths, by_term, summary = grouping.topics(weights, "id", 2)
    main = {r["id"]: r["topic"] for r in grouping.main_topic(strengths, "id", absolute=True).collect()}
    assert len({main[i] for i in range(0, 20, 2)}) == 1 and len(set(main.values())) == 2
    assert [round(r["singular_value"] ** 2, 6) for r in summary.orderBy("topic").collect()] == [10.0, 10.0]
    assert sum(r["explained"] for r in summary.collect()) == pytest.approx(1.0)
    assert grouping.topic_terms(by_term, 1).count() == 2


def test_principal_components_and_zones(spark):
    rng = random.Random(2)
    rows = [(float(v), 2.0 * v + rng.gauss(0, 0.1)) for v in range(50)]
    df = spark.createDataFrame(rows, "a double, b double")
    scaled = features.fit_features(df, ["a", "b"]).transform(df)
    assert grouping.components(scaled).explainedVariance[0] > 0.99
    model = grouping.centres(scaled, 2)
    assert grouping.centre_table(spark, model, ["a", "b"]).count() == 2


def test_topic_vectors_need_no_python(spark, monkeypatch):
    """The decomposition reads its rows many times; they come from a table of vectors, not through Python."""
    seen, matrix = [], grouping.RowMatrix
    monkeypatch.setattr(grouping, "RowMatrix", lambda rows, **options: seen.append(rows) or matrix(rows, **options))
    weights = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "b", 1.0), (3, "c", 1.0)], "id int, term string, weight double")
    _, _, summary = grouping.topics(weights, "id", 2)
    assert [hasattr(rows, "columns") for rows in seen] == [True] and summary.count() == 2
    stored = sorted((list(r.row.indices), list(r.row.values)) for r in seen[0].collect())
    assert stored == [([0, 1], [0.6, 0.8]), ([1], [1.0]), ([2], [1.0])]
