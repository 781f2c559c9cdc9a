"""The registered model jobs run with the operators' own settings and return their whole product."""

import pytest

from pyspark.sql import functions as F

from ferrolith.catalog import models
from ferrolith.models import boosting, regression
from ferrolith.operators.dbscan_sweep import choose


class Asked(Exception):
    pass


@pytest.mark.parametrize(("query", "sets", "module", "operator"), [
    ("gbt_regress", "pricing_sets", regression, "boosting"),
    ("feature_importance", "pricing_sets", regression, "boosting"),
])
def test_no_shortened_settings(monkeypatch, query, sets, module, operator):
    def asked(*args, **settings):
        raise Asked(len(args), settings)

    monkeypatch.setattr(models, sets, lambda *_: (None, None, None))
    monkeypatch.setattr(module, operator, asked)
    with pytest.raises(Asked) as found:
        getattr(models, query)(None, None)
    assert found.value.args[0] <= 3 and found.value.args[1] == {}


FOLDER = "/root/testdata/sf0.001"


def test_whole_forest_grid(spark):
    rows = models.rf_regress_grid(spark, FOLDER).collect()
    assert {(r.trees, r.depth, r.split) for r in rows} == {(t, d, m) for t in (100, 200) for d in (-1, 20, 30) for m in (2, 5)}
    assert len(rows) == 12 and [r.is_best for r in rows].count(True) == 1
    best = next(r for r in rows if r.is_best)
    assert best.mean_r2 == max(r.mean_r2 for r in rows) and best.train_r2 > best.test_r2 and all(r.test_r2 is None for r in rows if not r.is_best)


def test_whole_boosted_grid(spark, monkeypatch):
    asked = []
    search = boosting.staged_search
    monkeypatch.setattr(boosting, "staged_search", lambda c, i, s, stages, k, g: asked.append((s, stages, k)) or search(
        c, i, [boosting.replace(x, depth=1) for x in s], [1, 2, 3], k, g).withColumn("rounds", F.get(F.array(*map(F.lit, (300, 500, 800))), F.col("rounds") - 1)))
    rows = models.boosted_search(spark, FOLDER).collect()
    assert len(rows) == 72 and len(asked[0][0]) == 24 and asked[0][1:] == ((300, 500, 800), 5)
    assert {(s.rate, s.depth, s.subsample) for s in asked[0][0]} == {(a, b, c) for a in (0.01, 0.03, 0.05) for b in (3, 4, 5, 6) for c in (0.8, 1.0)}


@pytest.mark.parametrize("query", ["monotone_boosting", "oof_average"])
def test_decisions_of_the_test_rows(spark, query):
    rows = getattr(models, query)(spark, FOLDER).collect()
    _, test = models.visit_rows(spark, FOLDER)
    assert sorted(r.id for r in rows) == sorted(r.id for r in test.select("id").collect())
    assert all(r.converted == (r.score >= r.threshold) and 0 <= r.score <= 1 for r in rows)


def test_sweep_chooses():
    rows = [(0.1, 2, 40, 0.1, 0.9), (0.2, 2, 15, 0.3, 0.4), (0.3, 2, 12, 0.2, 0.6), (0.4, 2, 1, 0.0, None)]
    assert choose(rows, (10, 20)) == 2 and choose(rows[:1], (10, 20)) == 0 and choose([], (10, 20)) is None
