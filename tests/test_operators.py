"""Operators on small literal tables."""

import statistics

import pytest
from pyspark.sql import functions as F

from ferrolith.operators import aggregates, charts, evaluate, joins, ordering, prepare, reports, selection, words
from ferrolith.functions import text


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_exact_quantiles_with_hot_value(spark):
    data = [("a", float(i % 17)) for i in range(300)] + [("a", 3.0)] * 200 + [("b", 5.0), ("b", None), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in ordering.exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], ranges=4).collect()}
    mine = sorted(v for g, v in data if g == "a")
    expected = statistics.quantiles(mine, n=4, method="inclusive")
    assert [got["a"][f"q_{p}"] for p in (25, 50, 75)] == pytest.approx(expected)
    assert got["b"]["q_50"] == 5.0 and None not in got


def test_running_totals_and_ids(spark):
    df = spark.createDataFrame([(f"k{i:03d}", i) for i in range(100)], "k string, v long")
    totals = ordering.running_totals(df, "k", ["v"], ranges=8)
    assert rows(totals, "k", "cum_v") == [(f"k{i:03d}", i * (i + 1) // 2) for i in range(100)]
    ids = ordering.sequential_ids(df, "k", "id", ranges=5)
    assert rows(ids, "id", "k") == [(i + 1, f"k{i:03d}") for i in range(100)]


def test_random_rank_is_a_permutation(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3 == 0).alias("y"))
    ranked = ordering.random_rank(df, "id", 1, ["y"])
    for flag, size in ((True, 167), (False, 333)):
        assert sorted(r["rank"] for r in ranked.filter(F.col("y") == flag).collect()) == list(range(1, size + 1))


def test_previous_row_over_slices(spark):
    data = [(1, "a", "2024-01-01 00:10:00"), (2, "a", "2024-01-01 00:10:00"), (3, "a", "2024-01-01 05:00:00"), (4, "b", "2024-01-02 00:00:00")]
    df = spark.createDataFrame(data, "id int, e string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert rows(ordering.previous_row(df, "e", "t", "id", ["id"]).select("id", F.coalesce("prev_id", F.lit(0)).alias("p")), "id", "p") == [
        (1, 0), (2, 1), (3, 2), (4, 0)]


def test_previous_pairs_edges(spark):
    data = [(1, 50.0, None, None), (2, None, 1, 20.0), (3, 5.0, 2, 0.0), (4, 1.0, 99, 10.0), (5, -3.0, 1, 50.0), (6, 1.0, 1, None)]
    df = spark.createDataFrame(data, "id int, delay double, prev int, gap double")
    got = joins.previous_pairs(df, "id", "prev", "delay", "gap")
    assert rows(got, "id", "prev_delay_filled", "is_problem") == [
        (2, 50.0, True), (3, 0.0, False), (4, 0.0, False), (5, 50.0, False)]


def test_missing_ids(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 5, 9)], "id long")
    assert rows(joins.missing_ids(df, "id", block=3), "id") == [(3,), (4,), (6,), (7,), (8,)]


def test_lookup_with_fallback(spark):
    df = spark.createDataFrame([("h1", "c1"), ("h2", "c1"), ("h3", "c2")], "h string, c string")
    fine = spark.createDataFrame([("h1", "c1", 1.0)], "h string, c string, lat double")
    rough = spark.createDataFrame([("c1", 9.0)], "c string, lat double")
    got = joins.lookup_with_fallback(df, fine, rough, ["h", "c"], ["c"], ["lat"])
    assert {r["h"]: (r["lat"], r["match_level"]) for r in got.collect()} == {
        "h1": (1.0, "precise"), "h2": (9.0, "coarse"), "h3": (None, "none")}


def test_exclusion_band_keeps_null(spark):
    df = spark.createDataFrame([(5,), (6,), (9,), (10,), (None,)], "wave int")
    assert sorted(str(r[0]) for r in selection.exclusion_band(df, "wave", 5, 10).collect()) == ["10", "5", "None"]


def test_sigma_filter_is_sequential(spark):
    data = [(float(i % 5), float(i % 3)) for i in range(200)] + [(1000.0, 900.0), (1.0, 30.0), (None, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    kept = selection.sigma_filter(df, ["a", "b"])
    found = {(r["a"], r["b"]) for r in kept.collect()}
    assert (1000.0, 900.0) not in found
    assert (1.0, 30.0) not in found  # only outside once the row before is gone
    assert (None, 1.0) in found
    first_only = [(a, b) for a, b in data if a is not None]
    spread = statistics.stdev(b for _, b in first_only)
    assert abs(30.0 - statistics.mean(b for _, b in first_only)) < 3 * spread


def test_first_row_takes_nulls_and_order(spark):
    df = spark.createDataFrame([(1, 2, "late"), (1, 1, None), (2, 1, "x")], "id int, pos int, v string")
    assert sorted((r["id"], str(r["v"])) for r in selection.first_row(df, ["id"], ["pos"]).collect()) == [(1, "None"), (2, "x")]


def test_group_counts_leave_null_out(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert [tuple(r) for r in aggregates.group_counts(df, ["k"]).collect()] == [("a", 2), ("b", 1)]
    assert aggregates.group_counts(df, ["k"], keep_null=True).count() == 3


def test_correlation_of_constant_is_null(spark):
    df = spark.createDataFrame([("g", 1.0, float(i)) for i in range(5)] + [("h", float(i), float(2 * i)) for i in range(5)], "g string, x double, y double")
    got = {r["g"]: r["corr"] for r in aggregates.target_correlations(df, ["x"], "y", "g").collect()}
    assert got["g"] is None and got["h"] == pytest.approx(1.0)


def test_correlation_of_large_offsets(spark):
    df = spark.createDataFrame([(1e9 + i, -float(i)) for i in range(50)], "x double, y double")
    matrix = {(r["x"], r["y"]): r["corr"] for r in aggregates.correlation_matrix(df, ["x", "y"]).collect()}
    assert matrix["x", "y"] == pytest.approx(-1.0) and matrix["x", "x"] == 1.0


def test_category_report_maps(spark):
    df = spark.createDataFrame([("a", "u", 1.0), ("a", "v", 3.0), ("b", "v", 10.0), (None, "u", 7.0)], "c string, d string, p double")
    row = aggregates.category_report(df, "p", ["c", "d"]).first()
    assert row["by_c"] == {"a": 2.0, "b": 10.0} and row["by_d"] == {"u": 4.0, "v": 6.5} and row["median"] == 5.0


def test_histogram_last_bin_closed_and_constant_column(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)], "v double")
    assert rows(charts.histogram(df, "v", 5), "bin", "n") == [(0, 2), (1, 1), (4, 1)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert rows(charts.histogram(flat, "v", 5), "bin", "n") == [(0, 2)]


def test_auc_and_sweep_against_loops(spark):
    data = [(i, int(i * 7 % 11 > 6), round((i * 13 % 20) / 20, 2)) for i in range(120)]
    df = spark.createDataFrame(data, "id int, y int, s double")
    pos = [s for _, y, s in data if y]
    neg = [s for _, y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df, "y", "s").first()[0] == pytest.approx(auc)
    grid = (0.3, 0.02, 15)
    sweep = {round(r["threshold"], 6): r for r in evaluate.threshold_sweep(df, "y", "s", grid).collect()}
    best = (-1.0, None)
    for i in range(15):
        t = 0.3 + i * 0.02
        tp = sum(1 for _, y, s in data if y and s >= t)
        fp = sum(1 for _, y, s in data if not y and s >= t)
        fn = len(pos) - tp
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        assert sweep[round(t, 6)]["f1"] == pytest.approx(f1)
        if f1 > best[0] + 1e-12:
            best = (f1, round(t, 6))
    assert [k for k, r in sweep.items() if r["is_best"]] == [best[1]]


@pytest.mark.parametrize("label", [0, 1])
def test_single_class_does_not_fail(spark, label):
    df = spark.createDataFrame([(label, 0.5), (label, 0.5)], "y int, s double")
    assert evaluate.roc_auc(df, "y", "s").first()[0] is None
    assert evaluate.best_threshold(evaluate.threshold_sweep(df, "y", "s", (0.5, 0.1, 2))).first()["f1"] == float(label)


def test_folds_are_even(spark):
    df = spark.range(103).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    counts = prepare.folds(df, "id", 5, by=["y"]).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_label_codes_cover_all_frames(spark):
    a = spark.createDataFrame([("z",), ("b",)], "c string")
    b = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(prepare.label_codes([a, b], "c"), "c", "code") == [("a", 0), ("b", 1), ("z", 2)]


def test_fill_and_scale_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = prepare.fill_and_scale(df, ["a", "b"]).collect()
    assert [r["b"] for r in got] == [0.0, 0.0, 0.0]
    assert sorted(round(r["a"], 4) for r in got) == [-1.2247, 0.0, 1.2247]


def test_padded_sequences(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, "zz a")], "id int, t string")
    tokens = text.words(F.col("t"), 1)
    ids = words.word_ids(df, tokens, 4)  # room for two words
    got = {r["id"]: r["sequence"] for r in words.padded_sequences(df, "id", tokens, ids, 4).collect()}
    assert got == {1: [3, 2, 3, 0], 2: [0, 0, 0, 0], 3: [1, 2, 0, 0]}


def test_stop_words_and_lemmas(spark):
    df = spark.createDataFrame([(1, ["the", "wicking", "shirts"]), (2, [])], "id int, t array<string>")
    lemmas = spark.createDataFrame([("wicking", "wick"), ("shirts", "shirt")], "form string, lemma string")
    kept = words.without_stop_words(F.col("t"), ["the", "a"])
    got = {r["id"]: r["tokens"] for r in words.lemmatised(df, "id", kept, lemmas).collect()}
    assert got == {1: ["wick", "shirt"], 2: []}


def test_best_column_and_availability(spark):
    df = spark.createDataFrame([(1, 0.2, -0.9), (2, 0.5, 0.5)], "id int, a double, b double")
    assert rows(selection.best_column(df, ["a", "b"]), "id", "best") == [(1, "a"), (2, "a")]
    assert rows(selection.best_column(df, ["a", "b"], absolute=True), "id", "best") == [(1, "b"), (2, "a")]
    twice = spark.createDataFrame([("g", 1, True), ("g", 1, True), ("g", 2, False)], "g string, id int, f boolean")
    row = aggregates.availability(twice, "g", "id", {"f": F.col("f")}).first()
    assert row["pct_f"] == 100.0 and row["pct_ids_f"] == 50.0


def test_previous_row_when_all_rows_lie_in_one_hour(spark):
    """Ranges follow the rows, so one busy hour is cut too."""
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    made = [(i, "e", start + timedelta(milliseconds=37 * i)) for i in range(3000)]
    df = spark.createDataFrame(made, "id int, e string, t timestamp_ntz")
    spread = ordering.with_ranges(df.withColumn("m", F.unix_micros(F.col("t").cast("timestamp"))), "m").groupBy(ordering.RANGE).count()
    assert spread.count() > 30 and spread.agg(F.max("count")).first()[0] < 200
    out = ordering.previous_row(df, "e", "t", "id", ["id"]).collect()
    assert {r["id"]: r["prev_id"] for r in out} == {i: i - 1 if i else None for i in range(3000)}


def test_reports(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("a", 2, 9.0), ("b", 3, 1.0), (None, 4, 5.0)], "k string, i int, x double")
    report = reports.Report(key="k", only="x > {low}", settings={"low": 0}, least=("n", 1), lead="mean", measures={
        "n": reports.rows(), "ids": reports.distinct("i"), "mean": reports.measured(F.avg, "x", 1), "big": reports.holds("x >= 4")})
    assert [tuple(r) for r in report.run(df).collect()] == [(None, 1, 1, 5.0, 1), ("a", 3, 2, 5.0, 2), ("b", 1, 1, 1.0, 0)]
    assert [r["k"] for r in report.with_settings(low=1, least=2).run(df).collect()] == ["a"]
    assert reports.Report(measures={"n": reports.rows()}).run(df).first()["n"] == 5
