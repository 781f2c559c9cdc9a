"""Filter audit, hard negatives and the source mixture against plain versions, with nulls, ties, repeated rows and empty tables."""

import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrolith.llm import filter_audit, mixture, negatives
from ferrolith.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    words = WORD.findall(text)
    return {name for name, hit in (
        ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text)))) if hit}


def test_text_rules():
    for text in ["", "a", "É" * 40 + "AB", "x " * 60, " ".join(map(str, range(60))), "#", "A" * 5 + "b" * 95, "A" * 5 + "b" * 94, "\x1c\x85 \xa0 z"]:
        bits = filter_audit.text_rules(text.encode())
        assert {n for i, n in enumerate("ABCD") if bits >> i & 1} == fails(text)


def plain_audit(rows, good, toxic):
    firsts = {}
    for i, text, _ in rows:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    judged = [(i, p or "", fails(t or "") | ({"E"} if i is not None and i > firsts[t or ""] else set())) for i, t, p in rows]
    out = {}
    for part in {p for _, p, _ in judged}:
        mine = [(i, f) for i, p, f in judged if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                failing = [f for _, f in mine if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(f == {name} for f in failing),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[name])
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(3)
    pool = ["", None, "a b", "A B # c", "dull " * 70, " ".join(f"w{i}" for i in range(60)), " ".join(f"W{i}" for i in range(60)),
            "$ " + " ".join(f"w{i}" for i in range(60)), "word " * 30_000]
    rows = [(i, pool[rng.integers(len(pool))], [None, "", "s1", "s2"][rng.integers(4)]) for i in range(80)]
    return rows + [(None, "a b", "s1"), (None, "a b", "s1"), (7, "a b", "s2"), (7, "a b", "s2"), (8, "again", None)]


@pytest.fixture(scope="module")
def documents(spark, texts):
    rows = [(*row, "x", 1, 2, "y") for row in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, part string, row long, n int, kept string")


def test_filter_audit(spark, documents, texts):
    labels = spark.createDataFrame(
        [(i, int(i % 2), int(i % 5 == 0)) for i in range(0, 90, 3)] + [(3, 1, 0), (3, 1, 0), (None, 1, 1), (6, None, None)],
        "doc_id long, quality int, toxic int")
    marks = labels.collect()
    good, toxic = ({r.doc_id for r in marks if r[c] == 1 and r.doc_id is not None} for c in ("quality", "toxic"))
    got = filter_audit.audit_documents(documents, labels).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in got}
    assert len(got) == len(found) and found == plain_audit(texts, good, toxic)
    assert filter_audit.audit_documents(documents.filter("1 = 0"), labels).count() == 0
    assert filter_audit.audit_documents(documents, labels.filter("1 = 0")).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([(i, "p") for i in range(6)], "row long, part string")
    failing = {name: rows.filter(F.col("row").isin(ids)) for name, ids in {"x": [0, 1, 2], "y": [2, 3]}.items()}
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley, r.odd_lost)
           for r in filter_audit.interaction_audit(rows, failing, {"odd": rows.filter("row % 2 = 1").select("row")}).collect()}
    assert got == {("xy", 1): (3, 3, 0, 2, 5, 1), ("xy", 2): (2, 1, 1, 1, 3, 1), ("yx", 1): (4, 2, 0, 1, 3, 1), ("yx", 2): (2, 2, 1, 2, 5, 1)}


def plain_negatives(rows, every, k):
    whole = {}
    for i, x, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(
            c is not None and math.isfinite(c) for c in r[1])), key=lambda r: (r[0], r[2], [math.floor(256 * c) for c in r[1]])):
        whole.setdefault(i, (label, [max(-2**63, min(2**63 - 1, math.floor(256 * c))) for c in x]))
    cut = lambda s: max(-negatives.MOST, min(negatives.MOST, s))
    out = set()
    for a, (label, x) in whole.items():
        if a % every:
            continue
        met = sorted((-cut(sum(p * q for p, q in zip(x, y, strict=True))), o, l) for o, (l, y) in whole.items() if o != a and len(y) == len(x))
        for ps, p, _ in [m for m in met if m[2] == label][:k]:
            fit = [(n, -ns) for ns, n, l in met if l != label and 80 * -ps <= 100 * -ns <= 100 * -ps][:k]
            out |= {(a, p, rank, n, -ps, ns) for rank, (n, ns) in enumerate(fit, 1)}
    return out


def negatives_of(df, every, k):
    rows = negatives.hard_negatives(df, F.col("id") % every == 0, k, k).collect()
    assert len(set(rows)) == len(rows)
    return {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in rows}


@pytest.mark.parametrize("block", [7, 1024])
def test_hard_negatives(spark, monkeypatch, block):
    """Clustered vectors with ties, copies, odd rows, several lengths and huge components; blocks of any size."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", block)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 40))
    rows = [(i, (centre[rng.integers(4)] + rng.normal(size=40) * rng.choice([0, 0.2, 1])).round(1).tolist(), int(rng.integers(3))) for i in range(300)]
    rows += [(300 + i, rng.normal(size=3).tolist(), i % 2) for i in range(20)] + [(320 + i, [], i % 2) for i in range(4)]
    rows += [(330, None, 1), (331, [1.0, None], 1), (332, [float("nan")] * 3, 0), (333, [float("inf")] * 3, 0), (334, rows[0][1], None),
             (None, rows[0][1], 1), (5, rows[5][1], rows[5][2]), (10, rows[3][1], 0), (340, [1e30, 1.0, -1e30], 0), (345, [1e30, 2.0, 1e5], 1),
             (350, [9e5, 1e8, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("x"), "block": F.lit(1), "x": F.lit(2)})
    assert negatives_of(df, 5, 3) == plain_negatives(rows, 5, 3)
    assert negatives_of(df.filter("1 = 0"), 5, 3) == set()
    assert negatives_of(df.filter("label = 1"), 5, 3) == set()  # no other label


def test_summaries_enclose_the_score():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-300, 300, (2, 50, 64))
    for length in negatives.SEGMENTS:
        (am, ad), (bm, bd) = negatives.summaries(x.astype(float), length), negatives.summaries(y.astype(float), length)
        middle, width, score = (am * bm).sum(1), (ad * bd).sum(1), (x * y).sum(1)
        assert (np.abs(score - middle) <= width + 1e-6).all()


def test_pairs_ruled_out_by_summaries():
    """On clustered vectors the levels leave few pairs for the exact scores."""
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(10, 2)), 32, axis=1) * 200 + rng.normal(size=(10, 64))
    y = np.repeat(rng.normal(size=(500, 2)), 32, axis=1) * 200 + rng.normal(size=(500, 64))

    def block(v):
        v = np.floor(v).astype(np.int64)
        sums = np.concatenate([s for length in negatives.SEGMENTS[:-1] for s in negatives.summaries(v.astype(float), length)], axis=1)
        return negatives.Block({"dim": 64, "kind": "i8", "ids": np.arange(len(v)).tobytes(), "labels": np.zeros(len(v), np.int64).tobytes(),
                                "x": v.tobytes(), "sums": sums.astype("f4").tobytes()}, "")

    a, b = block(x), block(y)
    whole = a.x @ b.x.T
    bar = np.sort(whole, axis=1)[:, -5]
    i, j = np.nonzero(np.ones_like(whole, bool))
    i, j, score = negatives.refine(a, b, i, j, lambda i, j, low, high: high >= bar[i])
    assert (score == whole[i, j]).all() and set(zip(*np.nonzero(whole >= bar[:, None]), strict=True)) <= set(zip(i, j, strict=True))
    assert len(i) < 0.1 * whole.size


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing the excess again and again."""
    keys = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    target, full, rest = {}, set(), sum(sizes.values())
    while True:
        share = rest - sum(most * sizes[k] for k in full)
        total = sum(weight[k] for k in keys if k not in full)
        target = {k: most * sizes[k] if k in full else share * weight[k] / total for k in keys}
        above = {k for k in keys if target[k] > most * sizes[k] and k not in full}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("rows", [3, mixture.ROWS])
def test_mixture(spark, rows):
    """Targets by plain sharing; copies rounded expected copies; sources near their targets, however finely groups are cut."""
    rng = np.random.default_rng(9)
    docs = [(i, " \n ".join(["w"] * int(n)), s) for i, (n, s) in enumerate(zip(rng.geometric(0.05, 900), rng.choice(["z", "a", "b", "é", "B"], 900), strict=True))]
    docs += [(1000 + i, "same size", "hot") for i in range(400)] + [(7, "one id", "hot")] * 60
    docs += [(2000, None, "z"), (2001, "", "empty"), (None, "no id", "a"), (None, None, None), (2002, "x y z", None), (2003, "w " * 20_000, "long")]
    df = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, source string, size int, target string")
    got = mixture.mix_copies(df, rows=rows).collect()
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(WORD.findall(text or ""))
    want = filled(sizes)
    taken = Counter()
    assert sorted((r.doc_id or -1, r.source or "", r.size) for r in got) == sorted((i or -1, s or "", len(WORD.findall(t or ""))) for i, t, s in docs)
    longest = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert math.floor(rate - 1e-9) <= r.copies <= math.ceil(rate - 1e-9) <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert math.isclose(sum(want.values()), sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= longest[s] + 1 for s in want)
    again = mixture.mix_copies(df.repartition(5), rows=rows).collect()
    assert Counter((r.doc_id, r.source, r.size, r.taken) for r in again if r.doc_id != 7) == Counter(
        (r.doc_id, r.source, r.size, r.taken) for r in got if r.doc_id != 7)
    mix = mixture.emit(df, mixture.mix_copies(df, rows=rows))
    assert mix.columns == df.columns
    assert Counter((r.doc_id, r.source) for r in mix.collect()) == +Counter(
        {k: sum(r.copies for r in got if (r.doc_id, r.source) == k) for k in {(r.doc_id, r.source) for r in got}})


def test_mixture_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture.mix_copies(df).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], df.schema)
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixture.mix_copies(blank).collect()] == [(0, 0, 0.0, 0)] * 2


def test_mixture_is_native(spark, folder):
    plan = QUERIES["op13_source_mixture"](spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def plans_of(module, monkeypatch, run):
    """Plans of the tables that ``run`` settles, by name, and of its result under ``result``."""
    plans, settle = {}, module.settle
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def noted(df, label):
        plans[label] = plan(df)
        return settle(df, label)

    monkeypatch.setattr(module, "settle", noted)
    plans["result"] = plan(run())
    return plans


def test_copies_of_anchors_are_not_broadcast(spark, monkeypatch):
    """Anchors are copied to each part of the vectors; the copies must not all pass through the driver, however small the anchors are."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0], i % 2) for i in range(40)], "vec_id long, embedding array<double>, label int")
    plans = plans_of(negatives, monkeypatch, lambda: negatives.hard_negatives(df, F.col("id") % 5 == 0))
    for name in ("positives", "result"):
        assert re.search(r"SortMergeJoin \[cast\(part", plans[name]) and not re.search(r"BroadcastHashJoin \[cast\(part", plans[name])
    assert "BroadcastHashJoin" not in plans["aimed"]


def test_id_tables_are_not_broadcast(spark, monkeypatch, documents):
    """Id tables grow with the documents; small as they are here, no join sends one through the driver."""
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    plans = plans_of(filter_audit, monkeypatch, lambda: filter_audit.audit_documents(documents, labels))
    for name in ("quality", "toxic", "failed", "audit"):
        assert "Join" in plans[name] and "BroadcastHashJoin" not in plans[name]
