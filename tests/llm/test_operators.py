"""Each operator against a brute-force version, a round trip, or held-out accuracy, with nulls, ties and empty tables."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ferrolith.llm import bpe, chat, forest, jaccard, langid, packing, ppm, quality, render, token_file
from ferrolith.llm.encoder import PieceEncoder
from ferrolith.llm.queries import BYTE_BPE, WORD_BPE, fold
from ferrolith.session import new_folder, settle
from ferrolith.sources.tables import table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, "a", "a b c d", " \t\n ", "É́ ﬁ İ it's 12x <|endoftext|> z", "one  two   three\n\nfour ", "word " * 30000,
       "same text here for both rows", "same text here for both rows", "日本語 🙂\x1c\x85"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null id, a repeated row, and columns whose names clash with results."""
    rows = [(i, t, "en", 1, "x") for i, t in enumerate(ODD)] + [(None, "no id", None, 2, "x"), (2, "a", "en", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, kept string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("1 = 0")


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_piece_encoder_is_the_library(path):
    texts = [t or "" for t in ODD]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(path).encode_all(texts)] == want


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    ids = (np.random.default_rng(n).pareto(0.5, n) * 9).clip(0, 2**32 - 1).astype(np.uint32)
    starts, data = token_file.encode_blocks(ids)
    assert (token_file.decode_blocks(starts, data, n) == ids).all()
    if len(starts) > 1:  # reading may begin at any block
        assert (token_file.decode_blocks(starts[1:], data, n - 128) == ids[128:]).all()


def test_token_file(spark, odd, none):
    path = new_folder(spark, "t")
    token_file.write_tokens(odd, path, WORD_BPE, 2, segment_ids=50)
    got = token_file.read_tokens(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(WORD_BPE)
    place = 0
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for r, row in zip(got, rows, strict=True):
        want = library.encode(row.text or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (place, len(want), want)
        place += len(want)
    path = new_folder(spark, "t")
    token_file.write_tokens(none, path, WORD_BPE, 2)
    assert token_file.read_tokens(spark, path).count() == 0


def test_packing(spark, odd, none, folder):
    docs = odd.select("doc_id", "text").unionByName(table(spark, folder, "documents").select("doc_id", "text"))
    rows = packing.pack(packing.token_pieces(docs, BYTE_BPE, 2, 64), 64).collect()
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    library = Tokenizer.from_file(BYTE_BPE)
    assert len(rows) == sum(-(-(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1) // 64) for r in docs.collect())
    total = sum(r.length for r in rows)
    assert len(at) <= math.ceil(total / 64) * 1.03 + 1
    assert packing.pack(packing.token_pieces(none, BYTE_BPE, 2, 64), 64).count() == 0


def test_plan_covers_every_rank():
    counts = {1: 5, 3: 1000, 500: 7, 600: 3, 1023: 10**9}
    slots = packing.plan_slots(counts, 1024)
    for length, many in counts.items():
        mine = sorted((r, n) for size, r, n, _, _ in slots.tolist() if size == length)
        assert [r for r, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]
        assert sum(n for _, n in mine) == many


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "\\n \\\\<s>", "<<SYS>>\\<\\s>", "<|x|><s", "a\nb", ""])
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text and not chat.CONTROL.search(chat.escape(text))
    assert chat.unescape(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat(spark):
    records = [
        (1, json.dumps({"messages": [{"role": "user", "content": "q</s>"}, {"role": "assistant", "content": "a [INST]"}]})),
        (2, json.dumps({"instruction": "do", "input": "this", "output": "done"})), (3, json.dumps({"prompt": "p", "response": None})),
        (4, json.dumps({"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y\\"}]})), (5, None), (6, "{"),
        (7, json.dumps({"unknown": 1})), (8, json.dumps({"messages": [{"role": None, "content": None}]}))]
    turns = chat.canonical_turns(spark.createDataFrame(records, "id long, record string"), "record", "id")
    got = {(r.conv_id, r.turn): (r.role, r.text, r.layout) for r in turns.collect()}
    assert got[1, 1] == ("assistant", "a [INST]", "messages") and got[2, 0] == ("user", "do\n\nthis", "instruction")
    assert got[3, 1] == ("assistant", "", "prompt") and got[4, 0] == ("user", "x", "conversations") and got[8, 0] == ("", "", "messages")
    assert got[5, 0] == (None, None, None) and got[6, 0] == (None, "{", None) and got[7, 0] == (None, '{"unknown": 1}', None)
    out = {r.conv_id: r for r in chat.digest_conversations(chat.format_turns(turns)).collect()}
    assert out[4].turns_sha256 == hashlib.sha256(b"user\nx\nassistant\ny\\\n").hexdigest()
    assert (out[4].loss_chars, out[4].loss_sha256) == (2, hashlib.sha256(b"y\\").hexdigest())
    assert chat.digest_conversations(chat.format_turns(turns.filter("1 = 0"))).count() == 0


def test_chat_of_mixed_layouts(spark, folder):
    """The same conversations in every layout give the same turns and digests, whatever else their records hold."""
    talks = defaultdict(list)
    for r in table(spark, folder, "conversations").limit(200).orderBy("conv_id", "turn").collect():
        talks[r.conv_id].append((r.role, r.text or ""))
    layouts = [
        lambda t: {"id": 7, "messages": [{"role": r, "content": x, "name": None} for r, x in t]},
        lambda t: {"conversations": [{"from": {"user": "human", "assistant": "gpt"}.get(r, r), "value": x} for r, x in t], "source": {"a": [1]}}]
    pairs = [lambda u, a: {"instruction": u, "output": a, "id": 1}, lambda u, a: {"prompt": u, "response": a}, lambda u, a: {"completion": a, "prompt": u, "tags": []},
             lambda u, a: {"question": u, "answer": a, "score": 0.5}]
    records, want = [], {}
    for k, (conv, turns) in enumerate(sorted(talks.items())):
        pair = len(turns) == 2 and [r for r, _ in turns] == ["user", "assistant"]
        made = pairs[k % 4](turns[0][1], turns[1][1]) if pair and k % 3 else layouts[k % 2](turns)
        records.append((conv, json.dumps(made)))
        want[conv] = turns
    out = {r.conv_id: r for r in chat.digest_conversations(chat.format_turns(chat.canonical_turns(
        spark.createDataFrame(records, "id long, record string"), "record", "id"))).collect()}
    assert set(out) == set(want)
    for conv, turns in want.items():
        said = "".join(x for r, x in turns if r == "assistant")
        assert (out[conv].n_turns, out[conv].loss_chars) == (len(turns), len(said))
        assert out[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert out[conv].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_chat_keeps_every_content(spark):
    records = [(1, json.dumps({"id": 3, "role": "user", "text": 0})), (2, json.dumps({"messages": [], "id": 1})), (3, json.dumps({"prompt": False, "response": "r"})),
               (4, json.dumps({"prompt": "p", "response": "r", "completion": "c"})), (5, "[1]")]
    got = defaultdict(list)
    for r in chat.canonical_turns(spark.createDataFrame(records, "id long, record string"), "record", "id").orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    assert got == {1: [("user", "0")], 3: [("user", "false"), ("assistant", "r")], 4: [(None, records[3][1])], 5: [(None, "[1]")]}


def test_long_word():
    """A word of any length is merged in about linear time."""
    rng = np.random.default_rng(3)
    coder, library = bpe.forced_boundary_bpe(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for n in (63, 64, 65, 66, 500, 200_000):
        for word in ("".join(rng.choice(list("etaoinshr"), n)), "a" * n):
            assert np.frombuffer(coder.encode(word), "<u4").tolist() == library.encode(word, add_special_tokens=False).ids


def test_forest_of_mixed_lengths(spark):
    """Vectors of different length under one label link with nothing of another length."""
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0, 0.0], 0), (3, [1.0, 0.001], 0), (4, [1.0, 0.0, 0.001], 0), (None, [1.0, 0.0], 0), (5, [], 0), (6, None, 0)]
    got = forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == len(rows)
    found = {r.vec_id: r.component_id for r in got}
    assert found == {1: 1, 2: 2, 3: 1, 4: 2, None: None, 5: 5, 6: 6}


def base_counts(text):
    w = WORDS.findall(text or "")
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, folder, odd, none, monkeypatch):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rows = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    good = {r.doc_id: r.quality for r in labels.collect()}
    for r in docs.collect():
        q = rows[r.doc_id]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == base_counts(r.text)
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
        assert q.kept == (not q.base_failed and q.ratio >= q.threshold)
        if r.doc_id in good and not q.base_failed:
            assert q.kept == (good[r.doc_id] == 1)
    assert quality.quality_rules(docs, labels).filter("kept").count() == sum(r.kept for r in rows.values())
    monkeypatch.setattr(quality, "PLACE_BITS", 3)  # the way of very long texts
    got = {r.doc_id: r.n_repeat_words for r in quality.with_counts(docs).collect()}
    assert got == {i: r.n_repeat_words for i, r in rows.items()}
    assert quality.quality_rules(odd, labels.filter("1 = 0")).filter("base_failed").count() == odd.count()
    assert quality.quality_rules(none, labels).count() == 0
    bare = quality.quality_rules(docs, labels, carry_text=False)
    assert "text" not in bare.columns and bare.filter("kept").count() == sum(r.kept for r in rows.values())


def test_quality_ratio(spark, folder):
    docs = table(spark, folder, "documents").filter("doc_id < 40")
    sample = quality.labelled_sample(table(spark, folder, "labels"))
    good = {r["_id"]: r["_good"] for r in sample.collect()}
    buckets = 50

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORDS.findall(text or "")]
        seeds = [xxhash.xxh64_intdigest(x.to_bytes(8, "little"), 42) for x in h]
        pairs = [xxhash.xxh64_intdigest(y.to_bytes(8, "little"), x) for x, y in zip(seeds, h[1:], strict=False)] + seeds[-1:]
        signed = [x - (1 << 64) if x >> 63 else x for x in h + pairs]
        return [x % buckets for x in signed]

    both = {r.doc_id: grams(r.text) for r in docs.limit(6).collect()}
    few = docs.filter(F.col("doc_id").isin(list(both)))
    raw, fine = Counter(x for v in both.values() for x in v), Counter(x for i, v in both.items() if good.get(i) == 1 for x in v)
    counted = quality.with_counts(few, buckets=buckets)
    ratios = quality.fit_ratios(counted, sample, buckets=buckets)
    raws, fines = sum(raw.values()) + buckets, sum(fine.values()) + buckets
    want = [math.log((fine[b] + 1) / fines) - math.log((raw[b] + 1) / raws) for b in range(buckets)]
    assert ratios == pytest.approx(want)
    for r in quality.with_ratio(counted, ratios).collect():
        assert r.ratio == pytest.approx(sum(want[b] for b in both[r.doc_id]) / len(both[r.doc_id]))


def test_quality_fits_on_all_labels(spark):
    """No label is left out, however many there are, and the cut is the best one of all rows."""
    rng = np.random.default_rng(4)
    good = rng.random(25_000) < 0.7
    ratio = np.round(rng.normal(size=len(good)) + good, 2) + 0.0  # many ties
    failed = rng.random(len(good)) < 0.1
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)] + [(7, 0), (None, 1), (8, None)], "doc_id long, quality int")
    good[7] = False
    sample = quality.labelled_sample(labels)
    assert sample.count() == len(good)
    rows = [(i, float(x), bool(f)) for i, (x, f) in enumerate(zip(ratio, failed, strict=True))] + [(None, 0.0, False), (99_999, 0.0, False), (5, -9.0, False)]
    plain = spark.createDataFrame(rows, "doc_id long, ratio double, base_failed boolean").repartition(3)
    scored = settle(plain.withColumn("_row", F.monotonically_increasing_id()))
    want = Counter((None if i is None or i > len(good) else int(good[i]), x) for i, x, _ in rows)
    for way in (scored, plain):
        assert Counter((r["_good"], r.ratio) for r in quality.with_labels(way, sample).collect()) == want
    x, g = np.array([(r[1], good[r[0]]) for r in rows if r[0] is not None and r[0] < len(good) and not r[2]]).T
    cuts = np.unique(x)
    best = max(cuts, key=lambda c: ((x <= c) & (g == 0)).sum() / (g == 0).sum() - ((x <= c) & (g == 1)).sum() / (g == 1).sum())
    assert quality.fit_threshold(quality.with_labels(scored, sample)) == pytest.approx((best + cuts[cuts > best].min()) / 2)
    assert quality.fit_threshold(quality.with_labels(scored, sample.filter("_good = 1"))) is None


def test_forest(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    v = np.concatenate([centres[rng.integers(0, 40, 600)] + rng.normal(size=(600, 16)) * 0.1, np.tile(centres[0], (300, 1))])
    rows = [(i, x.tolist(), i % 2) for i, x in enumerate(v)] + [
        (2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None] + [1.0] * 15, 0), (2004, v[0].tolist(), None),
        (2005, (v[0] * 2).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in forest.near_vectors(df, leaf=64).collect()}
    assert len(got) == len(rows)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.arange(900)[:, None] % 2 == np.arange(900) % 2) & ~np.eye(900, dtype=bool)
    want = near.sum() + 2 * (near[0].sum() + 1)
    found = sum(r.n_links for r in got.values())
    assert 0.9 * want <= found <= want
    assert all(got[i].n_links == 0 and got[i].kept for i in range(2000, 2005))
    assert got[2005].component_id == got[0].component_id
    assert forest.near_vectors(df.filter("1 = 0")).count() == 0


@pytest.mark.parametrize("length", [2, 3, 12])
def test_forest_loses_no_link(spark, length):
    """Deep trees over vectors of any length find every pair, also those right above the threshold."""
    rng = np.random.default_rng(length)
    v = rng.normal(size=(400, length))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    turn = rng.normal(size=v.shape)
    turn -= (turn * v).sum(1, keepdims=True) * v
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = rng.uniform(0.975, 0.985, (400, 1))
    v = np.concatenate([v, v * cosine + turn * np.sqrt(1 - cosine ** 2)])
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {r.vec_id: r.n_links for r in forest.near_vectors(df, leaf=8).collect()}
    assert got == dict(enumerate(((u @ u.T >= 0.98).sum(1) - 1).tolist()))


@pytest.mark.parametrize("block", [4, 2048])
def test_forest_connects_through_larger_ids(spark, monkeypatch, block):
    """A vector whose neighbours all have larger ids stays connected through them."""
    monkeypatch.setattr(forest, "BLOCK", block)
    angles = {1: 0, 9: 10, 2: 20, 8: 30, 3: 40, 4: 90, 7: 100, 5: 110, 6: 200}  # neighbours are 10 degrees apart
    rows = [(i, [math.cos(math.radians(a)), math.sin(math.radians(a))], 0) for i, a in angles.items()]
    got = {r.vec_id: r for r in forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 9: 1, 2: 1, 8: 1, 3: 1, 4: 4, 7: 4, 5: 4, 6: 6}
    assert {i: r.n_links for i, r in got.items()} == {1: 1, 9: 2, 2: 2, 8: 2, 3: 1, 4: 1, 7: 2, 5: 1, 6: 0}


def test_language(spark, folder, odd, none):
    docs = table(spark, folder, "documents")
    profiles = langid.fit_profiles(docs.filter(fold("doc_id", 5) != 0))
    held = langid.identify(docs, profiles).filter(fold("doc_id", 5) == 0).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    got = {r.text: r for r in langid.identify(odd, profiles).collect()}
    assert got[None].lang_pred == got[""].lang_pred == got[" \t\n "].lang_pred == "und" and got[None].score == 0
    assert langid.identify(none, langid.fit_profiles(none)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}
    grams, counts = langid.gram_counts("abc, ab")
    vector = langid.GramTable(64, 1, rows=2).bundle([(grams, counts)])[0]
    assert (vector == counts @ langid.gram_vectors(grams, 64, 1)).all()


def jaccard_groups_brute(texts):
    sets = {}
    for i, t in texts:
        w = WORDS.findall(lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("held", [jaccard.GROUP_ITEMS, 0])
def test_jaccard(spark, odd, none, monkeypatch, held):
    monkeypatch.setattr(jaccard, "GROUP_ITEMS", held)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words, 60))
    base = rng.choice(words, 120).tolist()
    texts = []
    for i in range(60):  # a group of near copies, and texts that share a passage only
        w = list(base)
        for k in rng.integers(0, 120, i % 5):
            w[k] = "new" + str(i)
        texts += [" ".join(w).upper() if i % 2 else " ".join(w), " ".join(rng.choice(words, rng.integers(5, 60))) + " " + passage]
    rows = list(enumerate(texts + ["", "a b", "A  b", " "]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()}
    assert got == jaccard_groups_brute(rows)
    out = jaccard.jaccard_groups(odd).collect()
    assert len(out) == odd.count() and {r.component_id for r in out if r.doc_id in (8, 9)} == {8}
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert jaccard.jaccard_groups(none).count() == 0


@pytest.mark.parametrize("held", [jaccard.GROUP_ITEMS, 0])
def test_jaccard_of_one_id_with_several_texts(spark, monkeypatch, held):
    monkeypatch.setattr(jaccard, "GROUP_ITEMS", held)
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, ""), (2, a), (3, b), (2, b), (4, ""), (5, None), (6, a + " end")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 36, 1), (1, 0, 1), (2, 36, 1), (3, 36, 1), (4, 0, 4), (5, 0, 5), (6, 37, 1)}


def test_far_texts_with_one_passage(spark):
    """Two thousand texts that share a passage and nothing else: no node of the plan lists their pairs."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(8)) + " " + passage) for i in range(2000)] + [(5000, f"w7x0 w7x1 w7x2 w7x3 w7x4 w7x5 w7x6 w7x7 {passage} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()}
    assert got == jaccard_components(rows)


def jaccard_components(rows):
    """Components by links of any two texts that share a shingle the others lack."""
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    common = set.intersection(*sets.values())
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s - common:
            holders[x].add(i)
    home = {i: i for i in sets}
    for held in holders.values():
        for i in held:
            for j in held:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    home[i] = home[j] = min(home[i], home[j])
    linked = [i for i in sets if 100 * len(common) >= 80 * (2 * len(sets[i]) - len(common))]
    assert len(linked) <= 1  # else the passage alone would link texts
    return home


def test_bpe(spark, odd, none):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in bpe.encode_decode(odd, WORD_BPE).join(odd.dropDuplicates(["doc_id"]).select("doc_id", "text"), "doc_id").collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids, r.decoded) == (len(want), want, library.decode(want, skip_special_tokens=False))
    assert bpe.encode_decode(none, WORD_BPE).count() == 0
    coder = bpe.forced_boundary_bpe(WORD_BPE)
    assert coder.fragments("jqab") == ["j", "qab"]


PAGE = """<!doctype html><title>no</title><style>x</style><p>One &amp; two<p hidden>no<p style="display: none">no</p>
<ul><li>a<li>b<ol><li>c</ol></ul><table><tr><th>k<th>value<tr><td>long cell<td>1</table><pre> x
  y</pre>a<br>b<script>no</script><div>c</div></b>"""


def test_html(spark):
    want = "One & two\n\n- a\n- b\n  1. c\n\nk          value\nlong cell  1\n\n x\n  y\n\na\nb\nc"
    rows = [(1, PAGE, "old"), (2, None, None), (3, "", None), (4, "<div" * 2000, None), (5, "<div>" * 5000 + "deep", None), (None, "x", None)]
    got = {r.page_id: r.text for r in render.extract_text(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()}
    assert got[1] == want and got[2] is None and got[3] == "" and got[5] == "deep" and got[None] == "x"
    assert render.extract_text(spark.createDataFrame([], "html string")).count() == 0


def ppm_brute(rows):
    texts = [(i, lower(t)) for i, t in rows]
    train = [t for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    words, after = Counter(), defaultdict(Counter)
    for t in train:
        words.update(WORDS.findall(t))
        words[None] += 1
        b = b"\xfe\xfe\xfe" + t.encode() + b"\xff"
        for k in range(3, len(b)):
            for o in range(4):
                after[b[k - o:k]][b[k]] += 1
    n, v = sum(words.values()), len(words)
    out = {}
    for i, t in texts:
        w = [*WORDS.findall(t), None]
        b, score = b"\xfe\xfe\xfe" + t.encode() + b"\xff", 0.0
        for k in range(3, len(b)):
            excluded, p = set(), 1.0
            for o in (3, 2, 1, 0):
                seen = {s: c for s, c in after[b[k - o:k]].items() if s not in excluded}
                if not seen:
                    continue
                total = sum(seen.values()) + len(seen)
                if b[k] in seen:
                    p *= seen[b[k]] / total
                    break
                p *= len(seen) / total
                excluded |= set(seen)
            else:
                p /= 256 - len(excluded)
            score += math.log10(p)
        out[i] = (len(w), sum(words[x] > 0 for x in w), n, sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w), score)
    return out


@pytest.mark.parametrize("hot", [0, 50, 1 << 18])
def test_ppm(spark, odd, none, folder, hot):
    docs = table(spark, folder, "documents").select("doc_id", "text").filter("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(900, None), (901, ""), (902, "Zß☃ neverseen")]
    docs = docs.unionByName(spark.createDataFrame(rows[-3:], docs.schema))
    got = {r.doc_id: tuple(r)[1:] for r in ppm.ppm_scores(docs, fold("doc_id", 7) != 2, hot_rows=hot).collect()}
    for i, want in ppm_brute(rows).items():
        assert got[i][:3] == want[:3] and got[i][3:] == pytest.approx(want[3:], rel=1e-9)


def test_ppm_edges(odd, none):
    assert ppm.ppm_scores(odd, F.lit(True)).count() == odd.count()
    assert ppm.ppm_scores(none, F.lit(True)).count() == 0
    lone = {r.doc_id: r for r in ppm.ppm_scores(odd.filter("doc_id < 4"), F.lit(False)).collect()}
    assert lone[0].score == pytest.approx(-math.log10(256)) and lone[0].n_known == 0
