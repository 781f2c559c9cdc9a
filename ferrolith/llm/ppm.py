"""Language-model scores by prediction by partial matching over bytes, with a unigram base.

The model is a trie of byte contexts of up to three bytes with the counts of the
bytes that follow, pretrained on the chosen rows. A byte seen after its longest
context costs n / (total + distinct); otherwise the context escapes with
distinct / (total + distinct), the next shorter one is asked without the bytes
already excluded, and at last the bytes left over are equally likely.

Counts grow with the corpus and stay in Spark. Tasks hold only tables of a fixed
most size (the most frequent words and four-byte strings); every other word or
string of a document is looked up exactly, by a join with the whole counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.llm.hashing import text_blocks, word_hashes
from ferrolith.session import settle

#: Bytes that no UTF-8 text holds: before the first byte, and after the last.
BEFORE, END = b"\xfe", b"\xff"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: The end of a document as a token.
END_WORD = -0x0E0D
WORD, GRAM = 0, 1
#: Most rows of the tables of frequent words and strings that tasks hold.
HOT_ROWS = 1 << 18
ROWS = "kind int, key long, n long"


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(four-byte strings ending at each byte and at the end of each text, as numbers; where each text begins, and the total)."""
    data = np.frombuffer(b"".join([BEFORE * 3 + t.translate(LOWER) + END for t in texts]), np.uint8).astype(np.uint32)
    keys = (data[:-3] << np.uint32(24)) | (data[1:-2] << np.uint32(16)) | (data[2:-1] << np.uint32(8)) | data[3:]
    starts = np.cumsum([0, *(len(t) + 4 for t in texts)])
    keep = np.ones(len(keys), bool)
    for k in (-3, -2, -1):
        at = starts[1:-1] + k
        keep[at] = False
    return keys[keep], np.cumsum([0, *(len(t) + 1 for t in texts)])


class HotTable:
    """Keys with values; most are found by one probe of a table, the others by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys))))) + 3)
        self.probe = np.full(1 << self.bits, -1, np.int32)
        self.probe[self._slot(self.keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among the keys, -1 for none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = self.probe[self._slot(keys)].astype(np.int64)
        wrong = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        again = np.minimum(np.searchsorted(self.keys, keys[wrong]), len(self.keys) - 1)
        at[wrong] = np.where(self.keys[again] == keys[wrong], again, -1)
        return at


def _uniques(kind: int, keys: list[np.ndarray]) -> pa.RecordBatch:
    values, counts = np.unique(np.concatenate(keys), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), kind), pa.int32()), pa.array(values.astype(np.int64)),
                                       pa.array(counts, pa.int64())], names=["kind", "key", "n"])


def corpus_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(kind, key, n): how often each word and each four-byte string occurs in all rows; null texts are empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {WORD: [], GRAM: []}
        size = 0
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([WORD], pa.int32()), pa.array([END_WORD], pa.int64()),
                                              pa.array([len(bodies)], pa.int64())], names=["kind", "key", "n"])
            for a, b in text_blocks(bodies):
                held[WORD].append(word_hashes(bodies[a:b])[0])
                held[GRAM].append(grams_of(bodies[a:b])[0])
                size += len(held[GRAM][-1])
                if size > 1 << 24:
                    yield from (_uniques(k, v) for k, v in held.items())
                    held, size = {WORD: [], GRAM: []}, 0
        if size:
            yield from (_uniques(k, v) for k, v in held.items())

    rows = texts.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).mapInArrow(count, ROWS)
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _hot(counts: DataFrame, columns: list[str], most: int) -> list[np.ndarray]:
    """Columns of the most frequent rows: all with a count from a power of two on, chosen so that ``most`` rows suffice."""
    size = F.floor(F.log2("n")).cast("int")
    by_size = sorted(((r["s"], r["n"]) for r in counts.groupBy(size.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = 63, 0
    for s, n in by_size:  # one row for each power of two
        total += n
        if total > most:
            break
        least = s
    table = counts.filter(size >= least).select(*columns).toArrow()
    return [table.column(c).to_numpy() for c in columns]


class LowOrders:
    """Counts after contexts of two, one and no bytes, from the counts of three-byte strings (at most 2**24 rows)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.tables = []
        for bits in (16, 8, 0):
            wide, at = np.unique(keys & ((1 << (bits + 8)) - 1), return_inverse=True)
            n = np.zeros(len(wide), np.int64)
            np.add.at(n, at, counts)
            self.tables.append((bits, wide, n))

    def log_probability(self, key: int, symbols: np.ndarray, counts: np.ndarray) -> float:
        """Log10 probability of the last byte of ``key`` after the first three; ``symbols`` were seen there."""
        symbol, total = key & 255, 0.0
        excluded = np.zeros(256, bool)
        for bits, wide, n in [(None, None, None), *self.tables]:
            if bits is not None:
                context = (key >> 8) & ((1 << bits) - 1)
                a, b = np.searchsorted(wide, [context << 8, (context + 1) << 8])
                symbols, counts = wide[a:b] & 255, n[a:b]
                left = ~excluded[symbols]
                symbols, counts = symbols[left], counts[left]
            if not len(symbols):
                continue
            all_, kinds = float(counts.sum()), len(symbols)
            here = symbols == symbol
            if here.any():
                return total + math.log10(float(counts[here][0]) / (all_ + kinds))
            total += math.log10(kinds / (all_ + kinds))
            excluded[symbols] = True
        return total - math.log10(256 - int(excluded.sum()))


def ppm_scores(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    The counts come from the rows where ``training`` is true. Tokens are words
    ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and one end per text.
    ``base_score`` is the add-one unigram log10 probability of the tokens,
    ``score`` that of the lower-cased bytes and the end by partial matching.
    Null text: empty. Null ids and repeated rows: a row each. Without training
    rows every byte is equally likely. ``hot_rows`` changes speed only.
    """
    spark = docs.sparkSession
    counts = settle(corpus_counts(docs.filter(training), text), "counts")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    grams = counts.filter(F.col("kind") == GRAM).select("key", "n")
    sizes = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(
        F.max(F.when(F.col("key") == END_WORD, F.col("n"))), F.lit(0)).alias("ends")).first()
    tokens, floor = sizes["n"], math.log10(sizes["n"] + sizes["v"] + 1)

    context = F.shiftright("key", 8).alias("context")
    contexts = grams.groupBy(context).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    seen = settle(grams.select("key", "n", context).join(contexts, "context").select(
        "key", "n", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("cost")), "costs")
    hot_words = _hot(words.filter(F.col("key") != END_WORD), ["key", "n"], hot_rows)
    hot_grams = _hot(seen, ["key", "cost"], hot_rows)
    low = grams.groupBy(F.col("key").bitwiseAND(0xFFFFFF).alias("key")).agg(F.sum("n").alias("n")).toArrow()
    held = spark.sparkContext.broadcast((hot_words, hot_grams))
    orders = spark.sparkContext.broadcast((low.column("key").to_numpy(), low.column("n").to_numpy()))
    end_cost = math.log10(sizes["ends"] + 1) - floor
    columns = ["row", "doc_id", "kind", "key", "n", "known", "base", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (word_keys, word_n), (gram_keys, gram_cost) = held.value
        word_table = HotTable(word_keys.view(np.uint64), np.log10(word_n + 1.0) - floor)
        gram_table = HotTable(gram_keys.astype(np.uint32), gram_cost)
        row = TaskContext.get().partitionId() << 40

        def out(rows, ids, kind, keys, n, known, base, cost):
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                (rows, ids, np.full(len(rows), kind), keys, n, known, base, cost), kinds, strict=True)], names=columns)

        def rest(rows, kind, which, keys):
            """Keys that are not in the table, once per text with their count."""
            order = np.lexsort((keys, which))
            which, keys = which[order], keys[order]
            new = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.zeros(0, int)
            n = np.diff(np.concatenate([new, [len(keys)]]))
            zero = np.zeros(len(new))
            return out(rows[which[new]], pa.nulls(len(new)), kind, keys[new].astype(np.int64), n, np.zeros(len(new), np.int64), zero, zero)

        for batch in batches:
            ids, bodies = batch.column(0), batch.column(1).to_pylist()
            for a, b in text_blocks(bodies):
                rows = row + np.arange(b - a)
                row += b - a
                hashes, first = word_hashes(bodies[a:b])
                keys, begin = grams_of(bodies[a:b])
                at_word, at_gram = word_table.find(hashes), gram_table.find(keys)
                sums = []
                for at, table, edges in ((at_word, word_table, first), (at_gram, gram_table, begin)):
                    cost = np.where(at >= 0, table.values[at], 0.0) if len(table.values) else np.zeros(len(at))
                    sums.append(np.array([cost[i:j].sum() for i, j in zip(edges[:-1], edges[1:], strict=True)]))
                known = np.array([(at_word[i:j] >= 0).sum() for i, j in zip(first[:-1], first[1:], strict=True)], np.int64)
                yield out(rows, ids.slice(a, b - a), -1, pa.nulls(b - a), np.diff(first) + 1, known + (sizes["ends"] > 0), sums[0] + end_cost, sums[1])
                for kind, at, hashes_, edges in ((WORD, at_word, hashes, first), (GRAM, at_gram, keys, begin)):
                    lost = np.flatnonzero(at < 0)
                    yield rest(rows, kind, np.searchsorted(edges, lost, "right") - 1, hashes_[lost])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    parts = settle(source.mapInArrow(
        score, "row long, doc_id long, kind int, key long, n long, known long, base double, score double"), "parts")

    lost_words = parts.filter(F.col("kind") == WORD).select("row", "key", F.col("n").alias("times")).join(words, "key", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1.0) - floor)).alias("base"))
    lost = parts.filter(F.col("kind") == GRAM).select("row", "key", F.col("n").alias("times"))
    needed = lost.select("key").distinct().withColumn("context", F.shiftright("key", 8))
    after = grams.select("key", "n", context).join(needed.select("context").distinct(), "context", "leftsemi").groupBy("context").agg(
        F.collect_list(F.col("key").bitwiseAND(255)).alias("symbols"), F.collect_list("n").alias("counts"))  # 256 at most

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = LowOrders(*orders.value)
        for batch in batches:
            costs = [trie.log_probability(k, np.array(s or [], np.int64), np.array(n or [], np.int64))
                     for k, s, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.float64())], names=["key", "cost"])

    costs = needed.join(after, "context", "left").select("key", "symbols", "counts").mapInArrow(price, "key long, cost double")
    lost_grams = lost.join(costs, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("score"))
    whole = parts.filter(F.col("kind") == -1).select("row", "doc_id", F.col("n").alias("n_tokens"), "known", "base", "score")
    no_id, no_n, no_x = F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(0.0)
    every = whole.unionByName(lost_words.select("row", no_id.alias("doc_id"), no_n.alias("n_tokens"), "known", "base", no_x.alias("score"))).unionByName(
        lost_grams.select("row", no_id.alias("doc_id"), no_n.alias("n_tokens"), no_n.alias("known"), no_x.alias("base"), "score"))
    return every.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("score").alias("score")).drop("row")
