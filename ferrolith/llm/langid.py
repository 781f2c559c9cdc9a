"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrolith.llm.workers import frugal

#: Letters are dealt to this many symbols (0 is the gap between words); a trigram is three symbols.
SYMBOLS = 128
DIMENSIONS = 1024
#: Share of the labelled texts that may be odd (mislabelled, mostly names or numbers) and do not lower their language's floor.
ODD_SHARE = 0.001
#: Trigrams whose vectors are unfolded at once.
GRAMS = 1024
LETTER = re.compile(r"[^\W\d_]")


@lru_cache(maxsize=1)
def _symbol_of() -> np.ndarray:
    """Symbol of each code point: 0 unless it is a letter; case is folded; letters beyond Latin share symbols."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = ord(x.lower()[0])
            out[c] = 1 + (low - 97 if 97 <= low <= 122 else 26 + low * 2654435761 % (SYMBOLS - 27))
    return out


@lru_cache(maxsize=4)
def letter_vectors(dimensions: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random vectors of +1 and -1, one per symbol: rotated twice, rotated once, as they are."""
    letters = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dimensions)).astype(np.float32) * 2 - 1
    return np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters


def gram_vectors(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Bound vectors of trigram numbers: the first letter's vector rotated twice, the second's once, multiplied."""
    first, second, third = letter_vectors(dimensions, seed)
    a, b, c = grams // (SYMBOLS * SYMBOLS), grams // SYMBOLS % SYMBOLS, grams % SYMBOLS
    return first[a] * second[b] * third[c]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(trigram numbers, counts) over the letters of a text; runs of other characters are one gap."""
    symbols = _symbol_of()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    symbols = np.concatenate([[0], symbols, [0]]).astype(np.int32)
    symbols = symbols[np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])]
    grams = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    return np.unique(grams[symbols[1:-1] != 0], return_counts=True)


class GramTable:
    """Bound vectors of the trigrams met so far in a task; starts anew when full, results stay the same."""

    def __init__(self, dimensions: int, seed: int, rows: int = 16384):
        self.dimensions, self.seed, self.rows = dimensions, seed, rows
        self.clear()

    def clear(self) -> None:
        self.slot, self.used = np.full(SYMBOLS ** 3, -1, np.int32), 0
        self.vectors = np.empty((self.rows, self.dimensions), np.int8)

    def bundle(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row per text: the sum of the bound vectors of all its n-grams."""
        total = np.zeros((len(texts), self.dimensions), np.float32)
        for grams in np.array_split(np.unique(np.concatenate([g for g, _ in texts])), 1 + sum(len(g) for g, _ in texts) // (1 << 20)):
            step = min(self.rows, GRAMS)
            for i in range(0, len(grams), step):
                self._add(total, texts, grams[i:i + step])
        return total

    def _add(self, total: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], grams: np.ndarray) -> None:
        new = grams[self.slot[grams] < 0]
        if self.used + len(new) > self.rows:
            self.clear()
            new = grams
        self.slot[new] = np.arange(self.used, self.used + len(new))
        self.vectors[self.used:self.used + len(new)] = gram_vectors(new, self.dimensions, self.seed)
        self.used += len(new)
        counts = np.zeros((len(texts), len(grams)), np.float32)
        for row, (g, n) in zip(counts, texts, strict=True):
            a, b = np.searchsorted(g, (grams[0], grams[-1] + 1))  # both are in order, and grams lacks none of the text's between
            row[np.searchsorted(grams, g[a:b])] = n[a:b]
        total += counts @ self.vectors[self.slot[grams]].astype(np.float32)


def fit_profiles(docs: DataFrame, lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS,
                 seed: int = 1) -> dict[str, np.ndarray]:
    """Prototype vector of each language: the bundle of all its n-grams over all rows.

    Bundling is addition: every task adds up the n-gram counts of its rows by
    language, bundles once and sends one vector per language; Spark sums them.
    Rows with a null language or text, or without letters, add nothing.
    """

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                grams, counts = gram_counts(body.as_py())
                if len(grams):
                    held = sums.setdefault(name, np.zeros(SYMBOLS ** 3, np.int64))
                    held[grams] += counts
        for name, held in sums.items():
            grams = np.flatnonzero(held)
            vector = np.zeros(dimensions)
            for i in range(0, len(grams), GRAMS):  # double: counts of a whole task may pass what single can hold
                part = grams[i:i + GRAMS]
                vector += held[part].astype(np.float64) @ gram_vectors(part, dimensions, seed).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions), pa.int32()),
                                              pa.array(vector.astype(np.int64))], names=["lang", "at", "value"])

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    parts = rows.mapInArrow(frugal(bundles), "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    profiles: dict[str, np.ndarray] = {}
    for r in parts.collect():  # languages x dimensions numbers, whatever the input
        profiles.setdefault(r["lang"], np.zeros(dimensions))[r["at"]] = r["value"]
    return profiles


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS,
             seed: int = 1) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with the nearest prototype (0 if negative).

    A text that is null or has no letter, or any text when no language was
    learned, gives ``und`` and 0. Equal cosines: the first name in order.
    Columns named like the results are replaced.
    """
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")))
    names = sorted(profiles)
    table = np.array([profiles[x] / max(1.0, np.linalg.norm(profiles[x])) for x in names]).reshape(len(names), dimensions)
    at = docs.columns.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors_of = GramTable(dimensions, seed)  # goes with the task: workers live on beside other stages
        for batch in batches:
            found, scores = [], []
            for i in range(0, batch.num_rows, 256):
                grams = [gram_counts(body.as_py() or "") for body in batch.column(at).slice(i, 256)]
                vectors = vectors_of.bundle(grams).astype(np.float64)
                cosines = vectors @ table.T / np.maximum(1e-12, np.linalg.norm(vectors, axis=1))[:, None]
                for (held, _), row in zip(grams, cosines, strict=True):
                    best = int(np.argmax(row)) if len(held) and names else -1
                    found.append("und" if best < 0 else names[best])
                    scores.append(0.0 if best < 0 else float(min(1.0, max(0.0, row[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(frugal(predict), T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def score_floors(scored: DataFrame, lang: str = "lang") -> dict[str, float]:
    """Least score of each language: half of what all but ``ODD_SHARE`` of its rightly named labelled texts reach.

    ``scored`` is the result of ``identify`` for the labelled rows. Scores are
    counted in steps of a thousandth; a language without such rows has no floor.
    """
    step = F.floor(F.col("score") * 1000).cast("int").alias("step")
    right = scored.filter(F.col(f"`{lang}`") == F.col("lang_pred"))
    steps: dict[str, list[tuple[int, int]]] = {}
    for r in right.groupBy("lang_pred", step).agg(F.count("*").alias("n")).collect():  # 1001 rows a language at most
        steps.setdefault(r["lang_pred"], []).append((r["step"], r["n"]))
    floors: dict[str, float] = {}
    for name, held in steps.items():
        odd = ODD_SHARE * sum(n for _, n in held)
        below = 0
        for at, n in sorted(held):
            below += n
            if below > odd:
                floors[name] = at / 2000
                break
    return floors


def near_languages(scored: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Rows of ``identify`` with a language whose floor the score reaches."""
    known = scored.filter(F.col("lang_pred") != "und")
    if not floors:
        return known
    floor = F.create_map(*(F.lit(x) for item in sorted(floors.items()) for x in item))[F.col("lang_pred")]
    return known.filter(F.col("score") >= F.coalesce(floor, F.lit(0.0)))
