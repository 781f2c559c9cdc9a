"""Byte-pair encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can
never be merged across, so it is a certain cut: the fragments between cuts are
encoded independently (and only once per distinct fragment), then concatenated.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Symbols from which on a word's merges are kept in a heap.
LONG = 64
#: Fragments and words kept per Python worker; when full the store starts anew, results stay the same.
KEPT = 600_000


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class ForcedBoundaryBpe:
    """Encoder for vocabulary files with word ends: NFC, white space dropped, lower case, then byte-pair merges.

    ``encode`` gives what the tokenizers library gives without special tokens
    added; control strings in a text become their own ids, as there. ``decode``
    joins the tokens of all ids with single spaces, as the library does for a
    file without a decoder.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): k for k, m in enumerate(model["merges"])}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.control = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        letters = byte_letters()
        self.inside = set()
        for token in self.vocab:
            body = token.removesuffix(self.suffix)
            self.inside.update(zip(body, body[1:], strict=False))
        pairs = sorted(a + b for a in letters for b in letters if (a, b) not in self.inside)
        by_first: dict[str, str] = {}
        for a, b in pairs:
            by_first[a] = by_first.get(a, "") + b
        self.cuts = {a: set(b) for a, b in by_first.items()}
        self.letter = {b: x for b, x in enumerate(letters)}
        self.known_words: dict[str, bytes] = {}
        self.known_parts: dict[tuple[str, ...] | str, bytes] = {}

    def fragments(self, letters: str) -> list[str]:
        """A word's byte letters, cut at every pair that no token holds."""
        cuts, out, begin = self.cuts, [], 0
        for i in range(1, len(letters)):
            if (c := cuts.get(letters[i - 1])) and letters[i] in c:
                out.append(letters[begin:i])
                begin = i
        out.append(letters[begin:])
        return out

    def merge(self, symbols: list[str]) -> list[str]:
        """Apply the merges, lowest rank first, leftmost first."""
        if len(symbols) > LONG:
            return self._merge_long(symbols)
        ranks, none = self.ranks, 1 << 60
        found = [ranks.get(p, none) for p in zip(symbols, symbols[1:], strict=False)]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del found[i]
            if i < len(found):
                found[i] = ranks.get((symbols[i], symbols[i + 1]), none)
            if i:
                found[i - 1] = ranks.get((symbols[i - 1], symbols[i]), none)
        return symbols

    def _merge_long(self, symbols: list[str | None]) -> list[str]:
        """The same with a heap of pairs over a linked list: a long word takes little more than its length."""
        ranks, n = self.ranks, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
        heapify(heap)

        def offer(i: int, j: int) -> None:
            if (rank := ranks.get((symbols[i], symbols[j]))) is not None:
                heappush(heap, (rank, i, symbols[i], symbols[j]))

        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = left + right, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s is not None]

    def _part(self, part: str, last: bool) -> bytes:
        key = part + self.suffix if last else part
        if (ids := self.known_parts.get(key)) is None:
            symbols = list(part)
            if last:
                symbols[-1] += self.suffix
            ids = np.array([self.vocab[x] for x in self.merge(symbols)], "<u4").tobytes()
            if len(self.known_parts) >= KEPT:
                self.known_parts = {}
            self.known_parts[key] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of one piece of text without white space."""
        out = []
        for w in self.words.findall(word):
            *parts, end = self.fragments("".join([self.letter[b] for b in w.encode()]))
            out += [self._part(p, False) for p in parts]
            out.append(self._part(end, True))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        known, out = self.known_words, []
        for piece in text.replace("\n", " ").split(" "):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= KEPT:
                    known.clear()
                ids = known[piece] = self._word("".join([c.lower() for c in piece]) if not piece.isascii() else piece.lower())
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        if "<|" not in text:
            return self._plain(text)
        return b"".join([self.added.get(p) or self._plain(p) for p in self.control.split(text)])

    def decode(self, ids: np.ndarray) -> str:
        return " ".join([self.names[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def forced_boundary_bpe(path: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(path)


def encode_decode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every whole text.

    ``ids`` is a list of numbers. A null text is empty (no ids); null ids and repeated rows are kept as they are. Rows are
    encoded where they are read, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = forced_boundary_bpe(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                raw = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                texts = [bpe.decode(np.frombuffer(r, "<u4")) if decoded else None for r in raw]
                counts = [len(r) // 4 for r in raw]
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), ids, pa.array(texts, pa.string())],
                                                 names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, decoded string")

