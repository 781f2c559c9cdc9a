"""Cached use of the tokenizers library inside tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np

from ferrolith.llm.hashing import mix, text_blocks

if TYPE_CHECKING:
    from tokenizers import Encoding

#: The characters of Unicode white space, as the tokenizers' patterns see them.
SPACE = " \t\n\x0b\x0c\r\x85\xa0  -     　"
TWO_SPACES = re.compile(f"[{SPACE}][{SPACE}]|^[{SPACE}]|[{SPACE}]$")
CHUNKS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Pieces kept per Python worker; when full the store starts anew, results stay the same.
KEPT_PIECES = 700_000
#: Texts that are handed over, and bytes of text that are cut, at once.
TEXTS = 1024
BLOCK_BYTES = 1 << 20
#: Groups of a thousand pieces that the library encodes in one call; its results take ten times the memory of the pieces.
CALL = 8
#: Kinds of bytes: gaps, letters, digits, other ASCII signs; a word with any other byte, or with an apostrophe, stays whole.
GAP, LETTER, DIGIT, SIGN, ODD = range(5)
KIND = np.full(256, ODD, np.int8)
KIND[33:127] = SIGN
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[48:58] = DIGIT
KIND[39] = ODD
KIND[[10, 32]] = GAP
SHAPE = bytes(32 if b in b" \t\n\x0b\x0c\r" else 120 for b in range(256))
WIDE_SPACE = re.compile(f"[{SPACE[6:]}]")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
FILLED = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first n bytes


def _uneven(text: str) -> bool:
    """Whether white space stands at an end of the text or beside other white space."""
    shape = text.encode().translate(SHAPE)
    if b"  " in shape or shape[:1] == b" " or shape[-1:] == b" ":
        return True
    return not text.isascii() and bool(WIDE_SPACE.search(text)) and bool(TWO_SPACES.search(text))


class PieceEncoder:
    """Encodes texts as ``Tokenizer.encode`` does, each distinct piece of text once.

    White space always ends a pre-token in both supported kinds of file (word
    ends, and byte level with a leading space), as does the change between
    letters, digits and signs, so a text is the concatenation of its pieces. Texts that hold a control string of the file are given to
    the library whole. ``encode_all`` returns little-endian unsigned 32-bit ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.control = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.word_ends = bool(getattr(self.tokenizer.model, "end_of_word_suffix", None))
        self.mark = " ~ " if self.word_ends else "\n"
        ids = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.mark_id = ids[0] if len(ids) == 1 else None
        self.empty()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        plain = []
        for k, text in enumerate(texts):
            if any(c in text for c in self.control):
                out[k] = self._whole(text)
            elif not self.word_ends and _uneven(text):
                out[k] = self._joined(CHUNKS.findall(text))
            else:
                plain.append(k)
        raw = [texts[k].encode() for k in plain]
        for a, b in text_blocks(raw, BLOCK_BYTES):
            for k, ids in zip(plain[a:b], self._block(raw[a:b]), strict=True):
                out[k] = ids
        return out

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of the pieces in the store, which learns those it lacks."""
        if len(self.known) + len(pieces) > KEPT_PIECES:
            self.empty()
        numbers = np.fromiter((self.known.get(p, -1) for p in pieces), np.int64, len(pieces))
        lacking = np.flatnonzero(numbers < 0)
        if len(lacking):
            new = list(dict.fromkeys(pieces[k] for k in lacking))
            learned: dict[bytes, bytes] = {}
            self._learn(new, learned)
            parts = [learned[p] for p in new]
            lengths = np.array([len(x) // 4 for x in parts])
            first, held = len(self.known), len(self.ids)
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
            self.begin = np.concatenate([self.begin, held + np.cumsum(lengths) - lengths])
            self.length = np.concatenate([self.length, lengths])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(parts), "<u4")])
            numbers[lacking] = [self.known[pieces[k]] for k in lacking]
        return numbers

    def empty(self) -> None:
        """Forget all pieces; the tokenizer stays."""
        self.known: dict[bytes, int] = {}
        self.begin, self.length, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")

    def _ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered pieces in order, and how many each has."""
        length = self.length[numbers]
        shift = self.begin[numbers] - (np.cumsum(length) - length)
        return self.ids[np.repeat(shift, length) + np.arange(int(length.sum()))], length

    def _joined(self, pieces: list[str]) -> bytes:
        return self._ids(self._numbers([p.encode() for p in pieces]))[0].tobytes()

    def _block(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts in UTF-8, all pieces of the block at once.

        A piece ends at a blank or line end, and inside a word of plain ASCII also
        where the tokenizer's pattern ends one: between letters, digits and
        other signs. Equal pieces are looked up once.
        """
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        kind = KIND[data]
        gap = kind == GAP
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # U+00C0 to U+00FF: letters but two
        kind[latin] = kind[latin + 1] = LETTER
        edge = np.diff(gap, prepend=True, append=True)
        opens, closes = np.flatnonzero(edge[:-1] & ~gap), np.flatnonzero(edge[1:] & ~gap) + 1
        if len(opens):
            odd = np.maximum.reduceat(kind, np.stack([opens, closes], axis=1).ravel())[::2] == ODD
            whole = np.zeros(len(data) + 1, np.int8)
            whole[opens[odd]] += 1
            whole[closes[odd]] -= 1
            kind = np.where(np.cumsum(whole[:-1]) > 0, ODD, kind)
        cuts = np.ones(len(data), bool)
        cuts[1:] = kind[1:] != kind[:-1]
        if self.word_ends:
            data = LOWER[data]
            cuts |= kind == DIGIT
            first = np.flatnonzero(cuts & ~gap)
            last = np.flatnonzero(np.append(cuts[1:], True) & ~gap) + 1
        else:
            line = gap & (data == 10)
            line[starts[1:] - 1] = False  # line ends between the texts are none of theirs
            begins = (cuts & ~gap) | line
            first = np.flatnonzero(begins)
            last = np.flatnonzero((np.append(cuts[1:], True) & ~gap) | line) + 1
            blank = ~line[first] & (first > 0) & (data[np.maximum(first, 1) - 1] == 32)
            first = first - blank
        if not len(first):
            return [b""] * len(texts)
        size, body = last - first, data.tobytes()
        cut = lambda at: [body[a:b] for a, b in zip(first[at].tolist(), last[at].tolist(), strict=True)]
        # a piece of up to 16 bytes is two numbers and its length; equal ones are found by a hash of them, then compared
        windows = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(16, np.uint8)), 8)
        short = np.flatnonzero(size <= 16)
        low = windows[first[short]].view("<u8").ravel() & FILLED[np.minimum(size[short], 8)]
        high = windows[first[short] + 8].view("<u8").ravel() & FILLED[np.maximum(size[short] - 8, 0)]
        spans = size[short].astype(np.uint64)
        _, one, group = np.unique(mix(mix(mix(low) ^ high) ^ spans), return_index=True, return_inverse=True)
        if any((x != x[one[group]]).any() for x in (low, high, spans)):
            one = group = np.arange(len(short))
        numbers = np.empty(len(first), np.int64)
        long = np.flatnonzero(size > 16)
        known = self._numbers(cut(short[one]) + cut(long))
        numbers[short], numbers[long] = known[:len(one)][group], known[len(one):]
        ids, length = self._ids(numbers)
        ends = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(first, starts)]
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, piece: bytes) -> bool:
        """Whether the mark next to the piece stays a pre-token of its own."""
        if self.mark_id is None:
            return False
        if self.word_ends:
            return b"~" not in piece
        core = piece[1:] if piece[:1] == b" " else piece
        return core.isalnum() or core.decode().split() == [core.decode()]

    def _encoded(self, groups: list[list[bytes]], mark: bytes) -> Iterator[tuple[list[bytes], Encoding]]:
        return zip(groups, self.tokenizer.encode_batch_fast([mark.join(g).decode() for g in groups], add_special_tokens=False), strict=True)

    def _learn(self, pieces: list[bytes], learned: dict[bytes, bytes], at_once: int = 1000) -> None:
        """Ids of the pieces from the library, a thousand in one call with marks between them."""
        plain, odd = [], []
        for p in pieces:
            (plain if self._plain(p) else odd).append(p)
        groups = [plain[i:i + at_once] for i in range(0, len(plain), at_once)]
        mark = self.mark.encode()
        for group, e in ((g, x) for i in range(0, len(groups), CALL) for g, x in self._encoded(groups[i:i + CALL], mark)):
            ids = np.array(e.ids, "<u4")
            parts = np.flatnonzero(ids == self.mark_id)
            if len(parts) != len(group) - 1:
                odd += group
                continue
            raw, ends = ids.tobytes(), [*(parts * 4).tolist(), len(ids) * 4]
            begin = 0
            for piece, end in zip(group, ends, strict=True):
                learned[piece] = raw[begin:end]
                begin = end + 4
        for piece in odd:
            learned[piece] = self._whole(piece.decode())


@lru_cache(maxsize=4)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per file and Python worker."""
    return PieceEncoder(path)
