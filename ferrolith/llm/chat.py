"""Chat formatting: records of any known layout become turns, turns become masked text.

A record's fingerprint is a hash of its nested field paths (array steps as ``[]``).
The fingerprint selects a declarative mapping, which says where the turns are.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Layouts by their field paths. ``turns`` is the list of messages with the fields for role and text;
#: ``parts`` are (role, fields joined by an empty line); ``optional`` paths may be absent.
MAPPINGS = {
    "turn row": {"paths": ["role", "text"], "turns": None, "role": "role", "text": "text"},
    "messages": {"paths": ["messages[].content", "messages[].role"], "turns": "messages", "role": "role", "text": "content"},
    "conversations": {"paths": ["conversations[].from", "conversations[].value"], "turns": "conversations", "role": "from",
                      "text": "value"},
    "instruction": {"paths": ["instruction", "output"], "optional": ["input", "system"],
                    "parts": [("system", ["system"]), ("user", ["instruction", "input"]), ("assistant", ["output"])]},
    "prompt": {"paths": ["prompt", "response"], "optional": ["system"],
               "parts": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    "completion": {"paths": ["completion", "prompt"], "parts": [("user", ["prompt"]), ("assistant", ["completion"])]},
    "question": {"paths": ["answer", "question"], "parts": [("user", ["question"]), ("assistant", ["answer"])]},
}
#: Other names of the roles.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: A turn is OPEN role newline text CLOSE newline.
OPEN, CLOSE = "<s>", "</s>"
#: Fixed pattern: control strings of this template and of other common ones.
CONTROL = re.compile(r"</?s>|\[/?INST\]|<</?SYS>>|<\|\w+\|>")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Break every control string with a backslash after its first character; backslashes are doubled."""
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """The inverse of ``escape`` (and of ``escape_role``)."""
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def field_paths(value: object, at: str = "") -> set[str]:
    """Leaf paths of a parsed record; lists add ``[]``, whatever their length."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"} if not value else set(), *(field_paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def fingerprints(mappings: dict = MAPPINGS) -> dict[str, str]:
    """Fingerprint -> name of the mapping, for each choice of its optional paths."""
    out = {}
    for name, m in mappings.items():
        optional = m.get("optional", [])
        for k in range(1 << len(optional)):
            out[fingerprint({*m["paths"], *(p for i, p in enumerate(optional) if k >> i & 1)})] = name
    return out


def _text(value: object) -> str:
    """A field as text: null is empty, anything but a string as JSON."""
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def layout_of(record: object, known: dict[str, str], named: set[str], mappings: dict = MAPPINGS) -> str | None:
    """The mapping whose paths the record holds. Only ``named`` paths count; an empty list of turns is one without turns."""
    if not isinstance(record, dict):
        return None
    empty = [name for name, m in mappings.items() if m.get("turns") and record.get(m["turns"]) == []]
    own = field_paths(record) & named
    return empty[0] if empty and not own else known.get(fingerprint(own))


def _turns(record: object, m: dict) -> list[tuple[str | None, str | None]]:
    if "parts" in m:
        found = [(role, [t for f in fields if (t := _text(record.get(f)))]) for role, fields in m["parts"]]
        return [(role, "\n\n".join(texts)) for role, texts in found if texts or role != "system"]
    rows = [record] if m["turns"] is None else record[m["turns"]]
    return [(_text(r.get(m["role"])), _text(r.get(m["text"]))) for r in rows]


def canonical_turns(records: DataFrame, record: str, conv_id: str, order: str | None = None, mappings: dict = MAPPINGS) -> DataFrame:
    """(conv_id, turn, role, text, layout): the turns of JSON records, one row each.

    ``turn`` is the place inside the record, after ``order`` where a record is a
    single turn. Fields that no mapping names do not count for the fingerprint,
    and a record whose list of turns is empty has none. An unparsable or unknown
    record gives one row with null role and layout and the record itself as text,
    so nothing is lost; a null record one with null text. Null role or text become
    empty, numbers and the like their JSON; other role names are kept.
    """
    known = fingerprints(mappings)
    named = {p for m in mappings.values() for p in (*m["paths"], *m.get("optional", []))}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, place, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    value = None
                layout = layout_of(value, known, named, mappings)
                if layout is None:
                    rows.append((number, place, None, raw, None))
                    continue
                for k, (role, text) in enumerate(_turns(value, mappings[layout])):
                    rows.append((number, place + k if place is not None else None, ROLE_NAMES.get(role, role), text, layout))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["conv_id", "turn", "role", "text", "layout"])

    place = F.col(order).cast("long") if order else F.lit(0).cast("long")
    return records.select(F.col(conv_id).cast("long").alias("conv_id"), place.alias("turn"), F.col(record).alias("record")).mapInArrow(
        read, "conv_id long, turn long, role string, text string, layout string")


def format_turns(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_end): each turn as text of the template.

    A conversation's output is its turns' ``formatted`` in turn order. The loss
    span counts characters inside the turn and covers its escaped text; it is
    empty (0, 0) for other roles. Turns are formatted one by one, so a
    conversation of any length takes no memory. Null role or text: empty.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts, ends = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                head, body = f"{OPEN}{escape_role(role or '')}\n", escape(text or "")
                loss = role in loss_roles
                texts.append(f"{head}{body}{CLOSE}\n")
                starts.append(len(head) if loss else 0)
                ends.append(len(head) + len(body) if loss else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_end"])

    return turns.select("conv_id", "turn", "role", "text").mapInArrow(
        render, "conv_id long, turn long, formatted string, loss_start long, loss_end long")


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) read back from one formatted turn."""
    end = formatted.index(CLOSE)
    role, _, body = formatted[len(OPEN):end].partition("\n")
    return unescape(role), unescape(body)


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from formatted turns: counts and digests.

    ``turns_sha256`` hashes role, newline, text, newline of every turn;
    ``loss_sha256`` the unescaped text under the loss mask. Rows are dealt by
    conversation and sorted, and stream through the hashes: a conversation of
    any length is never held. Equal turn numbers are ordered by their text.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = object(), None, []

        def ended():
            n, turns, loss_chars, loss, chars = state
            rows.append((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for number, text, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if number != now:
                    if state:
                        ended()
                    now, state = number, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = parse_turn(text)
                masked = unescape(text[start:end])
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(text)
            if rows:
                yield out()
                rows = []
        if state:
            ended()
            yield out()

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select("conv_id", "turn", "formatted", "loss_start", "loss_end").mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
