"""Conversations as training windows of a token budget, and the way back.

A window holds whole turns only: the conversation's system turn, some turns of history
that an earlier window had already, then new turns as far as the budget goes. The loss
mask covers the texts of new assistant turns, so every assistant text is learned from
once. A turn beyond the budget is a window of its own and is not cut.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rushcart.llm.columns import texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BUDGET = 512
HISTORY = 128
#: Tokens of a turn's two marks.
MARKS = 2
BEGIN = "<s>"
AROUND = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
#: Around turns of any other role, whose name stands first.
OTHER, NAMED, OTHER_END = "[ROLE]", "[:]", "[/ROLE]"
_CONTROLS = sorted({BEGIN, OTHER, NAMED, OTHER_END, *[x for pair in AROUND.values() for x in pair]})
#: A control string, perhaps with backslashes after its first character.
_ANY = "|".join(re.escape(x[1:]) for x in _CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*)({_ANY})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_ANY})")
_TURN = re.compile("|".join(re.escape(a) for a in [*(a for a, _ in AROUND.values()), OTHER]))
_ROLE_OF = {begin: role for role, (begin, _) in AROUND.items()}


def escape(text: str) -> str:
    """One backslash more inside each control string, so that none stands in a text."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn with its marks, and where in it the text begins and ends."""
    begin, end = AROUND.get(role, (f"{OTHER}{escape(role)}{NAMED}", OTHER_END))
    inner = escape(text)
    return f"{begin}{inner}{end}", len(begin), len(begin) + len(inner)


def parsed(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a window: role, text, and where the escaped text begins and ends."""
    at = len(BEGIN)
    while at < len(formatted):
        mark = _TURN.match(formatted, at)
        start, role = mark.end(), _ROLE_OF.get(mark.group())
        if role is None:
            named = formatted.index(NAMED, start)
            role, start, closing = unescape(formatted[start:named]), named + len(NAMED), OTHER_END
        else:
            closing = AROUND[role][1]
        end = formatted.index(closing, start)
        yield role, unescape(formatted[start:end]), start, end
        at = end + len(closing)


class _Conversation:
    """Works off one conversation turn by turn and holds no more than one window and its history."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple[str, int] | None = None
        self.turns: list[tuple[str, str, str, int, int]] = []  # role, formatted, escaped span
        self.sums = [0]
        self.fresh = 0  # the first turn that no window had yet
        self.window = 0
        self.seen = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        turn = (role, *formatted_turn(role, text))
        cost = tokens + MARKS
        if self.seen == 0 and role == "system":
            self.system = (turn, cost)
        held = self.system[1] if self.system and (self.window or self.seen == 0) else 0
        if self.fresh < len(self.turns) and held + self.sums[-1] + cost > self.budget:
            yield self.flush()
            # Of the past, the longest run of turns within the history's tokens that leaves room for this one.
            room = min(self.history, self.budget - cost - (self.system[1] if self.system else 0))
            keep = bisect_left(self.sums, self.sums[-1] - max(room, 0))
            if self.system and self.window == 1:
                keep = max(keep, 1)  # the system turn is there anyway
            self.turns = self.turns[keep:]
            self.sums = [x - self.sums[keep] for x in self.sums[keep:]]
            self.fresh = len(self.turns)
        self.turns.append(turn)
        self.sums.append(self.sums[-1] + cost)
        self.seen += 1

    def flush(self) -> dict:
        out, at, spans, repeated = [BEGIN], len(BEGIN), [], self.fresh
        turns = list(self.turns)
        if self.system and self.window:
            turns.insert(0, self.system[0])
            repeated += 1
        for n, (role, whole, start, end) in enumerate(turns):
            if n >= repeated and role == "assistant":
                spans.append({"start": at + start, "end": at + end})
            out.append(whole)
            at += len(whole)
        row = {"window": self.window, "formatted": "".join(out), "repeated": repeated, "loss": spans}
        self.window += 1
        self.fresh = len(self.turns)
        return row


WINDOWS = "conv_id long, window long, formatted string, repeated long, loss array<struct<start:long,end:long>>"
_WINDOW_TYPE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("formatted", pa.string()),
        ("repeated", pa.int64()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def _counted(path: str):
    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            rows = texts(batch.column("text"))
            tokens = [len(x) for x in model.encode(rows, num_threads=1)] if rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], [*batch.schema.names, "tokens"])

    return run


def format_conversations(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, path: str = MODEL) -> DataFrame:
    """Windows (conv_id, window, formatted, repeated, loss) from rows (conv_id, turn, role, text).

    ``repeated`` is the number of turns at the beginning that an earlier window had, ``loss``
    the spans of the mask in code points. Null text and role count as empty, a null conv_id
    as one conversation, a null turn as the first; rows with one turn number follow each
    other by role and text, and equal rows are turns of their own. No rows give no windows.
    Tokens are counted where the rows are read; after that a conversation of any length
    passes through its task turn by turn.
    """

    def run(batches):
        conv_id, state, out = None, None, []

        def made(found):
            out.extend({"conv_id": conv_id, **x} for x in found)

        for batch in batches:
            for key, role, text, tokens in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "tokens"))):
                if state is None or key != conv_id:
                    if state:
                        made([state.flush()])
                    conv_id, state = key, _Conversation(budget, history)
                made(state.add(role, text, tokens))
                if len(out) >= 500:
                    yield pa.RecordBatch.from_pylist(out, _WINDOW_TYPE)
                    out.clear()
        if state:
            made([state.flush()])
        if out:
            yield pa.RecordBatch.from_pylist(out, _WINDOW_TYPE)

    filled = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")],
    )
    counted = filled.mapInArrow(_counted(path), "conv_id long, turn long, role string, text string, tokens long")
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "tokens").mapInArrow(run, WINDOWS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_TYPE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, repeated: int, loss: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in list(parsed(formatted))[repeated:]:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self, conv_id) -> dict:
        return {
            "conv_id": conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def read_back(windows: DataFrame, ordered: bool = False) -> DataFrame:
    """Per conversation, parsed from its windows: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    ``ordered`` says that the windows come straight from :func:`format_conversations`,
    whose tasks give a conversation's windows one after the other.
    """

    def run(batches):
        conv_id, state, out = None, None, []
        for batch in batches:
            for key, formatted, repeated, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "repeated", "loss"))):
                if state is None or key != conv_id:
                    if state:
                        out.append(state.row(conv_id))
                    conv_id, state = key, _Digest()
                state.add(formatted, repeated, loss)
            if out:
                yield pa.RecordBatch.from_pylist(out, _DIGEST_TYPE)
                out = []
        if state:
            yield pa.RecordBatch.from_pylist([state.row(conv_id)], _DIGEST_TYPE)

    if not ordered:
        windows = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return windows.mapInArrow(run, DIGESTS)
