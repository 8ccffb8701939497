import hashlib
import random

import pytest
from pyspark.sql import types as T

from rushcart.llm.chat import MARKS, escape, format_conversations, formatted_turn, parsed, read_back, unescape
from .conftest import ODD, rows_of

SCHEMA = T.StructType([T.StructField(c, t) for c, t in zip(("conv_id", "turn", "role", "text", "tokens", "window"), (T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.StringType()))])
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[:]", "[\\INST]", "<\\\\/s>", "[", "<", "\\"]


@pytest.fixture
def talks(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def wanted(turns):
    whole = "".join(f"{r or ''}\n{x or ''}\n" for r, x in turns)
    learned = "".join(x or "" for r, x in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(learned), sha(learned)


COLUMNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def test_control_strings_are_escaped_and_come_back():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(CONTROLS + ["a", " "]) for _ in range(rng.randrange(8)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[:]"))
        role = rng.choice(["user", "assistant", "system", "tool", "", text])
        assert [(r, t) for r, t, _, _ in parsed("<s>" + formatted_turn(role, text)[0])] == [(role, text)]


def test_round_trip_of_many_turns(talks):
    rng = random.Random(2)
    talk = {}
    for conv in range(40):
        turns = [("system", "be kind " * 9)] if conv % 2 else []
        for _ in range(rng.randrange(1, 60)):
            turns.append((rng.choice(["user", "assistant", "tool"]), " ".join(rng.choice(CONTROLS + ["word"]) for _ in range(rng.randrange(40)))))
        talk[conv] = turns
    talk[99] = [("user", "long " * 5000), ("assistant", "short"), ("assistant", "long too " * 3000), ("user", "end")]
    rows = [(c, n, r, t) for c, turns in talk.items() for n, (r, t) in enumerate(turns)]
    random.Random(3).shuffle(rows)
    windows = format_conversations(talks(rows).repartition(5), budget=200, history=60)
    assert rows_of(read_back(windows), *COLUMNS) == sorted([(c, *wanted(t)) for c, t in talk.items()], key=repr)
    assert rows_of(read_back(windows, ordered=True), *COLUMNS) == rows_of(read_back(windows), *COLUMNS)


def test_windows_keep_the_system_turn_and_some_history_within_the_budget(spark, talks):
    import sentencepiece

    from rushcart.llm.chat import MODEL

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    cost = lambda t: len(model.encode(t)) + MARKS
    rows = [(1, 0, "system", "you help")] + [(1, n, "user" if n % 2 else "assistant", f"turn {n} " + "word " * 10) for n in range(1, 30)]
    windows = sorted(format_conversations(talks(rows), budget=100, history=30).collect(), key=lambda w: w.window)
    assert len(windows) > 5
    for w in windows:
        turns = list(parsed(w.formatted))
        assert turns[0][:2] == ("system", "you help")
        assert sum(cost(t) for _, t, _, _ in turns) <= 100
        assert [(s.start, s.end) for s in w.loss] == [(a, b) for n, (r, _, a, b) in enumerate(turns) if r == "assistant" and n >= w.repeated]
        if w.window:
            history = turns[1 : w.repeated]
            assert history and sum(cost(t) for _, t, _, _ in history) <= 30


def test_odd_rows(talks):
    rows = [(n, 0, "user", t) for n, t in enumerate(ODD)]
    rows += [(50, None, None, None), (50, 1, "assistant", None), (50, 1, "assistant", None), (50, 1, "assistant", "b"), (None, 3, "user", "x"), (None, 1, "assistant", "y")]
    got = {r[0]: r[1:] for r in rows_of(read_back(format_conversations(talks(rows))), *COLUMNS)}
    assert got[50] == wanted([(None, None), ("assistant", None), ("assistant", None), ("assistant", "b")])
    assert got[None] == wanted([("assistant", "y"), ("user", "x")])
    assert all(got[n] == wanted([("user", t)]) for n, t in enumerate(ODD))
    assert format_conversations(talks([])).count() == 0
    assert read_back(format_conversations(talks([]))).count() == 0
