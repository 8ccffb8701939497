import random

import numpy as np
import pytest
import sentencepiece

from rushcart.llm import pieces
from rushcart.llm.pieces import MODEL, Pieces, decode_pieces, encode_pieces, piece_digests
from .conftest import ODD, prose, rows_of

TEXTS = [t or "" for t in ODD] + [prose(200, 1), "  a  b   c ", "▁x ▁ y▁", "日本語 テキスト\nnext\tline", "<s> </s> <0x0A>", "     ", "a" * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_without_dropout_it_is_the_library(library):
    whole = Pieces()
    for text in TEXTS:
        if "▁" not in text:
            assert whole.encode(text) == library.encode(text)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_everything_decodes(dropout):
    model = Pieces(dropout=dropout, seed=5)
    for i, text in enumerate(TEXTS):
        assert model.decode(model.encode(text, i)) == text


def test_dropout_varies_with_seed_and_place_and_is_stable():
    text = prose(300, 2)
    a, b = Pieces(dropout=0.2, seed=1), Pieces(dropout=0.2, seed=2)
    assert a.encode(text, 1) == Pieces(dropout=0.2, seed=1).encode(text, 1)
    assert a.encode(text, 1) != b.encode(text, 1) and a.encode(text, 1) != a.encode(text, 2)
    assert len(Pieces(dropout=0.5).encode(text)) > len(a.encode(text, 1)) > len(Pieces().encode(text))
    assert max(map(len, map(Pieces(dropout=1.0).back.__getitem__, Pieces(dropout=1.0).encode("some words")))) == 1


def test_many_rows_at_once_equal_the_agenda():
    rng = random.Random(4)
    chunks = ["▁" * rng.randrange(3) + "".join(rng.choice("abcdeinorst▁é\n漢" if j % 9 == 0 else "abcdeinorst") for j in range(rng.randrange(1, 30))) for _ in range(800)]
    chunks = [c for c in chunks if c]
    for model in (Pieces(), Pieces(dropout=0.3, seed=9)):
        variants = [i % model.variants for i in range(len(chunks))]
        for chunk, variant, ids in zip(chunks, variants, model.chunks(chunks, variants)):
            assert np.frombuffer(ids, np.int32).tolist() == model.chunk(chunk, variant)


def test_blocks_and_forgetting_change_nothing(monkeypatch):
    text = prose(3000, 6, 3000)
    whole = Pieces(dropout=0.1).encode(text, 3)
    monkeypatch.setattr(pieces, "BLOCK", 100)
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 50)
    assert Pieces(dropout=0.1).encode(text, 3) == whole


def test_every_occurrence_is_decided_for_itself():
    """More segmentations than eight, each what the agenda says at its place."""
    model = Pieces(dropout=0.3, seed=4)
    for word in ("international", "internationalcooperationagreement" * 3):
        text = " ".join([word] * 400)
        parts = [model.chunk("▁" + word, int(v)) for v in model._places(11, 0, 400)]
        assert model.encode(text, 11) == [i for part in parts for i in part]
        assert len(set(map(tuple, parts))) > 30


def test_tables(docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "twice"), (3, "twice")]
    encoded = encode_pieces(docs(rows))
    assert rows_of(decode_pieces(encoded), "doc_id", "text") == sorted([(i, t or "") for i, t in rows], key=repr)
    digests = piece_digests(docs(rows))
    from pyspark.sql import functions as F

    sha = docs(rows).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    assert rows_of(digests, "doc_id", "text_sha256") == rows_of(sha, "doc_id", "text_sha256")
    assert rows_of(digests.where("doc_id = 1"), "n_pieces") == [(0,)]
    assert encode_pieces(docs([])).count() == 0 and piece_digests(docs([])).count() == 0


def test_only_merges_that_come_up_are_hashed(monkeypatch):
    """Far fewer merges come up than are possible."""
    hashed, real = [], pieces._stir
    model = Pieces(dropout=0.1, seed=4)
    model.encode(" ".join(["appreciation"] * 4000), 11)
    monkeypatch.setattr(pieces, "_stir", lambda x: hashed.append(np.size(x)) or real(x))
    text = " ".join(["appreciation"] * 4000)
    ids = model.encode(text, 12)
    assert sum(hashed) < 4000 * 40
    monkeypatch.undo()
    assert ids == [i for v in model._places(12, 0, 4000) for i in model.chunk("▁appreciation", int(v))]


def test_occurrences_that_skip_more_than_is_kept_are_worked_off_alone(monkeypatch):
    text = prose(400, 3)
    whole = Pieces(dropout=0.5, seed=2).encode(text, 5)
    monkeypatch.setattr(pieces, "KEPT_SKIPS", 1)
    model = Pieces(dropout=0.5, seed=2)
    assert model.encode(text, 5) == whole and (model.above.all[model.above.all >= 0] == 0).sum() == 0
    assert set(model.above.all[model.above.all >= 0]) <= set(np.flatnonzero(model.above.all < 0))
