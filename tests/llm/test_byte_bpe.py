import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from rushcart.llm import byte_bpe
from rushcart.llm.byte_bpe import RANKS, ByteBpe, byte_digests, decode_bytes, encode_bytes
from .conftest import ODD, prose, rows_of


def library(path=RANKS):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return ByteBpe()


TEXTS = [t or "" for t in ODD] + [
    "a  b", " a", "a ", "a   \n  b\n \nc \n", "it's 'tis we'll  'x", "x" * 3000 + " " * 500 + "y", "-=" * 999, "ababab" * 50,
    "<|endoftext|> <|endoftext|>", "Grüße, Élan. naïve　 b​ \x1c\x1d \x85c", "1234 ١٢٣ Ⅷ ²", prose(3000, 1),
]


def test_equals_the_library(model):
    wanted = library()
    assert [x.tolist() for x in model.encode_all(TEXTS)] == [wanted.encode_ordinary(t) for t in TEXTS]


def test_equals_the_library_on_random_borders(model):
    rng, wanted = random.Random(5), library()
    rows = ["".join(rng.choices("  \n\t ab'sre12.,é😀\x1c　", k=rng.randrange(30))) for _ in range(5000)]
    assert [x.tolist() for x in model.encode_all(rows)] == [wanted.encode_ordinary(t) for t in rows]


def test_a_merge_may_call_for_a_lower_rank(tmp_path, monkeypatch):
    """Vocabularies that no training gives: strings over two letters in any order."""
    alone = []
    for seed in range(60):
        rng = random.Random(seed)
        made = {"".join(rng.choices("ab", k=rng.randrange(2, 6))) for _ in range(14)}
        tokens = [bytes([b]) for b in range(256)] + [t.encode() for t in rng.sample(sorted(made), len(made))]
        path = tmp_path / f"{seed}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
        own, wanted = ByteBpe(str(path)), library(path)
        kept = own.alone
        monkeypatch.setattr(own, "alone", lambda word, kept=kept: alone.append(word) or kept(word))
        rows = ["".join(rng.choices("ab", k=rng.randrange(1, 25))) for _ in range(200)]
        assert [x.tolist() for x in own.encode_all(rows)] == [wanted.encode_ordinary(t) for t in rows]
        assert [own.alone(t.encode()) for t in rows[:50]] == own.replay([t.encode() for t in rows[:50]])
    assert alone


def test_blocks_and_forgetting_change_nothing(monkeypatch):
    rows = [prose(60, i, 5000) + "  ," + "z" * i for i in range(200)]
    wanted = [x.tolist() for x in ByteBpe().encode_all(rows)]
    for name, value in (("REPLAY_BYTES", 100), ("BLOCK_CHARS", 1000), ("KEPT", 50), ("KEPT_CHARS", 3)):
        monkeypatch.setattr(byte_bpe, name, value)
    assert [x.tolist() for x in ByteBpe().encode_all(rows)] == wanted


def test_digests_and_round_trip(docs):
    wanted = library()
    rows = [(i, t) for i, t in enumerate(ODD + TEXTS)] + [(3, "again"), (3, "again"), (None, "no id"), (None, None)]
    df = docs(rows)
    expected = []
    for i, text in rows:
        ids = wanted.encode_ordinary(text or "")
        sha = lambda x: hashlib.sha256(x).hexdigest()
        expected.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert rows_of(byte_digests(df), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert rows_of(decode_bytes(encode_bytes(df)), "doc_id", "text") == sorted([(i, t or "") for i, t in rows], key=repr)


def test_no_rows_and_cut_characters(spark, docs):
    assert byte_digests(docs([])).count() == 0
    assert decode_bytes(encode_bytes(docs([]))).count() == 0
    cut = spark.createDataFrame([(1, [ByteBpe().ids[b"\xc3"]]), (2, None)], "doc_id long, ids array<int>")
    assert rows_of(decode_bytes(cut), "doc_id", "text") == [(1, "�"), (2, "")]
