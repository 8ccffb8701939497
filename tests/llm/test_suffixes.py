import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from rushcart.llm import suffixes
from rushcart.llm.suffixes import Hashes, anchors, later_equals, remove_repeats, suffix_order
from .conftest import ODD, prose, rows_of


def wanted(rows):
    """All 100-byte strings of all rows, kept with the smallest (document, start)."""
    order = lambda i: -(2**63) if i is None else i
    first = {}
    raw = [(t or "").encode() for _, t in rows]
    for (i, _), b in zip(rows, raw):
        for s in range(len(b) - 99):
            place = (order(i), s)
            first[b[s : s + 100]] = min(first.get(b[s : s + 100], place), place)
    out = []
    for (i, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (order(i), s):
                gone[s : s + 100] = b"\1" * 100
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [prose(rng.randrange(18, 60), k, 9000) for k in range(6)]
    rows = []
    for i in range(n):
        parts = [prose(rng.randrange(1, 60), 1000 + seed * 100 + i, 9000)]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            a = rng.randrange(0, 20)
            parts += [passage[a:], prose(rng.randrange(1, 20), rng.randrange(10**6), 9000)]
        rows.append((rng.randrange(10**6), "é ".join(parts)))
    rows += [(rows[3][0] + 1, rows[3][1]), (rows[4][0] + 1, rows[4][1][40:])]
    rows += [(7, "ab" * 300), (8, "z" * 700), (9, "z" * 150), (11, "")]
    return rows


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_strings(docs, seed):
    rows = corpus(seed)
    assert rows_of(remove_repeats(docs(rows).repartition(4)), *COLUMNS) == wanted(rows)


def test_small_buckets_flushes_and_spread_anchors_change_nothing(docs, monkeypatch):
    for name, value in (("FLUSH_ANCHORS", 40), ("FLUSH_BYTES", 3000), ("PER_TASK", 30), ("TASK_BYTES", 4000), ("COMPARED_BYTES", 500), ("COMPARED_WINDOWS", 50), ("LONG", 300)):
        monkeypatch.setattr(suffixes, name, value)
    rows = corpus(3)
    df = docs(rows).repartition(5)
    assert rows_of(remove_repeats(df), *COLUMNS) == wanted(rows)
    assert rows_of(remove_repeats(df, split_from=2), *COLUMNS) == wanted(rows)


def test_odd_rows(docs):
    long = prose(60, 5)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, long), (50, long), (50, "begin " + long), (None, long), (51, long)]
    assert rows_of(remove_repeats(docs(rows)), *COLUMNS) == wanted(rows)
    assert remove_repeats(docs([])).count() == 0
    assert rows_of(remove_repeats(docs([(1, None)])), *COLUMNS) == wanted([(1, None)])


def test_copies_of_one_text_spread_over_the_shelves():
    """None of the three shuffles gathers them under one key, and none parts a document."""
    text, n, shelves = prose(80, 1), 400, 16
    columns = {"doc": np.arange(n), "version": np.full(n, 12345), "text": [text] * n}

    def by_key(batches):
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["key"])
        return [pa.RecordBatch.from_pylist(rows, schema=next(iter(batches)).schema)], rows

    def spread(rows):
        shelf = {}
        for r in rows:
            for doc in np.frombuffer(r["doc"], np.int64).tolist():
                shelf.setdefault(doc, set()).add(r["key"])
        assert all(len(x) == 1 for x in shelf.values())
        counts = np.unique([min(x) for x in shelf.values()], return_counts=True)[1]
        assert len(counts) == shelves and counts.max() < 3 * n / shelves

    sent, rows = by_key(list(suffixes._sent(shelves)([pa.RecordBatch.from_pydict(columns)])))
    spread([r for r in rows if r["key"] < 0])
    places, rows = by_key(list(suffixes._repeated(shelves, 10**9)(sent)))
    spread(rows)
    found = list(suffixes._per_document(places))
    columns["places"] = dict(zip((x for b in found for x in b.column("doc").to_pylist()), (x for b in found for x in b.column("places").to_pylist())))
    columns["places"] = [columns["places"][i] for i in range(n)]
    segments, rows = by_key(list(suffixes._segments(shelves, np.zeros(0, np.int64), shelves)([pa.RecordBatch.from_pydict(columns)])))
    spread([r for r in rows if r["key"] < 0])
    _, rows = by_key(list(suffixes._removed(shelves)(segments)))
    spread(rows)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab c") for _ in range(400))
    data = np.frombuffer(b"xx yy" * 9 + text + b"q" * 70 + text + b"zz", np.uint8)
    found = anchors(data, np.array([0, len(data)]))
    windows = {}
    for first, last, at, hashed in zip(*(found[c].tolist() for c in ("first", "last", "at", "hash"))):
        for s in range(first, last + 1):
            key = (at - s, hashed)
            assert windows.setdefault(bytes(data[s : s + 100]), key) == key
    covered = sum(last - first + 1 for first, last in zip(found["first"], found["last"]))
    assert covered == len(data) - 99


def _anchor_of_windows(data):
    found, out = anchors(data, np.array([0, len(data)])), np.full(len(data) - 99, -1)
    for first, last, at in zip(*(found[c].tolist() for c in ("first", "last", "at"))):
        out[first : last + 1] = at
    return out.tolist()


def _repetitive(seed):
    rng, parts = random.Random(seed), [b"." * 100]
    for _ in range(rng.randrange(2, 8)):
        unit = bytes(rng.choices(b"abcdefgh ", k=rng.randrange(1, 90)))
        parts.append(unit * rng.randrange(1, 400 // len(unit) + 3))
    return b"".join(parts)


def test_anchor_is_the_leftmost_of_equal_hashes_whatever_stands_before():
    """The smallest hash comes in a second time in the very step in which a smaller one leaves."""
    for seed in range(100):
        data = np.frombuffer(_repetitive(seed), np.uint8)
        alone = [int(anchors(data[s : s + 100], np.array([0, 100]))["at"][0]) + s for s in range(len(data) - 99)]
        assert _anchor_of_windows(data) == alone


def test_long_rows_in_parts_have_the_same_anchors(monkeypatch):
    data = np.random.default_rng(5).integers(97, 123, 1400).astype(np.uint8)
    whole = {n: _anchor_of_windows(data[:n]) for n in (301, 399, 400, 699, 1400)}
    monkeypatch.setattr(suffixes, "LONG", 300)
    assert whole == {n: _anchor_of_windows(data[:n]) for n in whole}


def test_repetitive_texts_equal_all_strings(docs):
    rows = []
    for seed in range(40):
        text = _repetitive(seed).decode()
        rows += [(2 * seed, text), (2 * seed + 1, text[random.Random(seed).randrange(80, 180) :])]
    assert rows_of(remove_repeats(docs(rows).repartition(4)), *COLUMNS) == wanted(rows)


def test_suffix_order_sorts_and_finds_equals():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(300)]
    data, lengths = np.frombuffer(b"".join(strings), np.uint8), np.full(300, 6)
    group = np.array([rng.randrange(4) for _ in strings])
    order, equal = suffix_order(Hashes(data, lengths), group, np.arange(300) * 6, lengths)
    ranked = [(group[i], strings[i]) for i in order]
    assert ranked == sorted(ranked)
    assert equal.tolist() == [False] + [a == b for a, b in zip(ranked, ranked[1:])]


def test_hashes_that_collide_are_told_apart(monkeypatch):
    """With hashes that say nothing, the bytes decide."""
    monkeypatch.setattr(Hashes, "of", lambda self, at, length: np.zeros(len(at), np.uint64))
    strings = [b"aa", b"ab", b"aa", b"bb", b"ab", b"aa"]
    data, lengths = np.frombuffer(b"".join(strings), np.uint8), np.full(6, 2)
    place = np.arange(6)
    gone = later_equals(Hashes(data, lengths), np.zeros(6, np.int64), place * 2, lengths, place, place)
    assert gone.tolist() == [False, False, True, False, True, True]
