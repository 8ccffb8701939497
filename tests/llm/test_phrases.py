import re
from collections import Counter

import pytest

from rushcart.llm import phrases
from rushcart.llm.phrases import collocations
from .conftest import ODD, prose, rows_of

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def wanted(rows, longest=3, least=10, top=2000, share=50):
    """From (text, lang) rows, one by one."""
    grams, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            grams.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in grams.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, words), a in candidates.items():
        if any(
            lang == other and len(longer) > len(words) and share * a <= 100 * b
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        ):
            continue
        cuts = [(10**6 * a * a // (grams[lang, words[:k]] * grams[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), grams[lang, words[:k]], grams[lang, words[k:]]))
    ranked, turn = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):  # noqa: E741
        turn[lang] += 1
        if top is None or turn[lang] <= top:
            ranked.append((lang, turn[lang], phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(ranked, key=repr)


def of(spark, rows):
    full = [(t, x, "x", 1) for t, x in rows]
    return spark.createDataFrame(full, "text string, lang string, block string, n int")


MIXED = (
    [(prose(300, i, 25), "en") for i in range(12)]
    + [("New York City is BIG. new york city, new  york\tcity; york! Big", "en")] * 11
    + [("a a a a a", x) for x in ("de", None) for _ in range(4)]
    + [(t, "odd") for t in ODD] * 12
    + [("éa Éa\x0bz z\x0cz z\rz\x1cz z\x1cz", "é")] * 10
)


def test_equals_brute_force(spark):
    assert rows_of(collocations(of(spark, MIXED)), *COLUMNS) == wanted(MIXED)


@pytest.mark.parametrize("longest, least, top, share", [(2, 1, None, 50), (4, 3, 7, 80), (5, 2, None, 1)])
def test_other_parameters(spark, longest, least, top, share):
    rows = MIXED[:4] + MIXED[12:16] + MIXED[23:29]
    assert rows_of(collocations(of(spark, rows), longest, least, top, share), *COLUMNS) == wanted(rows, longest, least, top, share)


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 50)
    monkeypatch.setattr(phrases, "PER_TASK", 100)
    assert rows_of(collocations(of(spark, MIXED)), *COLUMNS) == wanted(MIXED)


def test_no_rows_and_nothing_frequent(spark):
    assert collocations(of(spark, [])).collect() == []
    assert collocations(of(spark, [("a b c", "en"), (None, None)])).collect() == []


def test_one_phrase_in_a_third_of_all_rows(spark):
    rows = [("of the same", "en") if i % 3 == 0 else (f"w{i % 40} v{i % 30}", "en") for i in range(1500)]
    assert rows_of(collocations(of(spark, rows)), *COLUMNS) == wanted(rows)
