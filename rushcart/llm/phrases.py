"""Phrase collocations by set-oriented mining: sorted occurrence relations and merge-joins.

A relation of length k holds every occurrence of a phrase of k words that is still in
question: its place and its phrase. Places number the words of a block of texts; pieces lie
a place apart, so two occurrences at neighbouring places are in one piece. Relations are
written sorted by place, block by block. One round

- merge-joins a relation with itself at neighbouring places, which extends a phrase by a word,
- counts the phrases found in each block, and over all blocks in a grouping by phrase,
- keeps the occurrences of frequent phrases (a semi-join on block and phrase) and writes them.

A phrase that occurs often enough has only parts that do, so nothing that is wanted is lost,
and counts of whatever is left are those of the whole table. For the grouping, a hash deals
phrases into parts; what a block has for a part travels as one row of packed columns, sorted
by phrase, and the answer names the block's phrases that are frequent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.llm.columns import partitions, pieces, utf8
from rushcart.llm.shingles import stir
from rushcart.sources.folders import stored

#: Bytes of text in a block, about. A longer text is a block of its own.
BLOCK_BYTES = 1 << 23
#: Occurrences for each part of the phrases, about. A task groups a part.
PER_TASK = 2_000_000
#: A block's part of the relation: ascending places, the number of the phrase at each, and the
#: words of each phrase, as packed numbers, and how many occurrences there are.
RELATION = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("phrases", pa.binary()), ("words", pa.binary()), ("n", pa.int64())])
RELATION_SQL = "block long, places binary, phrases binary, words binary, n long"
#: What a block asks about a part: phrases (or words of a lang), their numbers in the block, and how often each occurs there.
ASKED = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("keys", pa.binary()), ("numbers", pa.binary()), ("counts", pa.binary())])
ASKED_SQL = "part int, block long, lang string, keys binary, numbers binary, counts binary"
#: Answers, the numbers of a block's frequent phrases (and ids of its words); and totals, without a block: frequent phrases and their counts.
FOUND = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("keys", pa.binary()), ("numbers", pa.binary()), ("counts", pa.binary())])
FOUND_SQL = "block long, lang string, keys binary, numbers binary, counts binary"
#: Shares of a lang's phrases that are ranked apart before the best of them are.
TOP_SHARES = 64
NO_LANG = "und"


def _zipped(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unzipped(x: bytes) -> bytes:
    return pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd", asbytes=True)


def _packed(x: np.ndarray, kind: type = np.int32) -> bytes:
    return _zipped(np.ascontiguousarray(x, kind).tobytes())


def _unpacked(x: bytes, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(_unzipped(x), kind)


def _gaps(ascending: np.ndarray) -> bytes:
    return _packed(np.diff(ascending, prepend=np.int32(0)))


def _ascending(gaps: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(gaps), dtype=np.int32)


def _rows(schema: pa.Schema, *rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of texts end to end: the places of their words, each word's number, and the distinct words.

    A-Z are lower-cased. Pieces end at ``.,;:!?``, at 0x0A to 0x0D and with their text; words
    are runs of other bytes than space and tab in a piece.
    """
    data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    ends_piece = np.zeros(256, bool)
    ends_piece[list(b".,;:!?\n\x0b\x0c\r")] = True
    apart = ends_piece.copy()
    apart[list(b" \t")] = True
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True
    first[1:] &= ~inside[:-1] | border[1:-1]
    last[:-1] &= ~inside[1:] | border[1:-1]
    begin, end = np.flatnonzero(first).astype(np.int32), np.flatnonzero(last).astype(np.int32) + 1
    # words of a piece follow each other; where a piece (or text) ends in between, a place stays empty
    cuts = np.flatnonzero(ends_piece[data] | border[:-1]).astype(np.int32)
    piece = np.searchsorted(cuts, begin, side="right")
    places = np.arange(len(begin), dtype=np.int32) + np.cumsum(np.diff(piece, prepend=piece[:1]) > 0, dtype=np.int32)
    del first, last, border, cuts, piece
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=offsets[1:])
    flat = data[inside]
    column = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    coded = column.dictionary_encode()
    return places, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), coded.dictionary


def _blocks(batches, most: int) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one lang, about ``most`` bytes at a time."""
    waiting: dict[str, list[pa.Array]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        langs, column = batch.column("lang"), batch.column("text")
        for lang in pc.unique(langs).to_pylist():
            own = column.filter(pc.equal(langs, lang))
            _, starts = utf8(own)
            for first, end in pieces(starts, most):
                size = int(starts[end] - starts[first])
                if sizes.get(lang, 0) + size > most and lang in waiting:
                    del sizes[lang]
                    yield lang, pa.concat_arrays(waiting.pop(lang))
                waiting.setdefault(lang, []).append(own.slice(first, end - first))
                sizes[lang] = sizes.get(lang, 0) + size
        while sum(sizes.values()) > 2 * most:
            lang = max(sizes, key=sizes.get)
            del sizes[lang]
            yield lang, pa.concat_arrays(waiting.pop(lang))
    for lang, own in waiting.items():
        yield lang, pa.concat_arrays(own)


def _split(most: int):
    def run(batches):
        for lang, column in _blocks(batches, most):
            places, numbers, words = _words(*utf8(column))
            counts = np.bincount(numbers, minlength=len(words))
            spelled = _zipped(b"\n".join(words.to_pylist()))  # no word holds a line feed
            yield _rows(_SPLIT, (lang, _gaps(places), _packed(numbers), spelled, _packed(counts), len(numbers)))

    return run


_SPLIT = pa.schema([("lang", pa.string()), ("places", pa.binary()), ("phrases", pa.binary()), ("spelled", pa.binary()), ("counts", pa.binary()), ("n", pa.int64())])


def _each(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _cut(part: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts, and the rows of each in the given order."""
    parts, first = np.unique(part[order], return_index=True)
    yield from zip(parts.tolist(), np.split(order, first[1:]))


def _asked_words(parts: int):
    def run(batches):
        for row in _each(batches):
            words, counts = _unzipped(row["spelled"]).split(b"\n") if row["n"] else [], _unpacked(row["counts"])
            salt = crc32(row["lang"].encode())
            part = np.array([crc32(w, salt) % parts for w in words], np.int32)
            for p, own in _cut(part, np.argsort(part, kind="stable")):
                keys = _zipped(b"\n".join([words[i] for i in own.tolist()]))
                yield _rows(ASKED, (p, row["block"], row["lang"], keys, _gaps(own), _packed(counts[own])))

    return run


def _found_words(least: int, parts: int):
    """Counts the words of a part and gives the frequent ones ids, small ones to those that occur most."""

    def run(batches):
        rows, part, totals = [], 0, Counter()
        for row in _each(batches):
            part, lang = row["part"], row["lang"]
            words = _unzipped(row["keys"]).split(b"\n")
            for word, n in zip(words, _unpacked(row["counts"]).tolist()):
                totals[lang, word] += n
            rows.append((row["block"], lang, row["keys"], row["numbers"]))
        frequent = sorted((-n, lang, word) for (lang, word), n in totals.items() if n >= least)
        if len(frequent) * parts > 2**31 - 1:
            raise OverflowError("more frequent words than 31 bits can number")
        ids = {(lang, word): i * parts + part for i, (_, lang, word) in enumerate(frequent)}
        for block, lang, keys, numbers in rows:
            own = np.array([ids.get((lang, word), -1) for word in _unzipped(keys).split(b"\n")], np.int32)
            yield _rows(FOUND, (block, None, _packed(own[own >= 0]), _gaps(_ascending(numbers)[own >= 0]), None))
        for lang in sorted({lang for _, lang, _ in frequent}):
            own = [(word, ids[lang, word], -n) for n, at, word in frequent if at == lang]
            words, numbers, counts = zip(*own)
            yield _rows(FOUND, (None, lang, _zipped(b"\n".join(words)), _packed(numbers), _packed(counts, np.int64)))

    return run


def _word_table(batches):
    for row in _each(batches):
        words = _unzipped(row["keys"]).decode().split("\n")
        columns = [pa.array([row["lang"]] * len(words)), pa.array(words), pa.array(_unpacked(row["counts"], np.int64)), pa.array(_unpacked(row["numbers"]))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "f", "id"])


def _extended(places: np.ndarray, phrases: np.ndarray, words: np.ndarray):
    """The merge-join of a relation with itself at neighbouring places: places, the number of the
    longer phrase at each, the phrases' words and counts.

    The relation is sorted by place, so what lies next to a row is the only one it can meet.
    """
    at = np.flatnonzero(places[1:] == places[:-1] + 1)
    both = phrases[at].astype(np.int64) << 32 | phrases[at + 1]
    pairs, numbers, counts = np.unique(both, return_inverse=True, return_counts=True)
    longer = np.concatenate([words[pairs >> 32], words[pairs & 0xFFFFFFFF][:, -1:]], axis=1)
    return places[at], numbers.astype(np.int32), longer, counts.astype(np.int32)


def _relation(row: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _ascending(row["places"]), _unpacked(row["phrases"]), _unpacked(row["words"]).reshape(-1, length)


def _keys(words: np.ndarray) -> bytes:
    """Phrases in order, column by column: the first word of each as a gap."""
    columns = words.T.copy()
    columns[0] = np.diff(columns[0], prepend=np.int32(0))
    return _packed(columns)


def _words_of(keys: bytes, length: int) -> np.ndarray:
    columns = _unpacked(keys).reshape(length, -1).copy()
    np.cumsum(columns[0], dtype=np.int32, out=columns[0])
    return columns.T


def _asked(length: int, parts: int):
    """What each block asks about its phrases of ``length`` words, found in the relation one shorter."""

    def run(batches):
        for row in _each(batches):
            _, _, longer, counts = _extended(*_relation(row, length - 1))
            mixed = np.zeros(len(longer), np.uint64)
            for j in range(length):
                mixed = stir(mixed * np.uint64(0x9E3779B97F4A7C15) + longer[:, j].astype(np.uint64))
            part = (mixed % np.uint64(parts)).astype(np.int32)
            for p, own in _cut(part, np.lexsort((*longer.T[::-1], part))):
                yield _rows(ASKED, (p, row["block"], None, _keys(longer[own]), _packed(own), _packed(counts[own])))

    return run


def _found(length: int, least: int, answers: bool):
    """Counts the phrases of a part over all blocks."""

    def run(batches):
        blocks, keys, numbers, counts = [], [], [], []
        for row in _each(batches):
            blocks.append(row["block"])
            keys.append(_words_of(row["keys"], length))
            numbers.append(_unpacked(row["numbers"]))
            counts.append(_unpacked(row["counts"]))
        if not blocks:
            return
        edges = np.cumsum([0, *map(len, keys)])
        words = np.concatenate(keys)
        order = np.lexsort(words.T[::-1])
        words = words[order]
        fresh = np.ones(len(words), bool)
        fresh[1:] = (words[1:] != words[:-1]).any(axis=1)
        first = np.flatnonzero(fresh)
        totals = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), first)
        frequent = totals >= least
        if answers:
            wanted = np.empty(len(words), bool)
            wanted[order] = frequent[np.cumsum(fresh) - 1]
            for block, own, a, b in zip(blocks, numbers, edges, edges[1:]):
                yield _rows(FOUND, (block, None, None, _packed(own[wanted[a:b]]), None))
        if frequent.any():
            yield _rows(FOUND, (None, None, _keys(words[first[frequent]]), None, _packed(totals[frequent], np.int64)))

    return run


def _phrase_table(length: int):
    def run(batches):
        for row in _each(batches):
            words = _words_of(row["keys"], length)
            columns = [pa.array(np.ascontiguousarray(words[:, j])) for j in range(length)] + [pa.array(_unpacked(row["counts"], np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*[f"w{j}" for j in range(length)], "f"])

    return run


def _grouped(asked: DataFrame, parts: int, found, name: str) -> tuple[DataFrame, DataFrame]:
    """Answers to the blocks, and totals. A phrase is asked for once by each block at most, so
    none has a large part of all rows."""
    rows = stored(asked.repartitionById(parts, "part").mapInArrow(found, FOUND_SQL), name)
    return rows.where("block IS NOT NULL"), rows.where("block IS NULL")


def _semi_joined(relation: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """The occurrences of phrases of ``length`` words that the answers name, from the relation one shorter."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        row, named = left.to_pylist()[0], right.to_pylist()
        numbers = np.concatenate([np.zeros(0, np.int32), *[_ascending(x["numbers"]) if length == 1 else _unpacked(x["numbers"]) for x in named]])
        if length == 1:
            places, which = _ascending(row["places"]), _unpacked(row["phrases"])
            words = np.concatenate([np.zeros(0, np.int32), *[_unpacked(x["keys"]) for x in named]])[:, None]
        else:
            places, which, longer, _ = _extended(*_relation(row, length - 1))
            words = longer[numbers]
        renumbered = np.full(max(int(which.max(initial=-1)), int(numbers.max(initial=-1))) + 1, -1, np.int32)
        renumbered[numbers] = np.arange(len(numbers), dtype=np.int32)
        which = renumbered[which]
        alive = which >= 0
        made = (row["block"], _gaps(places[alive]), _packed(which[alive]), _packed(words), int(alive.sum()))
        return pa.Table.from_batches([_rows(RELATION, made)])

    return stored(relation.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, RELATION_SQL), "relation")


def _parts(rows: DataFrame) -> int:
    return partitions(rows, rows.agg(F.sum("n")).first()[0] or 0, PER_TASK)


def _named(length: int, first: int = 0) -> list[Column]:
    return [F.col(f"w{first + j}").alias(f"w{j}") for j in range(length)]


def _phrase_counts(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Words of each lang (lang, n); frequent words (lang, word, f, id); and for every length
    the frequent phrases (w0, w1, ..., f) by the words' ids."""
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    split = texts.mapInArrow(_split(BLOCK_BYTES), "lang string, places binary, phrases binary, spelled binary, counts binary, n long")
    blocks = stored(split.withColumn("block", F.monotonically_increasing_id()), "words")
    sizes = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = _parts(blocks)
    asked = blocks.select("block", "lang", "spelled", "counts", "n").mapInArrow(_asked_words(parts), ASKED_SQL)
    answers, totals = _grouped(asked, parts, _found_words(least, parts), "frequent-words")
    words = stored(totals.mapInArrow(_word_table, "lang string, word string, f long, id int"), "word-table")
    relation = _semi_joined(blocks.select("block", "places", "phrases"), answers.select("block", "keys", "numbers"), 1)
    found = [words.select(F.col("id").alias("w0"), "f")]
    for length in range(2, longest + 1):
        parts = _parts(relation)
        last = length == longest
        asked = relation.mapInArrow(_asked(length, parts), ASKED_SQL)
        answers, totals = _grouped(asked, parts, _found(length, least, not last), "frequent-phrases")
        columns = ", ".join(f"w{j} int" for j in range(length))
        found.append(stored(totals.mapInArrow(_phrase_table(length), f"{columns}, f long"), "phrases"))
        if not last:
            relation = _semi_joined(relation, answers.select("block", "numbers"), length)
    return sizes, words, found


def _scored(found: list[DataFrame], length: int) -> DataFrame:
    """Candidates of a length with the cut that scores lowest: (w0, ..., a, l, r, score).

    Products are whole numbers of up to 38 digits, enough for a phrase that occurs 10^16 times.
    """
    out = found[length - 1].withColumnRenamed("f", "a")
    cuts = []
    for k in range(1, length):
        left = found[k - 1].select(*_named(k), F.col("f").alias(f"l{k}"))
        right = found[length - k - 1].select(*[F.col(f"w{j}").alias(f"w{j + k}") for j in range(length - k)], F.col("f").alias(f"r{k}"))
        out = out.join(left, [f"w{j}" for j in range(k)]).join(right, [f"w{j}" for j in range(k, length)])
        score = F.expr(f"CAST(1000000 * CAST(a AS DECIMAL(38,0)) * a AS DECIMAL(38,0)) div CAST(CAST(l{k} AS DECIMAL(38,0)) * r{k} AS DECIMAL(38,0))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*cuts))
    return out.select(*[f"w{j}" for j in range(length)], "a", best.alias("cut")).select(*[f"w{j}" for j in range(length)], "a", "cut.l", "cut.r", "cut.score")


def _covered(found: list[DataFrame], length: int) -> DataFrame | None:
    """Of phrases of ``length`` words, how often the most frequent longer one that holds them occurs."""
    inside = [
        found[longer - 1].select(*_named(length, first), F.col("f").alias("over"))
        for longer in range(length + 1, len(found) + 1)
        for first in range(longer - length + 1)
    ]
    if not inside:
        return None
    out = inside[0]
    for part in inside[1:]:
        out = out.unionByName(part)
    return out.groupBy(*[f"w{j}" for j in range(length)]).agg(F.max("over").alias("over"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int | None = 2000, share: int = 50) -> DataFrame:
    """Per lang the best phrases of 2 to ``longest`` words: (lang, rank, phrase, a, l, r, n, score).

    ``a`` counts a phrase, at least ``least`` times, ``l`` and ``r`` the two parts of its lowest-scoring
    cut, ``n`` all words of the lang; the score is a * a / (l * r) in millionths, rounded down.
    Phrases inside a longer candidate that occurs at least ``share`` percent as often are left
    out. Ranks go by score, then ``a``, then the phrase's UTF-8 bytes; ``top`` limits them, None
    gives all. Null texts count as empty, null langs as ``und``; repeated rows count each time.
    Texts of any length are read whole. No rows, or no phrase often enough, give no rows. Only
    ``lang`` and ``text`` are read.
    """
    sizes, words, found = _phrase_counts(docs, longest, least)
    parts = []
    for length in range(2, longest + 1):
        key = [f"w{j}" for j in range(length)]
        rows = _scored(found, length)
        covered = _covered(found, length)
        if covered is not None:
            rows = rows.join(covered, key, "left").where(F.col("over").isNull() | (100 * F.col("over") < share * F.col("a"))).drop("over")
        for j in range(length):
            rows = rows.join(words.select(F.col("id").alias(f"w{j}"), F.col("word").alias(f"word{j}"), F.col("lang").alias(f"lang{j}")), f"w{j}")
        phrase = F.concat_ws(" ", *[F.col(f"word{j}") for j in range(length)])
        parts.append(rows.select(F.col("lang0").alias("lang"), phrase.alias("phrase"), "a", "l", "r", "score"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    if top is not None:  # the best of every share of a lang, of which no more than TOP_SHARES times ``top`` meet
        share_of = F.pmod(F.xxhash64("phrase"), F.lit(TOP_SHARES))
        turn = F.row_number().over(Window.partitionBy("lang", share_of).orderBy(*order))
        out = out.withColumn("turn", turn).where(F.col("turn") <= top).drop("turn")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
