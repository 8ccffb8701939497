"""Near-duplicate documents by the Jaccard similarity of their word shingles.

An exact prefix-filter join, rarest shingles first:

1. Documents with one set of shingles are one *class*; copies are never paired.
2. Shingles meet by hash, class by class, and get the number of classes that have them.
   Those of a single class can link nothing and are dropped there.
3. Back at their class, what is left stands rarest first. A class whose own shingles
   reach past its prefix can have no partner and is done; the others keep a prefix.
4. Classes meet on the shingles of their prefixes. Length, position and suffix filters
   leave few pairs, and each pair is verified once on its whole sets.

A group of very many near copies would still be all pairs. Links are therefore sought in
two turns: first every class with two of each group, those that differ least from the
rest, then, once those links have
been joined to components, all remaining pairs across components. A pair
inside a component can no longer change the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from rushcart.llm.columns import all_columns, partitions, pieces, plain, utf8
from rushcart.llm.components import components
from rushcart.llm.shingles import shingle_sets
from rushcart.sources.folders import stored

#: Shingles that one task sorts, about.
PER_BUCKET = 1_000_000
#: Bytes of text whose shingles leave a task together.
FLUSH_BYTES = 4 << 20
FLUSH_CLASSES = 1 << 16
#: Classes that a task remembers so as not to send a copy's shingles again.
REMEMBERED = 200_000
#: A shingle in this share of a flush's documents is reported as frequent, and counts as such
#: from this share of all documents. At most (mean set size / share) shingles are that frequent.
FREQUENT = 0.005
#: Cells of the token space in which the suffix filter compares counts.
CELLS = 16
#: Members of a group that all others of like length are compared with first.
HEADS = 2
#: Members of a group that meet all others of the group in one task.
BLOCK = 4_000
#: Partners that one copy of a set is compared with.
PARTNERS = 2_000
_LOW = np.uint64((1 << 40) - 1)


def least_overlap(n: int, percent: int):
    """Of a set of n, so many shingles must be shared with any partner."""
    return -(-percent * n // 100)


def pair_overlap(a, b, percent: int):
    return -(-percent * (a + b) // (100 + percent))


def _class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batches, words: int):
    """Per piece of text: doc ids and shingle sets."""
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        ids = batch.column("doc_id")
        for a, b in pieces(starts):
            yield ids.slice(a, b - a), shingle_sets(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], words)


def _described(words: int):
    """Rows (doc_id, n, class) of documents, and rows (token, rows) of what is frequent in a flush."""

    def frequent(held):
        token, count = np.unique(np.concatenate(held), return_counts=True)
        often = count >= max(8, FREQUENT * len(held))
        return pa.RecordBatch.from_arrays(
            [*[pa.nulls(int(often.sum()), pa.int64())] * 3, pa.array(token[often].view(np.int64)), pa.array(count[often])],
            ["doc_id", "n", "class", "token", "rows"],
        )

    def run(batches):
        held, size = [], 0
        for ids, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([_class_of(x) if len(x) else None for x in sets], pa.int64()),
                    *[pa.nulls(len(sets), pa.int64())] * 2,
                ],
                ["doc_id", "n", "class", "token", "rows"],
            )
            held += sets
            size += sum(map(len, sets))
            if size >= FLUSH_BYTES // 8:
                yield frequent(held)
                held, size = [], 0
        if held:
            yield frequent(held)

    return run


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _named(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A shingle's number from here on: its bucket and 40 bits of its hash."""
    return (bucket.astype(np.uint64) << np.uint64(40) | low).view(np.int64)


SENT = "bucket long, flush long, kind int, at binary, tokens binary, high binary"
#: What a row of SENT or SHARED holds: shingles and the places of their classes in the flush,
#: frequent ones likewise, or the flush's classes and their sizes.
TOKENS, OFTEN, CLASSES = 0, 1, 2


def _rows_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _sent(words: int, buckets: int, often: np.ndarray):
    """Shingles of classes that the task has not sent yet, packed by bucket. They name their
    class by its place in the flush. Frequent ones need no counting and skip the buckets.

    A flush's name holds its task and number: tasks with the same rows send the same classes.
    """

    def packed(number, classes, sets):
        sizes = np.array([len(x) for x in sets], np.int64)
        at = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        tokens = np.concatenate(sets)
        flush = _class_of(np.array([*number, *classes], np.int64))
        bucket = _bucket(tokens, buckets)
        frequent = np.zeros(len(tokens), bool)
        if len(often):
            frequent = often[np.minimum(np.searchsorted(often, tokens), len(often) - 1)] == tokens
        own = -1 - flush % buckets
        rows = [(own, flush, CLASSES, b"", np.array(classes, np.int64).tobytes(), sizes.tobytes())]
        if frequent.any():
            named = _named(bucket[frequent], tokens[frequent] & _LOW)
            rows.append((own, flush, OFTEN, at[frequent].tobytes(), named.tobytes(), b""))
        bucket, at, low = bucket[~frequent], at[~frequent], tokens[~frequent] & _LOW
        order = np.argsort(bucket, kind="stable")
        bucket, at, low = bucket[order], at[order], low[order]
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
        for a, b in zip(cuts, cuts[1:]):
            high = (low[a:b] >> np.uint64(32)).astype(np.uint8).tobytes()
            rows.append((int(bucket[a]), flush, TOKENS, at[a:b].tobytes(), low[a:b].astype(np.uint32).tobytes(), high))
        return _rows_of(rows, ["bucket", "flush", "kind", "at", "tokens", "high"])

    def run(batches):
        known, classes, sets, size = set(), [], [], 0
        task, sent = TaskContext.get().partitionId(), 0
        for _, found in _sets(batches, words):
            for x in found:
                if not len(x) or (one := _class_of(x)) in known:
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                known.add(one)
                classes.append(one)
                sets.append(x)
                size += 8 * len(x)
                if size >= FLUSH_BYTES or len(sets) == FLUSH_CLASSES:
                    yield packed((task, sent), classes, sets)
                    classes, sets, size, sent = [], [], 0, sent + 1
        if sets:
            yield packed((task, sent), classes, sets)

    return run


SHARED = "shelf long, flush long, kind int, at binary, tokens binary, degrees binary"


def _runs(batches, key: str):
    """Rows of a sorted partition, key by key."""
    now, rows = None, []
    for batch in batches:
        for a in range(0, batch.num_rows, 64):  # rows may be large
            for row in batch.slice(a, 64).to_pylist():
                if rows and row[key] != now:
                    yield now, rows
                    rows = []
                now = row[key]
                rows.append(row)
    if rows:
        yield now, rows


def _degrees(shelves: int):
    """Of every bucket, the shingles that several classes have, with a degree of frequency (16 log2, 254 at most).

    A copy of a class that another task sent counts for itself; that shifts degrees, alike for all.
    """
    names = ["shelf", "flush", "kind", "at", "tokens", "degrees"]

    def run(batches):
        for bucket, rows in _runs(batches, "bucket"):
            if bucket < 0:
                for r in rows:
                    degrees = r["high"] if r["kind"] == CLASSES else bytes([255]) * (len(r["at"]) // 2)
                    yield _rows_of([(r["flush"] % shelves, r["flush"], r["kind"], r["at"], r["tokens"], degrees)], names)
                continue
            low = np.concatenate([np.frombuffer(r["tokens"], np.uint32) for r in rows]).astype(np.uint64)
            low |= np.concatenate([np.frombuffer(r["high"], np.uint8) for r in rows]).astype(np.uint64) << np.uint64(32)
            order = np.argsort(low)
            sorted_ = low[order]
            head = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
            count = np.diff(np.append(head, len(low)))
            degree = np.empty(len(low), np.uint8)
            degree[order] = np.repeat(np.minimum(16 * np.log2(count), 254).astype(np.uint8), count)
            named, begin, out = _named(np.full(len(low), bucket), low), 0, []
            for r in rows:
                end = begin + len(r["at"]) // 2
                shared = degree[begin:end] > 0
                if shared.any():
                    at = np.frombuffer(r["at"], np.uint16)[shared]
                    out.append((r["flush"] % shelves, r["flush"], TOKENS, at.tobytes(), named[begin:end][shared].tobytes(), degree[begin:end][shared].tobytes()))
                begin = end
            if out:
                yield _rows_of(out, names)

    return run


SETS = "class long, flush long, n long, prefix long, tokens binary"


def _prefixes(percent: int):
    """Classes that may have a partner, with their shared shingles, rarest first, and how many of those their prefix holds."""

    def run(batches):
        for flush, rows in _runs(batches, "flush"):
            own = next(r for r in rows if r["kind"] == CLASSES)
            classes, n = np.frombuffer(own["tokens"], np.int64), np.frombuffer(own["degrees"], np.int64)
            rows = [r for r in rows if r["kind"] != CLASSES]
            at = np.concatenate([np.frombuffer(r["at"], np.uint16) for r in rows] or [np.zeros(0, np.uint16)]).astype(np.int64)
            tokens = np.frombuffer(b"".join(r["tokens"] for r in rows), np.int64)
            degree = np.frombuffer(b"".join(r["degrees"] for r in rows), np.uint8)
            shared = np.bincount(at, minlength=len(classes))
            need = least_overlap(n, percent)
            open_ = shared >= need
            wanted = open_[at]
            at, tokens, degree = at[wanted], tokens[wanted], degree[wanted]
            order = np.lexsort((tokens, degree, at))
            at, tokens = at[order], tokens[order]
            cuts = np.searchsorted(at, np.arange(len(classes) + 1))
            out = [
                (int(classes[i]), flush, int(n[i]), int(shared[i] - need[i] + 1), tokens[cuts[i] : cuts[i + 1]].tobytes())
                for i in np.flatnonzero(open_)
            ]
            for a in range(0, len(out), 1000):
                columns = list(zip(*out[a : a + 1000]))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                    ["class", "flush", "n", "prefix", "tokens"],
                )

    return run


def _once(sets: DataFrame) -> DataFrame:
    """Of a class that several tasks have sent, one row."""
    again = sets.groupBy("class").agg(F.min("flush").alias("_first"), F.count("*").alias("_rows")).where("_rows > 1").drop("_rows")
    kept = sets.join(again, "class", "left").where(F.col("_first").isNull() | (F.col("_first") == F.col("flush")))
    return kept.select("class", "n", "prefix", "tokens")


MEMBERS = "token long, class long, n long, own long, rest long, cells binary"


def _members(batches):
    """A row for each shingle of each prefix: how many shared ones are left from there, and
    how many shared ones lie in each cell of the token space."""
    for batch in batches:
        for row in batch.to_pylist():
            tokens = np.frombuffer(row["tokens"], np.int64)
            cells = np.bincount(tokens & (CELLS - 1), minlength=CELLS).astype(np.uint32).tobytes()
            k = row["prefix"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens[:k]),
                    pa.array([row["class"]] * k, pa.int64()),
                    pa.array([row["n"]] * k, pa.int64()),
                    pa.array([row["n"] - len(tokens)] * k, pa.int64()),
                    pa.array(np.arange(len(tokens), len(tokens) - k, -1)),
                    pa.array([cells] * k, pa.binary()),
                ],
                ["token", "class", "n", "own", "rest", "cells"],
            )


PAIRS = "a long, b long"


def _possible(x: dict, y: dict, percent: int) -> np.ndarray:
    """Which pairs of members pass the filters; arrays that numpy can set against each other."""
    need = pair_overlap(x["n"], y["n"], percent)
    long_enough = 100 * np.minimum(x["n"], y["n"]) >= percent * np.maximum(x["n"], y["n"])
    return long_enough & (np.minimum(x["rest"], y["rest"]) >= need) & (np.minimum(x["cells"], y["cells"]).sum(-1) >= need)


def _arrays(rows: list[dict]) -> dict:
    out = {c: np.array([r[c] for r in rows], np.int64) for c in rows[0] if c != "cells"}
    return out | {"cells": np.frombuffer(b"".join(r["cells"] for r in rows), np.uint32).reshape(-1, CELLS).astype(np.int64)}


def _pairs_of(found) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*found))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _neighbours(percent: int):
    """From members in the order (token, part, band, own, class): each with the first HEADS of its
    group, those with the fewest shingles of their own. Holds these members at a time."""

    def run(batches):
        found, heads = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _arrays(batch.to_pylist())
            if heads is not None:
                rows = {c: np.concatenate([heads[c], x]) for c, x in rows.items()}
            groups = list(zip(*(rows[c].tolist() for c in ("token", "part", "band"))))
            first, second, start = [], [], 0
            for i in range(1, len(groups)):
                if groups[i] != groups[start]:
                    start = i
                for head in range(start, min(start + HEADS, i)):
                    first.append(head)
                    second.append(i)
            x, y = ({c: v[i] for c, v in rows.items()} for i in (first, second))
            good = (x["class"] != y["class"]) & _possible(x, y, percent)
            found.append((x["class"][good], y["class"][good]))
            heads = {c: v[start : start + HEADS] for c, v in rows.items()}
            if sum(len(a) for a, _ in found) > 200_000:
                yield _pairs_of(found)
                found = []
        if found:
            yield _pairs_of(found)

    return run


def _across(percent: int):
    """All pairs of members of one token and two blocks that lie in different components."""

    def run(batches):
        found, size = [], 0
        for (_, low, high), rows in _runs((b.append_column("key", _keys(b)) for b in batches), "key"):
            left = [r for r in rows if r["block"] == low]
            right = left if low == high else [r for r in rows if r["block"] == high]
            if not left or not right:
                continue
            drop = lambda x: _arrays([{c: r[c] for c in ("class", "n", "rest", "root", "cells")} for r in x])
            x, y = drop(left), drop(right)
            for i in range(len(left)):
                one = {c: v[i] for c, v in x.items()}
                rest = {c: v[i + 1 :] for c, v in y.items()} if low == high else y
                good = (rest["root"] != one["root"]) & (100 * np.minimum(rest["n"], one["n"]) >= percent * np.maximum(rest["n"], one["n"]))
                if good.any():
                    rest = {c: v[good] for c, v in rest.items()}
                    good = _possible(one, rest, percent)
                    found.append((np.full(int(good.sum()), one["class"]), rest["class"][good]))
                    size += int(good.sum())
            if size > 200_000:
                yield _pairs_of(found)
                found, size = [], 0
        if found:
            yield _pairs_of(found)

    return run


def _keys(batch: pa.RecordBatch) -> pa.Array:
    return pa.array(list(zip(*(batch.column(c).to_pylist() for c in ("token", "low", "high")))), pa.list_(pa.int64()))


def _verified(percent: int):
    """From (a, part, b, n, tokens) in order, where b is null for the set of a itself: pairs that are similar enough."""

    def run(batches):
        own, own_n, links = None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                tokens = np.frombuffer(row["tokens"], np.int64)
                if row["b"] is None:
                    own, own_n = np.sort(tokens), row["n"]
                    continue
                at = np.searchsorted(own, tokens)
                at[at == len(own)] = 0
                shared = int((own[at] == tokens).sum())
                if 100 * shared >= percent * (own_n + row["n"] - shared):
                    links.append((row["a"], row["b"]))
            if links:
                columns = list(zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])
                links = []

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. A set that many pairs name is sent once per PARTNERS of them."""
    often = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    dealt = stored(pairs.join(often, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part")), "pairs")
    kept = sets.select("class", "n", "tokens")
    others = dealt.join(kept, F.col("b") == F.col("class")).select("a", "part", "b", "n", "tokens")
    owners = dealt.select("a", "part").distinct().join(kept, F.col("a") == F.col("class"))
    both = others.unionByName(owners.select("a", "part", F.lit(None).cast("long").alias("b"), "n", "tokens"))
    return both.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b")).mapInArrow(_verified(percent), PAIRS)


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row: (doc_id, n, class, root), the root being one class of its component."""
    rows = plain(docs, "doc_id", "text")
    described = stored(rows.mapInArrow(_described(words), "doc_id long, n long, class long, token long, rows long"), "described")
    documents = described.where("token IS NULL").select("doc_id", "n", "class")
    size = documents.agg(F.count("*").alias("rows"), F.sum("n").alias("tokens")).first()
    often = described.where("token IS NOT NULL").groupBy("token").agg(F.sum("rows").alias("rows"))
    # Few by the bound at FREQUENT: what is frequent in a flush adds up to its sets' sizes at most.
    frequent = often.where(F.col("rows") >= max(1000, FREQUENT * size.rows)).select("token").collect()
    frequent = np.sort(np.array([r.token for r in frequent], np.int64).view(np.uint64))
    buckets = partitions(docs, size.tokens or 0, PER_BUCKET)

    shared = (
        rows.mapInArrow(_sent(words, buckets, frequent), SENT)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_degrees(buckets), SHARED)
    )
    shelved = shared.repartition(buckets, "shelf").sortWithinPartitions("shelf", "flush")
    sets = _once(stored(shelved.mapInArrow(_prefixes(percent), SETS), "sets"))
    members = stored(sets.mapInArrow(_members, MEMBERS), "members")

    # A group of very many members is dealt out; its parts meet through other shingles and in the second turn.
    groups = members.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    met = members.join(groups, "token").withColumn("part", F.pmod(F.xxhash64("class", "token"), F.ceil(F.col("size") / (10 * BLOCK))))
    # Bands of length, each class also in the one below, so that classes of like length meet.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / min(percent, 99))))
    met = met.withColumn("band", F.explode(F.array(band, band - 1)))
    near = met.repartition("token", "part", "band").sortWithinPartitions("token", "part", "band", "own", "class")
    near = near.select("token", "part", "band", "class", "n", "rest", "cells")
    links = stored(verify(near.mapInArrow(_neighbours(percent), PAIRS).distinct(), sets, percent), "links")
    roots = stored(components(links), "roots")

    placed = members.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class")).drop("node")
    divided = placed.groupBy("token").agg(F.count("*").alias("size"), F.min("root").alias("least"), F.max("root").alias("most"))
    divided = divided.where("least != most").select("token", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("class"), "blocks")
    facing = placed.join(divided, "token").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    facing = facing.select("token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class", "n", "rest", "root", "cells")
    left = facing.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high").mapInArrow(_across(percent), PAIRS).distinct()
    more = stored(verify(left, sets, percent), "links")
    roots = stored(components(links.unionByName(more)), "roots")

    return documents.join(roots, F.col("class") == F.col("node"), "left").select("doc_id", "n", "class", F.coalesce("root", "class").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Per row: (doc_id, n_shingles, component_id).

    Two documents link when their sets of ``words``-word shingles have a Jaccard similarity
    of at least ``percent`` hundredths. ``component_id`` is the smallest doc_id that links
    reach, its own included; a null id is never the smallest. Null, empty and blank texts
    have no shingles and link with nothing; fewer words are one shingle. Repeated rows are
    rows of one class; no rows give no rows. Only ``doc_id`` and ``text`` are read.
    """
    grouped = _grouped(docs, words, percent)
    smallest = grouped.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = grouped.join(smallest, "root", "left")
    return linked.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _classed(words: int):
    """Rows with the class of their text."""

    def run(batches):
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            classes = []
            for a, b in pieces(starts):
                sets = shingle_sets(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], words)
                classes += [_class_of(x) if len(x) else None for x in sets]
            yield batch.append_column("_class", pa.array(classes, pa.int64()))

    return run


@all_columns
def first_of_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with all columns, whatever their names: that of the smallest id, a null id being the
    largest, then of the smallest class, then of the smallest text. Texts without shingles all stay; no rows give no rows."""
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    number, missing = F.coalesce("doc_id", F.lit(0).cast("long")).alias("_id"), F.col("doc_id").isNull().alias("_null")
    grouped = _grouped(docs, words, percent).where("root IS NOT NULL").select("root", missing, number, F.col("class").alias("_class"))
    best = grouped.groupBy("root").agg(F.min(F.struct("_null", "_id", "_class")).alias("_best")).select("_best.*")
    schema = T.StructType([*docs.schema.fields, T.StructField("_class", T.LongType())])
    named = docs.where(~blank).mapInArrow(_classed(words), schema).select("*", missing, number).join(best, ["_null", "_id", "_class"], "left_semi")
    one = named.groupBy("_null", "_id", "_class").agg(F.min_by(F.struct(*docs.columns), "text").alias("_row")).select("_row.*")
    return one.unionByName(docs.where(blank)).select(*docs.columns)
