"""Exact duplicates through a cuckoo-filter index of live digests."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rushcart.llm.columns import all_columns, partitions, plain
from rushcart.sources.folders import stored

SLOTS = 4
KICKS = 200
#: Entries after which an index on the map side hands on what it has and starts again.
FLUSH = 100_000
#: Digests that one index on the reduce side is planned for.
PER_SHARD = 250_000


class CuckooFilter:
    """Fingerprints of 16 bits in two possible buckets of four. Supports deletion.

    ``insert`` says no when the table is too full; the caller then builds a larger one
    from the keys it keeps.
    """

    def __init__(self, buckets: int = 1 << 10):
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * SLOTS * buckets))
        self.turn = 0

    def _print(self, digest: int) -> tuple[int, int]:
        mark = (digest >> 48) & 0xFFFF or 1
        return mark, digest & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _find(self, bucket: int, mark: int) -> int:
        for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.slots[at] == mark:
                return at
        return -1

    def __contains__(self, digest: int) -> bool:
        mark, bucket = self._print(digest)
        return self._find(bucket, mark) >= 0 or self._find(self._other(bucket, mark), mark) >= 0

    def insert(self, digest: int) -> bool:
        mark, bucket = self._print(digest)
        for place in (bucket, self._other(bucket, mark)):
            if (at := self._find(place, 0)) >= 0:
                self.slots[at] = mark
                return True
        for _ in range(KICKS):
            self.turn += 1
            at = bucket * SLOTS + self.turn % SLOTS
            mark, self.slots[at] = self.slots[at], mark
            bucket = self._other(bucket, mark)
            if (free := self._find(bucket, 0)) >= 0:
                self.slots[free] = mark
                return True
        return False

    def delete(self, digest: int) -> bool:
        mark, bucket = self._print(digest)
        for place in (bucket, self._other(bucket, mark)):
            if (at := self._find(place, mark)) >= 0:
                self.slots[at] = 0
                return True
        return False


class LiveIndex:
    """Counts the live rows of each content and names the one that stays.

    The filter answers first. Where it claims to know a digest, the bucket of that digest
    is read and the content's SHA-256 compared, so a false claim never merges two texts.
    """

    def __init__(self):
        self.filter = CuckooFilter()
        self.content: dict[int, list[list]] = {}
        self.live = 0

    def _entry(self, digest: int, sha: str) -> list | None:
        if digest in self.filter:
            for entry in self.content.get(digest, ()):
                if entry[0] == sha:
                    return entry
        return None

    def add(self, digest: int, sha: str, keep: int | None, rows: int, ties: int) -> None:
        """``ties``: how many of the ``rows`` have the id ``keep``, the largest. Null is below all ids."""
        entry = self._entry(digest, sha)
        if entry is None:
            self.live += 1
            bucket = self.content.setdefault(digest, [])
            bucket.append([sha, keep, rows, ties])
            if len(bucket) == 1 and not self.filter.insert(digest):
                self._grow()
            return
        entry[2] += rows
        if entry[1] == keep:
            entry[3] += ties
        elif entry[1] is None or (keep is not None and keep > entry[1]):
            entry[1], entry[3] = keep, ties

    def remove(self, digest: int, sha: str, rows: int) -> None:
        """Takes back rows; content without rows leaves the filter and its bucket."""
        entry = self._entry(digest, sha)
        if entry is None:
            return
        entry[2] -= rows
        if entry[2] <= 0:
            bucket = self.content[digest]
            bucket.remove(entry)
            if not bucket:
                del self.content[digest]
                self.filter.delete(digest)
            self.live -= 1

    def _grow(self) -> None:
        buckets = self.filter.mask + 1
        while True:
            buckets *= 2
            larger = CuckooFilter(buckets)
            if all(map(larger.insert, self.content)):
                self.filter = larger
                return

    def rows(self) -> Iterator[tuple]:
        for digest, bucket in self.content.items():
            for sha, keep, rows, ties in bucket:
                yield digest, sha, keep, rows, ties


GROUPS = "digest long, sha string, keep long, rows long, ties long"
GROUP_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]


def _batches(index: LiveIndex, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    rows = list(index.rows())
    for at in range(0, len(rows), size):
        columns = zip(*rows[at : at + size])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, GROUP_TYPES)],
            ["digest", "sha", "keep", "rows", "ties"],
        )


def _indexed(flush: int | None):
    def run(batches):
        index = LiveIndex()
        for batch in batches:
            for digest, sha, keep, rows, ties in zip(*(c.to_pylist() for c in batch.columns)):
                index.add(digest, sha, keep, rows, ties)
                if flush and index.live >= flush:
                    yield from _batches(index)
                    index = LiveIndex()
        yield from _batches(index)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return plain(docs, "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("sha"))


def _digest():
    return F.xxhash64("sha")


def live_groups(keyed: DataFrame, shards: int) -> DataFrame:
    """One row per content: (digest, sha, keep, rows, ties).

    Tasks index their own rows first, so that a text with very many copies leaves a task
    as one row, and an index per shard merges what they found.
    """
    one = F.lit(1).cast("long")
    return (
        keyed.select(_digest().alias("digest"), "sha", F.col("doc_id").alias("keep"), one.alias("rows"), one.alias("ties"))
        .mapInArrow(_indexed(FLUSH), GROUPS)
        .repartition(shards, "digest")
        .mapInArrow(_indexed(None), GROUPS)
    )


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    keyed = stored(_keyed(docs), "digests")
    shards = partitions(keyed, keyed.count(), PER_SHARD)
    return keyed, stored(live_groups(keyed, shards).withColumnRenamed("sha", "_sha").drop("digest"), "groups")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Per row: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical; null counts as empty. Of equal texts the row with the
    largest doc_id stays, and where rows repeat that id exactly one of them. A null doc_id is
    below all others. Only ``doc_id`` and ``text`` are read; no rows give no rows.
    """
    keyed, groups = _grouped(docs)
    joined = keyed.join(groups, F.col("sha") == F.col("_sha"))
    first = F.col("doc_id").eqNullSafe(F.col("keep"))
    tied = first & (F.col("ties") > 1)
    turn = Window.partitionBy("sha").orderBy("doc_id")
    marked = (
        joined.where(~tied)
        .withColumn("kept", first)
        .unionByName(joined.where(tied).withColumn("kept", F.row_number().over(turn) == 1))
    )
    return marked.select(
        "doc_id",
        F.col("keep").alias("keep_id"),
        F.col("rows").alias("group_size"),
        "kept",
        F.col("sha").alias("text_sha256"),
    )


@all_columns
def unique_rows(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names. Equal rows with one id
    leave one row; nulls and texts are as in :func:`exact_dedup`, and no rows give no rows."""
    _, groups = _grouped(docs)
    groups = groups.select("_sha", F.col("keep").alias("_keep"), F.col("ties").alias("_ties"))
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    kept = docs.join(groups, (sha == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_keep")))
    turn = Window.partitionBy("_sha").orderBy(*[F.col(c) for c in docs.columns])
    tied = kept.where(F.col("_ties") > 1).withColumn("_turn", F.row_number().over(turn)).where("_turn = 1")
    return kept.where(F.col("_ties") == 1).select(*docs.columns).unionByName(tied.select(*docs.columns))


def update_index(live: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Live contents (digest, sha, rows) after rows came and went.

    ``live`` is an earlier result (or no rows); ``added`` and ``removed`` are documents.
    Content whose last row went is deleted; removing what is not there changes nothing.
    """
    def counted(df, kind):
        rows = _keyed(df).groupBy("sha").agg(F.count("*").alias("rows"))
        return rows.select(_digest().alias("digest"), "sha", "rows", F.lit(kind).alias("kind"))

    def run(batches):
        index, later = LiveIndex(), []
        for batch in batches:
            for digest, sha, rows, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 2:
                    later.append((digest, sha, rows))
                else:
                    index.add(digest, sha, None, rows, 0)
        for digest, sha, rows in later:
            index.remove(digest, sha, rows)
        for batch in _batches(index):
            yield batch.select(["digest", "sha", "rows"])

    before = live.select("digest", "sha", "rows", F.lit(0).alias("kind"))
    changes = before.unionByName(counted(added, 1)).unionByName(counted(removed, 2))
    return changes.repartition("digest").mapInArrow(run, "digest long, sha string, rows long")
