"""Shards of near-equal size by sampled splitters over a hash of the text."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.llm.columns import plain
from rushcart.sources.folders import stored

#: Ranges per shard that are aimed at; shards differ by about the size of one.
RANGES = 32
#: Rows of a range that are numbered in one task, about.
TOGETHER = 200_000
ROUNDS = 20


def _key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _sample(keys: DataFrame, bytes_a_draw: float, seed: int) -> np.ndarray:
    """Keys drawn with a chance of their bytes over ``bytes_a_draw``, and surely from there on.

    Rows of one key are one row here, so about total / bytes_a_draw keys come back.
    """
    chance = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 40)) / float(1 << 40)
    drawn = keys.where(chance * bytes_a_draw < F.col("bytes")).select("key", "bytes").collect()
    weights = sorted((r.key, r.bytes) for r in drawn)
    # A drawn key stands for at least the bytes of a draw.
    return np.array([(k, max(b, bytes_a_draw)) for k, b in weights], dtype=[("key", np.int64), ("weight", np.float64)])


def _quantiles(sample: np.ndarray, most: float) -> list[int]:
    """Borders between sampled keys so that about ``most`` bytes lie between two; a key as heavy as that alone."""
    borders, filled = [], 0.0
    for key, weight in sample:
        if filled + weight > most and filled > 0 or weight >= most:
            borders.append(int(key))
            filled = 0.0
        filled += weight
        if weight >= most and key < np.iinfo(np.int64).max:
            borders.append(int(key) + 1)
            filled = 0.0
    return borders


def ranged(keys: DataFrame, borders: np.ndarray) -> DataFrame:
    """Adds ``range``: how many borders are at most the key."""

    def run(batches):
        for batch in batches:
            at = np.searchsorted(borders, batch.column("key").to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "range"])

    return keys.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema) + ", range long")


def splitters(keys: DataFrame, shards: int, seed: int = 0) -> tuple[np.ndarray, dict[int, int]]:
    """Borders over the keys, and the bytes of each range that has any.

    A range above its share is sampled again, more finely, and subdivided until it fits or
    is a single key. What comes to the driver is bounded by ``shards`` and RANGES.
    """
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    most = max(total / (shards * RANGES), 1.0)
    borders = np.unique(np.array(_quantiles(_sample(keys, most / 4, seed), most / 2), np.int64))
    for turn in range(1, ROUNDS + 1):
        found = ranged(keys, borders).groupBy("range").agg(F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        over = [r for r in found if r.bytes > most and r.low < r.high]
        if not over:
            break
        inner = ranged(keys, borders).where(F.col("range").isin([r.range for r in over]))
        finer = _quantiles(_sample(inner, most / 2 ** min(turn + 3, 8), seed + turn), most / 2)
        middle = [r.low + (r.high - r.low) // 2 + 1 for r in over]  # so that each round makes progress
        borders = np.unique(np.concatenate([borders, np.array(finer + middle, np.int64)]))
    return borders, {r.range: r.bytes for r in found}


def packed(ranges: dict[int, int], shards: int) -> dict[int, int]:
    """Ranges to shards: the largest first, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for at, size in sorted(ranges.items(), key=lambda x: (-x[1], x[0])):
        filled, shard = heapq.heappop(heap)
        placed[at] = shard
        heapq.heappush(heap, (filled + size, shard))
    return placed


def _keyed(docs: DataFrame) -> DataFrame:
    return plain(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        _key().alias("key"),
    )


def _plan(rows: DataFrame, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Borders, the shard of every range, and the rows of the largest range."""
    keys = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "keys")
    borders, ranges = splitters(keys, shards, seed)
    placed = packed(ranges, shards)
    most = ranged(keys, borders).groupBy("range").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    return borders, np.array([placed.get(at, 0) for at in range(len(borders) + 1)], np.int64), most


def shard(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """Per row: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Law ``bytes``: sizes are near equal. Equal texts share a shard, null counts as the empty
    text of size 1, and rows that repeat are rows of their own. A text whose copies outweigh
    a shard fills one alone. Slots count from 0 in each shard; no rows give no rows. Only ``doc_id`` and ``text`` are read.
    """
    rows = stored(_keyed(docs), "sizes")
    borders, shard_of, most = _plan(rows, shards, seed)
    lookup = F.array(*[F.lit(int(s)) for s in shard_of])
    parts = max(1, -(-most // TOGETHER))
    placed = stored(
        ranged(rows, borders)
        .withColumn("shard", F.element_at(lookup, (F.col("range") + 1).cast("int")))
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts))),
        "ranges",
    )
    counts = placed.groupBy("shard", "range", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range", "part").orderBy("key", "doc_id")
    return placed.join(starts, ["range", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.row_number().over(inside) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 0) -> None:
    """Writes whole rows into one folder per shard, ``shard=0`` and so on, in the order of the keys.

    A column ``shard`` that the rows have already is left out.
    """
    borders, shard_of, _ = _plan(_keyed(docs), shards, seed)
    lookup = F.array(*[F.lit(int(s)) for s in shard_of])
    rows = docs.drop("shard").select(F.struct("*").alias("row"), _key().alias("key"))
    at = ranged(rows, borders).withColumn("shard", F.element_at(lookup, (F.col("range") + 1).cast("int")))
    in_order = at.repartition("shard", "range").sortWithinPartitions("shard", "key")
    in_order.select("row.*", "shard").write.partitionBy("shard").parquet(path)
