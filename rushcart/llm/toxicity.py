"""A linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rushcart.llm.columns import pieces, plain, texts, utf8

ORDERS = (3, 4, 5, 6)
BITS = 20
#: Labelled rows that are learned from at most, the first by a hash of their id.
TRAINING_ROWS = 12_000
#: n-grams that may have a weight, those whose rates in the two classes differ most surely.
FEATURES = 8_192
THRESHOLD = 0.3


def grams(rows: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per order: n, the bucket of the n-gram at every character, and the characters' rows.

    Rows stand end to end, each after a mark for its beginning; an n-gram that reaches
    into the next row is the caller's to leave out (see :func:`inside`).
    """
    joined = "".join("\0" + x for x in rows).lower()
    if len(joined) != len(rows) + sum(map(len, rows)):  # some letters grow when lower-cased
        rows = [x.lower() for x in rows]
        joined = "".join("\0" + x for x in rows)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(x) + 1 for x in rows])
    mixed = chars * np.uint32(0x9E3779B1) ^ (chars >> np.uint32(7))
    hashed = mixed
    for n in range(2, max(ORDERS) + 1):
        if len(chars) < n:
            return
        hashed = hashed[:-1] * np.uint32(0x01000193) + mixed[n - 1 :]
        if n in ORDERS:
            bucket = hashed * np.uint32(0x85EBCA6B)
            bucket ^= bucket >> np.uint32(15)
            yield n, bucket >> np.uint32(32 - BITS), ends


def inside(n: int, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams beginning ``at``, and which of them end in the same row."""
    row = np.searchsorted(ends, at, side="right")
    return row, at + n <= ends[row]


def present(rows: list[str], wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs, of wanted buckets if given."""
    found = []
    for n, bucket, ends in grams(rows):
        at = np.flatnonzero(wanted[bucket]) if wanted is not None else np.arange(len(bucket))
        row, whole = inside(n, at, ends)
        found.append((row[whole].astype(np.int64) << BITS) | bucket[at[whole]])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    """Weight of every bucket (0 for most) and the bias."""

    weight: np.ndarray
    bias: float

    def scores(self, rows: list[str]) -> np.ndarray:
        row, bucket = present(rows, self.weight != 0)
        total = self.bias + np.bincount(row, self.weight[bucket], minlength=len(rows))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def held_out(doc_id: str = "doc_id"):
    kept_back = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
    return F.coalesce(kept_back, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Text and class of at most ``most`` labelled rows that are not held out."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    chosen = usable.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most)
    return plain(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _counts(batches):
    """Rows per class, and for each n-gram in how many rows of a class it stands."""
    seen, counts = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.uint32)
    for batch in batches:
        rows, toxic = texts(batch.column("text")), np.array(batch.column("toxic").to_pylist(), np.int64)
        seen += np.bincount(toxic, minlength=2)
        for a, b in pieces(utf8(batch.column("text"))[1], 1 << 18):
            row, bucket = present(rows[a:b], None)
            for c in (0, 1):
                counts[c] += np.bincount(bucket[toxic[a:b][row] == c], minlength=1 << BITS).astype(np.uint32)
    yield pa.RecordBatch.from_pylist([{"seen": seen.tolist(), "counts": zlib.compress(counts.tobytes(), 1)}])


def _vectors(wanted: np.ndarray):
    def run(batches):
        for batch in batches:
            rows, toxic = texts(batch.column("text")), batch.column("toxic").to_pylist()
            for a, b in pieces(utf8(batch.column("text"))[1], 1 << 18):
                row, bucket = present(rows[a:b], wanted)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(toxic[a:b], pa.int32()),
                        pa.array([bucket[x:y].astype(np.int32).tobytes() for x, y in zip(cut, cut[1:])], pa.binary()),
                    ],
                    ["toxic", "buckets"],
                )

    return run


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """Learns from at most ``most`` rows; what reaches the driver is bounded by that and by the buckets.

    Without rows of both classes every text gets the smoothed share of class 1.
    """
    rows = training_rows(docs, labels, most).repartition(8)
    # Few tasks: each hands over counts of all buckets.
    parts = rows.mapInArrow(_counts, "seen array<long>, counts binary").collect()
    seen = np.sum([[0, 0], *(p.seen for p in parts)], axis=0)
    share = (seen[1] + 1) / (seen.sum() + 2)
    empty = Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    if seen.min() == 0:
        return empty
    counts = sum(np.frombuffer(zlib.decompress(p.counts), np.uint32).reshape(2, -1).astype(np.float64) for p in parts)
    rate = (counts + 1) / (seen[:, None] + 2)
    ratio = np.log(rate[1] / rate[0])
    both = (counts.sum(0) + 1) / (seen.sum() + 2)
    sure = np.abs(rate[1] - rate[0]) / np.sqrt(both * (1 - both) * (1 / seen).sum())
    sure[counts.sum(0) < 5] = 0
    chosen = np.argsort(-sure, kind="stable")[:FEATURES]
    chosen = chosen[sure[chosen] > 3]
    if len(chosen) == 0:
        return empty
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen] = True
    vectors = rows.mapInArrow(_vectors(wanted), "toxic int, buckets binary").collect()
    toxic = np.array([v.toxic for v in vectors], np.float64)
    buckets = [np.frombuffer(v.buckets, np.int32) for v in vectors]
    weight, bias = _fit(toxic, buckets, np.where(wanted, ratio, 0), empty.bias)
    return Model(weight.astype(np.float32), bias)


def _fit(toxic: np.ndarray, buckets: list[np.ndarray], ratio: np.ndarray, bias: float, rounds: int = 150):
    """Logistic regression on ratio-scaled presence, with Adam steps and an L2 penalty."""
    # One order of rows, whatever order the tasks ended in.
    order = sorted(range(len(toxic)), key=lambda i: (toxic[i], buckets[i].tobytes()))
    toxic, buckets = toxic[order], [buckets[i] for i in order]
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), [len(b) for b in buckets])
    used = np.flatnonzero(ratio)
    place = np.zeros(len(ratio), np.int32)
    place[used] = np.arange(len(used))
    at = place[np.concatenate(buckets)]
    scale = ratio[used]
    value = scale.astype(np.float32)[at]
    v, mean, square = np.full(len(used), 0.05), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, rounds + 1):
        total = bias + np.bincount(row, v.astype(np.float32)[at] * value, minlength=len(toxic))
        off = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - toxic
        slope = np.bincount(at, off.astype(np.float32)[row] * value, minlength=len(used)) / len(toxic) + 2e-5 * v
        slope = np.append(slope, off.mean())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        v, bias = v - move[:-1], bias - move[-1]
    weight = np.zeros(len(ratio))
    weight[used] = v * scale
    return weight, float(bias)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: (doc_id, held_out, score, predicted). Reads ``doc_id`` and ``text`` only.

    An empty or null text scores as the bias says. A null id is not held out. Equal texts
    score alike; texts are read whole, whatever their length. No rows give no rows.
    """

    def run(batches):
        for batch in batches:
            rows, scores = texts(batch.column("text")), []
            for a, b in pieces(utf8(batch.column("text"))[1]):
                scores.append(model.scores(rows[a:b]))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    rows = plain(docs, "doc_id", "text").select("doc_id", "text", held_out().alias("held_out"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows scored below the threshold, with all their columns."""

    def run(batches):
        for batch in batches:
            rows = texts(batch.column("text"))
            keep = [model.scores(rows[a:b]) < threshold for a, b in pieces(utf8(batch.column("text"))[1])]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
