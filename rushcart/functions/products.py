"""The largest inner products of many vectors with many others, exactly and without all pairs.

Items are dealt into blocks by length, longest first. No product with an item of a block is
larger than the product of the two lengths (Cauchy and Schwarz), so a user who has found
``n`` products above that bound for a block is done with it and all later ones. Users meet
the first block, then the next one, then two, four and so on, fewer of them each time.

The first block is small and each one is twice as large as the one before, up to a limit, so
all users take only few items to begin with. Inside a block the same bound holds for every
stretch of items, and a user leaves at the first stretch that cannot matter.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.functions.ranks import ranked
from rushcart.sources.folders import stored

# What runs inside tasks travels with its code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Items of the first block, and of the largest ones unless that makes more than BLOCKS of them.
BLOCK, BLOCK_MOST, BLOCKS = 16_384, 262_144, 128
#: Users that meet a block in one task, about. Every such chunk takes a copy of the block.
CHUNK = 20_000
#: Products that a task holds at a time; items of a stretch, the first of which is shorter.
PRODUCTS, STRETCH, FIRST = 1 << 20, 512, 64
#: Items up to this rank are broadcast to find those that users had among them.
BROADCAST = 262_144
_FOUND = "user long, item long, score double"
#: A bound is a product of rounded lengths, so it is taken a little larger.
_SLACK = 1 + 1e-9


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _best(n: int):
    """The best ``n`` items of one block for each of a chunk of users, without those they had.

    Only items that reach ``least``, the n-th best a user has found before, are wanted.
    """

    def run(users: pa.Table, block: pa.Table) -> pa.Table:
        ids, left, right = users.column("user").to_numpy(), _matrix(users.column("features")), _matrix(block.column("features"))
        size, far = np.sqrt((right * right).sum(axis=1)), np.sqrt((left * left).sum(axis=1)) * _SLACK
        longest = np.argsort(-size, kind="stable")
        items, right, size = block.column("item").to_numpy()[longest], right[longest], size[longest]
        had = users.column("had").combine_chunks()
        lane = np.repeat(np.arange(len(ids)), np.diff(had.offsets.to_numpy()))
        by_id = np.argsort(items)
        column = by_id[np.searchsorted(items, had.flatten().to_numpy(zero_copy_only=False), sorter=by_id)]
        before = users.column("least").to_numpy()
        starts = [0, *range(max(FIRST, n), len(items), STRETCH)]
        step = max(1, PRODUCTS // max(STRETCH, n))
        out = []
        for a in range(0, len(ids), step):
            b = min(a + step, len(ids))
            own = slice(*np.searchsorted(lane, [a, b]))
            owner, owned = lane[own] - a, column[own]
            score = np.full((b - a, n), -np.inf)
            best = np.full((b - a, n), np.iinfo(np.int64).max)
            least = before[a:b].copy()
            for c, d in zip(starts, [*starts[1:], len(items)]):
                in_reach = far[a:b] * size[c] >= least
                if not in_reach.any():
                    break  # items only get shorter
                rows = np.flatnonzero(in_reach)
                near = left[a:b][rows] @ right[c:d].T
                here = (owned >= c) & (owned < d) & in_reach[owner]
                near[np.searchsorted(rows, owner[here]), owned[here] - c] = -np.inf
                # what the matrix product rounds otherwise than the sum below is far less than this
                slack = far[a:b][rows] * size[c] * (_SLACK - 1)
                level = least[rows]
                if d - c > n and (new := level == -np.inf).any():
                    level[new] = np.partition(near[new], d - c - n, axis=1)[:, d - c - n]
                row, at = np.nonzero((near >= (level - slack)[:, None]) & (near > -np.inf))
                if not len(row):
                    continue
                row, at = rows[row], at + c
                found = np.zeros(len(row))
                for k in range(left.shape[1]):  # one factor after the other, so that sums never depend on the blocks
                    found += left[a + row, k] * right[at, k]
                met, first, many = np.unique(row, return_index=True, return_counts=True)
                place = n + np.arange(len(row)) - np.repeat(first, many)
                some = np.full((len(met), n + many.max()), -np.inf)
                theirs = np.full(some.shape, np.iinfo(np.int64).max)
                some[:, :n], theirs[:, :n] = score[met], best[met]
                line = np.repeat(np.arange(len(met)), many)
                some[line, place], theirs[line, place] = found, items[at]
                order = np.lexsort((theirs, -some), axis=1)[:, :n]  # of ties the smallest items
                score[met], best[met] = np.take_along_axis(some, order, 1), np.take_along_axis(theirs, order, 1)
                least = np.maximum(least, score[:, n - 1])
            row, at = np.nonzero((score > -np.inf) & (score >= least[:, None]))
            out.append((ids[a:b][row], best[row, at], score[row, at]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out)], names=["user", "item", "score"])

    return run


def _length() -> Column:
    return F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def largest_products(
    users: DataFrame, items: DataFrame, had: DataFrame, n: int, *, block: int = BLOCK, chunk: int = CHUNK
) -> DataFrame:
    """Per user the ``n`` items with the largest inner product: (user, item, score, rank).

    ``users`` and ``items`` hold (user, features) and (item, features), ids as longs; items that ``had``
    names for a user are left out. Ties go to the smaller item. Products are summed in
    double precision, factor by factor. A task holds one block of items and a chunk of users.
    """
    items = stored(items.select("item", "features", _length().alias("length")), "items")
    by_length = ranked(items, [F.desc("length"), F.col("item")], "length")
    ends = _ends(items.count(), block)
    passed = F.filter(F.array(*[F.lit(x) for x in ends]), lambda x: x < F.col("rank"))
    dealt = by_length.select(F.size(passed).cast("long").alias("block"), "item", "features", "length")
    dealt = stored(dealt, "item-blocks")
    longest = [r[1] for r in dealt.groupBy("block").agg(F.max("length")).orderBy("block").collect()]  # BLOCKS or so at most
    found = []
    open_ = users.select("user", "features", _length().alias("length"), F.array().cast("array<double>").alias("best"))
    first, last = 0, 1
    while first < len(longest):
        bounds = F.array(*[F.lit(x * _SLACK) for x in longest[first:last]])
        least = F.when(F.size("best") >= n, F.get("best", F.lit(n - 1))).otherwise(F.lit(float("-inf")))
        # lengths fall from block to block, so those that a user still needs come first
        needed = F.size(F.filter(bounds, lambda x: x * F.col("length") >= F.col("least")))
        met = open_.withColumn("least", least).withColumn("_needed", needed).where("_needed > 0")
        met = stored(met.withColumn("block", F.explode(F.sequence(F.lit(first).cast("long"), F.col("_needed") + F.lit(first - 1).cast("long")))), "met")
        still = met.where(F.col("block") == first)
        if not (many := still.count()):
            break
        place = F.pmod(F.xxhash64("user"), F.lit(-(-many // chunk))).alias("chunk")
        asked = met.select("user", "features", "least", "block", place)
        inside = dealt.where(F.col("block").between(first, last - 1)).select("item", "block")
        inside = F.broadcast(inside) if ends[last - 1] <= BROADCAST else inside
        mine = had.select("user", "item").join(inside, "item").groupBy("user", "block").agg(F.collect_set("item").alias("had"))  # a block's items at most
        asked = asked.join(mine, ["user", "block"], "left").withColumn("had", F.coalesce("had", F.array().cast("array<bigint>")))
        where = met.select(F.col("block").alias("_block"), place.alias("_chunk")).distinct()
        copies = where.join(dealt, F.col("block") == F.col("_block")).select("_block", "_chunk", "item", "features")
        offers = asked.groupBy("block", "chunk").cogroup(copies.groupBy("_block", "_chunk")).applyInArrow(_best(n), _FOUND)
        found.append(stored(offers, "found"))
        new = found[-1].groupBy("user").agg(F.collect_list("score").alias("_new"))  # n of each of the round's blocks at most
        both = F.concat("best", F.coalesce("_new", F.array().cast("array<double>")))
        open_ = still.join(new, "user", "left").select("user", "features", "length", F.slice(F.sort_array(both, asc=False), 1, n).alias("best"))
        first, last = last, min(2 * last, len(longest))
    every = reduce(DataFrame.unionByName, found, users.sparkSession.createDataFrame([], _FOUND))
    best = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def _ends(many: int, block: int) -> list[int]:
    """The last rank of each block; a block is twice as large as the one before, as far as BLOCK_MOST."""
    most = max(block, min(BLOCK_MOST, block << 4), -(-many // BLOCKS))
    out = [block]
    while out[-1] < many:
        block = min(2 * block, most)
        out.append(out[-1] + block)
    return out
