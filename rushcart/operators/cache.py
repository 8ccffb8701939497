"""Which keys a cache would serve, and how evenly keys spread over servers.

Accesses without a key are left out throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from math import gcd

from pyspark.sql import DataFrame, Window, functions as F

from rushcart.functions.money import ratio
from rushcart.functions.skew import HOT_ROWS, cut_hot_keys, nearest
from rushcart.functions.spans import MICROSECOND, micros, window_start
from rushcart.sources.folders import stored

#: Hash slots whose accesses are counted before keys are.
SLOTS = 1 << 16
#: Logarithm of a distinct-count sketch's size.
LG = 12


def _uses(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("uses"))


def hot_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most used keys and their share of all accesses."""
    uses = _uses(df, key)
    total = uses.select(F.sum("uses")).scalar()
    top = uses.orderBy(F.desc("uses"), key).limit(k)
    return top.withColumn("share", ratio("uses", total))


def hot_keys_counted(df: DataFrame, key: str, k: int, *, slots: int = SLOTS) -> DataFrame:
    """The same rows as :func:`hot_keys`, counting exactly only keys that may be among them.

    A first pass counts accesses per hash slot, which no key of the slot can exceed. The keys of the
    fullest slots are counted; the k-th of them, if it exceeds every other slot, proves that
    no key is missing. If not, it is still a lower limit, and one more pass over the slots that
    reach it settles the rest.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(slots))
    used = df.where(F.col(key).isNotNull()).select(key, slot.alias("_slot"))
    sizes = stored(used.groupBy("_slot").agg(F.count("*").alias("_n")), "slots")  # a row per slot at most
    total = sizes.select(F.sum("_n")).scalar()
    fullest = sizes.orderBy(F.desc("_n"), "_slot")
    chosen = fullest.limit(4 * k)
    while True:
        inside = used.join(F.broadcast(chosen.select("_slot")), "_slot", "left_semi")
        top = stored(_uses(inside, key).orderBy(F.desc("uses"), key).limit(k), "top")
        found, least = top.agg(F.count("*"), F.min("uses")).first()
        others = sizes.join(chosen.select("_slot"), "_slot", "left_anti")
        bound = others.agg(F.max("_n")).first()[0]
        if bound is None or (found == k and bound < least):
            return top.withColumn("share", ratio("uses", total))
        chosen = stored(sizes.where(F.col("_n") >= (least if found == k else 0)), "chosen")


def hot_keys_approx(df: DataFrame, key: str, k: int, tracked: int = 10_000) -> DataFrame:
    """The same from sketches that track at most ``tracked`` keys.

    They are merged in two steps, so that no task has to take in one per input split.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(64)).alias("_part")
    sketches = (
        df.where(F.col(key).isNotNull())
        .groupBy(part)
        .agg(
            F.expr(f"approx_top_k_accumulate(`{key}`, {int(tracked)})").alias("sketch"),
            F.count("*").alias("_n"),
        )
    )
    merged = sketches.agg(
        F.expr(f"approx_top_k_combine(sketch, {int(tracked)})").alias("sketch"),
        F.sum("_n").alias("_all"),
    )
    top = F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(k)})")).alias("top")
    return merged.select("_all", top).select(
        F.col("top.item").alias(key),
        F.col("top.count").alias("uses"),
        ratio("top.count", "_all").alias("share"),
    )


def coverage_curve(df: DataFrame, key: str) -> DataFrame:
    """How many of the most used keys cover which share of accesses.

    One row per number of uses: all keys used at least that often, and the share
    they cover. The table that one task orders holds the distinct numbers of uses,
    at most the square root of twice the accesses.
    """
    per_use = _uses(df, key).groupBy("uses").agg(F.count("*").alias("_keys"))
    most_used = Window.orderBy(F.desc("uses"))
    sofar = most_used.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = most_used.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    accesses = F.col("uses") * F.col("_keys")
    return per_use.select(
        "uses",
        F.sum("_keys").over(sofar).alias("keys"),
        F.sum(accesses).over(sofar).alias("accesses"),
        ratio(F.sum(accesses).over(sofar), F.sum(accesses).over(everything)).alias("share"),
    )


def reuse_gaps(df: DataFrame, key: str, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per access, the microseconds since the key was last used; null for the first use."""
    known = df.where(F.col(key).isNotNull()).select(key, "ts")
    rows, cut = cut_hot_keys(known, key, "ts", hot_rows)
    seen = nearest(rows, key, ["ts"], F.col("ts"), "_before", cut=cut)
    return seen.select(key, "ts", (micros("ts") - micros("_before")).alias("gap_us"))


def ttl_hit_share(gaps: DataFrame, ttls: Sequence[timedelta]) -> DataFrame:
    """Per time to live, the share of accesses that come no later than that after the last.

    Exact for an unbounded cache that renews an entry on each access; an upper
    bound for caches that evict or expire from the time of writing.
    """
    limits = [ttl // MICROSECOND for ttl in ttls]
    sums = gaps.agg(
        F.count("*").alias("accesses"),
        *[F.count_if(F.col("gap_us") <= us).alias(f"_{i}") for i, us in enumerate(limits)],
    )
    rows = [
        F.struct(F.lit(us / 1e6).alias("ttl_s"), F.col(f"_{i}").alias("hits"))
        for i, us in enumerate(limits)
    ]
    return sums.select("accesses", F.inline(F.array(*rows))).select(
        "ttl_s", "accesses", "hits", ratio("hits", "accesses").alias("hit_share")
    )


def working_set(df: DataFrame, key: str, width: timedelta, approx: bool = False) -> DataFrame:
    """Distinct keys per window."""
    count = F.approx_count_distinct(key) if approx else F.countDistinct(key)
    return df.groupBy(window_start("ts", width).alias("window_start")).agg(count.alias("keys"))


def key_sketches(df: DataFrame, key: str, width: timedelta, group: Sequence[str] = (), lg: int = LG) -> DataFrame:
    """A distinct-count sketch per window and group: small, mergeable, can be stored.

    The standard error of a sketch, and of any merger of them, is about 1.04 / sqrt(2^``lg``).
    """
    start = window_start("ts", width).alias("window_start")
    return df.where(F.col(key).isNotNull()).groupBy(start, *group).agg(F.hll_sketch_agg(key, lg).alias("sketch"))


def working_set_sliding(
    df: DataFrame, key: str, width: timedelta, slide: timedelta, group: Sequence[str] = (), lg: int = LG
) -> DataFrame:
    """About how many distinct keys each sliding window sees.

    Rows meet sketches of panes, the common divisor of width and slide; a pane's sketch is
    merged into every window that covers it, so no row is copied.
    """
    pane = gcd(width // MICROSECOND, slide // MICROSECOND) * MICROSECOND
    panes = key_sketches(df, key, pane, group, lg).withColumnRenamed("window_start", "ts")
    start = window_start("ts", width, slide).alias("window_start")
    return panes.groupBy(start, *group).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys"))


def shared_keys(df: DataFrame, key: str, by: str, a: object, b: object, lg: int = LG) -> DataFrame:
    """About how many distinct keys two values of ``by`` (versions) use: ``either``, ``both``, ``only_a``, ``only_b``.

    From one theta sketch per value; ``low_both`` and ``high_both`` are three standard errors around ``both``.
    """
    sketches = df.where(F.col(key).isNotNull() & F.col(by).isin(a, b)).groupBy(by).agg(F.theta_sketch_agg(key, lg).alias("_s"))
    none = F.theta_sketch_agg(F.lit(None).cast("long"), F.lit(lg))
    x, y = (F.coalesce(F.max(F.when(F.col(by) == v, F.col("_s"))), none) for v in (a, b))
    sides = sketches.agg(x.alias("_x"), y.alias("_y"))
    estimate = F.theta_sketch_estimate
    either, both = estimate(F.theta_union("_x", "_y", lg)), estimate(F.theta_intersection("_x", "_y"))
    # what two sketches share is known as well as a sample of the whole at the rate 2^lg / either
    error = 3 * F.sqrt(F.col("both") * F.greatest(F.lit(0.0), F.col("either") / F.lit(float(1 << lg)) - 0.5))
    return (
        sides.select(
            either.alias("either"), both.alias("both"),
            estimate(F.theta_difference("_x", "_y")).alias("only_a"), estimate(F.theta_difference("_y", "_x")).alias("only_b"),
        )
        .withColumns({"low_both": F.col("both") - error, "high_both": F.col("both") + error})
    )


def load_spread(df: DataFrame, key: str, n: int, *, hashed: bool = False) -> DataFrame:
    """Requests per server if keys are dealt to ``n`` of them by remainder (or hash).

    ``imbalance`` is the fullest server's load over the mean load.
    """
    where = F.pmod(F.xxhash64(key) if hashed else F.col(key), F.lit(n)).cast("long")
    counts = (
        df.where(F.col(key).isNotNull())
        .groupBy(where.alias("bucket"))
        .agg(F.count("*").alias("_n"))
    )
    servers = df.sparkSession.range(n).withColumnRenamed("id", "bucket")
    everyone = Window.partitionBy()
    filled = servers.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("_n", F.lit(0)).alias("requests")
    )
    total = F.sum("requests").over(everyone)
    return filled.select(
        "bucket",
        "requests",
        ratio("requests", total).alias("share"),
        ratio(F.max("requests").over(everyone) * n, total).alias("imbalance"),
    )
