"""Mixing sources to target token counts by entropy balancing.

Of all document rates between 0 and ``limit`` that give each source its target, the
dual solution is the one closest in entropy to half the limit everywhere: a rate of
``limit / (1 + exp(-tilt * size))`` with one tilt per source. Everything the tilt depends
on is how many documents of which size a source has, so the Newton steps run on counts
per source and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.llm.columns import all_columns, plain
from rushcart.sources.folders import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
STEPS = 40
#: A source's words may be off by this share of its target before rounding.
CLOSE = 1e-9
#: Documents of one source and size that are numbered together; larger groups are dealt out by a hash.
TOGETHER = 5_000


def words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def _key() -> Column:
    """Sorts by code point with null last, and joins null with null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """One row per source: (key, source_size, target), from rows of (key, size).

    The sources share ``share`` times all words by weight; a target stops at ``limit``
    times its source's size and the others share what is left. Its windows run over one
    row per source.
    """
    per_source = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    ).withColumn("most", limit * F.col("source_size").cast("double"))
    # By the level at which a source is full: all before it are full, it and those after share the rest.
    filling = Window.orderBy(F.col("most") / F.col("weight"), "key")
    everyone = Window.partitionBy()
    level = (share * F.sum("source_size").over(everyone) - F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, 0)) + F.col("most")) / (
        F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    )
    return (
        weighted.withColumn("level", level)
        .withColumn("open", F.col("most") / F.col("weight") > F.col("level"))
        .withColumn("shared", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("key", "source_size", F.when(F.col("open"), F.col("weight") * F.col("shared")).otherwise(F.col("most")).alias("target"))
    )


def tilts(counts: DataFrame, goals: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per source: (key, tilt, unit). Newton steps on the dual, kept inside a bracket.

    ``unit`` is the mean size, by which sizes are divided. A source that must give its
    limit has no finite tilt and gets null.
    """
    units = counts.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("unit"))
    state = stored(
        goals.join(units, "key")
        .where((F.col("source_size") > 0) & (F.col("target") < limit * F.col("source_size") * (1 - 1e-12)))
        .select("key", "unit", "target", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(1.0).alias("off")),
        "tilts",
    )
    for _ in range(STEPS):
        z = F.col("size") / F.col("unit")
        odds = 1 / (1 + F.exp(-F.col("tilt") * z))
        steps = (
            counts.join(state, "key")
            .groupBy("key", "unit", "target", "tilt", "low", "high")
            .agg(
                F.sum(F.col("n") * F.col("size") * limit * odds).alias("got"),
                F.sum(F.col("n") * F.col("size") * z * limit * odds * (1 - odds)).alias("slope"),
            )
            .withColumn("low", F.when(F.col("got") < F.col("target"), F.col("tilt")).otherwise(F.col("low")))
            .withColumn("high", F.when(F.col("got") >= F.col("target"), F.col("tilt")).otherwise(F.col("high")))
        )
        newton = F.col("tilt") + (F.col("target") - F.col("got")) / F.greatest("slope", F.lit(1e-300))
        # Outside the bracket: halve it, or double the distance from 0 while one side is open.
        between = F.when(
            F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2
        ).otherwise(F.when(F.col("low").isNotNull(), 2 * F.abs("low") + 1).otherwise(-2 * F.abs("high") - 1))
        fits = (newton > F.coalesce("low", F.lit(-1e6))) & (newton < F.coalesce("high", F.lit(1e6))) & (F.abs(newton) <= 4 * F.abs("tilt") + 4)
        state = stored(
            steps.select(
                "key", "unit", "target",
                F.when(F.abs(F.col("got") - F.col("target")) <= CLOSE * F.col("target"), F.col("tilt")).otherwise(F.when(fits, newton).otherwise(between)).alias("tilt"),
                "low", "high",
                (F.abs(F.col("got") - F.col("target")) / F.col("target")).alias("off"),
            ),
            "tilts",
        )
        if (state.agg(F.max("off")).first()[0] or 0.0) <= CLOSE:
            break
    return state.select("key", "tilt", "unit")


def copies_per_size(counts: DataFrame, goals: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per source and size: (key, size, n, copies), copies in whole documents.

    Rates are rounded along each source's sizes, from the largest, so that running totals
    stay within half a copy; three rounds then even out the words that are left, with the
    largest documents that fit first. Windows run over the sizes of a source, whose number
    the longest text bounds.
    """
    tilt = tilts(counts, goals, limit)
    along = Window.partitionBy("key").orderBy(F.desc("size"))
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    rate = F.when(F.col("tilt").isNull(), float(limit)).otherwise(limit / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("unit"))))
    # Documents without words change nothing and are taken once.
    expected = F.when(F.col("size") == 0, F.col("n").cast("double")).otherwise(F.col("n") * rate)
    running = F.floor(F.sum("expected").over(upto) + 0.5)
    rounded = (
        counts.join(tilt, "key", "left")
        .withColumn("expected", expected)
        .withColumn("running", running)
        .withColumn("copies", F.col("running") - F.coalesce(F.lag("running").over(along), F.lit(0)))
        .select("key", "size", "n", F.greatest(F.least("copies", limit * F.col("n")), F.lit(0)).cast("long").alias("copies"))
    )
    rounded = stored(rounded, "copies")
    for _ in range(3):
        left = (
            rounded.groupBy("key").agg(F.sum(F.col("size") * F.col("copies")).alias("got"))
            .join(goals, "key")
            .select("key", F.round(F.col("target") - F.col("got")).cast("long").alias("left"))
        )
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("left"))
        room = F.when(fits, F.when(F.col("left") > 0, limit * F.col("n") - F.col("copies")).otherwise(F.col("copies"))).otherwise(0)
        rest = F.abs("left") - (F.sum(F.col("room") * F.col("size")).over(upto) - F.col("room") * F.col("size"))
        # The full room while the words last, a part of it where they run out, nothing after that.
        part = F.when(fits & (rest > 0), F.least("room", F.floor(rest / F.col("size")))).otherwise(0)
        rounded = stored(
            rounded.join(left, "key").withColumn("room", room).withColumn("part", part)
            .select("key", "size", "n", (F.col("copies") + F.signum(F.col("left").cast("double")) * F.col("part")).cast("long").alias("copies")),
            "copies",
        )
    return rounded


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: int = 0
) -> DataFrame:
    """Per row: (doc_id, size, source_size, target, copies, taken).

    Size counts words; null text has none, and a null source is a source of its own, the
    last. No row is taken more than ``limit`` times. Which documents of a source and size
    are taken follows a keyed hash of doc_id, so reruns agree; rows that repeat an id count
    one by one. Without any words all targets are 0; no rows give no rows. Only ``doc_id``, ``text`` and
    ``source`` are read.
    """
    sizes = stored(plain(docs, "doc_id", "text", "source").select("doc_id", _key().alias("key"), words().alias("size")), "sizes")
    goals = stored(targets(sizes, weights, share, limit), "targets")
    counts = stored(sizes.groupBy("key", "size").agg(F.count("*").alias("n")), "counts")
    given = copies_per_size(counts, goals, limit)
    hashed = F.xxhash64(F.lit(seed), "doc_id")
    dealt = (
        sizes.join(given.join(goals, "key"), ["key", "size"])
        .withColumn("parts", F.ceil(F.col("n") / TOGETHER))
        .withColumn("part", F.pmod(hashed, "parts"))
        .repartition("key", "size", "part")
    )
    place = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id")) - 1
    # Each part of a large group begins its rounding elsewhere, so that the errors even out.
    begin = F.when(F.col("parts") > 1, F.pmod(F.xxhash64(F.lit(seed), "key", "size", "part"), F.col("n"))).otherwise(F.lit(0))
    upto = lambda k: F.floor((k * F.col("copies") + F.col("begin")) / F.col("n"))
    return (
        dealt.withColumn("place", place)
        .withColumn("begin", begin)
        .withColumn("copies", (upto(F.col("place") + 1) - upto(F.col("place"))).cast("long"))
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


@all_columns
def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: rows with all their columns, as often as they are taken.

    Columns may have any names. Rows of one id are told apart by their size; of two such rows of
    one size either may be the one taken more often. Nulls are as in :func:`mix`; no rows
    give no rows.
    """
    turn = F.row_number().over(Window.partitionBy("_id").orderBy("_size"))
    taken = mix(docs, **how).select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "copies")
    taken = taken.withColumn("_turn", turn).where("copies > 0").select(F.col("_id").alias("_taken"), F.col("_turn").alias("_at"), F.col("copies").alias("_copies"))
    rows = docs.withColumn("_id", F.col("doc_id")).withColumn("_size", words()).withColumn("_turn", turn)
    found = rows.join(taken, F.col("_id").eqNullSafe(F.col("_taken")) & (F.col("_turn") == F.col("_at")))
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)
