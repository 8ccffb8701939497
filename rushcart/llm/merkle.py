"""A Merkle manifest of a dataset, with the proof of every row, by pointer jumping.

Rows are leaves, numbered within their group. Runs of neighbouring nodes become their
parent, until a group has one node left, its subroot; subroots make the tree above in the
same way. Every node but the root then holds the siblings on its way to its parent. Each
round joins this table of ways to itself: a way from a node to an ancestor and the
ancestor's own way become one, which doubles the distance. Leaves follow along with the ways
of that round, and after a logarithm of the height all of them have arrived at the root.

Digests travel as 32 bytes and are hashed as hexadecimal text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rushcart.llm.columns import partitions
from rushcart.sources.folders import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Consecutive nodes that become one.
FAN = 8
#: Leaves of a range that one task numbers, about.
RANGE_ROWS = 100_000
#: The group of the nodes above the subroots.
_TOP = -1
_NONE = b""


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as its length in UTF-8 bytes, a colon and itself, null as ``-``."""
    parts = [v.cast("string") for v in values]
    return _hash(F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]))


def _numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``at``, the row's number from 0 within its group, and ``size``, the group's rows.

    Rows are dealt to ranges of all groups' order, so that a group of any size is numbered by many
    tasks; a table with a row per range and group carries the numbers on. Rows that are
    equal in that order are told apart by their place in the written table.
    """
    kept = stored(df.withColumn("_tie", F.monotonically_increasing_id()), "unnumbered")
    ranges = partitions(kept, kept.count(), RANGE_ROWS)
    dealt = stored(kept.repartitionByRange(ranges, group, *order, "_tie").withColumn("_range", F.spark_partition_id()), "ranges")
    here = dealt.groupBy(group, "_range").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = here.select(
        group, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"), F.sum("_rows").over(whole).alias("size")
    )
    inside = Window.partitionBy(group, "_range").orderBy(*order, "_tie")
    numbered = dealt.join(starts, [group, "_range"]).withColumn("at", F.col("_first") + F.row_number().over(inside) - 1)
    return numbered.drop("_tie", "_range", "_rows", "_first")


def _runs(nodes: DataFrame, fan: int, *carried: str) -> DataFrame:
    """Nodes (tree, level, at, size, node, digest), ``size`` being the nodes of that level, to
    the runs that become one: their parent's place, and themselves in order."""
    members = F.array_sort(F.collect_list(F.struct("at", "node", "digest", *carried)), lambda a, b: (a["at"] - b["at"]).cast("int"))
    return nodes.groupBy("tree", "level", F.expr(f"at div {fan}").alias("parent"), "size").agg(members.alias("run"))


def _parents(runs: DataFrame, fan: int) -> DataFrame:
    digests = F.array_join(F.transform("run", lambda x: _text(x["digest"])), "")
    level = F.col("level") + 1
    return runs.select(
        "tree",
        level.alias("level"),
        F.col("parent").alias("at"),
        F.expr(f"(size + {fan - 1}) div {fan}").alias("size"),
        F.struct("tree", level.alias("level"), F.col("parent").alias("at")).alias("node"),
        _hash(digests).alias("digest"),
    )


def _ways(runs: DataFrame, *carried: str) -> DataFrame:
    """(node, above, way) for every member of a run: its parent and the siblings on both sides."""
    digests = F.transform("run", lambda x: x["digest"])
    joined = lambda part: F.aggregate(part, F.lit(_NONE), lambda a, b: F.concat(a, b))
    members = runs.select(
        F.struct("tree", (F.col("level") + 1).alias("level"), F.col("parent").alias("at")).alias("above"),
        digests.alias("digests"),
        F.posexplode("run").alias("place", "member"),
    )
    left = joined(F.slice("digests", F.lit(1), F.col("place")))
    right = joined(F.slice("digests", F.col("place") + 2, F.size("digests")))
    return members.select(
        F.col("member.node").alias("node"),
        "above",
        F.array(F.struct(left.alias("left"), right.alias("right"))).alias("way"),
        *[F.col(f"member.{c}").alias(c) for c in carried],
    )


def _climbed(nodes: DataFrame, fan: int, height: int, ways: list[DataFrame]) -> list[DataFrame]:
    """Levels above ``nodes``, each written; the ways of their members are added to ``ways``.

    Gives the nodes that are alone on their level, which end their tree.
    """
    alone = []
    for _ in range(height):
        runs = stored(_runs(nodes.where("size > 1"), fan), "runs")
        ways.append(_ways(runs))
        alone.append(nodes.where("size = 1"))
        nodes = stored(_parents(runs, fan), "nodes")
    return [*alone, nodes.where("size = 1")]


def _height(size: int, fan: int) -> int:
    height = 0
    while size > 1:
        size, height = -(-size // fan), height + 1
    return height


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _jumped(paths: DataFrame, ways: DataFrame) -> DataFrame:
    """Paths taken on by the ways of where they have arrived."""
    on = ways.select(F.col("node").alias("_at"), F.col("above").alias("_above"), F.col("way").alias("_way"))
    return paths.join(on, F.col("above") == F.col("_at")).select(
        *[c for c in paths.columns if c not in ("above", "way")],
        F.col("_above").alias("above"),
        F.concat("way", "_way").alias("way"),
    )


def _onward(paths: DataFrame, ways: DataFrame, root: Column) -> DataFrame:
    """One round for those that have not arrived at the root."""
    return _jumped(paths.where(F.col("above") != root), ways).unionByName(paths.where(F.col("above") == root))


def proofs(leaves: DataFrame, group: str, order: Sequence[str], digest: str, fan: int = FAN) -> DataFrame:
    """The rows with ``subroot``, ``root`` (hexadecimal) and ``proof``: per level from the leaf up, the
    digests ``left`` and ``right`` of it in its run, end to end. Columns of those names are replaced.

    ``digest`` names the leaves' digests, 32 bytes. Groups are ordered by their text as UTF-8 bytes,
    null first; leaves of a group by ``order``, nulls first, then by digest, equal ones in any
    order. No rows give no rows. Other columns stay and may have any names. The only lists
    are runs of ``fan`` digests; a group of any size is spread over all tasks.
    """
    key = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))
    keys = [F.col(c).alias(f"order{i}") for i, c in enumerate(order)]
    packed = leaves.select(key.alias("group"), *keys, F.col(digest).alias("digest"), F.struct("*").alias("row"))
    numbered = stored(_numbered(packed, "group", [*[f"order{i}" for i in range(len(order))], "digest"]), "leaves")
    groups = numbered.where("at = 0").select("group", F.col("size").alias("leaves"), F.lit("").alias("all"))
    groups = stored(_numbered(groups, "all", ["group"]).select("group", "leaves", F.col("at").alias("tree"), F.col("size").alias("trees")), "groups")
    most, trees = groups.agg(F.max("leaves"), F.max("trees")).first()
    inner, outer = _height(most or 0, fan), _height(trees or 0, fan)

    nodes = numbered.join(groups.select("group", "tree"), "group").select("tree", F.lit(0).alias("level"), "at", "size", "digest", "row")
    nodes = nodes.withColumn("node", F.struct("tree", "level", "at"))
    runs = stored(_runs(nodes.where("size > 1"), fan, "row"), "leaf-runs")
    lone = stored(nodes.where("size = 1"), "lone")
    ways: list[DataFrame] = []
    tops = [lone.drop("row")]
    if inner:
        tops += _climbed(stored(_parents(runs, fan), "nodes"), fan, inner - 1, ways)
    subroots = stored(_union(tops).select("tree", "node", "digest"), "subroots")
    above = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), F.lit(trees).cast("long").alias("size"), "node", "digest"
    )
    last = _climbed(above, fan, outer, ways)[-1].select("node", _text(F.col("digest"))).first() or ((None,) * 3, None)
    root = F.struct(*[F.lit(x).cast(t).alias(c) for x, (c, t) in zip(last[0], (("tree", "long"), ("level", "int"), ("at", "long")))])

    there = lone.select("node", F.col("node").alias("above"), F.array().cast("array<struct<left:binary,right:binary>>").alias("way"), "row")
    paths = _ways(runs, "row").unionByName(there)
    reach, ways_now = 1, stored(_union(ways), "ways") if ways else None
    while ways_now is not None and reach < max(inner, 1) + outer:
        # leaves are at least that far up by now, unless their group is a single one
        needed = ways_now if reach == 1 else ways_now.where((F.col("node.tree") == _TOP) | (F.col("node.level") >= reach))
        paths = _onward(paths, needed, root)
        reach *= 2
        if reach < max(inner, 1) + outer:
            ways_now = stored(_onward(ways_now, ways_now, root), "ways")
    subroot = subroots.select(F.col("tree").alias("_tree"), _text(F.col("digest")).alias("subroot"))
    done = paths.join(subroot, F.col("node.tree") == F.col("_tree"))
    kept = [F.col(f"row.`{c}`").alias(c) for c in leaves.columns if c not in ("subroot", "root", "proof")]
    return done.select(*kept, "subroot", F.lit(last[1]).cast("string").alias("root"), F.col("way").alias("proof"))


def fold(digest: Column, proof: Column) -> Column:
    """The root, in hexadecimal, that a leaf and its proof lead to."""
    return F.aggregate(proof, _text(digest), lambda a, x: F.sha2(F.concat(_text(x["left"]), a, _text(x["right"])), 256))


def document_leaves(docs: DataFrame, text: Column | None = None) -> Column:
    """The digest of a row of documents, with another ``text`` if one is given."""
    return leaf(*[text if c == "text" and text is not None else docs[c] for c in FIELDS])


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: (doc_id, lang, leaf, subroot, root, proof), a tree for each lang.

    Null columns count as such and differ from empty ones; null langs are a group of
    their own. Repeated rows are leaves each, neighbours of one digest. Only the columns in
    FIELDS are read; texts of any length are hashed whole. No documents give no rows.
    """
    return proofs(docs.select("doc_id", "lang", document_leaves(docs).alias("leaf")), "lang", ["doc_id"], "leaf")


def verified(docs: DataFrame) -> DataFrame:
    """Per document: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    The proof is followed from the document as it is, or with its text lower-cased (A-Z) where 3
    divides the CRC-32 of the decimal doc_id; a null doc_id is left as it is. Rows as in
    :func:`manifest`.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    touched = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").rlike("[A-Z]")
    changed = F.when(touched, document_leaves(docs, F.translate("text", upper, upper.lower())))
    rows = docs.select("doc_id", "lang", document_leaves(docs).alias("leaf"), changed.alias("changed"))
    siblings = F.array_join(F.transform("proof", lambda x: _text(F.concat(x["left"], x["right"]))), "")
    return (
        proofs(rows, "lang", ["doc_id"], "leaf")
        .withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("proof")))
        .select("doc_id", _text(F.col("leaf")).alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root")
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
