"""A Merkle manifest of a table: trees of SHA-256 digests, one per group, and one over their roots.

A row's leaf is the digest of its fields, each written as ``-`` if null, else as its UTF-8 byte count, ``:`` and its value.
Leaves are numbered within their group by (order, leaf). While a tree has several nodes, every ``arity`` consecutive ones
(the last run may hold fewer, even one) become the digest of their digests, as hex text, one after the other. The last node is the
group's subroot; the subroots, in the order of their groups, form the upper tree in the same way.

Each level is one table of nodes (tree, n, idx, hash). It joins itself on the tree and the computed index of the sibling: idx XOR 1
in a binary tree, otherwise one join per slot offset; then the rows in slot zero emit the parents. A key names one node, so
no tree, however large, is one group. The siblings that a level has found are kept, and handed down from the root in one
join per level to become every row's path. Numbers within groups come from a range sort and counts per partition, not from a
window over a group. Levels lie in the work folder, so a lost executor repeats one level at most.

Defined results: a null group is a tree of its own, the first one; null order values come first; rows with equal order values are
told apart by their leaf, and equal leaves are interchangeable; null, empty and very long texts are whole fields of the leaf; an
empty table gives an empty result; a table of one row has that leaf as root, with an empty path; other columns, whatever their
names, are read only where they are named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.batches import stored

PATH = "array<struct<before:binary,after:binary>>"
NOTHING = b""


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda h, step: digest(F.concat(_hex(step["before"]), h, _hex(step["after"]))))


def proof_text(path: Column) -> Column:
    """All siblings of a path as hex text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: _hex(F.concat(step["before"], step["after"]))), "")


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with n, the number of rows of their tree, and idx, their place in it by ``order``, from 0."""
    at, part = F.monotonically_increasing_id(), F.spark_partition_id()
    placed = stored(rows.orderBy(tree, *order).withColumn("part", part).withColumn("at", at), "merkle-order")
    counts = placed.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("own"), F.min("at").alias("first"))
    whole = Window.partitionBy(tree)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        tree, "part", F.sum("own").over(whole).alias("n"),
        (F.coalesce(F.sum("own").over(earlier), F.lit(0)) - F.col("first")).alias("base"))
    return placed.join(bases, [tree, "part"]).withColumn("idx", F.col("at") + F.col("base")).drop("part", "at", "base")


def _siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with before and after: the digests of the other nodes of their run, as bytes."""
    slot = F.col("idx") % arity
    bytes_of = nodes.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.unhex("hash").alias("h"))
    if arity == 2:
        other = bytes_of.withColumn("i", F.col("i").bitwiseXOR(F.lit(1)))
        joined = nodes.join(other, (F.col("tree") == F.col("t")) & (F.col("idx") == F.col("i")), "left")
        side = lambda wanted: F.coalesce(F.when(slot == wanted, F.col("h")), F.lit(NOTHING))
        return joined.select("tree", "n", "idx", "hash", side(1).alias("before"), side(0).alias("after"))
    joined = nodes
    for offset in range(1, arity):
        # The node whose partner at this offset, counted around the run, is ``idx``.
        turned = F.col("i") - F.col("i") % arity + (F.col("i") + arity - offset) % arity
        other = bytes_of.select(F.col("t").alias(f"t{offset}"), turned.alias(f"i{offset}"), F.col("h").alias(f"h{offset}"))
        joined = joined.join(other, (F.col("tree") == F.col(f"t{offset}")) & (F.col("idx") == F.col(f"i{offset}")), "left")
    found = F.array_sort(F.filter(F.array(*[
        F.struct(((slot + o) % arity).alias("slot"), F.col(f"h{o}").alias("h")) for o in range(1, arity)]),
        lambda x: x["h"].isNotNull()))

    def side(wanted) -> Column:
        return F.aggregate(F.filter(found, wanted), F.lit(NOTHING), lambda a, x: F.concat(a, x["h"]))

    return joined.select("tree", "n", "idx", "hash", side(lambda x: x["slot"] < slot).alias("before"),
                         side(lambda x: x["slot"] > slot).alias("after"))


def _climb(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels (tree, n, idx, hash, before, after) of trees with several nodes, and (tree, height, hash) of their tops."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], [nodes.where("n = 1").select("tree", F.lit(0).alias("height"), "hash")]
    while most > 1:
        level = stored(_siblings(nodes.where("n > 1"), arity), f"merkle-level{len(levels)}")
        levels.append(level)
        parents = level.where(F.col("idx") % arity == 0).withColumn(
            "hash", digest(F.concat("hash", _hex(F.col("after")))))
        tops.append(parents.where((F.col("idx") == 0) & (F.col("n") <= arity)).select(
            "tree", F.lit(len(levels)).alias("height"), "hash"))
        nodes = parents.where(F.col("n") > arity).select(
            "tree", F.ceil(F.col("n") / arity).cast("long").alias("n"), F.expr(f"idx div {arity}").alias("idx"), "hash")
        most = -(-most // arity)
    found = tops[0]
    for top in tops[1:]:
        found = found.union(top)
    return levels, stored(found, "merkle-tops")


def _descend(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """(tree, idx, path) of every node of the lowest level; ``tops`` has tree, height and the path above the top."""
    def top(height: int) -> DataFrame:
        return tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("idx"), "path")

    paths = top(len(levels))
    for height in range(len(levels) - 1, -1, -1):
        step = F.array(F.struct("before", "after")).cast(PATH)
        own = levels[height].select("tree", F.col("idx").alias("own"), F.expr(f"idx div {arity}").alias("idx"), step.alias("step"))
        paths = own.join(paths, ["tree", "idx"]).select(
            "tree", F.col("own").alias("idx"), F.concat("step", "path").alias("path")).union(top(height))
        if height % 4 == 0 and height:
            paths = stored(paths, "merkle-paths")
    return paths


def manifest(
    rows: DataFrame, fields: Sequence[Column], group: str, order: str, arity: int = 2, also: dict[str, Column] | None = None,
) -> DataFrame:
    """(group, order, leaf, n, idx, subroot, root, path) of every row, and the columns ``also``, computed from ``rows``.

    ``path`` has, for each level on the way to the root, the digests before and after the row's node in its run, as bytes.
    """
    if arity < 2:
        raise ValueError("a tree needs an arity of 2 or more")
    also = also or {}
    # The tree's name orders as the group does, with null first, and is never null.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = stored(rows.select(
        tree.alias("tree"), F.col(order).alias("key"), leaf(fields).alias("hash"),
        *[c.alias(f"also{i}") for i, c in enumerate(also.values())]), "merkle-leaves")
    placed = stored(numbered(leaves, "tree", ["key", "hash"]), "merkle-rows")
    levels, tops = _climb(placed.select("tree", "n", "idx", "hash"), arity)
    upper = stored(numbered(tops.select(
        F.lit("").alias("whole"), F.col("tree").alias("name"), "hash", "height"), "whole", ["name"]), "merkle-subroots")
    upper_levels, root = _climb(upper.select(F.col("whole").alias("tree"), "n", "idx", "hash"), arity)
    empty = F.array().cast(PATH)
    upper_paths = _descend(upper_levels, root.select("tree", "height", empty.alias("path")), arity)
    subroots = stored(
        upper.join(upper_paths.drop("tree"), "idx").join(root.select(F.col("tree").alias("whole"), F.col("hash").alias("root")), "whole")
        .select(F.col("name").alias("tree"), "height", F.col("hash").alias("subroot"), "root", "path"), "merkle-roots")
    paths = _descend(levels, subroots.select("tree", "height", "path"), arity)
    return (placed.join(paths, ["tree", "idx"]).join(subroots.select("tree", "subroot", "root"), "tree")
            .select(F.expr("IF(tree = '', NULL, substr(tree, 2))").alias(group), F.col("key").alias(order),
                    F.col("hash").alias("leaf"), "n", "idx", "subroot", "root", "path",
                    *[F.col(f"also{i}").alias(name) for i, name in enumerate(also)]))
