"""Merkle manifest of a dataset: one digest per row, a tree per part, one root, and proofs.

A row's digest is taken over chosen columns. The rows of a part ascend by an order column, and
every ``fanout`` consecutive ones become one parent, until one node is left: the part's
subroot. The subroots, in the order of their parts, make the root in the same way.

Each level is one aggregation: conditional aggregates spread the children of a parent into
``fanout`` columns, and the columns joined are what is hashed. The siblings of a child are the
same columns without its own. Proofs are made from the root down: the parents of a level are
joined with their own paths and each gives its children theirs, so that a level moves one row
for ``fanout`` rows of the next and no row is joined with every level.

Places within a part are running numbers of a range-sorted table, by the rows of each sorted
slice before, so that no part is gathered anywhere, however large it is.

A null in a column of the digest is written ``-``, a null part is a part of its own and comes
first, a null in the order column comes first. Rows that tie are ordered by their digest, and
equal digests may trade places without a change. Rows equal in everything are rows of their
own. Texts are hashed whole, whatever their length; an empty one is ``0:``. A table without
rows has no nodes and no root. Only chosen columns are read, so other names are free.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableship.llm.common import staged

FANOUT = 8


@dataclass(frozen=True)
class Tree:
    """``levels[k]`` has the parents of level ``k`` nodes: ``key`` of the part, ``pos``, ``n``
    (nodes of that part on the parents' level), ``digest``, the children's digests ``c0``, ``c1``
    and so on and, for leaves, what they carry in ``r0``, ``r1`` and so on.
    ``roots`` has ``key``, ``depth`` (levels above its leaves), ``digest`` and ``carried`` (of
    parts with a single leaf)."""

    fanout: int
    levels: list[DataFrame]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    """``parts``: one tree per part; ``top``: the tree over the subroots; ``subroots``: ``part``,
    ``n_rows``, ``subroot``; ``root``: one row ``root``, null for no rows."""

    parts: Tree
    top: Tree
    subroots: DataFrame
    root: DataFrame


def leaf_digest(*values: Column) -> Column:
    """Hex SHA-256 of the values one after the other, each as its number of bytes, a colon and
    its text; ``-`` for null."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, values)), 256)


def build(
    docs: DataFrame,
    digest: Column,
    part: Column,
    order: Column,
    carried: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> Manifest:
    """The manifest of ``docs``. ``digest`` is the digest of a row; ``carried`` are values that
    come back with its proof. The table is read once."""
    values = [value.alias(name) for name, value in (carried or {}).items()]
    leaves = docs.select(
        part.alias("part"),
        order.alias("place"),
        digest.alias("digest"),
        F.struct(digest.alias("leaf"), *values).alias("carried"),
    )
    placed = _placed(staged(leaves, "merkle-leaves"), ["place", "digest"])
    parts = _tree(placed, fanout)
    keys = placed.where("pos = 0").select("part", "key", F.col("n").alias("n_rows"))
    subroots = staged(keys.join(parts.roots.select("key", "digest"), "key"), "merkle-subroots")
    nodes = subroots.select(
        F.lit(0).alias("part"), "digest", F.col("key").alias("place"), F.struct("key").alias("carried")
    )
    top = _tree(_placed(nodes, ["place"]), fanout)
    return Manifest(
        parts,
        top,
        subroots.select("part", "n_rows", F.col("digest").alias("subroot")),
        top.roots.agg(F.max("digest").alias("root")),
    )


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: what it carries, ``subroot``, ``root`` and ``path``, the siblings level by
    level up to the root, each level as the digests ``before`` and ``after`` the own one."""
    root = manifest.top.roots.select("key", "depth", F.col("digest").alias("root"))
    start = root.withColumn("path", F.array().cast("array<struct<before:string,after:string>>"))
    tops = _paths(manifest.top, start, ["root"]).select(
        F.col("carried")["key"].alias("key"), "root", "path"
    )
    subroots = manifest.parts.roots.select(
        "key", "depth", F.col("digest").alias("subroot"), "carried"
    )
    found = _paths(manifest.parts, subroots.join(tops, "key"), ["subroot", "root"])
    return found.select("carried.*", "subroot", "root", "path")


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and the siblings of its path lead to."""
    return F.aggregate(
        path, digest, lambda x, level: F.sha2(F.concat(level["before"], x, level["after"]), 256)
    )


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level and left to right."""
    shown = F.transform(path, lambda level: F.concat(level["before"], level["after"]))
    return F.sha2(F.array_join(shown, ""), 256)


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (with a ``part``) and ``key``, a number of the part that ascends as the parts
    do, ``pos`` of the row within it, from 0, and ``n``, the number of its rows."""
    keys = ["part", *order]
    # The running number cuts equal rows apart, however many there are.
    numbered = nodes.withColumn("row_no", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*keys, "row_no").sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    ordered = staged(ranged.drop("row_no").withColumn("at", at), "merkle-order")
    ordered = ordered.withColumn("slice", F.shiftright("at", 33))
    of_part = Window.partitionBy("part")
    before = of_part.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each slice and part.
    slices = ordered.groupBy("part", "slice").agg(
        F.min("at").alias("first"), F.count("*").alias("rows")
    )
    slices = staged(
        slices.select(
            F.col("part").alias("its_part"),
            F.col("slice").alias("its_slice"),
            "first",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
            F.sum("rows").over(of_part).alias("n"),
            F.min("first").over(of_part).alias("key"),
        ),
        "merkle-slices",
    )
    same = F.col("part").eqNullSafe(F.col("its_part")) & (F.col("slice") == F.col("its_slice"))
    return ordered.join(slices, same).select(
        *nodes.columns, "key", (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "n"
    )


def _tree(leaves: DataFrame, fanout: int) -> Tree:
    nodes = leaves.select("key", "pos", "n", "digest", "carried")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    kind = nodes.schema["carried"].dataType
    no_rows = [F.lit(None).cast(kind).alias("carried")]
    single = nodes.where("n = 1").select("key", F.lit(0).alias("depth"), "digest", "carried")
    levels, roots = [], single
    while largest > 1:
        parents = staged(_pivot(nodes.where("n > 1"), fanout), "merkle-level")
        levels.append(parents)
        largest = -(-largest // fanout)
        nodes = parents.select("key", "pos", "n", "digest")
        done = nodes.where("n = 1").select("key", F.lit(len(levels)).alias("depth"), "digest", *no_rows)
        roots = roots.unionByName(done)
    return Tree(fanout, levels, staged(roots, "merkle-roots"))


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """Parents of a level, the children of each in columns."""
    slots = range(fanout)
    own = [F.col("pos") % fanout == k for k in slots]
    spread = [F.max(F.when(own[k], F.col("digest"))).alias(f"c{k}") for k in slots]
    if "carried" in nodes.columns:
        spread += [F.any_value(F.when(own[k], F.col("carried")), True).alias(f"r{k}") for k in slots]
    above = F.expr(f"pos DIV {fanout}")
    parents = nodes.groupBy("key", above.alias("pos")).agg(F.max("n").alias("n"), *spread)
    # Missing children of the last parent are null and left out.
    digest = F.sha2(F.concat_ws("", *(f"c{k}" for k in slots)), 256)
    return parents.withColumn("n", F.expr(f"(n + {fanout - 1}) DIV {fanout}")).withColumn("digest", digest)


def _paths(tree: Tree, roots: DataFrame, passed: list[str]) -> DataFrame:
    """``carried`` and ``path`` of every leaf, and the columns ``passed`` of its root. ``roots`` have
    ``key``, ``depth``, these columns and the path from the root of this tree on."""
    wanted = [*passed, "path"]
    if "carried" not in roots.columns:
        roots = roots.join(tree.roots.select("key", "carried"), "key")
    roots = roots.withColumn("pos", F.lit(0).cast("long"))
    found = roots.where("depth = 0").select("carried", *wanted)
    nodes = None
    for depth in range(len(tree.levels), 0, -1):
        here = roots.where(F.col("depth") == depth).select("key", "pos", *wanted)
        nodes = here if nodes is None else nodes.unionByName(here)
        children = _children(tree, tree.levels[depth - 1].join(nodes, ["key", "pos"]), depth == 1)
        child = children.select("key", "pos", *wanted, "child.*")
        nodes = child.select(
            "key",
            (F.col("pos") * tree.fanout + F.col("slot")).alias("pos"),
            *passed,
            F.concat(F.array(F.struct("before", "after")), F.col("path")).alias("path"),
            *(["carried"] if depth == 1 else []),
        )
    return found if nodes is None else found.unionByName(nodes.select("carried", *wanted))


def _children(tree: Tree, parents: DataFrame, leaves: bool) -> DataFrame:
    slots = range(tree.fanout)

    def siblings(ks) -> Column:
        return F.concat_ws("", *(f"c{k}" for k in ks)) if ks else F.lit("")

    entries = [
        F.struct(
            F.lit(k).alias("slot"),
            F.col(f"c{k}").alias("digest"),
            siblings(slots[:k]).alias("before"),
            siblings(slots[k + 1 :]).alias("after"),
            *([F.col(f"r{k}").alias("carried")] if leaves else []),
        )
        for k in slots
    ]
    child = F.explode(F.filter(F.array(*entries), lambda c: c["digest"].isNotNull()))
    return parents.withColumn("child", child)
