"""Connected components of pairs, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableship.llm.common import staged


class Parts:
    """Connected parts of the pairs a task has seen. They are given out as stars around the
    smallest node of each, so a task gives fewer pairs than it has nodes, and tasks that see
    the same part give the same pairs. ``MOST`` nodes are held at a time."""

    MOST = 1 << 16

    def __init__(self) -> None:
        self._above: dict[int, int] = {}

    def add(self, a: list[int], b: list[int]) -> None:
        for x, y in zip(a, b, strict=True):
            x, y = self._root(x), self._root(y)
            if x != y:
                self._above[max(x, y)] = min(x, y)

    def full(self) -> bool:
        return len(self._above) >= self.MOST

    def stars(self) -> tuple[list[int], list[int]]:
        """All pairs so far, which are then forgotten."""
        pairs = [(self._root(x), x) for x in list(self._above)]
        self._above = {}
        pairs = [(low, x) for low, x in pairs if low != x]
        return [low for low, _ in pairs], [x for _, x in pairs]

    def _root(self, x: int) -> int:
        above = self._above
        up = above.setdefault(x, x)
        while up != x:
            above[x] = above[up]
            x, up = above[x], above[above[x]]
        return x


def contracted(edges: DataFrame) -> DataFrame:
    """Pairs that connect the same nodes, with as few per node as one round gives: a node keeps
    the smallest of its smaller neighbours, and the others are tied to that one. Where many
    tasks give stars of one part around centres of their own, what is left is about one star."""
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    low = F.min("a").over(Window.partitionBy("b"))
    tied = pairs.distinct().select(low.alias("low"), F.explode(F.array("b", "a")).alias("b"))
    return tied.where("low <> b").select(F.col("low").alias("a"), "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for all nodes of
    ``edges`` (columns ``a`` and ``b``, longs).

    Each round gives a node the smallest label among its neighbours and its own, and then the
    label of that label, so long chains shorten fast. Rounds end when none changes; labels are
    written to the shared folder each round. Only counts reach the driver.
    """
    once = staged(contracted(edges), "edges")
    both = once.union(once.select("b", "a"))
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("low")
        )
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("root_label"))
        jumped = hooked.join(roots, hooked["low"] == roots["root"]).select(
            "node", "old", F.least("low", "root_label").alias("label")
        )
        jumped = staged(jumped, "labels")
        if jumped.where("label <> old").isEmpty():
            return jumped.select("node", F.col("label").alias("component"))
        labels = jumped.select("node", "label")
