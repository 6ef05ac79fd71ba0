"""Embedding near-dedup: cover trees and a dual traversal give the exact links.

Unit vectors with cosine >= c lie within distance sqrt(2 - 2c). A cover tree nests
levels of centres with halving radii: every centre of a level is also one of the
next, and every point of a node lies within the node's radius of its centre. Two
trees are walked together; for each pair of nodes the distance of their centres and
the true covering radii decide:

* too far apart for any link: the pair is pruned;
* so close that every pair is linked: it is counted as a whole;
* otherwise the children of both are paired.

Only near the threshold, within rounding, are cosines computed from the vectors
themselves. A task returns the number of links of each of its points and a few
edges that span the components, never the pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import written
from basketlens.llm.components import components

COSINE = 0.98
#: Vectors of a block.
BLOCK_ROWS = 1024
#: Sign bits by which a label's vectors are put into blocks of similar direction.
CODE_BITS = 12
#: Distances are trusted to this; closer calls are decided by the cosine itself.
SLACK = 1e-7
#: Radius below which a node is not split further.
LEAST_RADIUS = 1e-9


@dataclass
class Node:
    """``points`` within ``radius`` of ``centre``, all row numbers of the matrix."""

    centre: int
    points: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)
    centres: np.ndarray | None = None
    radii: np.ndarray | None = None


def build(x: np.ndarray) -> Node:
    """Cover tree of unit vectors: levels with radius 2, 1, 1/2, ... (no deeper than needed)."""
    every = np.arange(len(x))
    root = Node(0, every, float(_distances(x, x[:1])[:, 0].max()))
    stack = [(root, 2.0)]
    while stack:
        node, radius = stack.pop()
        while radius >= 2 * node.radius > 0:
            radius /= 2
        if node.radius <= LEAST_RADIUS or len(node.points) == 1:
            continue
        radius /= 2
        rest, centre = node.points, node.centre
        while len(rest):
            near = _distances(x[rest], x[centre:centre + 1])[:, 0]
            inside = near <= radius
            inside |= rest == centre
            node.children.append(Node(centre, rest[inside], float(near[inside].max())))
            rest = rest[~inside]
            centre = rest[0] if len(rest) else -1
        node.centres = np.array([c.centre for c in node.children])
        node.radii = np.array([c.radius for c in node.children])
        stack += [(c, radius) for c in node.children]
    return root


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Links:
    """Weighted link counts and spanning edges over the rows of one or two blocks."""

    def __init__(self, x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, weight_x: np.ndarray, weight_y: np.ndarray, cosine: float):
        self.x, self.y, self.raw_x, self.raw_y, self.weight_x, self.weight_y = x, y, raw_x, raw_y, weight_x, weight_y
        self.cosine, self.limit = cosine, float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        self.count_x, self.count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        self.root = np.arange(len(x) + len(y))
        self.edges: list[tuple[int, int]] = []

    def top(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.top(i), self.top(j)
        if a != b:
            self.root[max(a, b)] = min(a, b)
            self.edges.append((i, j))

    def linked(self, i: int, j: int) -> bool:
        a, b = self.raw_x[i], self.raw_y[j]
        return float(np.dot(a, b)) / (float(np.sqrt(np.dot(a, a))) * float(np.sqrt(np.dot(b, b)))) >= self.cosine

    def all_linked(self, one: np.ndarray, two: np.ndarray) -> None:
        """Every row of ``one`` with every row of ``two``."""
        self.count_x[one] += self.weight_y[two].sum()
        self.count_y[two] += self.weight_x[one].sum()
        for j in two.tolist():
            self.join(int(one[0]), len(self.x) + j)
        for i in one[1:].tolist():
            self.join(i, len(self.x) + int(two[0]))

    def walk(self, left: Node, right: Node) -> None:
        """Dual traversal of two different trees."""
        stack = [(left, right)]
        while stack:
            a, b = stack.pop()
            some_a = a.children or [a]
            some_b = b.children or [b]
            at_a = a.centres if a.children else np.array([a.centre])
            at_b = b.centres if b.children else np.array([b.centre])
            span = (a.radii if a.children else np.array([a.radius]))[:, None] + (b.radii if b.children else np.array([b.radius]))[None, :]
            far = _distances(self.x[at_a], self.y[at_b])
            sure = far + span <= self.limit - SLACK
            open_ = (far - span <= self.limit + SLACK) & ~sure
            for i, j in zip(*np.nonzero(sure), strict=True):
                self.all_linked(some_a[i].points, some_b[j].points)
            for i, j in zip(*np.nonzero(open_), strict=True):
                p, q = some_a[i], some_b[j]
                if p.children or q.children:
                    stack.append((p, q))
                else:
                    self.close_call(p.points, q.points)

    def close_call(self, one: np.ndarray, two: np.ndarray) -> None:
        for i in one.tolist():
            for j in two.tolist():
                if self.linked(i, j):
                    self.all_linked(np.array([i]), np.array([j]))

    def within(self, node: Node) -> None:
        """Dual traversal of a tree with itself: every unordered pair once (x is y)."""
        stack = [node]
        while stack:
            a = stack.pop()
            if 2 * a.radius <= self.limit - SLACK and len(a.points) > 1:
                total = self.weight_x[a.points].sum()
                self.count_x[a.points] += total - self.weight_x[a.points]
                for j in a.points[1:].tolist():
                    self.join(int(a.points[0]), len(self.x) + j)
                continue
            if not a.children:
                for k, i in enumerate(a.points.tolist()):
                    self.close_call(np.array([i]), a.points[k + 1:])
                continue
            stack += a.children
            far = _distances(self.x[a.centres], self.x[a.centres])
            near = np.triu(far - (a.radii[:, None] + a.radii[None, :]) <= self.limit + SLACK, 1)
            for i, j in zip(*np.nonzero(near), strict=True):
                p, q = a.children[i], a.children[j]
                if far[i, j] + p.radius + q.radius <= self.limit - SLACK:
                    self.all_linked(p.points, q.points)
                elif p.children or q.children:
                    self.walk(p, q)
                else:
                    self.close_call(p.points, q.points)


def link_blocks(left: pd.DataFrame, right: pd.DataFrame | None, cosine: float) -> pd.DataFrame:
    """Links of two blocks, or within one: a row (node, links, other) for each point
    with links and one for each spanning edge (``other`` not NULL, no links)."""
    raw_x = np.array(left["v"].tolist(), np.float64)
    x = raw_x / np.sqrt((raw_x**2).sum(axis=1))[:, None]
    own = left["node"].to_numpy()
    if right is None:
        links = Links(x, x, raw_x, raw_x, left["weight"].to_numpy(), left["weight"].to_numpy(), cosine)
        links.within(build(x))
        names, counts = np.concatenate([own, own]), np.concatenate([links.count_x, links.count_y])
    else:
        raw_y = np.array(right["v"].tolist(), np.float64)
        y = raw_y / np.sqrt((raw_y**2).sum(axis=1))[:, None]
        links = Links(x, y, raw_x, raw_y, left["weight"].to_numpy(), right["weight"].to_numpy(), cosine)
        links.walk(build(x), build(y))
        names, counts = np.concatenate([own, right["node"].to_numpy()]), np.concatenate([links.count_x, links.count_y])
    some = counts > 0
    edges = np.array(links.edges, np.int64).reshape(-1, 2)
    return pd.DataFrame({"node": np.concatenate([names[some], names[edges[:, 0]]]), "links": np.concatenate([counts[some], np.zeros(len(edges), np.int64)]),
                         "other": pd.array([None] * int(some.sum()) + names[edges[:, 1]].tolist(), dtype="Int64")})


def _blocks(classes: DataFrame) -> DataFrame:
    """``classes`` with ``block``: at most about BLOCK_ROWS vectors of one label whose
    directions agree in the signs of some fixed sums of their components."""
    @F.pandas_udf("int")
    def code(units: pd.Series) -> pd.Series:
        out, widths = np.zeros(len(units), np.int64), units.map(len).to_numpy()
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            directions = np.random.default_rng(int(width)).standard_normal((int(width), CODE_BITS))
            out[rows] = (np.array(units.iloc[rows].tolist(), np.float64) @ directions >= 0) @ (1 << np.arange(CODE_BITS))
        return pd.Series(out)

    coded = classes.withColumn("code", code("unit"))
    per_label = coded.groupBy("label").agg(F.count("*").alias("rows"))
    bits = F.least(F.lit(CODE_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("rows") / BLOCK_ROWS)))).cast("int")
    coded = written(coded.join(per_label, "label").withColumn("code", F.pmod(F.col("code"), F.pow(F.lit(2), bits).cast("int"))).drop("rows"), "coded")
    cells = coded.groupBy("label", "code").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    return coded.join(cells, ["label", "code"]).withColumn("block", F.struct("code", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))).drop("code", "parts")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Rows with equal, non-NULL labels are linked when the cosine of their vectors in
    double precision reaches ``cosine``. n_links counts the other rows linked
    directly, component_id is the smallest vec_id that links reach and ``kept`` marks
    it. Vectors that are NULL, zero, empty or hold a NULL or non-finite component, and
    rows with a NULL label, are linked with nothing. Vectors of different dimension
    are not linked. Equal vectors of a label are one class that counts with its
    number of rows; repeated ids are rows of their own; a row with a NULL id counts
    as a link of others and reaches the smallest id among them. Other columns are not
    read.

    A task holds two blocks of BLOCK_ROWS. Pairs of blocks of a label whose covering
    balls are too far apart are never formed.
    """
    rows = written(vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("name"),
                                  F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v")), "vectors")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = rows.where(F.col("v").isNotNull() & F.col("name").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    grouped = usable.groupBy("name", "v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id"))
    # scaled by the largest component, so that squares neither overflow nor vanish
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()).withColumn("label", F.concat_ws(":", F.size("v"), "name"))
                      .withColumn("top", largest).withColumn("w", F.transform("v", lambda x: x / F.col("top"))).drop("top"), "classes")
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    unit = classes.select("label", "node", "weight", F.col("w").alias("v"), norm.alias("norm")).withColumn("unit", F.transform("v", lambda x: x / F.col("norm")))
    placed = written(_blocks(unit), "blocks")
    keys = ["label", "block"]
    limit = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def ball(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["unit"].tolist(), np.float64)
        centre = x.mean(axis=0)
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "block": pdf["block"].iloc[:1], "centre": [centre.tolist()],
                             "radius": [float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())]})

    balls = written(placed.select(*keys, "unit").withColumn("block", F.to_json("block")).groupBy(*keys)
                    .applyInPandas(ball, "label string, block string, centre array<double>, radius double"), "balls")
    other = balls.select("label", *[F.col(c).alias(f"{c}_2") for c in ("block", "centre", "radius")])
    apart = F.sqrt(F.aggregate(F.zip_with("centre", "centre_2", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))
    pairs = written(balls.join(other, "label").where((F.col("block") <= F.col("block_2")) & (apart <= F.col("radius") + F.col("radius_2") + limit + SLACK))
                    .select("label", F.col("block").alias("one"), F.col("block_2").alias("two")), "pairs")
    data = placed.select("label", F.to_json("block").alias("block"), "node", "weight", "v")
    key = ["label", "one", "two"]
    left = pairs.join(data.withColumnRenamed("block", "one"), ["label", "one"]).withColumn("side", F.lit(0))
    right = pairs.where("one < two").join(data.withColumnRenamed("block", "two"), ["label", "two"]).withColumn("side", F.lit(1))

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf["side"] == 0
        return link_blocks(pdf[first], pdf[~first] if not first.all() else None, cosine)

    found = written(left.unionByName(right).groupBy(*key).applyInPandas(linked, "node bigint, links bigint, other bigint"), "links")
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(edges).withColumnRenamed("id", "node")
    per_class = classes.select("name", "v", "node", "weight", "first_id").join(counts, "node", "left").join(groups, "node", "left")
    per_class = written(per_class.select("name", "v", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                         F.coalesce("component", "node").alias("component"), "first_id"), "per_class")
    smallest = per_class.groupBy("component").agg(F.min("first_id").alias("component_id"))
    own = per_class.join(smallest, "component").select("name", "v", "n_links", "component_id")
    out = rows.join(own, ["name", "v"], "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
