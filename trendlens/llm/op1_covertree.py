"""Operator 1: embedding near-dedup by dual traversal of cover trees.

On unit vectors cosine >= c is the same as distance <= tau = sqrt(2 - 2c). Equal vectors are one class
(pre-aggregated, so a vector that a third of all rows share is one row). The classes are dealt to
cells, the top nodes of the tree: each goes to its nearest pivot; a cell of more than BLOCK classes is
dealt by hash over several blocks. In each block the lower levels are built once: leaders at
halving radii, each point under the leader that covers it, with the true covering radius of every node.

Block pairs are pruned by the covering bound d(a, b) <= r(a) + r(b) + tau; the rest are tasks that walk the
two trees together: a node pair is dropped by the same bound, taken whole when d + r(a) + r(b) <= tau, and
opened else, down to the points. Candidates come from single precision with a margin; every link
is decided in double precision. A task returns link counts and a spanning forest, never the pairs.

Bounds: at most MAX_PIVOTS pivots, chosen by hash, are on the driver and broadcast; a task holds two
blocks. The number of block pairs that the bound leaves is quadratic where the vectors have no structure.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are their own component; vectors of different lengths never link; repeated vec_ids are
rows of their own, each with its own vector's links; a null vec_id links like any other and is no smallest id
(component_id is null, and the row kept, where a component has no other); an empty table gives an empty result;
other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import Forest, connected_components, materialise, table

COSINE = 0.95
BLOCK = 8192
MAX_PIVOTS = 1024
RADII = (0.5, 0.25, 0.125)      # of the levels in a block
SLACK = 1e-4                    # margin for single precision
CHUNK = 1024


def classes_of(vectors: DataFrame) -> DataFrame:
    """vec_id and key of every row; key is null where the vector can link with nothing."""
    e = F.col("embedding")
    ok = e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    return vectors.select("vec_id", F.when(ok, F.sha2(e.cast("string"), 256)).alias("key"), "embedding")


def units(rows) -> np.ndarray:
    """Unit vectors in double precision; scaling by the largest component avoids overflow."""
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors, in single precision."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a.astype(np.float32) @ b.astype(np.float32).T), 0.0))


def leaders(x: np.ndarray, radius: float) -> np.ndarray:
    """Index of the leader of each point: the nearest of those met so far within the radius, or itself."""
    lead, heads = np.empty(len(x), np.int64), np.empty(0, np.int64)
    for at in range(0, len(x), CHUNK):
        part = np.arange(at, min(at + CHUNK, len(x)))
        best, near = np.full(len(part), -1), np.full(len(part), np.inf)
        if len(heads):
            d = gaps(x[part], x[heads])
            arg = d.argmin(axis=1)
            near = d[np.arange(len(part)), arg]
            best = heads[arg]
        free = part[near > radius]
        lead[part] = best
        if len(free):
            d, new = gaps(x[free], x[free]), []
            for i in range(len(free)):
                if new and d[i, new].min() <= radius:
                    lead[free[i]] = free[new[int(d[i, new].argmin())]]
                else:
                    new.append(i)
                    lead[free[i]] = free[i]
            heads = np.concatenate([heads, free[new]])
    return lead


class Node:
    __slots__ = ("at", "points", "children", "radius")

    def __init__(self, at: int, points: np.ndarray, children: list, radius: float):
        self.at, self.points, self.children, self.radius = at, points, children, radius


def grow(x: np.ndarray, paths: np.ndarray, points: np.ndarray, level: int) -> list[Node]:
    """Nodes of `points` at `level`, from the leaders' columns in `paths`."""
    order = points[np.argsort(paths[points, level], kind="stable")]
    cuts = np.flatnonzero(np.diff(paths[order, level])) + 1
    out = []
    for part in np.split(order, cuts):
        at = int(paths[part[0], level])
        radius = 0.0 if len(part) == 1 else float(gaps(x[part], x[[at]]).max()) + SLACK
        children = grow(x, paths, part, level + 1) if len(part) > 1 and level + 1 < paths.shape[1] else []
        out.append(Node(at, part, children, radius))
    return out


def tree_paths(x: np.ndarray) -> np.ndarray:
    """Per point its leader at each level; finer leaders are chosen under each coarser one."""
    paths = np.empty((len(x), len(RADII)), np.int64)
    paths[:, 0] = leaders(x, RADII[0])
    for level in range(1, len(RADII)):
        paths[:, level] = np.arange(len(x))
        order = np.argsort(paths[:, level - 1], kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(paths[order, level - 1])) + 1):
            if len(part) > 1:
                paths[part, level] = part[leaders(x[part], RADII[level])]
    return paths


class Meeting:
    """Dual traversal of two blocks (or of one with itself)."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, cosine: float):
        self.x, self.weight, self.cosine, self.tau = x, weight, cosine, float(np.sqrt(2 - 2 * cosine))
        self.links, self.forest = np.zeros(len(x), np.int64), Forest(len(x))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """All of a link with all of b (disjoint)."""
        self.links[a] += self.weight[b].sum()
        self.links[b] += self.weight[a].sum()
        for i in (*a.tolist(), *b.tolist()):
            self.forest.union(int(a[0]), i) if i != a[0] else None

    def points(self, a: np.ndarray, b: np.ndarray) -> None:
        same = a is b
        for s in range(0, len(a), CHUNK):
            for t in range(s if same else 0, len(b), CHUNK):
                p, q = a[s:s + CHUNK], b[t:t + CHUNK]
                i, j = np.nonzero(gaps(self.x[p], self.x[q]) <= self.tau + SLACK)
                i, j = p[i], q[j]
                if same and s == t:
                    i, j = i[i < j], j[i < j]
                cos = np.einsum("ij,ij->i", self.x[i], self.x[j])
                i, j = i[cos >= self.cosine], j[cos >= self.cosine]
                np.add.at(self.links, i, self.weight[j])
                np.add.at(self.links, j, self.weight[i])
                for u, v in zip(i.tolist(), j.tolist(), strict=True):
                    self.forest.union(u, v)

    def lists(self, a: list[Node], b: list[Node]) -> None:
        """Every pair of nodes that the bound leaves; a list with itself meets each pair once."""
        same = a is b
        ra, rb = (np.array([n.radius for n in s], np.float32) for s in (a, b))
        xa, xb = (self.x[[n.at for n in s]] for s in (a, b))
        for s in range(0, len(a), CHUNK):
            d = gaps(xa[s:s + CHUNK], xb)
            for i, j in zip(*np.nonzero(d <= ra[s:s + CHUNK, None] + rb[None] + self.tau + SLACK), strict=True):
                if not same or s + i <= j:
                    self.nodes(a[s + i], b[j], float(d[i, j]))

    def nodes(self, a: Node, b: Node, d: float) -> None:
        if a is b:
            if len(a.points) > 1:
                self.lists(a.children, a.children) if a.children else self.points(a.points, a.points)
        elif d + a.radius + b.radius <= self.tau - SLACK:
            self.join(a.points, b.points)
        elif a.children or b.children:
            self.lists(a.children or [a], b.children or [b])
        else:
            self.points(a.points, b.points)


def _meet(cosine: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "rep"], kind="stable")
        x, side, rep = units(pdf["embedding"]), pdf["side"].to_numpy(), pdf["rep"].to_numpy()
        local = {(s, r): i for i, (s, r) in enumerate(zip(side.tolist(), rep.tolist(), strict=True))}
        paths = np.array([[local[s, r] for r in p] for s, p in zip(side.tolist(), pdf["path"], strict=True)])
        meeting = Meeting(x, pdf["n"].to_numpy(), cosine)
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        a = grow(x, paths, left, 0)
        if len(right):
            meeting.lists(a, grow(x, paths, right, 0))
        elif not pdf["other"].any():            # the block with itself
            meeting.lists(a, a)
        root = rep[[meeting.forest.find(i) for i in range(len(x))]]
        some = (meeting.links > 0) | (root != rep)
        return pd.DataFrame({"rep": rep[some], "links": meeting.links[some], "root": root[some]})

    return run


def _paths(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("rep", kind="stable")
    rep = pdf["rep"].to_numpy()
    paths = tree_paths(units(pdf["embedding"]))
    return pdf.assign(path=[rep[p].tolist() for p in paths])[["block", "rep", "n", "embedding", "path"]]


def cells(classes: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """cell and distance of each class: its nearest pivot of the same length, or -1."""
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(pivots):
        by_size.setdefault(len(p), []).append(i)
    at = {k: (np.array(v), units([pivots[i] for i in v])) for k, v in by_size.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            cell, far = np.empty(len(rows), np.int32), np.full(len(rows), 2.0)
            sizes = np.array([len(r) for r in rows])
            for k in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == k)
                cell[here] = -k
                if k in at:
                    d = gaps(units([rows[i] for i in here]), at[k][1])
                    cell[here] = at[k][0][d.argmin(axis=1)]
                    far[here] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], ["rep", "n", "embedding", "cell", "far"])

    return classes.select("rep", "n", "embedding").mapInArrow(run, "rep long, n long, embedding array<double>, cell int, far double")


def link_classes(classes: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(rep, links, root): partial link counts and forest edges, from every pair of blocks that may hold links."""
    spark = classes.sparkSession
    n = classes.count()
    wanted = min(MAX_PIVOTS, max(1, -(-n // block)))
    pivots = [r.embedding for r in classes.orderBy(F.xxhash64("rep"), "rep").limit(wanted).select("embedding").collect()]
    placed = materialise(cells(classes, pivots), "cover-cells")
    stats = placed.groupBy("cell", F.size("embedding").alias("dim")).agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    blocks, first, subs = [], {}, {}
    for s in sorted(stats):
        first[s.cell], subs[s.cell] = len(blocks), -(-s.n // block)
        blocks += [(s.cell, s.dim, s.far)] * subs[s.cell]
    known = units(pivots) if len({len(p) for p in pivots}) == 1 else None
    tau = float(np.sqrt(2 - 2 * cosine))
    pairs = []
    for i, (ci, di, ri) in enumerate(blocks):
        for j in range(i, len(blocks)):
            cj, dj, rj = blocks[j]
            if di == dj and (ci == cj or min(ci, cj) < 0 or known is None or gaps(known[[ci]], known[[cj]])[0, 0] <= ri + rj + tau + SLACK):
                pairs += [(i, i * len(blocks) + j, 0, i != j)]
                if i != j:
                    pairs += [(j, i * len(blocks) + j, 1, True)]
    if not pairs:
        return spark.createDataFrame([], "rep long, links long, root long")
    starts = spark.createDataFrame([(c, first[c], subs[c]) for c in first], "cell int, first int, subs int")     # one row a cell
    dealt = placed.join(F.broadcast(starts), "cell").withColumn("block", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("subs")).cast("int"))
    trees = materialise(dealt.select("block", "rep", "n", "embedding").groupBy("block")
                        .applyInPandas(_paths, "block int, rep long, n long, embedding array<double>, path array<long>"), "cover-trees")
    to = spark.createDataFrame(pairs, "block int, pair long, side int, other boolean")
    return trees.join(to, "block").groupBy("pair").applyInPandas(_meet(cosine), "rep long, links long, root long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row. Classes go by numbers of their own; ids come in at the end."""
    rows = classes_of(vectors)
    classes = materialise(rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("embedding").cast("array<double>").alias("embedding"))
        .withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    found = materialise(link_classes(classes, cosine, block), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = connected_components(found, "rep", "root").select(F.col("node").alias("rep"), "component")
    of_class = classes.select("key", "rep", "low", "n").join(counts, "rep", "left").join(groups, "rep", "left")
    of_class = materialise(of_class.select("key", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                                           F.coalesce("component", "rep").alias("component")), "vector-components")
    lowest = materialise(of_class.groupBy("component").agg(F.min("low").alias("component_id")), "vector-lowest")
    of_class = of_class.join(lowest, "component").select("key", "links", "component_id", F.lit(True).alias("linked"))
    own = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (rows.select("vec_id", "key").join(of_class, "key", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op1_cover_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT x.a, l.b FROM reach x JOIN links l ON l.a = x.b),
low AS (SELECT x.a, min(v.vec_id) AS component_id FROM reach x JOIN v ON v.r = x.b GROUP BY x.a)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.r) AS n_links, low.component_id, v.vec_id IS NOT DISTINCT FROM low.component_id AS kept
FROM v JOIN low ON low.a = v.r
"""
