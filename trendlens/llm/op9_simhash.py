"""Operator 9: SimHash near-dedup with BK-trees.

Fingerprint: ASCII lower case, words between ASCII white space, shingles of three words (repeats
included), XXH64 with seed 42 of each; a bit is set when over half of the hashes have it.

Links (at most RADIUS differing bits) are found with BK-trees over the distinct fingerprints:

- The top levels of the tree are laid over the cluster. All nodes of a level share one fixed pivot,
  and the edge to a subtree is the integer distance to that pivot. A subtree is a shard; a
  fingerprint is sent along the edges within RADIUS of its own distance only (and, as links are
  symmetric, only to shards at or after its own). A shard too large for one tree is dealt by hash
  over several, and its queries go to each of them.
- Each shard builds a local BK-tree (children keyed by their distance to the parent) of at most
  about CAP nodes and streams its queries through it in blocks, following only edges within RADIUS.

Trees reach their queries by a shuffle and not by a broadcast, as a broadcast would bring the
fingerprints of all documents to the driver. Every tree returns a spanning forest of its links, never
the pairs themselves, and components come from connected_components.

Defined cases: a null, empty or blank text has fingerprint zero, linked like any other; a null doc_id
takes no part in the choice of a component id (a group of null ids alone has a null one); repeated
rows get a row each; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import Forest, connected_components, materialise, table, text_batches

SHINGLE = 3
RADIUS = 2
SEED = 42
CAP = 1 << 15                   # nodes of one local tree, about
BLOCK = 512                     # queries in one pass through a tree
SHARE = 0.1                     # of all fingerprints at the commonest distance to a pivot, about
MAX_LEVELS = 3
BITS = 64
PIVOTS = tuple((0x9E3779B97F4A7C15 * (2 * i + 1) + (1 << 63)) % (1 << 64) - (1 << 63) for i in range(MAX_LEVELS))


def simhash(text: str, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = text.encode().lower().split()       # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends[:-1]]
    spans = zip(starts, ends[size - 1:], strict=False) if len(words) >= size else ((0, len(line)),)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py() or "", size) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return text_batches(docs).select("doc_id", "text").mapInArrow(rows, "doc_id long, fp long")


class BKTree:
    """Nodes are rows of `points`; child[node, d] is the child at distance d, or -1."""

    def __init__(self, points: np.ndarray):
        self.points = points
        values = points.tolist()
        child: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            node, v = 0, values[i]
            while True:
                d = (v ^ values[node]).bit_count()
                below = child[node].get(d)
                if below is None:
                    child[node][d] = i
                    break
                node = below
        self.child = np.full((len(values), BITS + 1), -1, np.int32)
        for i, edges in enumerate(child):
            for d, j in edges.items():
                self.child[i, d] = j

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (query, node) at most `radius` bits apart."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int32)
        found_q, found_node = [], []
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.points[node]).astype(np.int16)
            hit = d <= radius
            found_q.append(q[hit])
            found_node.append(node[hit])
            next_q, next_node = [], []
            for step in range(-radius, radius + 1):
                edge = d + step
                below = self.child[node, np.clip(edge, 0, BITS)]
                go = (below >= 0) & (edge >= 0) & (edge <= BITS)
                next_q.append(q[go])
                next_node.append(below[go])
            q, node = np.concatenate(next_q), np.concatenate(next_node)
        return np.concatenate(found_q), np.concatenate(found_node)


class Shard:
    """One local tree: links among its nodes, and links from queries to its nodes."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, radius: int):
        self.tree, self.ids, self.radius, self.forest = BKTree(points), ids, radius, Forest(len(points))
        for at in range(0, len(points), BLOCK):
            q, node = self.tree.within(points[at:at + BLOCK], radius)
            for a, b in zip((q + at).tolist(), node.tolist(), strict=True):
                if a != b:
                    self.forest.union(a, b)

    def ask(self, points: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
        """One link per query that has any; other nodes it meets are united with the first."""
        links = []
        for at in range(0, len(points), BLOCK):
            first: dict[int, int] = {}
            for a, b in zip(*(x.tolist() for x in self.tree.within(points[at:at + BLOCK], self.radius)), strict=True):
                if a in first:
                    self.forest.union(first[a], b)
                else:
                    first[a] = b
            links += [(int(ids[at + a]), int(self.ids[b])) for a, b in first.items()]
        return links

    def own(self) -> list[tuple[int, int]]:
        roots = [self.forest.find(i) for i in range(len(self.ids))]
        return [(int(self.ids[i]), int(self.ids[r])) for i, r in enumerate(roots) if i != r]


def _edges(radius: int):
    """Rows sorted by shard, nodes before queries -> links. A shard's queries are streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        key, nodes, shard = None, [], None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]       # path, sub, role, fp, rep
            group = np.stack([cols[0], cols[1].astype(np.int64), cols[2].astype(np.int64)], axis=1)
            cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist(), len(group)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                here, role = (int(group[i, 0]), int(group[i, 1])), group[i, 2]
                points, ids = cols[3][i:j].view(np.uint64), cols[4][i:j]
                if here != key:
                    if key is not None:
                        yield out((shard or _shard(nodes, radius)).own())
                    key, nodes, shard = here, [], None
                if role == 0:
                    nodes.append((points, ids))
                else:
                    shard = shard or _shard(nodes, radius)
                    yield out(shard.ask(points, ids))
        if key is not None:
            yield out((shard or _shard(nodes, radius)).own())

    return run


def _shard(nodes: list[tuple[np.ndarray, np.ndarray]], radius: int) -> Shard:
    points, ids = (np.concatenate([x[i] for x in nodes]) if nodes else np.zeros(0, t) for i, t in enumerate((np.uint64, np.int64)))
    order = np.argsort(points, kind="stable")       # the same tree whatever the order of arrival
    order = np.random.default_rng(SEED).permutation(order)
    return Shard(points[order], ids[order], radius)


def link_fingerprints(classes: DataFrame, radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """Links (a, b) between the representatives of distinct fingerprints (fp, rep): a spanning
    forest of all links within each shard, and a link for each query that meets a shard."""
    n = classes.count()
    levels = 0
    while levels < MAX_LEVELS and n * SHARE ** levels > cap:
        levels += 1
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(PIVOTS[i]))) for i in range(levels)]
    weights = [(BITS + 1) ** (levels - 1 - i) for i in range(levels)]
    path = sum((d.cast("long") * w for d, w in zip(distances, weights, strict=True)), F.lit(0).cast("long"))
    nodes = classes.withColumn("path", path)
    sizes = nodes.groupBy("path").agg(F.ceil(F.count("*") / cap).cast("int").alias("subs"))
    nodes = nodes.join(sizes, "path").withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
    cols = ["path", "sub", "role", "fp", "rep"]
    trees = nodes.withColumn("role", F.lit(0)).select(cols)
    siblings = (nodes.where("sub + 1 < subs").withColumn("sub", F.explode(F.sequence(F.col("sub") + 1, F.col("subs") - 1)))
                .withColumn("role", F.lit(1)).select(cols))
    rows = trees.unionByName(siblings)
    if levels:
        steps = [s for s in product(range(-radius, radius + 1), repeat=levels) if s > (0,) * levels]
        edges = F.array(*[F.struct(*[F.lit(x).alias(f"s{i}") for i, x in enumerate(s)]) for s in steps])
        sent = classes.withColumn("edge", F.explode(edges)).withColumn("to", F.lit(0).cast("long"))
        for i, (d, w) in enumerate(zip(distances, weights, strict=True)):
            at = d + F.col(f"edge.s{i}")
            sent = sent.where((at >= 0) & (at <= BITS)).withColumn("to", F.col("to") + at.cast("long") * w)
        sent = sent.join(sizes.withColumnRenamed("path", "to"), "to")
        rows = rows.unionByName(sent.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
                                .select(F.col("to").alias("path"), "sub", F.lit(1).alias("role"), "fp", "rep"))
    rows = rows.repartition("path", "sub").sortWithinPartitions("path", "sub", "role", "fp")
    return rows.mapInArrow(_edges(radius), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id for every row of `docs`."""
    fps = materialise(fingerprints(docs, size), "simhash")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    known = classes.where("rep is not null")
    links = link_fingerprints(known, radius)
    groups = connected_components(links, "a", "b")
    of_class = classes.join(groups, classes["rep"] == groups["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(of_class, "fp", "left").select("doc_id", "fp", "component_id")


def op9_simhash_bktrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
