"""Operator 11: prefix trie of conversations, as adaptive radix trees over fixed-width big-endian turn ids.

Every distinct (role, text) has one integer id (`naming`), written in WIDTH big-endian bytes, so a conversation
is a byte key whose order is the trie's order. The keys are range-partitioned: each range of neighbouring keys
is a connected piece of the trie and is built as one radix tree inside a task, where only byte depths that are a
multiple of WIDTH are nodes of the trie. Texts never leave the first scan: a turn travels as id and length.

A range shares only prefixes of its first key (with the range before) and of its last key (with the one behind).
Those nodes go out as partial rows, and their counts are sums over ranges because each range knows the last key
before it: a node or a leaf counts where it first stands, and a key that goes on from the last key before takes
back the leaf counted there. So a first turn or a whole conversation that a third of all rows share is spread
over as many ranges as it has rows for, and meets again as one partial row of each.

Order and rebuilding: turns go by turn (null first), then role, then text; null role or text is empty. c % 100
and crc32(decimal c) % 6 have the sign of SQL's remainder. A conversation without turns ends at the root.

Defined cases: rows with a null conv_id belong to no conversation and are left out; repeated rows are turns of
their own; an empty table has no members, so no root and an empty result; other columns are ignored. The turn
ids of one conversation are held in one row (12 bytes a turn), its texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlens.llm.common import materialise, table
from trendlens.llm.naming import clashes, integer_names, with_twin
from trendlens.llm.radix_tree import RadixTree

WIDTH = 8
FAMILY = 100                # conversation c takes its first turns from c - c % FAMILY
HEADS = 6                   # and so many of them at most, less one
RANGE_TURNS = 50_000        # turns in a range of keys, about
ROWS_OUT = 10_000           # rows in an Arrow batch that a task gives back


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, tie, digest, twin, chars: a narrow row for every turn. `tie` holds role and text of turns that
    share their place with another one, `twin` those whose digest stands for several contents."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    content = F.to_json(F.struct("role", "text")).cast("binary")
    digest = F.xxhash64("role", "text").alias("digest")
    clash = clashes(rows.select(digest, F.struct("role", "text").alias("content")))
    shared = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(shared.select("conv_id", "turn", F.lit(True).alias("shared")), "shared-places")
    place = (rows["conv_id"] == shared["conv_id"]) & rows["turn"].eqNullSafe(shared["turn"])
    rows = rows.join(shared, place, "left").select(rows["conv_id"], rows["turn"], "role", "text", "shared", digest)
    rows = with_twin(rows, clash, content)
    return materialise(rows.select("conv_id", "turn", F.when(F.col("shared"), F.struct("role", "text")).alias("tie"),
                                   "digest", "twin", F.length("text").alias("chars")), "turns")


def originals(turns: DataFrame) -> DataFrame:
    """conv_id, steps: the (id, chars) of every conversation's turns, in order."""
    names = integer_names(turns.select("digest", "twin"), "id", "turn-ids")
    row = F.struct("turn", "tie", "id", "chars")
    got = turns.join(names, ["digest", "twin"]).groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return materialise(got.select("conv_id", F.transform("rows", lambda r: F.struct(r["id"].alias("id"), r["chars"].alias("chars"))).alias("steps")), "conversation-ids")


def rebuilt(own: DataFrame) -> DataFrame:
    """conv_id, key, chars: each conversation's rebuilt turns, as a byte key and the turns' lengths."""
    heads = own.select(F.col("conv_id").alias("base"), F.slice("steps", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    rows = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", h).join(heads, "base", "left")
    rest = F.slice("steps", F.col("h") + 1, F.greatest(F.size("steps") - F.col("h"), F.lit(0)))
    front = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("steps", 1, 0))
    rows = rows.select("conv_id", F.concat(front, rest).alias("steps"))
    return rows.select("conv_id", byte_key(F.col("steps.id")).alias("key"), F.col("steps.chars").alias("chars"))


def byte_key(ids: Column) -> Column:
    return F.unhex(F.array_join(F.transform(ids, lambda x: F.lpad(F.hex(x), 2 * WIDTH, F.lit("0"))), ""))


def in_ranges(keys: DataFrame, range_turns: int) -> DataFrame:
    """part, conv_id, key, chars, and a marker row (null conv_id) of each part with the last key before it."""
    total = keys.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    parts = max(1, -(-total // range_turns))
    rows = keys.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id())
    rows = materialise(rows.select("part", "conv_id", "key", "chars"), "key-ranges")
    last = rows.groupBy("part").agg(F.max("key").alias("key"))
    before = last.select("part", F.lag("key").over(Window.orderBy("part")).alias("key"))       # one row a range
    marks = before.select("part", F.lit(None).cast("long").alias("conv_id"), "key", F.lit(None).cast("array<int>").alias("chars"))
    both = rows.unionByName(marks)
    return both.repartition(parts, "part").sortWithinPartitions("part", F.asc_nulls_first("conv_id"))


FIELDS = [("open", pa.binary()), ("part", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
          ("parent_open", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
          ("saved_tokens", pa.int64()), ("ends", pa.string()), ("ends_sha256", pa.string())]
SCHEMA = ("open binary, part int, conv_id long, depth long, parent_conv_id long, parent_open binary, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends string, ends_sha256 string")


def digests(key: bytes, depth: int) -> list[bytes]:
    """Digest of every prefix of 0 to `depth` turns."""
    running, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(running.digest())
        running.update(key[d * WIDTH:(d + 1) * WIDTH])
    return out


def shared_turns(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid * WIDTH] == b[:mid * WIDTH] else (low, mid - 1)
    return low


class Piece:
    """The trie nodes of one range of keys."""

    def __init__(self, part: int, before: bytes | None, convs: list[tuple[int, bytes, list[int]]]):
        self.part, self.rows = part, []
        self.chars = {key: chars for _, key, chars in convs}
        tree = RadixTree()
        for conv, key, _ in convs:
            tree.insert(key, (conv, key))
        first, last = min(self.chars), max(self.chars)
        # prefixes of `first` up to `old` turns stand in the range before; prefixes of `last` may go on behind
        self.old = shared_turns(before, first) if before is not None else -1
        self.continued = before is not None and first.startswith(before)
        self.first, self.last = first, last
        self.left, self.right = digests(first, max(self.old, 0)), digests(last, len(last) // WIDTH)
        self.old_end = len(before) // WIDTH if self.continued else -1
        self.visit(tree.root)

    def visit(self, root) -> None:
        """Children before parents, without recursion. What stands below a byte depth is a summary:
        [members, least member, nodes waiting for their parent, of them new, leaves, saved, a key]."""
        results, stack = {}, [(root, 0, False)]
        while stack:
            node, start, seen = stack.pop()
            if not seen:
                stack.append((node, start, True))
                stack.extend((child, start + len(node.path) + 1, False) for _, child in node.items())
                continue
            at = start + len(node.path)
            got = self.joined([results.pop(id(child)) for _, child in node.items()], node.values)
            low = 0 if node is root else start - 1          # byte depth of the parent, which is not of this node
            depth = at // WIDTH
            spans = min(self.old, shared_turns(got[6], self.first)), shared_turns(got[6], self.last)
            while depth * WIDTH > low or (depth == 0 and node is root):
                got = self.emit(got, depth, spans, [c for c, _ in node.values] if depth * WIDTH == at else [])
                depth -= 1
            results[id(node)] = got

    @staticmethod
    def joined(parts: list, values: list) -> list:
        if len(parts) == 1 and not values:
            return parts[0]
        convs = [p[1] for p in parts] + [c for c, _ in values]
        waiting = [i for p in parts for i in p[2]]
        return [sum(p[0] for p in parts) + len(values), min(convs), waiting, sum(p[3] for p in parts), sum(p[4] for p in parts),
                sum(p[5] for p in parts), parts[0][6] if parts else values[0][1]]

    def emit(self, got: list, depth: int, spans: tuple[int, int], ends: list[int]) -> list:
        """The row of a trie node, and the summary that its parent sees. spans: the turns that the node's path
        shares with the range before, and with the range's last key."""
        members, least, waiting, new, leaves, saved, key = got
        on_left, on_right = depth <= spans[0], depth <= spans[1]
        if not waiting:
            leaves = 0 if on_left else 1
        elif on_left and depth == self.old_end:
            leaves -= 1                                     # the range before took its last key for a leaf
        length = self.chars[key][depth - 1] if depth else 0
        saved += members * length - (0 if on_left else length)
        open_ = self.left[depth] if on_left else self.right[depth] if on_right else None
        text = ",".join(map(str, sorted(ends)))
        row = [open_, self.part, least, depth, None, None, members, new, leaves, saved,
               text if open_ and ends else None, None if open_ else hashlib.sha256(text.encode()).hexdigest()]
        for i in waiting:
            self.rows[i][4 if open_ is None else 5] = least if open_ is None else open_
        self.rows.append(row)
        return [members, least, [len(self.rows) - 1], 0 if on_left else 1, leaves, saved, key]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before, convs = None, None, []

    def built():
        rows = Piece(part, before, convs).rows if convs else []
        for low in range(0, len(rows), ROWS_OUT):
            cols = zip(*rows[low:low + ROWS_OUT], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, FIELDS, strict=True)], [n for n, _ in FIELDS])

    for batch in batches:
        for at, conv, key, chars in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if at != part:
                yield from built()
                part, before, convs = at, None, []
            if conv is None:
                before = key
            else:
                convs.append((conv, key, chars))
    yield from built()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces of text, in order, comma-joined; a node's rows are neighbours."""
    node, running, some = None, None, False

    def row():
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], ["open", "ends_sha256"])

    for batch in batches:
        for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if at != node:
                if node is not None:
                    yield row()
                node, running, some = at, hashlib.sha256(), False
            if text is not None:
                running.update(("," if some else "").encode() + text.encode())
                some = True
    if node is not None:
        yield row()


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """One row per trie node of the rebuilt conversations (columns OUT)."""
    keys = materialise(rebuilt(originals(turns_of(conversations))), "conversation-keys")
    return trie_of_keys(keys, range_turns)


def trie_of_keys(keys: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """The trie of conv_id, key (WIDTH bytes a turn), chars (an int a turn). conv_ids are distinct."""
    ranges = in_ranges(keys, range_turns).select("part", "conv_id", "key", "chars")
    found = materialise(ranges.mapInArrow(_pieces, SCHEMA), "trie-pieces")
    partial = found.where("open is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    hashed = (partial.select("open", "ends", "part").repartition("open").sortWithinPartitions("open", "part")
              .select("open", "ends").mapInArrow(_hashed, "open binary, ends_sha256 string"))
    whole = partial.groupBy("open").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_open").alias("parent_open"), *sums)
    whole = materialise(whole.join(hashed, "open"), "trie-shared-nodes")
    inner = found.where("open is null").select("conv_id", "depth", "parent_conv_id", "parent_open", *OUT[3:])
    outer = whole.select("conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "parent_open", *OUT[3:])
    parents = whole.select(F.col("open").alias("parent_open"), F.col("conv_id").alias("open_parent"))
    rows = inner.unionByName(outer).join(parents, "parent_open", "left")
    return rows.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "open_parent")).select(*OUT)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# crc32 in SQL: every digit is xored in, then eight shifts (marked -1) follow it
OP11_SQL = """
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS steps
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
steps_of AS (
  SELECT conv_id, steps, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(conv_id::VARCHAR, ''), lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, 3988292384 * (a % 2)) END)) % 6 AS h
  FROM own),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(list_slice(b.steps, 1, s.h), []), list_slice(s.steps, s.h + 1, len(s.steps))) AS steps
  FROM steps_of s LEFT JOIN own b ON b.conv_id = s.base),
prefixes AS (
  SELECT conv_id, d, list_slice(steps, 1, d) AS seq, d = len(steps) AS ends, CASE WHEN d > 0 THEN steps[d].text ELSE '' END AS last
  FROM (SELECT *, unnest(range(len(steps) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT seq, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(length(last)) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY seq),
kids AS (SELECT list_slice(seq, 1, depth - 1) AS seq, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.seq = n.seq),
below AS (
  SELECT list_slice(seq, 1, up) AS seq, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON b.seq = n.seq
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.seq = list_slice(n.seq, 1, n.depth - 1)
"""
