"""Operator 13: exact dedup by deterministic block naming, in DataFrame functions only.

A text is cut into blocks of BLOCK_BYTES bytes. Equal blocks get one integer name (`naming`: sorted and
numbered, decided by content and not by hash). Adjacent names are then paired and each distinct pair gets a
name of its own, an odd last name being paired with NONE, until every text has one name. Texts of equal
level and name are equal: a name at a level stands for one sequence of bytes, and the level with NONE fixes
where the sequence ends.

Each level halves the names, so all levels together shuffle about twice the first, which has 8 bytes for
each BLOCK_BYTES of text. Contents cross the network once, one copy of a block from each map task, so a group
that holds a third of all rows costs no more there than a single row of it. A hot name only meets its names
table in an equi-join of two written tables, which adaptive execution splits.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; among rows of equal text
and equal doc_id one stays; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import materialise, table
from trendlens.llm.naming import clashes, integer_names, with_twin

BLOCK_BYTES = 1024
NONE = -1                   # the right half of a pair whose left is the last name of its text


def blocks(text: Column) -> Column:
    """Array of the text's blocks, as binary. The bytes are made once, as the one element of an array."""
    def cut(data: Column) -> Column:
        last = F.floor((F.greatest(F.length(data), F.lit(1)) - 1) / BLOCK_BYTES).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)))

    return F.transform(F.array(text.cast("binary")), cut)[0]


def occurrences(docs: DataFrame, block: Column) -> DataFrame:
    """row, doc_id, sha, pos, n, digest, twin: a row for each of the n blocks of a text; doc_id and sha at pos 0."""
    contents = docs.select(F.explode(block).alias("content")).select(F.xxhash64("content").alias("digest"), "content")
    clash = clashes(contents)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "sha", block.alias("all"))
    rows = rows.select("row", "doc_id", "sha", F.size("all").alias("n"), F.posexplode("all").alias("pos", "content"))
    rows = with_twin(rows.withColumn("digest", F.xxhash64("content")), clash, F.col("content"))
    first = F.col("pos") == 0
    return materialise(rows.select("row", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("sha")).alias("sha"),
                                   "pos", "n", "digest", "twin"), "block-occurrences")


def paired(level: DataFrame) -> DataFrame:
    """row, pos, n, left, right: the adjacent names of the texts that still have more than one."""
    even = F.col("pos") % 2 == 0
    return (level.where("n > 1").groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.ceil(F.max("n") / 2).cast("int").alias("n"), F.max(F.when(even, F.col("name"))).alias("left"),
                 F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NONE)).alias("right")))


def identities(docs: DataFrame) -> DataFrame:
    """row, doc_id, sha, level, name of every row of `docs` (doc_id, text, sha): equal (level, name) = equal text."""
    occ = occurrences(docs, blocks(F.col("text")))
    names = integer_names(occ.select("digest", "twin"), "name", "block-names")
    level = materialise(occ.join(names, ["digest", "twin"]).select("row", "pos", "n", "name"), "block-level")
    done, depth = [level.where("n = 1").select("row", F.lit(0).alias("level"), "name")], 0
    longest = level.agg(F.max("n")).first()[0] or 1
    while longest > 1:
        depth, longest = depth + 1, -(-longest // 2)
        names = integer_names(paired(level).select("left", "right"), "name", "pair-names")
        level = materialise(paired(level).join(names, ["left", "right"]).select("row", "pos", "n", "name"), "pair-level")
        done.append(level.where("n = 1").select("row", F.lit(depth).alias("level"), "name"))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return materialise(occ.where("pos = 0").select("row", "doc_id", "sha").join(every, "row"), "text-names")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, sha, level, name: the largest doc_id of each group of equal texts stays."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = identities(docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("sha")))
    keeper = F.max(F.struct("doc_id", "row")).alias("keep")
    groups = materialise(rows.groupBy("level", "name").agg(F.count("*").alias("group_size"), keeper), "text-groups")
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"),
        "sha", "level", "name")


def op13_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


OP13_SQL = """
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST)
"""
