"""Operators 11 to 13: brute force, DuckDB SQL, odd rows, and the data structures on their own."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute_alignment, brute_trie, dense
from trendlens.llm import naming, op11_prefix_trie, op12_alignment, op13_blocks
from trendlens.llm.csr import CSR, labels, product, product_sizes, spans
from trendlens.llm.radix_tree import Direct, Indexed, RadixTree, Sorted

SMALL, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def ask(sql, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con.sql(sql).fetchall()


# ---------------------------------------------------------------- 11: prefix trie
def conversations(n=420, seed=3):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.choice([0, 1, 1, 2, 3, 4, 9])):
            rows.append((c, rng.choice([None, t, t, t, 0]), rng.choice(["a", "b", None]) if c % 3 else "a",
                         rng.choice(["x", "yy", None, "", "zzé"]) if c % 5 else "same", 7, "k", b"c"))
    return [*rows, (None, 1, "a", "b", 1, "k", b"c")]


CONV = "conv_id long, turn long, role string, text string, depth int, key string, twin binary"


@pytest.mark.parametrize("range_turns", [50_000, 40, 7])
def test_trie_equals_plain_prefixes(spark, range_turns):
    """Repeated, null and tied turns, turnless conversations, clashing column names; one range and very many."""
    rows = conversations()
    got = op11_prefix_trie.prefix_trie(spark.createDataFrame(rows, CONV), range_turns).collect()
    assert sorted(map(tuple, got), key=brute_trie.order) == brute_trie.trie([r[:4] for r in rows])


def test_trie_of_hot_and_long_conversations(spark):
    """A third of all conversations are copies of one, and one has 300 turns; their nodes span ranges."""
    rows = [(c, t, "user", f"t{t}" if c % 3 == 0 else f"{c % 7}-{t % 2}") for c in range(0, 240) for t in range(3)]
    rows += [(1000, t, "user", "same" if t else "t0") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for range_turns in (20, 100_000):
        got = op11_prefix_trie.prefix_trie(df, range_turns).collect()
        assert sorted(map(tuple, got), key=brute_trie.order) == brute_trie.trie(rows)


def test_trie_sql_and_empty_table(spark):
    got = op11_prefix_trie.op11_prefix_trie(spark, SF01)
    want = ask(op11_prefix_trie.OP11_SQL, SF01, "conversations")
    assert got.columns == op11_prefix_trie.OUT
    assert sorted(map(tuple, got.collect()), key=brute_trie.order) == sorted(want, key=brute_trie.order)
    assert op11_prefix_trie.prefix_trie(spark.createDataFrame([], CONV)).count() == 0


def test_radix_tree_layouts_and_paths():
    """Keys that fill every layout, that end inside paths and at inner nodes, and that repeat."""
    rng = random.Random(8)
    keys = [bytes([5, e]) + bytes(rng.randrange(3)) for e in range(256)] + [b"", b"\x05", b"\x05\x07longer", b"\x05\x07long"]
    keys += [bytes(rng.randrange(4) for _ in range(rng.randrange(9))) for _ in range(400)]
    tree, want = RadixTree(), {}
    for i, k in enumerate(keys):
        tree.insert(k, i)
        want.setdefault(k, []).append(i)
    found, seen, stack = {}, set(), [(tree.root, b"")]
    while stack:
        node, at = stack.pop()
        at += node.path
        seen.add(type(node.layout))
        if node.values:
            found[at] = node.values
        edges = [e for e, _ in node.items()]
        assert edges == sorted(edges) and (node.values or len(edges) > 1 or node is tree.root)      # paths are compressed
        stack.extend((child, at + bytes([e])) for e, child in node.items())
    assert found == want and Direct in seen and Sorted in seen
    tree = RadixTree()
    for e in range(40):
        tree.insert(bytes([e]), e)
    assert isinstance(tree.root.layout, Indexed)


# ---------------------------------------------------------------- 12: alignment
ODD = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (4, "<0x41> <s> </s> <unk> <|endoftext|>"), (5, "\n\n\t  x   y"), (None, "no id"), (None, None),
       (6, "中文😀 é \x00\x01"), (7, "word " * 30_000), (8, "=" * 5000), (9, " " * 3000 + "x"), (10, " 　ﬁ"), (11, "same same"), (11, "same same")]


def odd_texts():
    rng = random.Random(3)
    return ODD + [(100 + i, "".join(rng.choice("ab zé中😀\n\t 0 1'sll▁<>x") for _ in range(rng.randrange(60)))) for i in range(150)]


def aligned(df):
    return sorted(map(tuple, op12_alignment.alignment_counts(df).collect()), key=brute_alignment.order)


def test_alignment_equals_token_by_token(spark, monkeypatch):
    """Null, empty, unfaithful, repeated, very long and non-ASCII texts, extra columns; then tiny steps and chunks."""
    rows = odd_texts()
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, chunk int, pair string")
    want = brute_alignment.counts(rows)
    assert aligned(df) == want
    monkeypatch.setattr(op12_alignment, "STEP_BYTES", 500)
    monkeypatch.setattr(op12_alignment, "CHUNK_BYTES", 2000)
    assert aligned(df.repartition(3)) == want
    assert aligned(df.limit(0)) == []


def test_alignment_query_on_whole_table(spark):
    got = op12_alignment.op12_token_incidence(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect()), key=brute_alignment.order) == brute_alignment.counts([tuple(r) for r in docs])


def test_alignment_lists_links_and_shared_groups(spark):
    df = spark.createDataFrame([(1, "unbelievable 中"), (2, None)], "doc_id long, text string")
    row, none = op12_alignment.alignments(df).orderBy("doc_id").collect()
    aligner = op12_alignment.Aligner(*op12_alignment.tokenizer_paths())
    size = [len(aligner.a_bytes[i]) for i in row.a_ids], [len(aligner.b_bytes[i]) for i in row.b_ids]
    assert sum(row.link_bytes) == sum(size[0]) == sum(size[1]) == len(" unbelievable 中".encode())
    ends = [set(np.cumsum(s).tolist()) for s in size]
    assert row.group_ends == sorted(ends[0] & ends[1]) and len(row.shared_a) == len(row.shared_b) >= len(row.link_a)
    assert none.a_ids == [] and none.link_a == [] and none.group_ends == []


def test_fast_ranks_equal_the_tokenizer_file():
    """A's encoder against its own file, on fuzzed texts of many scripts."""
    aligner, rng = op12_alignment.Aligner(*op12_alignment.tokenizer_paths()), random.Random(4)
    alphabet = [chr(c) for r in ((32, 127), (160, 600), (0x400, 0x460), (0x3040, 0x30A0), (0x4E00, 0x4E40), (0x1F600, 0x1F620)) for c in range(*r)] + list("\n\t\r\x0b\x85  ")
    for _ in range(1500):
        text = " " + "".join(rng.choice(alphabet) if rng.random() < 0.6 else rng.choice(" ab'sl1") for _ in range(rng.randrange(40)))
        assert aligner.encode_a(text).tolist() == aligner.a.encode(text, add_special_tokens=False).ids


def test_sparse_products():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a, b = rng.random((7, 9)) < 0.3, rng.random((9, 5)) < 0.4
        got = product(dense.to_rows(a), dense.to_rows(b))
        assert np.array_equal(dense.of(got), a.astype(int) @ b.astype(int))
        assert np.array_equal(dense.of(dense.to_rows(a).transposed()), a.T)
        assert np.array_equal(product_sizes(dense.to_rows(a), dense.to_rows(b)), (a.astype(int) @ b.astype(int)).sum(1))
    cover = spans(np.array([2, 3, 6]), 6)
    assert dense.of(product(cover, spans(np.array([1, 6]), 6).transposed())).tolist() == [[1, 1], [0, 1], [0, 3]]
    assert dense.of(product(labels(np.array([0, 0, 1]), 2), labels(np.array([0, 1, 1]), 2).transposed())).tolist() == [[1, 0, 0], [1, 0, 0], [0, 1, 1]]
    assert CSR(np.array([0, 2, 2]), np.array([0, 2]), 3, np.array([3, 4])).times(np.array([1, 10, 100])).tolist() == [403, 0]


# ---------------------------------------------------------------- 13: block naming
TWINS = [(1, None), (2, ""), (3, "a" * 5000), (3, "a" * 5000), (None, "a" * 5000), (None, None), (9, "b" * 1024), (10, "b" * 1025), (11, "b" * 2048),
         (12, "é" * 1024), (13, "b" * 1024 + "c"), (14, "b" * 1025), (15, "B" * 1025), (16, " "), (17, "ab"), (18, "ba"), (19, "word " * 40_000)]


def grouped(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in op13_blocks.exact_groups(df).collect()), key=repr)


def by_text(rows):
    groups, out = {}, []
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    for ids in groups.values():
        ids = sorted(ids, key=lambda d: (d is not None, d or 0))
        out += [(d, ids[-1], len(ids), i == len(ids) - 1) for i, d in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 4, 1024])
def test_block_names_tell_texts_apart(spark, monkeypatch, size):
    monkeypatch.setattr(op13_blocks, "BLOCK_BYTES", size)
    rows = TWINS if size > 1 else [(d, t and t[:90]) for d, t in TWINS]
    df = spark.createDataFrame([(*r, 1, "q", 2) for r in rows], "doc_id long, text string, row int, name string, level int")
    assert grouped(df) == by_text(rows)
    assert grouped(df.limit(0)) == []


def test_block_names_survive_equal_digests(spark, monkeypatch):
    """A digest of three values only: contents decide, not digests."""
    real = F.xxhash64
    monkeypatch.setattr(op13_blocks, "BLOCK_BYTES", 16)
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(3)))
    rows = [(d, t and t[:300]) for d, t in TWINS] + [(100 + i, f"text {i % 13}" * (i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert naming.clashes(df.select(F.xxhash64("text").alias("digest"), F.col("text").alias("content"))).count() > 0
    assert grouped(df) == by_text(rows)


def test_block_naming_sql_and_plan(spark):
    got = op13_blocks.op13_block_naming(spark, SF01)
    want = ask(op13_blocks.OP13_SQL, SF01, "documents")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
