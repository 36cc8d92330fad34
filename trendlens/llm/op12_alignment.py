"""Operator 12: alignment of two tokenizers by sparse products of token-byte incidence matrices.

A text is encoded by A (byte-level BPE, on space+text) and B (piece BPE with byte fallback, on text). Each side is
an incidence matrix tokens x bytes in compressed rows (`csr`). A·Bᵀ, row by row, links every pair of tokens that
share bytes, with the number of bytes. Offsets where tokens of both sides end cut the text into groups, and the
product of the two token-group matrices links the tokens that share a group.

How many documents of the corpus hold an id pair linked is counted exactly: a task gathers the texts it reads into
chunks of about CHUNK_BYTES, and writes per document its counts and one sparse row over the chunk's distinct pairs.
Only distinct pairs of a chunk are shuffled, with the number of its documents that hold them, summed, and brought
back to the chunk, where each document's sums are a sparse matrix-vector product. So a text is encoded once, no
text is shuffled, and a pair that every document holds is one row of each chunk.

Defined cases: texts that are null, empty or not told exactly by their tokens' bytes (such as those that hold
U+2581, which B reads as a space) have no tokens: counts 0, groups ''; repeated rows are documents of their own; a
null doc_id is carried along; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import materialise, table, whole_texts
from trendlens.llm.csr import CSR, labels, product, product_sizes, spans

CHUNK_BYTES = 16 << 20      # texts that share one list of distinct pairs, about
STEP_BYTES = 1 << 20        # texts that are encoded and linked at a time, about
DIGITS = 6                  # of an id in decimal, and a separator


class Aligner:
    """Both tokenizers and their tokens' bytes. Made once in a worker."""

    def __init__(self, a_path: str, ranks_path: str, pattern: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # the same vocabulary and merges as `a`, three times as fast; the tests hold one against the other
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        code = [re.fullmatch("<0x([0-9A-Fa-f]{2})>", p) if self.b.is_byte(i) else None for i, p in enumerate(pieces)]
        self.b_bytes = [bytes([int(c[1], 16)]) if c else p.replace("▁", " ").encode() for c, p in zip(code, pieces, strict=True)]
        self.a_len = np.array([len(x) for x in self.a_bytes])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        self.kinds = np.array([len(self.a_bytes), len(self.b_bytes)])
        # rows of decimal ids with what follows one: A "," and "|", B "," and ";" and nothing
        a, b = range(self.kinds[0]), range(self.kinds[1])
        text = [f"{i}{end}".encode() for ids, ends in ((a, ",|"), (b, [",", ";", ""])) for end in ends for i in ids]
        self.digits = np.array(text, f"S{DIGITS}").view(np.uint8).reshape(len(text), DIGITS)
        self.digits_len = np.array([len(x) for x in text])

    def encode_a(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except BaseException as error:                      # its pattern engine gives up on some very long runs
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of every text; none where the tokens' bytes are not exactly the text's."""
        none = np.zeros(0, np.int64)
        out = [(none, none)] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        for i, b in zip(some, self.b.encode([texts[i] for i in some], num_threads=1), strict=True):
            want = b" " + texts[i].encode()
            if b"".join([self.b_bytes[x] for x in b]) == want:
                a = self.encode_a(" " + texts[i])
                if b"".join([self.a_bytes[x] for x in a.tolist()]) == want:
                    out[i] = (a, np.array(b, np.int64))
        return out


class Linked:
    """Links and groups of several texts side by side. Bytes, tokens and groups are numbered through."""

    def __init__(self, aligner: Aligner, texts: list[str | None]):
        self.aligner, both = aligner, aligner.tokens(texts)
        self.a_ptr = np.concatenate([[0], np.cumsum([len(a) for a, _ in both])])
        self.b_ptr = np.concatenate([[0], np.cumsum([len(b) for _, b in both])])
        self.a, self.b = np.concatenate([a for a, _ in both]), np.concatenate([b for _, b in both])
        a_end, b_end = np.cumsum(aligner.a_len[self.a]), np.cumsum(aligner.b_len[self.b])
        size = int(a_end[-1]) if len(a_end) else 0
        self.links = product(spans(a_end, size), spans(b_end, size).transposed())
        ends = np.zeros(size + 1, np.int8)
        ends[a_end] += 1
        ends[b_end] += 1
        self.group_end = np.flatnonzero(ends == 2)
        upto = np.cumsum(ends == 2)
        self.a_group, self.b_group = upto[a_end - 1], upto[b_end - 1]
        # of_text: where the groups of each text begin
        text_end = np.concatenate([[0], a_end])[self.a_ptr]
        self.group_ptr = np.searchsorted(self.group_end, text_end, "right")

    def sharing(self) -> tuple[CSR, CSR]:
        """Token-group matrices of both sides, B's transposed: their product is the shared-group links."""
        n = len(self.group_end)
        return labels(self.a_group, n), labels(self.b_group, n).transposed()

    def per_text(self, of_a_token: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(of_a_token)])
        return upto[self.a_ptr[1:]] - upto[self.a_ptr[:-1]]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id pair, links) of the distinct linked id pairs of each text, in order."""
        kinds = self.aligner.kinds
        token = self.links.row_of()
        text = np.repeat(np.arange(len(self.a_ptr) - 1), np.diff(self.a_ptr))[token]
        base = int(kinds[0] * kinds[1])
        key = np.sort(text * base + self.a[token] * kinds[1] + self.b[self.links.indices])
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[start] // base, key[start] % base, np.diff(np.append(start, len(key)))

    def group_digests(self) -> list[str]:
        """SHA-256 of each text's `a1,a2|b1;a3|b2,b3`; '' without tokens."""
        na, nb = self.aligner.kinds
        n = len(self.group_end)
        a_upto = np.cumsum(np.bincount(self.a_group, minlength=n))
        b_upto = np.cumsum(np.bincount(self.b_group, minlength=n))
        rows = np.empty(len(self.a) + len(self.b), np.int64)
        last = np.append(self.a_group[1:] != self.a_group[:-1], True)[:len(self.a)]
        rows[np.arange(len(self.a)) + np.concatenate([[0], b_upto])[self.a_group]] = self.a + np.where(last, na, 0)
        last = np.append(self.b_group[1:] != self.b_group[:-1], True)[:len(self.b)].astype(np.int64)
        last[self.b_ptr[1:][np.diff(self.b_ptr) > 0] - 1] = 2
        rows[np.arange(len(self.b)) + a_upto[self.b_group]] = 2 * na + last * nb + self.b
        text = self.aligner.digits[rows].ravel()
        text = memoryview(text[text != 0])
        ends = np.concatenate([[0], np.cumsum(self.aligner.digits_len[rows])])[self.a_ptr + self.b_ptr].tolist()
        return [hashlib.sha256(text[i:j]).hexdigest() if j > i else "" for i, j in zip(ends, ends[1:], strict=False)]


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """doc_ids and texts of about STEP_BYTES at a time; a text is never cut."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= STEP_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
FOUND = [("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups_sha256", pa.string()),
         ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("k", pa.int32()), ("pair", pa.int64()), ("docs", pa.int32())]
FOUND_SCHEMA = ("chunk long, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
                + ", groups_sha256 string, at array<int>, times array<int>, k int, pair long, docs int")
OUT_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in [*COUNTS, "n_best", "count_sum"]) + ", groups_sha256 string"


def batch_of(fields: list, columns: dict, rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[n] if n in columns else pa.nulls(rows, t) for n, t in fields], [n for n, _ in fields])


def lists(values: np.ndarray, ptr: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(values, pa.int32()))


class Chunk:
    """Documents that share a list of distinct pairs."""

    def __init__(self, number: int):
        self.number, self.size, self.parts = number, 0, []

    def add(self, ids: list, linked: Linked) -> None:
        text, pair, times = linked.pairs()
        sharing = linked.sharing()
        counts = [np.diff(linked.a_ptr), np.diff(linked.b_ptr), np.diff(linked.group_ptr), linked.per_text(linked.links.sizes()),
                  linked.per_text(product_sizes(*sharing))]
        ptr = np.searchsorted(text, np.arange(len(ids) + 1))
        self.parts.append((ids, counts, linked.group_digests(), ptr, pair, times.astype(np.int32)))

    def batches(self) -> Iterator[pa.RecordBatch]:
        pairs, at, docs = np.unique(np.concatenate([p[4] for p in self.parts]), return_inverse=True, return_counts=True)
        done = 0
        for ids, counts, digests, ptr, pair, times in self.parts:
            mine = at[done:done + len(pair)]
            done += len(pair)
            cols = {"chunk": pa.array(np.full(len(ids), self.number)), "doc_id": pa.array(ids, pa.int64()), "groups_sha256": pa.array(digests),
                    "at": lists(mine, ptr), "times": lists(times, ptr)} | {n: pa.array(c, pa.int64()) for n, c in zip(COUNTS, counts, strict=True)}
            yield batch_of(FOUND, cols, len(ids))
        for low in range(0, len(pairs), 1 << 17):
            part = slice(low, low + (1 << 17))
            n = len(pairs[part])
            yield batch_of(FOUND, {"chunk": pa.array(np.full(n, self.number)), "k": pa.array(np.arange(low, low + n), pa.int32()),
                                   "pair": pa.array(pairs[part]), "docs": pa.array(docs[part], pa.int32())}, n)


def _found(paths: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(*paths), TaskContext.get().partitionId() << 32
        chunk = Chunk(number)
        for ids, texts in steps(batches):
            chunk.add(ids, Linked(aligner, texts))
            chunk.size += sum(len(t or "") for t in texts)
            if chunk.size >= CHUNK_BYTES:
                yield from chunk.batches()
                chunk = Chunk(chunk.number + 1)
        if chunk.parts:
            yield from chunk.batches()

    return run


def _scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A chunk's documents, with the sums of their links' counts: sparse rows times the vectors of counts and bests."""
    n = len(pairs)
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    k = pairs["k"].to_numpy()
    count[k], best[k] = pairs["n"].to_numpy(), pairs["best"].to_numpy()
    at, times = docs["at"].combine_chunks(), docs["times"].combine_chunks()
    ptr = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False))])
    rows = CSR(ptr, at.flatten().to_numpy(), n, times.flatten().to_numpy())
    cols = {c: docs[c] for c in ["doc_id", *COUNTS, "groups_sha256"]} | {"n_best": pa.array(rows.times(best)), "count_sum": pa.array(rows.times(count))}
    return pa.table({c: cols[c] for c in ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]})


def tokenizer_paths() -> tuple[str, str, str, str]:
    """A's file, its ranks and pattern, B's file: the public tokenizers of this installation."""
    import public_tokenizers as public
    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, public.path("piece_bpe_32k.model")


def alignment_counts(docs: DataFrame, paths: tuple | None = None) -> DataFrame:
    """doc_id, COUNTS, n_best, count_sum, groups_sha256 of every row of `docs` (doc_id, text)."""
    paths = paths or tokenizer_paths()
    with whole_texts(docs.sparkSession):
        found = materialise(docs.select("doc_id", "text").mapInArrow(_found(paths), FOUND_SCHEMA), "alignments")
    pairs = found.where("k is not null").select("chunk", "k", "pair", "docs")
    kinds = Aligner(*paths).kinds
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.floor(F.col("pair") / F.lit(int(kinds[1]))))
    counts = materialise(counts, "pair-documents")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    counts = materialise(counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "pair-counts")
    mine = pairs.select("chunk", "k", "pair").join(counts, "pair").select(F.col("chunk").alias("of_chunk"), "k", "n", "best")
    rows = found.where("k is null").drop("k", "pair", "docs")
    return rows.groupBy("chunk").cogroup(mine.groupBy("of_chunk")).applyInArrow(_scored, OUT_SCHEMA)


LINKS_SCHEMA = ("doc_id long, a_ids array<int>, b_ids array<int>, link_a array<int>, link_b array<int>, link_bytes array<int>, "
                "shared_a array<int>, shared_b array<int>, group_ends array<long>")


def alignments(docs: DataFrame, paths: tuple | None = None) -> DataFrame:
    """The alignment itself: each document's ids, its links (token numbers and shared bytes), its shared-group links
    and the byte offsets, in space+text, where its groups end."""
    paths = paths or tokenizer_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*paths)
        for ids, texts in steps(batches):
            for doc_id, text in zip(ids, texts, strict=True):
                one = Linked(aligner, [text])
                shared = product(*one.sharing())
                cols = [one.a, one.b, one.links.row_of(), one.links.indices, one.links.data, shared.row_of(), shared.indices, one.group_end]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *(pa.array([c], pa.list_(pa.int32())) for c in cols[:-1]),
                                                  pa.array([cols[-1]], pa.list_(pa.int64()))], re.findall(r"(\w+) (?:long|array)", LINKS_SCHEMA))

    return docs.select("doc_id", "text").mapInArrow(run, LINKS_SCHEMA)


def op12_token_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(table(spark, sf_dir, "documents"))
