"""Operator 8: language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A document is
parsed greedily into the longest phrases that occur in the sample (Ziv-Merhav cross parsing); the
language that needs the fewest phrases, normalised by the log of its sample's length, wins.

The automaton is made deterministic and total for the parse: where a phrase ends, the transition
starts the next phrase and carries a flag, so one table lookup per character and language does the
work. Many pieces of PIECE characters are parsed side by side; a piece's end ends a phrase, in every
language alike, so whole texts are parsed at any length.

Text is folded to lower-case letters; any run of other characters is one separator.

Bounds (documented parameters): SAMPLE_CHARS characters per language, in equal shares of at most SAMPLE_DOCS distinct
labelled texts that their hashes choose; a longer text gives a stretch at a place told by its hash. So neither a long
text nor copies fill a language's model.

Defined cases: a text that is null or has no letter is `und` with score 0, and so is every text when
nothing could be learned; ties go to the alphabetically first language; repeated rows get a row each;
rows with a null doc_id are scored but never learned from; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.llm.common import table, text_batches

SAMPLE_DOCS = 64
SAMPLE_CHARS = 24_000
FOLDS = 5
PIECE = 256
LANES = 1 << 14                     # pieces parsed side by side
UNDETERMINED = "und"
SHIFT = 28
ENDS = 1 << SHIFT                   # added to a transition for each phrase that ends there
SEPARATOR, UNKNOWN, PAD = 0, 1, 2   # codes before those of letters


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def samples(docs: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Language -> bounded sample of labelled text outside the held-out fold: SAMPLE_DOCS distinct texts by the order of
    their hashes (copies count once), an equal share of `chars` from each, at a place told by its hash."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold() != 0)).select("lang", "text", F.xxhash64("text").alias("h"))
    first = Window.partitionBy("lang").orderBy("h")
    chosen = (labelled.select("lang", "h").distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= SAMPLE_DOCS)
              .withColumn("share", F.floor(F.lit(chars) / F.count("*").over(Window.partitionBy("lang"))).cast("int")))
    spare = F.greatest(F.length("text") - F.col("share"), F.lit(0))
    start = (F.pmod(F.xxhash64("text", F.lit("start")), spare + 1) + 1).cast("int")
    rows = (labelled.join(F.broadcast(chosen), ["lang", "h"])       # SAMPLE_DOCS rows per language
            .select("lang", "rank", F.substring("text", start, F.col("share")).alias("text"))
            .groupBy("lang", "rank").agg(F.min("text").alias("text")).collect())
    out: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.rank)):
        out[r.lang] = (out.get(r.lang, "") + " " + r.text)[:chars + SAMPLE_DOCS]
    return out


class Alphabet:
    """Codes of lower-case letters met in the samples, as a table over all code points."""

    def __init__(self, texts: list[str]):
        letters = sorted({c for t in texts for c in t.lower() if c.isalpha()})
        self.size = PAD + 1 + len(letters)
        self.code = {c: PAD + 1 + i for i, c in enumerate(letters)}

    def table(self) -> np.ndarray:
        table = np.zeros(0x110000, np.uint8 if self.size <= 256 else np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                table[cp] = self.code.get(c.lower(), UNKNOWN)
        return table

    def encode(self, text: str) -> list[int]:
        out = [SEPARATOR]
        for c in text:
            code = self.code.get(c.lower(), UNKNOWN) if c.isalpha() else SEPARATOR
            if code or out[-1]:
                out.append(code)
        return out


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of `codes`; state 0 is its start."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


def parser(codes: list[int], size: int) -> np.ndarray:
    """Flat table [state * size + code] -> next state, plus ENDS where a phrase ends before `code`."""
    step = suffix_automaton(codes)
    start = np.zeros(size, np.int64)
    for c, s in step[0].items():
        start[c] = s
    table = np.tile(start + ENDS, (len(step), 1))
    table[0] = start                                    # no phrase is open at the start state
    absent = [c for c in range(size) if c not in step[0]]
    table[:, absent] = 2 * ENDS                         # the open phrase, and the unknown code as one of its own
    table[0, absent] = ENDS
    for s, edges in enumerate(step):
        for c, t in edges.items():
            table[s, c] = t
    table[:, PAD] = np.arange(len(step))
    return table.astype(np.int32).ravel()


def learn(texts: dict[str, str]) -> tuple[Alphabet, list[tuple[str, float, np.ndarray]]]:
    """(language, weight of a phrase, table) per language, in alphabetical order."""
    alphabet = Alphabet(list(texts.values()))
    out = []
    for lang in sorted(texts):
        codes = alphabet.encode(texts[lang])
        out.append((lang, math.log2(len(codes) + 1), parser(codes, alphabet.size)))
    return alphabet, out


def phrases(codes: np.ndarray, owner: np.ndarray, n: int, tables: list[np.ndarray], size: int) -> np.ndarray:
    """Phrase counts [text, language]. codes: texts laid end to end; owner: the text of each piece start."""
    counts = np.zeros((n, len(tables)), np.int64)
    pieces = codes.reshape(-1, PIECE)
    for at in range(0, len(pieces), LANES):
        block = np.ascontiguousarray(pieces[at:at + LANES].T).astype(np.int64)
        for k, step in enumerate(tables):
            state = np.zeros(block.shape[1], np.int64)
            ended = np.zeros(block.shape[1], np.int64)
            for row in block:
                got = step[state * size + row]
                ended += got >> SHIFT
                state = got & (ENDS - 1)
            ended += state != 0                         # the open phrase
            np.add.at(counts[:, k], owner[at:at + LANES], ended)
    return counts


def squeeze(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes of one text, runs of separators as one."""
    codes = table[points]
    return codes[(codes != SEPARATOR) | np.concatenate([[True], codes[:-1] != SEPARATOR])]


def predict(docs: DataFrame, model: tuple[Alphabet, list[tuple[str, float, np.ndarray]]], carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns `carried` along, lang_pred, score. score = 1 - best cost / second cost (1 with a single language)."""
    alphabet, langs = model
    shipped = docs.sparkSession.sparkContext.broadcast((alphabet.table(), alphabet.size, langs))     # bounded by the samples

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, size, langs = shipped.value
        names = [x[0] for x in langs]
        weights = np.array([x[1] for x in langs])
        for batch in batches:
            laid, owner, some = [], [], []
            for i, value in enumerate(batch.column(1)):
                points = np.frombuffer((value.as_py() or "").encode("utf-32-le"), np.uint32)
                codes = squeeze(points, table)
                some.append(bool(langs) and bool((codes != SEPARATOR).any()))
                if some[-1]:
                    pieces = -(-len(codes) // PIECE)
                    laid.append(np.concatenate([codes, np.full(pieces * PIECE - len(codes), PAD, codes.dtype)]))
                    owner += [i] * pieces
            n = batch.num_rows
            best, score = np.zeros(n, np.int64), np.zeros(n)
            if laid:
                cost = phrases(np.concatenate(laid), np.array(owner), n, [x[2] for x in langs], size) * weights
                best = cost.argmin(axis=1)
                if len(langs) > 1:
                    two = np.partition(cost, 1, axis=1)[:, :2]
                    score = 1.0 - two[:, 0] / np.maximum(two[:, 1], 1e-9)
                else:
                    score = np.ones(n)
            pred = [names[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), some, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(sent.index(c)) for c in ("doc_id", *carried)), pa.array(pred, pa.string()),
                                              pa.array(np.where(some, score, 0.0))], [f.name for f in out])

    out = T.StructType([*docs.select("doc_id", *carried).schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sent = ["doc_id", "text", *(c for c in carried if c != "text")]
    return text_batches(docs).select(*sent).mapInArrow(rows, out)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(samples(docs)))


def op8_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = identify(table(spark, sf_dir, "documents"))
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
