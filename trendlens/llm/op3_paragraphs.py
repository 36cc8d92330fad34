"""Operator 3: substring dedup by MinHash banding of paragraphs.

Paragraphs, the text between line breaks, are the units; one of over LONG words is split at content-defined
cuts (after each word whose hash with its successor is the smallest of WIDE neighbours on either side). Units with
equal words are one class. Classes are compared by shingles of five words: BANDS bands of ROWS MinHash values each
(tuned for recall: a pair at the threshold 0.8 is missed with (1 - 0.8 ^ 3) ^ 9 = 0.16 %, a pair at 0.1 meets with
0.9 %), classes that share a band are brought together, and the exact Jaccard of their shingle sets is verified at
0.8 or more. Shingles are read only for classes that met another. A band value of over CELL classes is dealt to a
grid of cells so that every pair still meets in some cell and no task holds more than two CELLs; the others are
grouped until a cell is full. Linked classes form components.

Passages also stand inside longer lines. They are found exactly: of each MIN_WORDS - ANCHOR + 1 neighbouring
shingles of ANCHOR words the smallest is an anchor, so a shared stretch of MIN_WORDS words holds a shared anchor,
and around these all windows of MIN_WORDS words are compared. A window belongs to the first anchor in it, and its words
tell where that stands, so equal windows belong to equal anchors. The neighbouring windows of one anchor travel as one
row (place, hash of them all, a `bundle`). Their own hashes are sent once per bundle and task and compared among the
bundles of one anchor: copies of a passage are one bundle. The component of a stretch is the stretch of first
occurrences it leads to. A stretch that adds under SHINGLE words to a
longer one is left out: it is the word beside a passage that some copies share by chance, and it stays in all of them.

A unit or window that occurs more than once, in one document or in several, is repeated. Neighbouring repeated words
make a run; runs of at least MIN_WORDS words are reported, one row per part of equal component and state; `piece` is the
number of the part's first word. The first occurrence (smallest doc_id, then text hash and place) is kept, all others are
`removed`. `within_document` says that all occurrences of the part lie in one document. In a text that repeats itself
with a short period, the windows that overlap the first occurrence belong to it.

Defined cases: null, empty and short texts have nothing to report; a null doc_id comes before all others; rows alike
in doc_id and text are occurrences of each other: the whole text is repeated, `rows` counts them, and each has the
same rows here; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendlens.llm.common import Forest, connected_components, materialise, table

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 9, 3
CELL = 400
MIN_WORDS = 20
ANCHOR = 8
LONG, WIDE = 128, 48        # paragraphs of more words are split, by cuts of this reach
SLICE = 1000                # paragraphs whose MinHash values are computed side by side
TEXT_BITS = 28              # of a place: words of a text; the other 35 number the texts
VOCABULARY = 500_000        # word hashes a task remembers
SPACES = np.array([chr(i).isspace() for i in range(0x3002)])        # the last entry stands for all code points after it
SEEDS = np.random.default_rng(8).integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
LAST = np.uint64((1 << 64) - 1)
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))     # of XXH64
LOWER = np.frombuffer(bytes(range(128)).lower() + b"\0", np.uint8)       # the last entry stands for all that is not ASCII
SIDE = 1 << 16              # code points whose words are hashed side by side
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Steps written inside the block remove their shuffle files when they end: what they found is in the shared folder."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


class WordHashes(dict):
    """Hashes of lower-cased words. Word by word: a letter whose lower case is longer (such as İ) moves no other word's place."""

    def __missing__(self, word: str) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        x = self[word] = xxhash.xxh64_intdigest(word.lower())
        return x


def sliding(x: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """The smallest (or `best`) of each `width` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    step = 1
    while 2 * step <= width:
        x = best(x[:len(x) - step], x[step:])
        step *= 2
    return best(x[:len(x) - (width - step)], x[width - step:])


def cuts(h: np.ndarray, reach: int) -> np.ndarray:
    """Index after which a part ends, without the last word's."""
    if len(h) < 2:
        return np.empty(0, np.int64)
    pair = mixed(h[:-1] * PRIME + h[1:])
    low = sliding(np.concatenate([np.full(reach, LAST), pair, np.full(reach, LAST)]), reach)
    return np.flatnonzero((pair < low[:len(pair)]) & (pair <= low[reach + 1:]))


def word_places(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and past-end of each word (code points), and the number of its line."""
    gap = np.concatenate([[True], SPACES[np.minimum(codes, len(SPACES) - 1)], [True]])
    start, end = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    return start, end, np.searchsorted(np.flatnonzero((codes == 10) | (codes == 13)), start)


def rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def short_hashes(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of all words (start, size) of under 32 bytes, side by side; 32 bytes stand behind the last one."""
    lanes = np.ndarray(len(low) - 7, "<u8", low.data, strides=(1,))
    halves = np.ndarray(len(low) - 3, "<u4", low.data, strides=(1,))
    out, rest = size.astype(np.uint64) + P5, size & 7
    for k in range(3):
        at = np.flatnonzero(size >= 8 * k + 8)
        if len(at):
            out[at] = rotated(out[at] ^ (rotated(lanes[start[at] + 8 * k] * P2, 31) * P1), 27) * P1 + P4
    done = start + (size - rest)
    at = np.flatnonzero(rest >= 4)
    out[at] = rotated(out[at] ^ (halves[done[at]].astype(np.uint64) * P1), 23) * P2 + P3
    done[at] += 4
    rest = size & 3
    for k in range(3):
        at = np.flatnonzero(rest > k)
        out[at] = rotated(out[at] ^ (low[done[at] + k].astype(np.uint64) * P5), 11) * P1
    out = (out ^ (out >> np.uint64(33))) * P2
    out = (out ^ (out >> np.uint64(29))) * P3
    return out ^ (out >> np.uint64(32))


def hashed(texts: list[str], known: WordHashes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of SIDE code points or more are taken side by side: the number of the first one, hashes of their words, the first word of
    each text (and the past-last one), the gap before and the length of each word, and the number of its line, which
    changes with the text. A word of other than ASCII letters, or of 32 or more, is hashed by itself."""
    k = 0
    while k < len(texts):
        first, borders = k, [0]
        while k < len(texts) and borders[-1] < SIDE:
            borders.append(borders[-1] + len(texts[k]) + 1)             # a line break stands between two texts
            k += 1
        joined = "\n".join(texts[first:k])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        start, end, line = word_places(codes)
        low = np.concatenate([LOWER[np.minimum(codes, 128)], np.zeros(32, np.uint8)])
        size, foreign = end - start, np.concatenate([[0], np.cumsum(codes >= 128)])
        alone = np.flatnonzero((size >= 32) | (foreign[end] != foreign[start]))
        h = short_hashes(low, start, np.minimum(size, 31))
        h[alone] = np.fromiter((known[joined[a:b]] for a, b in zip(start[alone].tolist(), end[alone].tolist(), strict=True)), np.uint64, len(alone))
        words = np.searchsorted(start, borders)
        before = np.concatenate([[0], end[:-1]])[:len(start)]
        some = np.flatnonzero(words[1:] > words[:-1])
        before[words[some]] = np.array(borders)[some]
        yield first, h, words, np.stack([start - before, size], 1), line


def packed(steps: np.ndarray) -> bytes:
    """The gap before each word of a text and its length, a byte each where all fit."""
    small = bool(steps.max(initial=0) < 256)
    raw = steps.astype(np.uint8 if small else np.int32).tobytes()
    return pa.compress(raw, "zstd", asbytes=True) + len(raw).to_bytes(8, "little") + bytes([small])


def unpacked(places: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and past-ends of the words (code points)."""
    raw = pa.decompress(places[:-9], int.from_bytes(places[-9:-1], "little"), "zstd", asbytes=True)
    both = np.cumsum(np.frombuffer(raw, np.uint8 if places[-1] else np.int32), dtype=np.int64)
    return both[::2], both[1::2]


def paragraphs(h: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last word of each paragraph of at least SHINGLE words, of texts side by side."""
    borders = np.concatenate([[0], np.flatnonzero(line[1:] != line[:-1]) + 1, [len(h)]]).astype(np.int64)
    more = [a + cuts(h[a:b], WIDE) + 1 for a, b in zip(borders[:-1], borders[1:], strict=True) if b - a > LONG]
    borders = np.unique(np.concatenate([borders, *more]))
    enough = borders[1:] - borders[:-1] >= SHINGLE
    return borders[:-1][enough], borders[1:][enough]


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of `size` words."""
    n = max(len(h) - size + 1, 0)
    out = h[:n].copy()
    for k in range(1, size) if n else ():
        out = mixed(out * PRIME + h[k:k + n])
    return mixed(out)


def minima(h: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts side by side (the first word of each, and the past-last one): hashes of grams of ANCHOR words, the smallest in each window of
    min_words words, which windows end in their text, and which grams are anchors: the smallest of such a window, told by its words alone."""
    g, wide = grams(h, ANCHOR), max(min_words - ANCHOR + 1, 1)
    least, edge = sliding(g, wide), np.zeros(wide - 1, g.dtype)
    whole = np.arange(len(least)) + max(min_words, ANCHOR) <= np.repeat(words[1:], np.diff(words))[:len(least)]
    least = np.where(whole, least, np.uint64(0))
    return g, least, whole, g == sliding(np.concatenate([edge, least, edge]), wide, np.maximum) if len(least) else np.zeros(len(g), bool)


def bundles(h: np.ndarray, words: np.ndarray, shared: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of texts side by side whose first anchor is one of `shared`: the hashes of the windows, and for each
    run of windows with one anchor its first window, how many it has and the anchor's hash."""
    g, least, whole, low = minima(h, words, min_words)
    windows_of = np.flatnonzero(whole)
    places, nth, least = np.flatnonzero(low), (np.cumsum(low) - low)[windows_of], least[windows_of]
    at = places[nth]                    # of each window, the first anchor from its start on
    late = np.flatnonzero(g[at] != least)
    while len(late):                    # that holds the smallest: a step or two
        nth[late] += 1
        at[late] = places[nth[late]]
        late = late[g[at[late]] != least[late]]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])[:len(at)])
    mark, many = g[at[begin]].view(np.int64), np.diff(begin, append=len(at))
    mine = np.isin(mark, shared)
    begin, many, mark = windows_of[begin[mine]], many[mine], mark[mine]
    first = np.arange(many.sum()) + np.repeat(begin - (np.cumsum(many) - many), many)
    size, out = max(min_words, ANCHOR), g[first]
    for k in range(ANCHOR, size, ANCHOR):           # a window is told by the grams that cover it
        out = mixed(out * PRIME + g[first + min(k, size - ANCHOR)])
    return out.view(np.int64), begin, many, mark


def shingles(h: np.ndarray, first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit shingle hashes of paragraphs of texts side by side, one after the other, and how many each has."""
    whole = grams(h, SHINGLE)
    counts = past - first - SHINGLE + 1
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - first, counts)
    return (whole[at] >> np.uint64(32)).astype(np.uint32).view(np.int32), counts


def band_values(sh: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of BANDS hashes per paragraph, each of ROWS MinHash values."""
    ends, out = np.concatenate([[0], np.cumsum(counts)]), np.zeros((len(counts), BANDS), np.uint64)
    for low in range(0, len(counts), SLICE):
        high = min(low + SLICE, len(counts))
        x, starts = sh[ends[low]:ends[high]].view(np.uint32), ends[low:high] - ends[low]
        y, z = np.empty_like(x), np.empty_like(x)
        for j in range(BANDS):
            value = np.full(high - low, j + 1, np.uint64)
            for seed in SEEDS[j * ROWS:(j + 1) * ROWS]:
                np.multiply(x, seed, out=y)
                np.right_shift(y, np.uint32(15), out=z)
                np.bitwise_xor(y, z, out=y)
                np.multiply(y, np.uint32(0x846CA68B), out=y)
                value = mixed(value * PRIME + np.minimum.reduceat(y, starts))
            out[low:high, j] = value
    return out.view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text) and text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("row"), text.alias("text"))


def _lists(sizes: list, flat: list, kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([[], *sizes]))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *flat])))


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Of every text one row with its anchors, its number of words (`past`) and their places, its unit is null; and a row
    for each paragraph: first and past (words), unit (hash of the words) and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, none = WordHashes(), np.zeros(0, np.int64)
        for batch in batches:
            texts, past, places, marks, owners, a_of, b_of, unit, flat = [none], [none], [], [], [none], [none], [none], [none], []
            for low, h, words, steps, line in hashed(batch.column(2).to_pylist(), known):
                n = np.diff(words)
                kept = np.flatnonzero(n >= SHINGLE)
                texts.append(low + kept)
                past.append(n[kept])
                g, _, _, lowest = minima(h, words, min_words)
                at = np.flatnonzero(lowest)
                anchors, of = g[at].view(np.int64), np.searchsorted(at, words).tolist()
                for i, a, b in zip(kept.tolist(), words[kept].tolist(), words[kept + 1].tolist(), strict=True):
                    mark, times = np.unique(anchors[of[i]:of[i + 1]], return_counts=True)
                    marks.append(np.repeat(mark, np.minimum(times, 2)))         # twice is enough to be shared
                    places.append(packed(steps[a:b]))
                a, b = paragraphs(h, line)
                if not len(a):
                    continue
                owner = np.searchsorted(words, a, "right") - 1
                owners.append(low + owner)
                a_of.append(a - words[owner])
                b_of.append(b - words[owner])
                inside = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())
                place = (inside - np.repeat(a, b - a)).astype(np.uint64)
                sums = np.add.reduceat(mixed(h[inside] + place * PRIME), np.cumsum(b - a) - (b - a))
                unit.append(mixed(sums + (b - a).astype(np.uint64)).view(np.int64))
                flat.append(shingles(h, a, b))
            texts, past, owners, a_of, b_of, unit = (np.concatenate(x) for x in (texts, past, owners, a_of, b_of, unit))
            bands = [band_values(*(np.concatenate(x) for x in zip(*flat, strict=True))).ravel()] if flat else []
            rows, none_of = pa.array(np.concatenate([texts, owners])), np.zeros(len(texts), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate([none_of, a_of]).astype(np.int32)),
                                              pa.array(np.concatenate([past, b_of]).astype(np.int32)), pa.concat_arrays([pa.nulls(len(texts), pa.int64()), pa.array(unit)]),
                                              _lists([none_of, np.full(len(unit), BANDS)], bands, np.int64),
                                              _lists([[len(x) for x in marks], np.zeros(len(unit), np.int64)], marks, np.int64),
                                              pa.concat_arrays([pa.array(places, pa.binary()), pa.nulls(len(unit), pa.binary())])],
                                             ["doc_id", "row", "first", "past", "unit", "bands", "anchors", "places"])

    return keyed(docs).mapInArrow(run, "doc_id long, row long, first int, past int, unit long, bands array<long>, anchors array<long>, places binary")


def requests(found: DataFrame, met: DataFrame) -> DataFrame:
    """tid, doc_id, row, anchors (those shared) and units (first, past, unit of classes that met another, at the
    class's first place) of each text that has any. `tid` numbers them from 0, by doc_id and row."""
    texts = found.where("unit is null")
    marks = texts.select("doc_id", "row", F.explode("anchors").alias("anchor"))
    marks = marks.withColumn("n", F.count("*").over(Window.partitionBy("anchor"))).where("n > 1")
    none = F.lit(None)
    leads = found.where("unit is not null").join(met.select("unit").distinct(), "unit", "left_semi")
    leads = leads.groupBy("unit").agg(F.min(F.struct("doc_id", "row", "first", "past")).alias("lead"))
    asked = leads.select("lead.doc_id", "lead.row", none.cast("long").alias("anchor"), F.struct("lead.first", "lead.past", "unit").alias("unit"))
    asked = marks.select("doc_id", "row", "anchor", none.cast("struct<first:int,past:int,unit:bigint>").alias("unit")).unionByName(asked)
    asked = asked.groupBy("doc_id", "row").agg(F.collect_set("anchor").alias("anchors"), F.collect_list("unit").alias("units"))
    asked = materialise(asked.orderBy("doc_id", "row").withColumn("at", F.monotonically_increasing_id()), "paragraph-requests")
    part = F.shiftright("at", 33)                   # the number of the partition, and the row in it below
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = asked.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", before.alias("before"))     # a row per partition
    return asked.join(sizes, part == F.col("part")).select("doc_id", "row", "anchors", "units", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("tid"))


def of_texts(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The `texts` named by `asked` (both have doc_id and row), a null id included."""
    asked = asked.withColumnsRenamed({"doc_id": "its_id", "row": "its_row"})
    return texts.join(asked, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("row") == F.col("its_row"))).drop("its_id", "its_row")


def windows(docs: DataFrame, asked: DataFrame, min_words: int) -> DataFrame:
    """Rows of two kinds: anchor, bundle (hash of its windows of min_words words), place (text and first word in one
    number) and grams (hashes of the windows, once per bundle and batch, else empty) of the windows around shared anchors; unit and
    sh (shingles) of the paragraphs asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, zeros = WordHashes(), [np.zeros(0, np.int64)]
        for batch in batches:
            place, anchor, gram, lengths, unit, sizes, flat = zeros[:], zeros[:], zeros[:], zeros[:], [], [], []
            numbers, wanted = batch.column(0).to_numpy(), batch.column(3).to_pylist()
            for low, h, words, _, _ in hashed(batch.column(1).to_pylist(), known):
                n = np.diff(words)
                if (n >> TEXT_BITS).any() or (numbers >> 63 - TEXT_BITS).any():
                    raise ValueError(f"a text of {n.max()} words, or text number {numbers.max()}, has no place in 64 bits")
                windows_of, first, many, marks = bundles(h, words, batch.column(2).slice(low, len(n)).flatten().to_numpy(), min_words)
                owner = np.searchsorted(words, first, "right") - 1
                place.append((numbers[low + owner] << TEXT_BITS) + first - words[owner])
                anchor.append(marks)
                gram.append(windows_of)
                lengths.append(many)
                of_slice = [(w["first"] + a, w["past"] + a, w["unit"]) for a, its in zip(words.tolist(), wanted[low:low + len(n)]) for w in its or ()]
                if of_slice:
                    a, b, names = zip(*of_slice, strict=True)
                    sh, counts = shingles(h, np.array(a), np.array(b))
                    unit += names
                    sizes.append(counts)
                    flat.append(sh)
            place, anchor, gram, lengths = (np.concatenate(x) for x in (place, anchor, gram, lengths))
            n, m, begin = len(place), len(unit), np.cumsum(lengths) - lengths
            k = (np.arange(len(gram)) - np.repeat(begin, lengths)).astype(np.uint64)
            each = mixed(mixed(gram.view(np.uint64)) + k * PRIME)
            bundle = (mixed(np.add.reduceat(each, begin)) if n else each).view(np.int64)
            new = np.zeros(n, bool)
            new[np.unique(bundle, return_index=True)[1]] = True
            once = _lists([np.where(new, lengths, 0)], [gram[np.repeat(new, lengths)]], np.int64)
            pad = lambda x: pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(m, pa.int64())])
            yield pa.RecordBatch.from_arrays([pad(place), pad(anchor), pad(bundle), pa.concat_arrays([once, pa.nulls(m, once.type)]),
                                              pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(unit, pa.int64())]),
                                              pa.concat_arrays([pa.nulls(n, pa.list_(pa.int32())), _lists(sizes, flat, np.int32)])],
                                             ["place", "anchor", "bundle", "grams", "unit", "sh"])

    return of_texts(keyed(docs), asked).select("tid", "text", "anchors", "units").mapInArrow(
        run, "place long, anchor long, bundle long, grams array<long>, unit long, sh array<int>")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables that hold all rows of each value."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        if held and key[-1] == held[0].column(0)[0].as_py():
            held.append(batch)
            continue
        cut = int(np.searchsorted(key, key[-1]))
        yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _leads(size: int):
    """Rows (anchor, bundle, n, lead, last, grams), sorted by the first two, one with n and others with grams -> for each bundle its
    stretches of windows that stand at two places or more which don't overlap: off and len (windows of the bundle), lead (first
    place of the first one) and start (of the row of leads that holds it). For each row of leads, the bundle is
    null: start, len, n and last (most occurrences and last place of its windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            anchor, bundle = (rows.column(i).to_numpy() for i in (0, 1))
            group = np.cumsum(np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (bundle[1:] != bundle[:-1])]))
            counted = rows.column(2).is_valid().to_numpy()
            n, lead, last = (rows.column(i).filter(counted).to_numpy() for i in (2, 3, 4))
            with_grams = np.flatnonzero(~counted)
            told = rows.column(5).take(with_grams[np.unique(group[with_grams], return_index=True)[1]]).combine_chunks()
            gram, lengths = told.flatten().to_numpy(), told.value_lengths().to_numpy()
            of, begin = np.repeat(np.arange(len(n)), lengths), np.cumsum(lengths) - lengths
            k = np.arange(len(gram)) - np.repeat(begin, lengths)
            values, which = np.unique(gram, return_inverse=True)
            times, first, final = np.zeros(len(values), np.int64), np.full(len(values), np.iinfo(np.int64).max), np.full(len(values), -1)
            np.add.at(times, which, n[of])
            np.minimum.at(first, which, lead[of] + k)
            np.maximum.at(final, which, last[of] + k)
            order = np.argsort(first)
            order = order[final[order] >= first[order] + size]
            if not len(order):
                continue
            at = first[order]
            new = np.concatenate([[True], at[1:] != at[:-1] + 1])
            heads, start = np.flatnonzero(new), np.full(len(values), -1)
            start[order] = at[heads][np.cumsum(new) - 1]
            rows_of = [np.diff(heads, append=len(at)), at[heads], at[heads], np.maximum.reduceat(times[order], heads), np.maximum.reduceat(final[order], heads)]
            on = np.flatnonzero(start[which] >= 0)
            its, lead_of = of[on], first[which[on]]
            new = np.concatenate([[True], (its[1:] != its[:-1]) | (on[1:] != on[:-1] + 1) | (lead_of[1:] != lead_of[:-1] + 1)])
            heads = np.flatnonzero(new)
            stretch = [np.diff(heads, append=len(on)), lead_of[heads], start[which[on[heads]]]]
            names = bundle[counted][its[heads]]
            join = lambda a, b: pa.concat_arrays([pa.array(a, pa.int64()), pa.nulls(b, pa.int64()) if isinstance(b, int) else pa.array(b, pa.int64())])
            none = len(rows_of[0])
            yield pa.RecordBatch.from_arrays([join(names, none), join(k[on[heads]], none), *(join(a, b) for a, b in zip(stretch, rows_of, strict=False)),
                                              *(pa.concat_arrays([pa.nulls(len(heads), pa.int64()), pa.array(x, pa.int64())]) for x in rows_of[3:])],
                                             ["bundle", "off", "len", "lead", "start", "n", "last"])

    return run


def stretches(found: DataFrame, size: int) -> DataFrame:
    """The windows that stand at two places or more which don't overlap, as (tid, first, past, component_id, copies, removed, within)
    of neighbours alike, from (place, anchor, bundle, grams). Windows of two texts are never nearer than `size`: each window ends in its text."""
    text = lambda x: F.shiftright(x, TEXT_BITS)
    none = F.lit(None).cast("long")
    counts = found.groupBy("anchor", "bundle").agg(F.count("*").alias("n"), F.min("place").alias("lead"), F.max("place").alias("last"))
    told = found.where(F.size("grams") > 0).select("anchor", "bundle", none.alias("n"), none.alias("lead"), none.alias("last"), "grams")
    both = counts.withColumn("grams", F.lit(None).cast("array<long>")).unionByName(told)
    leads = both.repartition("anchor").sortWithinPartitions("anchor", "bundle").mapInArrow(_leads(size), "bundle long, off long, len long, lead long, start long, n long, last long")
    leads = materialise(leads, "paragraph-leads")
    before = Window.partitionBy(text("start")).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    rows = leads.where("bundle is null").withColumn("island", F.col("start") - 1 - F.coalesce(F.sum("len").over(before), F.lit(0)))
    of_island = Window.partitionBy(text("start"), "island")
    rows = rows.select("start", F.xxhash64("island").alias("component_id"), F.max("n").over(of_island).alias("copies"),
                       (text(F.max("last").over(of_island)) == text("start")).alias("within"))
    told = leads.where("bundle is not null").select("bundle", "off", "len", "lead", "start").join(rows, "start").drop("start")
    at = F.col("place") + F.col("off")
    first = at.bitwiseAND((1 << TEXT_BITS) - 1).cast("int")
    spans = found.select("bundle", "place").join(told, "bundle").select(text("place").alias("tid"), F.struct(
        "component_id", "copies", (at >= F.col("lead") + size).alias("removed"), "within", first.alias("first"), (first + F.col("len") + (size - 1)).cast("int").alias("past")).alias("span"))
    return spans.groupBy("tid").agg(F.collect_set("span").alias("spans")).mapInArrow(
        _merged(size), "tid long, first int, past int, component_id long, copies long, removed boolean, within boolean")


def _merged(size: int):
    """Spans of windows at neighbouring places, alike in component and state, as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            component, copies, removed, within, first, past = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            tid = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
            order = np.lexsort((first, within, removed, copies, component, tid))
            alike = [x[order] for x in (tid, component, copies, removed, within)]
            first, past = first[order], past[order]
            new = np.ones(len(first), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in alike], axis=0) | (first[1:] != past[:-1] - (size - 1))
            tid, component, copies, removed, within = (x[new] for x in alike)
            past = past[np.flatnonzero(np.append(new[1:], True))] if len(new) else past
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tid, first[new], past, component, copies, removed, within)],
                                             ["tid", "first", "past", "component_id", "copies", "removed", "within"])

    return run


def parts(spans: list[tuple], min_words: int) -> list[tuple]:
    """(first, past, rank, component_id, copies, removed, within) that may overlap -> (first, past, component_id, copies,
    within, removed) of runs that don't: the lowest rank names the component, and what any span removes is removed."""
    borders = sorted({x for s in spans for x in (s[0], s[1])})
    index = {x: i for i, x in enumerate(borders)}
    gone = [0] * (len(borders) + 1)
    heap: list[tuple] = []
    for s in spans:
        if s[5]:
            gone[index[s[0]]] += 1
            gone[index[s[1]]] -= 1
    todo, k, level, runs = sorted(spans), 0, 0, []
    for i, x in enumerate(borders[:-1]):
        level += gone[i]
        while k < len(todo) and todo[k][0] == x:
            heapq.heappush(heap, (todo[k][2], todo[k][0], todo[k][1], *todo[k][3:5], todo[k][6]))
            k += 1
        while heap and heap[0][2] <= x:
            heapq.heappop(heap)
        if not heap:
            continue
        got = [x, borders[i + 1], *heap[0][3:], level > 0]
        if not runs or runs[-1][-1][1] != x:
            runs.append([got])
        elif runs[-1][-1][2:] == got[2:]:
            runs[-1][-1][1] = got[1]
        else:
            runs[-1].append(got)
    return [tuple(part) for run in runs if run[-1][1] - run[0][0] >= min_words for part in run]


def _colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (value, unit) sorted -> distinct rows of values that have more than one unit. One row is held back."""
    held: list[tuple[int, int]] = []            # the last value's first row while it is alone, else nothing to add
    last_value, last_unit, many = None, None, False
    for batch in batches:
        v, u = (batch.column(i).to_numpy() for i in (0, 1))
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
        v, u = v[new], u[new]
        if len(v) and last_value == v[0] and last_unit == u[0]:
            v, u = v[1:], u[1:]
        if not len(v):
            continue
        all_v = np.concatenate([[last_value if last_value is not None else v[0] - 1], v])
        same = all_v[1:] == all_v[:-1]                      # has a partner before it
        keep = same.copy()
        keep[:-1] |= same[1:]                               # or after it, in this batch
        if same[0] and not many:
            held = [(last_value, last_unit)]
        many = bool(same[-1])
        last_value, last_unit = int(v[-1]), int(u[-1])
        first = np.array(held, np.int64).reshape(-1, 2)         # an empty list would make it all floats, and hashes lose bits
        out_v, out_u = np.concatenate([first[:, 0], v[keep]]), np.concatenate([first[:, 1], u[keep]])
        held = []
        yield pa.RecordBatch.from_arrays([pa.array(out_v), pa.array(out_u)], ["value", "unit"])


def _verified(pdf: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the pairs with one band value, in one cell, whose exact Jaccard reaches the threshold."""
    ids, at = np.unique(pdf["unit"].to_numpy(), return_inverse=True)
    sets: list = [None] * len(ids)
    for i, sh in zip(at.tolist(), pdf["sh"], strict=True):
        if sets[i] is None:
            sets[i] = frozenset(sh.tolist())
    forest, of_value = Forest(len(ids)), {}
    for value, i in zip(pdf["value"].tolist(), at.tolist(), strict=True):
        of_value.setdefault(value, []).append(i)
    for members in of_value.values():
        members = sorted(set(members), key=lambda i: (len(sets[i]), i))
        for k, i in enumerate(members):
            for j in reversed(members[:k]):             # the nearest in size first
                if len(sets[j]) < SIMILARITY * len(sets[i]) - 1e-6:
                    break
                if forest.find(i) != forest.find(j):
                    both = len(sets[i] & sets[j])
                    if both >= SIMILARITY * (len(sets[i]) + len(sets[j]) - both) - 1e-6:
                        forest.union(i, j)
    root = ids[[forest.find(i) for i in range(len(ids))]]
    return pd.DataFrame({"a": ids[root != ids], "b": root[root != ids]})


def met_in_bands(bands: DataFrame) -> DataFrame:
    """(value, unit) of all band values that several units share, from (unit, bands)."""
    rows = bands.select("unit", F.explode("bands").alias("value")).select("value", "unit")
    return materialise(rows.repartition("value").sortWithinPartitions("value", "unit").mapInArrow(_colliding, "value long, unit long"), "paragraph-buckets")


def verified_links(met: DataFrame, sh: DataFrame) -> DataFrame:
    """(a, b) links between units that met and whose shingles (unit, sh) are alike."""
    sizes = met.groupBy("value").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    cells = max(1, -(-met.count() // CELL))
    mine = sh.groupBy("unit").agg(F.first("sh").alias("sh"))
    part = F.pmod(F.xxhash64("unit"), F.col("parts")).cast("int")
    to = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(j, part).alias("i"), F.greatest(j, part).alias("j"))))
    cell = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("value"), F.lit(cells))).otherwise(F.col("value"))
    dealt = met.join(sizes, "value").withColumn("cell", cell).withColumn("to", to).join(mine, "unit")
    return dealt.groupBy("parts", "cell", "to.i", "to.j").applyInPandas(_verified, "a long, b long")


def link_units(found: DataFrame) -> DataFrame:
    """(a, b) links between different units of similar words, from their shingles (unit, sh)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = batch.column(1)
                got = band_values(lists.flatten().to_numpy(), np.asarray(lists.value_lengths()))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists([[BANDS] * len(got)], [got.ravel()], np.int64)], ["unit", "bands"])

    found = found.where(F.size("sh") > 0).select("unit", "sh")
    return verified_links(met_in_bands(found.mapInArrow(run, "unit long, bands array<long>")), found)


def without_chance(spans: list[tuple]) -> list[tuple]:
    """The spans without stretches that add under SHINGLE words to the longer ones: the word beside a passage that
    some of its copies share by chance."""
    covered = np.zeros(max(s[1] for s in spans), bool)
    out = [s for s in spans if s[2] != 1]
    for s in sorted((s for s in spans if s[2] == 1), key=lambda s: (s[0] - s[1], s)):
        new = s[1] - s[0] - int(covered[s[0]:s[1]].sum())
        if new == 0 or new >= SHINGLE:
            out.append(s)
            covered[s[0]:s[1]] = True
    return out


def _reported(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece", "start", "end", "words", "component_id", "copies", "within_document", "removed", "rows"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
        for batch in batches:
            rows = []
            for doc_id, value, alike, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                got = parts(without_chance([tuple(x.values()) for x in spans.as_py()]), min_words)
                if got:
                    start, end = unpacked(value.as_py())
                    rows += [(doc_id, a, start[a], end[b - 1], b - a, *state, alike) for a, b, *state in got]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def repeats(docs: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, row and places of every text, and doc_id, row, rows (alike) and spans of those that hold something repeated."""
    size = max(min_words, ANCHOR)
    found = materialise(units(docs, min_words), "paragraphs")
    lines = found.where("unit is not null")
    met = met_in_bands(lines)
    asked = materialise(requests(found, met), "paragraph-texts")
    read = materialise(windows(docs, asked, min_words), "paragraph-windows")
    groups = connected_components(materialise(verified_links(met, read.where("unit is not null").select("unit", "sh")), "paragraph-links"), "a", "b")

    place = F.struct("doc_id", "row", "first")
    counts = lines.groupBy("unit").agg(F.count("*").alias("n"), F.min(place).alias("lead"), F.max(place).alias("last"))
    counts = counts.join(groups.withColumnRenamed("node", "unit"), "unit", "left").where("n > 1 or component is not null")
    counts = materialise(counts.select("unit", F.coalesce("component", "unit").alias("component_id"), "n", "lead", "last"), "paragraph-classes")
    whole = counts.groupBy("component_id").agg(F.sum("n").alias("copies"), F.min("lead").alias("lead"), F.max("last").alias("last"))
    one = F.col("lead.doc_id").eqNullSafe(F.col("last.doc_id")) & (F.col("lead.row") == F.col("last.row"))
    whole = whole.where("copies > 1").withColumn("within", one).drop("last")
    of_unit = counts.select("unit", "component_id").join(whole, "component_id")
    rows = lines.select("doc_id", "row", "first", "past", "unit").join(of_unit, "unit").withColumn("removed", ~place.eqNullSafe(F.col("lead")))

    texts = found.where("unit is null").groupBy("doc_id", "row").agg(F.count("*").alias("rows"), F.max("past").alias("past"))
    alike = texts.where("rows > 1").select("doc_id", "row", F.lit(0).alias("first"), "past", F.xxhash64("doc_id", "row").alias("component_id"),
                                           F.col("rows").alias("copies"), F.lit(False).alias("removed"), F.lit(True).alias("within"))
    runs = stretches(read.where("bundle is not null").drop("unit", "sh"), size).join(asked.select("tid", "doc_id", "row"), "tid")
    span = lambda rank: F.struct("first", "past", F.lit(rank).alias("rank"), "component_id", "copies", "removed", "within").alias("span")
    spans = rows.select("doc_id", "row", span(0)).unionByName(runs.select("doc_id", "row", span(1))).unionByName(alike.select("doc_id", "row", span(2)))
    of_text = spans.groupBy("doc_id", "row").agg(F.collect_set("span").alias("spans"))
    return found.where("unit is null").select("doc_id", "row", "places"), materialise(of_texts(texts, of_text).select("doc_id", "row", "rows", "spans"), "paragraph-spans")


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, piece, start, end, words, component_id, copies, within_document, removed, rows of every part of a repeated run."""
    with shuffles_removed(docs.sparkSession):
        texts, of_text = repeats(docs, min_words)
    return of_texts(texts, of_text).select("doc_id", "places", "rows", "spans").mapInArrow(
        _reported(min_words), "doc_id long, piece int, start int, end int, words int, component_id long, copies long, within_document boolean, removed boolean, rows long")


def op3_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(table(spark, sf_dir, "documents"))
