"""Operator 7: BPE encoding and decoding with a minimal acyclic transducer lexicon.

The frequent words of the corpus (counted over all documents) are compiled into a minimal acyclic
automaton: states with equal futures are shared, and every arc carries the number of words that
sort before it at its state, so the sum along a word's path is the word's rank, and the rank
gives its token ids. The automaton is one image of flat arrays; each Python worker puts it into a
file without a name and memory-maps it. A batch's distinct words walk it side by side; words it
doesn't hold are merged exactly, by rank and then position.

The tokenizer file's steps: special tokens are cut out of the raw text, the rest is normalised (NFC,
white space to a blank, lower case), split into words, mapped to bytes, and each word is merged
with an end-of-word mark on its last symbol. Decoding joins the token strings with blanks, as the
file names no decoder.

Bounds (documented parameters): LEXICON words; each task's counter is cut to COUNTER words when, after
COUNTED texts, it holds more than 2 * COUNTER (Misra-Gries: every word of more than a COUNTER-th of
a task's words is in it); CACHE words are remembered. They decide speed only, never results.

Defined cases: a null or empty text has no tokens and decodes to the empty text; repeated rows get a
row each; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import table, text_batches

TOKENIZER = "word_bpe_49k.json"
LEXICON = 1 << 16
COUNTER = 1 << 16
COUNTED = 200                   # texts whose runs are counted before their words are
CACHE = 200_000                 # words that a worker remembers
SHORT = 48                      # symbols up to which the plain merge loop is used
NEVER = 1 << 30


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def byte_letters() -> list[str]:
    """The printable character of each byte, as byte-level vocabularies write them."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Rules:
    """What a tokenizer file says, as plain dictionaries (bounded by its vocabulary)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.mark: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in {**self.vocab, **self.special}.items()}
        self.pattern: str = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.mark] for c in letters]
        pairs = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in model["merges"]]
        self.rank = {a << 20 | b: i for i, (a, b, _) in enumerate(pairs)}       # of a pair of ids
        self.made = [c for _, _, c in pairs]                                    # the id that a rank makes

    def merge(self, word: str) -> list[int]:
        """Token ids of one word: the lowest rank first, the leftmost first among equals."""
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]]
        ids.append(self.last[data[-1]])
        return self._few(ids) if len(ids) <= SHORT else self._many(ids)

    def _few(self, ids: list[int]) -> list[int]:
        rank = self.rank.get
        ranks = [rank(a << 20 | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            made = self.made[best]
            ids[i:i + 2] = [made]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 20 | made, NEVER)
            if i < len(ranks):
                ranks[i] = rank(made << 20 | ids[i + 1], NEVER)
        return ids

    def _many(self, ids: list[int]) -> list[int]:
        """The same for long words, by a heap of pairs and a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := self.rank.get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or self.rank.get(ids[i] << 20 | ids[j]) != r:
                continue                        # one of the two has been merged meanwhile
            ids[i], ids[j] = self.made[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (x := self.rank.get(ids[a] << 20 | ids[b])) is not None:
                    heapq.heappush(heap, (x, a))
        return [x for x in ids if x >= 0]


class Merger:
    """Many words at once, merged as `Rules.merge` does: in each step every word makes its lowest-ranked pair,
    the leftmost among equals. Words of like length share a matrix; those over SHORT go one by one."""

    WIDTHS = (8, 12, 16, 24, SHORT)

    def __init__(self, rules: Rules):
        self.rules = rules
        self.inner, self.last, self.made = (np.array(x, np.int64) for x in (rules.inner, rules.last, rules.made))
        keys = np.fromiter(rules.rank, np.int64, len(rules.rank))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(rules.rank.values(), np.int64, len(keys))[order]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NEVER where there is none; -1 stands behind a word's end."""
        want = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], NEVER)

    def __call__(self, words: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """(words, number of ids of each, ids one word after the other), in groups."""
        data = [w.encode() for w in words]
        lengths = np.array([len(d) for d in data], np.int64)
        low = 0
        for width in self.WIDTHS:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            if len(rows):
                yield from self.group([words[i] for i in rows], b"".join([data[i] for i in rows]), lengths[rows], width)
        for i in np.flatnonzero(lengths > SHORT):
            ids = np.array(self.rules.merge(words[i]), np.int64)
            yield [words[i]], np.array([len(ids)]), ids

    def group(self, words: list[str], data: bytes, lengths: np.ndarray, width: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        letters = np.frombuffer(data, np.uint8)
        ids = np.full((len(words), width + 1), -1, np.int64)
        ids[np.arange(width + 1) < lengths[:, None]] = self.inner[letters]
        row = np.arange(len(words))
        ids[row, lengths - 1] = self.last[letters[np.cumsum(lengths) - 1]]
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        number, column = row, np.arange(width + 1)
        while len(number):
            pos = ranks.argmin(1)
            best = ranks[row, pos]
            done = best == NEVER
            if done.any():
                ready = ids[done]
                held = ready >= 0
                yield [words[i] for i in number[done]], held.sum(1), ready[held]
                ids, ranks, number, pos, best = ids[~done], ranks[~done], number[~done], pos[~done], best[~done]
                row = np.arange(len(number))
            ids = np.where(column <= pos[:, None], ids, np.roll(ids, -1, 1))
            ids[:, -1] = -1
            ids[row, pos] = self.made[best]
            ranks = np.where(column[:-1] < pos[:, None], ranks, np.roll(ranks, -1, 1))
            ranks[:, -1] = NEVER
            ranks[row, pos] = self.rank(ids[row, pos], ids[row, pos + 1])
            left = np.flatnonzero(pos)
            ranks[left, pos[left] - 1] = self.rank(ids[left, pos[left] - 1], ids[left, pos[left]])


class Splitter:
    """Text -> words and special tokens, in order."""

    def __init__(self, pattern: str, special: Iterable[str]):
        self.words = regex.compile(pattern).findall
        self.between = regex.compile(r"\S+").findall
        self.special = set(special)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def plain(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")        # each character by itself: no final sigma
        return text.lower()                     # no word holds white space, so which kind it is doesn't matter

    def parts(self, text: str, each: Callable[[str], list[str]]) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return each(self.plain(text))
        out: list[str] = []
        for part in self.cut.split(text):
            out += [SPECIAL + part] if part in self.special else each(self.plain(part))
        return out

    def __call__(self, text: str) -> list[str]:
        return self.parts(text, self.words)

    def runs(self, text: str) -> list[str]:
        """Runs without white space, and special tokens. A text's words are those of its runs, so where
        only their number matters, a run that stands there often is split once."""
        return self.parts(text, lambda t: self.between(t) if any(c in t for c in SEPARATORS) else t.split())

    def of_run(self, run: str) -> list[str]:
        return [run] if run.startswith(SPECIAL) else self.words(run)


SPECIAL = "\u0000 "             # no run holds a blank, so this marks special tokens
SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to str.split, but not to the tokenizer


class Automaton:
    """Minimal acyclic automaton over UTF-8 bytes. Arcs are sorted by state * 256 + byte; `skip` is
    the number of words that sort before the arc's words at its state, and a final state counts one."""

    NAMES = ("keys", "target", "skip", "final", "starts", "ids")

    def __init__(self, keys, target, skip, final, starts, ids):
        self.keys, self.target, self.skip, self.final, self.starts, self.ids = keys, target, skip, final, starts, ids

    @classmethod
    def build(cls, outputs: dict[str, list[int]]) -> Automaton:
        words = sorted((w.encode(), ids) for w, ids in outputs.items())
        register: dict[tuple, int] = {}
        nodes: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def settle(node: list) -> int:
            sig = (node[0], tuple(node[1]))
            if sig not in register:
                register[sig] = len(nodes)
                nodes.append(sig)
            return register[sig]

        path: list[list] = [[False, []]]            # open states: final?, settled arcs
        last = b""
        for w, _ in words:
            same = len(os.path.commonprefix([last, w]))
            while len(path) > same + 1:
                done = settle(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            path += [[False, []] for _ in w[same:]]
            path[-1][0] = True
            last = w
        while len(path) > 1:
            done = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        root = settle(path.pop())
        total = [0] * len(nodes)                    # words below a state; children are settled first
        rows = []
        for i, (final, arcs) in enumerate(nodes):
            total[i] = int(final)
            for byte, to in arcs:
                rows.append((i, byte, to, total[i]))
                total[i] += total[to]
        number = [(i - root) % len(nodes) for i in range(len(nodes))]       # the start state is 0
        rows = sorted((number[i] * 256 + byte, number[to], skip) for i, byte, to, skip in rows)
        final = np.zeros(len(nodes), np.int32)
        for i, (is_final, _) in enumerate(nodes):
            final[number[i]] = is_final
        keys, target, skip = (np.array([r[k] for r in rows], t) for k, t in enumerate((np.int64, np.int32, np.int32)))
        lengths = np.array([len(ids) for _, ids in words], np.int64)
        return cls(keys, target, skip, final, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
                   np.array([i for _, ids in words for i in ids], np.uint32))

    def dump(self) -> bytes:
        """One image: a header with the type and length of each array, then the arrays, aligned."""
        arrays = [np.ascontiguousarray(getattr(self, name)) for name in self.NAMES]
        head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
        parts = [len(head).to_bytes(8, "little"), head]
        for a in arrays:
            parts += [bytes(-sum(map(len, parts)) % 8), a.tobytes()]
        return b"".join(parts)

    @classmethod
    def mapped(cls, image: bytes) -> Automaton:
        """Put an image into a file without a name and map its arrays, read-only, from there."""
        with tempfile.TemporaryFile() as f:
            f.write(image)
            f.flush()
            pages = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        at = 8 + int.from_bytes(pages[:8], "little")
        arrays = []
        for kind, n in json.loads(pages[8:at]):
            at += -at % 8
            arrays.append(np.frombuffer(pages, kind, n, at))
            at += arrays[-1].nbytes
        return cls(*arrays)

    def ranks(self, words: list[str]) -> np.ndarray:
        """Rank of each word, or -1. All words walk together, one byte at a time."""
        if not words or not len(self.keys):
            return np.full(len(words), -1, np.int64)
        data = [w.encode() for w in words]
        lengths = np.array([len(w) for w in data])
        flat = np.frombuffer(b"".join(data), np.uint8)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        state, rank = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.arange(len(words))
        for step in range(int(lengths.max())):
            alive = alive[(lengths[alive] > step) & (state[alive] >= 0)]
            if not len(alive):
                break
            want = state[alive] * 256 + flat[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[arc] == want
            rank[alive] += np.where(ok, self.skip[arc], 0)
            state[alive] = np.where(ok, self.target[arc], -1)
        found = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(found, rank, -1)


class Encoder:
    """Words -> (ids as little-endian bytes, decoded piece), by lexicon first and merges else."""

    def __init__(self, rules: Rules, lexicon: Automaton):
        self.rules, self.lexicon, self.known = rules, lexicon, {}
        self.merger = Merger(rules)
        self.split = Splitter(rules.pattern, rules.special)

    def keep(self, words: list[str], counts: np.ndarray, flat: np.ndarray) -> None:
        """Remember the pieces of words; `flat` holds their ids one word after the other."""
        ends = np.cumsum(counts).tolist()
        data, strings = flat.astype("<u4").tobytes(), list(map(self.rules.strings.__getitem__, flat.tolist()))
        at = 0
        for w, end in zip(words, ends, strict=True):
            self.known[w] = data[4 * at:4 * end], strings[at] if end - at == 1 else " ".join(strings[at:end])
            at = end

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE:
            self.known = {}
        new = [w for w in words if w not in self.known]
        ranks = self.lexicon.ranks(new)
        found, lexicon = ranks[ranks >= 0], self.lexicon
        starts = lexicon.starts[found]
        counts = lexicon.starts[found + 1] - starts
        at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        self.keep([new[i] for i in np.flatnonzero(ranks >= 0)], counts, lexicon.ids[at])
        other = [new[i] for i in np.flatnonzero(ranks < 0)]
        special = [w for w in other if w.startswith(SPECIAL)]
        self.keep(special, np.ones(len(special), np.int64), np.array([self.rules.special[w[len(SPECIAL):]] for w in special], np.int64))
        for group in self.merger([w for w in other if not w.startswith(SPECIAL)]):
            self.keep(*group)

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        known = self.known
        for words in split:
            pairs = [known[w] for w in words]
            yield b"".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs])


def frequent_words(docs: DataFrame, pattern: str, special: list[str], limit: int = LEXICON) -> list[str]:
    """The commonest words over all documents. Each task keeps a bounded Misra-Gries counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Splitter(pattern, special), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED):
                runs: Counter = Counter()
                for text in batch.column(0).slice(at, COUNTED):
                    runs.update(split.runs(text.as_py() or ""))
                for run, n in runs.items():
                    for word in split.of_run(run):
                        seen[word] += n
                if len(seen) > 2 * COUNTER:
                    floor = sorted(seen.values(), reverse=True)[COUNTER]
                    seen = Counter({w: n - floor for w, n in seen.items() if n > floor})
        kept = [(w, n) for w, n in seen.items() if n > 1 and not w.startswith(SPECIAL)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    counts = text_batches(docs).select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(limit).collect()]      # `limit` rows


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>), decoded, ids_sha256, decoded_sha256 of every document."""
    spark = docs.sparkSession
    rules = Rules(path or default_path())
    words = frequent_words(docs, rules.pattern, list(rules.special))
    image = Automaton.build({w: rules.merge(w) for w in words}).dump()
    shipped = spark.sparkContext.broadcast((rules, image))   # bounded by the vocabulary and by LEXICON

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, image = shipped.value
        encoder = Encoder(rules, Automaton.mapped(image))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, decoded = zip(*encoder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True)
                counts = np.array([len(b) // 4 for b in ids], np.int64)
                flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(counts), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat),
                    pa.array(decoded, pa.string()), pa.array([hashlib.sha256(b).hexdigest() for b in ids], pa.string()),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                ], ["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"])

    return text_batches(docs).select("doc_id", "text").mapInArrow(rows, "doc_id long, n_tokens long, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string")


def op7_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
