"""Operator 4: secret scans with multipart credential linking.

Base spans (always reported), leftmost and non-overlapping per kind: `assign` (a named password,
secret, token or API key with a value), `access` (AKIA identifiers), `hex` (long hex strings).

Weak parts are reported only when complementary parts co-occur: access identifiers (`id`), bare
secrets (`key`) and endpoints (`url`) are joined on intervals within a scope. A scope is a
paragraph (text between blank lines), and parts must lie within REACH code points of each other. Weak identifiers have
12 characters or more, weak keys 16 or more; neither has an upper length:

- a weak `id` needs a secret (base `assign`, base `hex` or weak `key`),
- a weak `key` needs an identifier (base `access` or weak `id`),
- a `url` needs both an identifier and a secret.

The join runs inside each document as a sweep over sorted parts (nearest part of a kind on either
side), so its work is linear in the parts and no pairs are written; a document is one row.

Defined cases: a null or empty text has no spans; ties are ordered by start, then by kind as listed
in KINDS; a weak part that overlaps a base span is dropped; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from trendlens.llm.common import table

REACH = 256
MIN_ENTROPY = 3.0           # bits per character of a weak key
KINDS = ("assign", "access", "hex", "id", "key", "url")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")          # [0-9a-f]+ of 24 or more: a shorter run holds no longer match
WEAK_ID = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])[A-Z0-9]{12,}(?![A-Za-z0-9])")
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z]|[0-9a-f]+(?![A-Za-z0-9]))[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
URL = re.compile(r"""\b[a-z][a-z0-9+]{1,15}://[^\s"'<>|]+""", re.A)
DIGIT = re.compile(r"[0-9]")
BLANK = re.compile(r"\n[^\S\n]*\n")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted. Matches that fail their length rule are consumed, then dropped."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def weak_parts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found: list[tuple[int, int, int]] = []
    if DIGIT.search(text):                      # weak identifiers and keys hold a digit
        found += [(m.start(), 3, m.end()) for m in WEAK_ID.finditer(text) if not m[0].isdigit()]
        found += [(m.start(), 4, m.end()) for m in WEAK_KEY.finditer(text) if entropy(m[0]) >= MIN_ENTROPY and not m[0].isupper()]
    if "://" in text:
        found += [(m.start(), 5, m.end()) for m in URL.finditer(text)]
    starts, last_end, clear = [s for s, _, _ in base], [], []
    for _, _, e in base:
        last_end.append(max(e, last_end[-1] if last_end else 0))
    for s, k, e in found:
        i = bisect_left(starts, e)              # base spans that begin before this part ends
        if not i or last_end[i - 1] <= s:
            clear.append((s, k, e))
    return sorted(clear)


def linked(text: str, base: list[tuple[int, int, int]], weak: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The weak parts whose complementary parts lie in the same scope and within REACH."""
    if not weak:
        return []
    edges = [m.start() for m in BLANK.finditer(text)]
    scope = lambda at: bisect_left(edges, at)
    ids = sorted(x for x in base + weak if x[1] in (1, 3))
    keys = sorted(x for x in base + weak if x[1] in (0, 2, 4))

    def near(part: tuple[int, int, int], others: list[tuple[int, int, int]]) -> bool:
        i = bisect_left(others, part)
        for o in others[max(0, i - 1):i + 1]:       # the nearest on either side
            gap = max(o[0] - part[2], part[0] - o[2])
            if gap <= REACH and scope(o[0]) == scope(part[0]):
                return True
        return False

    needs = {3: (keys,), 4: (ids,), 5: (ids, keys)}
    return [x for x in weak if all(near(x, others) for others in needs[x[1]])]


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and linked weak spans of one text."""
    base = base_spans(text)
    return base, linked(text, base, weak_parts(text, base))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")}
        for text in batch.column(1):
            base, extra = scan(text.as_py() or "")
            n = Counter(k for _, k, _ in base)
            for name, value in zip(out, (n[0], n[1], n[2], hashlib.sha256(as_text(base).encode()).hexdigest(),
                                         as_text(sorted(base + extra)), len(extra)), strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64())
                                                             for k, v in out.items())], ["doc_id", *out])


def scan_secrets(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_rows, SCHEMA)


def op4_multipart_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
