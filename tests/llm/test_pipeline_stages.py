"""The pipeline's stages on rows that once were lost, on clashing columns, on empty tables; long mail domains and digit rows."""

from __future__ import annotations

import random

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from trendlens.llm import op1_covertree, op2_pii, op3_paragraphs, op8_language, queries
from trendlens.llm.common import table

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", lang_pred string, score double, mix_tokens long, mix_copies int, kept_0 string, row_of_stage long, pii_kinds string, place string"


def words(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_an_empty_table(spark, name):
    got = dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame([], DOCS), SMALL)
    assert got.count() == 0 and (name == "bpe" or got.columns == ["doc_id", "text", "lang", "source", "n_chars"])


def test_clashing_columns_come_through(spark):
    docs = table(spark, SMALL, "documents").limit(40)
    extra = docs.select("*", *[F.lit("7").cast(t).alias(c) for c, t in (x.split() for x in CLASHING.lstrip(", ").split(", "))])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, extra, SMALL)
        assert got.columns == extra.columns, name
        rows = got.collect()
        assert rows and all(r.place == "7" and r.mix_tokens == 7 and r.lang_pred == "7" for r in rows), name


def test_language_without_labels_keeps_lettered_texts(spark):
    rows = [(1, "some words", None, "s", 10), (2, "12 !!", None, "s", 5), (3, None, None, "s", 0), (4, "слова", None, "s", 5), (5, "", None, "s", 0)]
    got = corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCS), SMALL).collect()
    assert sorted((r.doc_id, r.lang) for r in got) == [(1, None), (4, None)]


def test_simhash_decides_by_row(spark):
    """Ids that repeat with other texts, null ids, repeated rows: one row per group of alike texts stays, no other goes."""
    a, b, c, d = (words(i) for i in range(4))
    rows = [(1, a), (5, a), (5, b), (6, c), (6, d), (None, a), (None, a), (6, d)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.simhash(spark, docs, SMALL).collect())
    assert got == sorted([(1, a), (5, b), (6, c), (6, d)])
    nulls = spark.createDataFrame([(None, t, "en", "s", 1) for t in (a, a, b, b)], DOCS)
    assert sorted(r.text for r in corpus_pipeline.simhash(spark, nulls, SMALL).collect()) == sorted([a, b])


def test_long_mail_domains_and_digit_rows(spark):
    """A domain of 100,000 labels stays and is no stack overflow; 127 labels are an address; a row of 20,000 groups
    gives the same as its pieces between cards do."""
    long, most = "a@" + ".".join(["ab"] * 100_000) + ".com", "x@" + ".".join(["ab"] * 126) + ".com"
    rng, card = random.Random(2), "4111 1111 1111 1111"
    row = " ".join([*(f"{rng.randrange(10):d}" for _ in range(5000)), card, *(f"{rng.randrange(10):d}" for _ in range(5000))])
    rows = [(1, long + " and b@c.org"), (2, most), (3, card), (4, "x " + row)]
    got = {r.doc_id: r for r in op2_pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text.startswith(long) and got[1].pii_found == ["email"] and "b@c.org" not in got[1].text
    assert got[2].pii_found == ["email"] and got[3].pii_found == ["card"]
    assert "card" in got[4].pii_found and card not in got[4].text and len(got[4].text) == len(row) + 2


def test_a_letter_that_grows_hides_no_passage(spark):
    """A passage of 60 words that two documents share is reported where one of them holds an İ elsewhere."""
    passage = words(9, 60).title()
    rows = [(1, f"{words(1, 30)}\n{passage}\n{words(2, 30)}"), (2, f"İstanbul {words(3, 30)}\n{passage.upper()}\n{words(4, 30)}")]
    got = op3_paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.words >= 60} == {1, 2} and len({r.component_id for r in got}) == 1
    assert {r.doc_id for r in got if r.removed} == {2}


def test_language_samples_share_the_room(spark):
    """One very long text and a hundred copies beside 70 short texts: 64 distinct texts, an equal share of each."""
    rows = [(i, words(100 + i, 200), "xx") for i in range(1, 70)] + [(1000, "z" * 500_000, "xx")] + [(2000 + i, "qq copy " * 50, "xx") for i in range(100)]
    rows += [(3000 + i, "few words here", "yy") for i in range(20)] + [(4000, None, "yy"), (4001, "no language", None)]
    got = op8_language.samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 6400)
    assert set(got) == {"xx", "yy"} and got["yy"].strip() == "few words here"
    parts = got["xx"].split(" ")
    assert 6400 <= len(got["xx"]) <= 6400 + op8_language.SAMPLE_DOCS
    assert got["xx"].count("z") <= 100 and got["xx"].count("copy") <= 13 and len(set(parts)) > 500


def test_vectors_with_repeated_and_null_ids(spark):
    """Ids are labels only: links belong to rows. Two vectors under one id, nulls linked to others and to each other."""
    e = [[1.0 if i == k else 0.0 for i in range(4)] for k in range(4)]
    near = lambda v: [x + 0.01 for x in v]      # noqa: E731
    rows = [(1, e[0]), (1, e[1]), (2, near(e[0])), (3, near(e[1])), (None, e[2]), (7, near(e[2])), (None, e[3]), (None, e[3]), (9, None), (None, [])]
    got = op1_covertree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    told = sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str)
    assert told == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (None, 1, 7, False), (7, 1, 7, True),
                           (None, 1, None, True), (None, 1, None, True), (9, 0, 9, True), (None, 0, None, True)], key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    """What the driver compares at sf0.01, here at sf0.001."""
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_op3_counts_every_occurrence(spark):
    """Repeats inside one document, in two rows of one doc_id, under null ids and in rows alike in id and text."""
    a, b, c, d, e = (words(50 + i, 60) for i in range(5))
    rest = iter(words(70 + i, 40) for i in range(20))
    rows = [(1, f"{a} {next(rest)} {a}"), (2, f"{next(rest)}\n{b}"), (2, f"{b}\n{next(rest)}"), (None, f"{c} {next(rest)}"),
            (None, f"{next(rest)} {c}"), (5, d), (5, d), (6, "of " * 50), (7, e), (8, next(rest))]
    got = op3_paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    of = lambda i: sorted((r.start, r.end, r.removed, r.within_document) for r in got if r.doc_id == i)
    assert of(1) == [(0, len(a), False, True), (len(text[1]) - len(a), len(text[1]), True, True)]
    assert sorted(r.removed for r in got if r.doc_id == 2) == sorted(r.removed for r in got if r.doc_id is None) == [False, True]
    assert {r.words for r in got if r.doc_id in (2, None)} == {60}
    assert [(r.words, r.copies, r.rows, r.removed) for r in got if r.doc_id == 5] == [(60, 2, 2, False)] * 2
    assert [(r.removed, r.words) for r in sorted((r for r in got if r.doc_id == 6), key=lambda r: r.start)] == [(False, 20), (True, 30)]
    assert not {r.doc_id for r in got} & {7, 8}


def test_op3_covers_shared_stretches_of_a_brute_force(spark):
    """Every window of 20 words that stands at two places is in a reported part; what is removed stands elsewhere too."""
    rng = __import__("random").Random(12)
    pool = [words(200 + i, rng.randrange(15, 45)) for i in range(12)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.4 else words(1000 + 50 * i + k, rng.randrange(5, 40)) for k in range(6))) for i in range(60)]
    got = op3_paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    places: dict[tuple, list] = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 19):
            places.setdefault(tuple(w[k:k + 20]), []).append((i, k))
    covered = {(r.doc_id, k) for r in got for k in range(r.piece, r.piece + r.words)}
    shared = [p for p in places.values() if len(p) > 1]
    assert shared and all((i, k + j) in covered for p in shared for i, k in p for j in range(20))
    repeated = {(i, k + j) for p in shared for i, k in p for j in range(20)}
    assert len(covered - repeated) <= 0.02 * len(covered)
    assert all((i, k + j) in {(r.doc_id, x) for r in got if r.removed for x in range(r.piece, r.piece + r.words)} for p in shared[:40] for i, k in sorted(p)[1:] for j in range(20))


def test_op3_sends_the_windows_of_a_passage_once(spark):
    """A passage in many texts: a row per anchor and text, no row per window; its windows' hashes once per batch. The setting that
    removes a step's shuffle files is put back."""
    passage = words(300, 200)
    docs = spark.createDataFrame([(i, f"{words(400 + i, 30)} {passage} {words(500 + i, 30)}") for i in range(50)], "doc_id long, text string").coalesce(1)
    found = op3_paragraphs.units(docs).cache()
    asked = op3_paragraphs.requests(found, op3_paragraphs.met_in_bands(found.where("unit is not null")))
    rows = op3_paragraphs.windows(docs, asked, 20).where("unit is null").cache()
    assert rows.count() < 50 * 181 / 4
    inside = [(r.n, r.told) for r in rows.groupBy("bundle").agg(F.count("*").alias("n"), F.sum(F.size("grams")).alias("told")).collect() if r.n == 50]
    assert len(inside) > 10 and all(told <= 13 * spark.sparkContext.defaultParallelism for _, told in inside)
    before = spark.conf.get(op3_paragraphs.CLEANUP)
    with op3_paragraphs.shuffles_removed(spark):
        assert spark.conf.get(op3_paragraphs.CLEANUP) == "true"
    assert spark.conf.get(op3_paragraphs.CLEANUP) == before


def test_op3_words_side_by_side_are_hashed_as_alone(monkeypatch):
    """Words of 1 to 70 letters, capitals, other letters and spaces, in slices of one and of many texts; places survive packing."""
    rng = random.Random(5)
    texts = ["", "a", " ", "İ \t\n" + "x" * 300 + "  中文 😀", " " * 400 + "one two", "Σίσυφος ΣΑΣ\x85A\x1cB\u2003c\r\nD", words(1, 50)]
    texts += [rng.choice(" \n\t").join("".join(rng.choice("aBcDe0:_[@`{Zz") for _ in range(rng.randrange(1, 71))) for _ in range(300)) for _ in range(6)]
    for side in (1, 50, 1 << 16):
        monkeypatch.setattr(op3_paragraphs, "SIDE", side)
        told = []
        for low, h, words_of, steps, line in op3_paragraphs.hashed(texts, op3_paragraphs.WordHashes()):
            assert low == len(told)
            told += [(h[a:b], *op3_paragraphs.unpacked(op3_paragraphs.packed(steps[a:b])), line[a:b]) for a, b in zip(words_of[:-1], words_of[1:])]
        assert len(told) == len(texts)
        for text, (h, start, end, line) in zip(texts, told, strict=True):
            assert [text[a:b] for a, b in zip(start, end)] == text.split()
            assert h.tolist() == [xxhash.xxh64_intdigest(w.lower()) for w in text.split()]
            breaks = [sum(text.count(c, a, b) for c in "\n\r") > 0 for a, b in zip(end[:-1], start[1:])]
            assert (line[1:] != line[:-1]).tolist() == breaks
    assert not list(op3_paragraphs.hashed([], op3_paragraphs.WordHashes()))
