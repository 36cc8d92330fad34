"""The corpus pipeline: five stages, each calling one operator of trendlens.llm on what its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared
folder and read again as the next stage's documents. All but the last return the columns of documents.

1. language  documents whose language cannot be told (null text, or no letter) go; the rest carry the predicted
             language in `lang`. Where no language can be learned (no labelled text), every text with a letter
             stays and `lang` is left as it is
2. simhash   one row of each group of near duplicates stays: the smallest doc_id (null last), then the smallest
             text hash. Rows count, not ids: rows of one doc_id whose texts are not alike all stay
3. pii       personal data in `text` is replaced by pseudonyms; n_chars follows
4. mixing    each document is repeated or dropped by its fitted rate; clean documents are never dropped
5. bpe       token ids, their decoding and digests per document

A table with no rows passes through every stage. Extra columns of documents are kept up to stage 4, whatever their
names: inside a stage every column but doc_id and text has a name of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import materialise, table
from trendlens.llm.op2_pii import pseudonymise
from trendlens.llm.op5_mixing import mix
from trendlens.llm.op7_bpe import encode_decode
from trendlens.llm.op8_language import UNDETERMINED, learn, predict, samples
from trendlens.llm.op9_simhash import near_duplicates


ROW = "row_of_stage"


def enclosed(docs: DataFrame) -> tuple[DataFrame, list[str], list]:
    """`docs` with its columns but doc_id and text renamed, those names, and the columns that undo it."""
    inner = [c if c in ("doc_id", "text") else f"kept_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*inner), inner, [F.col(i).alias(c) for i, c in zip(inner, docs.columns, strict=True)]


def replaced(columns: list, docs: DataFrame, name: str, value) -> list:
    """`columns` with the one of `docs` called `name` (if there) as `value`."""
    return [value.alias(name) if c == name else x for c, x in zip(docs.columns, columns, strict=True)]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the language operator rejects. A row's columns travel with its text: nothing is joined back."""
    model = learn(samples(docs))
    inner, names, columns = enclosed(docs)
    if not model[1]:
        return inner.where(F.col("text").rlike(r"\p{L}")).select(*columns)
    found = predict(inner, model, tuple(c for c in names if c != "doc_id")).where(F.col("lang_pred") != UNDETERMINED)
    return found.select(*replaced(columns, docs, "lang", F.col("lang_pred")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decides in narrow tables by row; the texts meet the rows that stay once."""
    inner, _, columns = enclosed(docs)
    rows = materialise(inner.withColumn(ROW, F.monotonically_increasing_id()), "simhash-rows")
    groups = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW), "component_id")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text").alias("hash"), ROW)
    places = materialise(rows.select(ROW, first.alias("place")), "simhash-places")
    kept = groups.join(places, ROW).groupBy("component_id").agg(F.min("place").alias("place")).select(F.col(f"place.{ROW}").alias(ROW))
    kept = materialise(kept, "simhash-kept")
    return rows.join(kept, ROW, "left_semi").select(*columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, _, columns = enclosed(docs)
    return pseudonymise(inner, found="pii_kinds").select(*replaced(columns, docs, "n_chars", F.length("text").cast("long")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    inner, names, columns = enclosed(docs)
    got = mix(inner, table(spark, sf_dir, "labels"), names)
    return got.where("mix_copies > 0").withColumn("copy_of_stage", F.explode(F.sequence(F.lit(1), "mix_copies"))).select(*columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs)


STAGES = [("language", language), ("simhash", simhash), ("pii", pii), ("mixing", mixing), ("bpe", bpe)]
ORACLE_SQL = None       # automata, Feistel rounds, fitted rates and BPE merges are not SQL: see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
