from pyspark.sql import functions as F
from pyspark.ml.feature import StopWordsRemover

from trendlens.functions import text, vocab


def _one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_stop_list_matches_spark_default(spark):
    assert list(vocab.SPARK_ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(vocab.stop_words()) == 197


def test_token_cleaning_joins_letters(spark):
    words = _one(spark, text.drop_stop_words(text.tokens(F.col("s"))), "Lithium-ion  batteries, don't")
    assert [w for w in words if w] == ["lithiumion", "batteries", "dont"]


def test_empty_tokens_kept_until_length_filter(spark):
    assert _one(spark, text.tokens(F.col("s")), " a  B\tc \n") == ["", "a", "", "b", "c"]
    assert _one(spark, text.tokens(F.col("s")), "") == [""]
    assert _one(spark, text.tokens(F.col("s")), " 1 2") == []


def test_length_thresholds(spark):
    assert _one(spark, text.long_words(text.tokens(F.col("s")), 4), "abc abcd abcde") == ["abcd", "abcde"]
    assert _one(spark, text.long_words(text.tokens(F.col("s")), 5), "abc abcd abcde") == ["abcde"]


def test_long_stop_words_still_removed(spark):
    assert _one(spark, text.long_words(text.tokens(F.col("s")), 4), "their model works") == ["works"]


def test_year_normalise(spark):
    rows = spark.createDataFrame([("2019",), ("20191",), ("",), ("19a2",), (None,), ("2011",)], "y string")
    got = [r[0] for r in rows.select(text.normalise_year(F.col("y"))).collect()]
    assert got == [2019, 2019, None, None, None, 2011]


def test_keyword_split(spark):
    assert _one(spark, text.split_keywords(F.col("s")), "deep learning, cloud；iot") == ["deep learning", "cloud", "iot"]
    assert _one(spark, text.split_keywords(F.col("s")), ",;") == []


def test_domain_precedence_and_substrings(spark):
    cases = {"smart grid": "soc_sci", "clinical trial": "med_bio", "deep learning": "cs_eng",
             "law": "soc_sci", "tion": "generic", "training": "cs_eng"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = dict(df.select("s", text.domain_of(F.col("s"))).collect())
    assert got == cases


def test_volume_band(spark):
    df = spark.createDataFrame([(2001,), (2000,), (100,), (99,)], "n long")
    assert [r[0] for r in df.select(text.volume_band(F.col("n"))).collect()] == \
        ["rich", "sufficient", "sufficient", "scarce"]


def test_cleaning_of_every_character(spark):
    """ASCII letters and whitespace stay, nothing else does; what is dropped together is one match."""
    import re
    every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000, 7), *range(0x1F600, 0x1F650)]))
    assert _one(spark, text.clean_title(F.col("s")), every) == re.sub(r"[^a-zA-Z \t\n\x0b\f\r]", "", every).lower()
    assert _one(spark, F.regexp_count(F.col("s"), F.lit(text.NON_LETTER)), "a 2,048-bit key \u212a\u0130") == 2
