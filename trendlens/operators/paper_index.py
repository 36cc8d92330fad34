"""A persisted index of paper titles, and the searches that read it instead of the titles.

Three written tables, all flat (a hot gram or word is many rows, never one long list):

  postings  word, id            every distinct folded word of a title beside its paper. Each task writes the
                                words of the titles it reads, sorted: no shuffle, and a word that a third of all
                                papers hold is spread over all files
  grams     gram, word, often   every distinct word of the corpus under the GRAM characters at each of its places
                                (filled up behind its end), with the number of papers that hold it
  gram_sizes  gram, words       the number of words under each gram

A keyword is cut at white space. Any title that holds it holds, for each part, a word that contains the part
(at the keyword's inner ends: begins or ends with it). A part finds its words under its rarest gram, or, shorter
than a gram, under the grams that begin with it. The keyword's rarest two parts are intersected in the postings,
and what is left is compared with the titles where the keyword has several parts; one part alone is decided by
the words. A request without a keyword needs the newest papers of a year and discipline only. All joins are by
key: titles are read for the papers that come out, and for the candidates of keywords of several words.

`search` takes a `write` (name, rows) -> rows, by which a job writes the narrow tables in between (requests, matched
words, candidates, hits), so that the planner knows their sizes: small ones are broadcast, and then neither the
index nor a title moves.

Matching is case- and accent-insensitive (`text.fold`); disciplines are compared under UNICODE_CI_AI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.functions import text
from trendlens.operators.clean import top_per_key

GRAM = 3
FILL = "\x01" * (GRAM - 1)     # behind a word's end, so that every place of it begins a gram
RAREST = 2                      # parts of a keyword that are intersected
ANY_YEAR = -1


def postings(cleaned: DataFrame) -> DataFrame:
    """word, id: sorted within each task's share of the papers."""
    words = F.array_distinct(F.split(text.fold(F.col("title")), text.WHITESPACE))
    return cleaned.select(F.explode(words).alias("word"), "id").where("word <> ''").sortWithinPartitions("word", "id")


def word_grams(posted: DataFrame) -> DataFrame:
    """gram, word, often."""
    words = posted.groupBy("word").agg(F.count(F.lit(1)).alias("often"))
    return words.select(F.explode(F.array_distinct(_grams(F.concat("word", F.lit(FILL))))).alias("gram"), "word", "often")


def gram_sizes(grams: DataFrame) -> DataFrame:
    """gram, words: how many words each gram leads to (a small table: grams have GRAM characters)."""
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("words"))


def _grams(s: F.Column) -> F.Column:
    return F.transform(F.sequence(F.lit(1), F.length(s) - GRAM + 1), lambda i: F.substring(s, i, GRAM))


def _requests(requests: DataFrame) -> DataFrame:
    """qid, kw, disc, year of the requests that can have an answer; '' or NULL year = no filter."""
    open_ = lambda c: F.when(F.col(c).isNull() | F.col(c).isin("", "All"), None).otherwise(F.col(c))     # noqa: E731
    r = requests.select("qid", text.fold(text.strip(F.coalesce("keyword", F.lit("")))).alias("kw"),
                        open_("discipline").alias("disc"), open_("year").alias("_y"))
    return r.withColumn("year", F.col("_y").try_cast("int")).where("_y is null or year is not null").drop("_y")


def _matched_words(parts: DataFrame, grams: DataFrame, sizes: DataFrame) -> DataFrame:
    """`parts` (part_text, ...) beside every word of the corpus that may stand where the part does."""
    keys = parts.select("part_text").distinct()
    own = keys.where(F.length("part_text") >= GRAM).withColumn("gram", F.explode(F.array_distinct(_grams(F.col("part_text")))))
    # a part with a gram that no word has is in no title
    rarest = own.join(sizes, "gram", "left").groupBy("part_text").agg(
        F.min(F.struct(F.coalesce("words", F.lit(0)), "gram"))["gram"].alias("gram"))
    heads = F.explode(F.array(*[F.substring("gram", 1, n) for n in range(1, GRAM)])).alias("part_text")
    short = sizes.select(heads, "gram").join(keys, "part_text").distinct()
    # one pass over the grams; a short part meets a word once for each place
    found = rarest.unionByName(short.select("part_text", "gram")).join(grams, "gram").where(F.contains("word", "part_text"))
    found = found.groupBy("part_text", "word").agg(F.max("often").alias("often"))
    inner = F.col("first") | F.startswith("word", "part_text")
    outer = F.col("last") | F.endswith("word", "part_text")
    return parts.join(found, "part_text").where(inner & outer)


def _by_keyword(r: DataFrame, papers: DataFrame, posted: DataFrame, grams: DataFrame, sizes: DataFrame, write) -> DataFrame:
    """qid, id, publish_year of every paper that answers a request with a keyword."""
    cut = r.where("kw <> ''").select("qid", F.split("kw", text.WHITESPACE).alias("_all"))
    parts = cut.select("qid", F.size("_all").alias("_n"), F.posexplode("_all").alias("at", "part_text")).where("part_text <> ''") \
        .select("qid", "at", "part_text", (F.col("at") == 0).alias("first"), (F.col("at") == F.col("_n") - 1).alias("last"))
    words = write("matched_words", _matched_words(parts, grams, sizes).select("qid", "at", "word", "often"))
    weight = words.groupBy("qid", "at").agg(F.sum("often").alias("_w"))
    chosen = weight.withColumn("_r", F.row_number().over(Window.partitionBy("qid").orderBy("_w", "at"))).where(F.col("_r") <= RAREST)
    wanted = parts.groupBy("qid").agg(F.least(F.count(F.lit(1)), F.lit(RAREST)).alias("need"), (F.count(F.lit(1)) > 1).alias("check"))
    look = words.join(chosen.select("qid", "at"), ["qid", "at"]).select("word", "qid", "at")
    met = look.join(posted, "word").select("qid", "at", "id").distinct().groupBy("qid", "id").agg(F.count(F.lit(1)).alias("_k"))
    met = met.join(wanted, "qid").where("_k = need").join(r, "qid")
    facts = papers.select("id", "publish_year", "discipline")
    met = met.join(facts, "id").where((F.col("year").isNull() | (F.col("publish_year") == F.col("year"))) & _same_discipline())
    met = write("candidates", met.select("qid", "id", "publish_year", "check", F.when(F.col("check"), F.col("kw")).alias("kw")))
    sure = met.where(~F.col("check")).select("qid", "id", "publish_year")
    titles = papers.select("id", "title")
    told = met.where("check").select("qid", "id", "publish_year", "kw").join(titles, "id").where(F.contains(text.fold(F.col("title")), F.col("kw")))
    return sure.unionByName(told.select("qid", "id", "publish_year"))


def _same_discipline() -> F.Column:
    return F.col("disc").isNull() | (text.ci_ai("discipline") == text.ci_ai("disc"))


def _newest(r: DataFrame, papers: DataFrame, limit: int) -> DataFrame:
    """qid, id, publish_year for requests without a keyword. The newest papers of any choice of year and discipline
    are among the first `limit` ids of each (year, discipline)."""
    first = Window.partitionBy("publish_year", "discipline").orderBy("id")
    top = papers.select("id", "publish_year", "discipline").withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= limit)
    keys = F.array(*[F.struct(y.alias("year_key"), d.alias("disc_key")) for y in (F.col("publish_year"), F.lit(ANY_YEAR))
                     for d in (F.col("discipline"), F.lit(""))])
    listed_ = top.select("id", "publish_year", F.explode(keys).alias("k")).select("id", "publish_year", "k.year_key", text.ci_ai("k.disc_key").alias("disc_key"))
    asked = r.where("kw = ''").select("qid", F.coalesce("year", F.lit(ANY_YEAR)).alias("year_key"), text.ci_ai(F.coalesce("disc", F.lit(""))).alias("disc_key"))
    return asked.join(listed_, ["year_key", "disc_key"]).select("qid", "id", "publish_year").distinct()


def search(papers: DataFrame, requests: DataFrame, posted: DataFrame, grams: DataFrame, sizes: DataFrame, limit: int,
           write=lambda name, rows: rows) -> DataFrame:
    """qid, rank, id, title, discipline, publish_year, source of the `limit` newest papers of each request."""
    r = write("requests", _requests(requests))
    hits = _by_keyword(r, papers, posted, grams, sizes, write).unionByName(_newest(r, papers, limit))
    top = top_per_key(hits, "qid", "id", limit, F.desc("publish_year"), F.asc("id")).select("qid", "rank", "id")
    return write("hits", top).join(papers, "id").select("qid", "rank", "id", "title", "discipline", "publish_year", "source")
