"""Operator 5: mixing to target weights by soft membership.

A classifier learned from the labelled table gives each document a posterior over domains (`clean`,
`low` quality, `toxic`). Each document gets a nonnegative rate, how often it is to be read, such that
the expected tokens of every domain, the sum of rate * tokens * posterior, match the targets:

    minimise  1/2 (A r - t)' W (A r - t) + lambda/2 * sum of share_i (r_i - 1)^2,   r_i >= low_i

over all documents, by projected gradient; low_i is 1 for a document that is clean by KEEP_CLEAN and 0
for others, so mixing never drops a clean document. share_i is a document's share of all tokens, A r the
expected domain shares, and W the inverse of the posteriors' second moments, which makes one step
length right for every domain. A document's rate after k steps depends only on its posterior and on
the k residual vectors so far, so no state of the size of the corpus is kept: each step is one
aggregation over the narrow table of posteriors to as many sums as there are domains, and the final
rates are one projection.

Rates become copies by floor(rate + u), with u a hash of the document, so the expected number of
copies is the rate and equal runs agree.

Bounds (documented parameters): the classifier is fitted on at most SAMPLE_ROWS labelled documents,
chosen by hash; STEPS steps. All counts and sums cover all documents.

Defined cases: a null or empty text has no tokens and gets the classifier's answer for an empty
document; an empty label table, or one that meets no document, makes every document `clean`; labels
of one domain give that domain posterior 1 everywhere; a label with a null counts as not toxic, or as
good quality; a domain with no expected tokens takes no part in the fit; when no document has tokens
every rate is 1; repeated rows get equal rates; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import materialise, table

DOMAINS = ("clean", "low", "toxic")
TARGET_WEIGHTS = {"clean": 0.9, "low": 0.05, "toxic": 0.05}
KEEP_CLEAN = 0.5            # a document at least so likely to be clean has a rate of 1 or more
GAIN = 1.1                  # the heaviest domain is read so many times as often as it stands in the corpus
SAMPLE_ROWS = 6000
VOCABULARY = 4096           # words that the classifier knows, the commonest of the sample
MIN_DOCUMENTS = 15          # of the sample, that hold a word
SPARSITY = 4e-3             # weight of the L1 penalty
STEPS = 12
RIDGE = 1e-3                # lambda
TOLERANCE = 1e-4            # stop when the sums are so near the targets, or move less, as a share of all tokens

WORDS = "__mix_words"


def words(text: Column) -> Column:
    """Lower-case words and runs of symbols; white space and the end of a word separate."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+|(?<=\p{L})(?=[^\p{L}\s])"), lambda w: w != "")


def features(text: Column) -> Column:
    """The words, and one more that tells how often words repeat (distinct share in tenths)."""
    w = words(text)
    return F.get(F.transform(F.array(w), lambda x: F.concat(x, F.array(F.concat(
        F.lit("repeat "), F.floor(10 * F.size(F.array_distinct(x)) / F.greatest(F.size(x), F.lit(1))).cast("string"))))), F.lit(0))


def domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and domain of at most `rows` labelled documents."""
    chosen = (labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
              .select("doc_id", domain().alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


class Classifier:
    """Posterior of each domain; `found` names those that the sample has."""

    def __init__(self, sample: DataFrame):
        sample = materialise(sample, "mix-sample")
        self.found = sorted((r.domain for r in sample.select("domain").distinct().collect()), key=DOMAINS.index) or [DOMAINS[0]]
        self.model = None
        if len(self.found) > 1:
            label = F.array_position(F.array(*map(F.lit, self.found)), F.col("domain")).cast("double") - 1
            rows = sample.select(features(F.col("text")).alias(WORDS), label.alias("__mix_label")).repartition(6)
            self.model = Pipeline(stages=[
                CountVectorizer(inputCol=WORDS, outputCol="__mix_features", vocabSize=VOCABULARY, minDF=MIN_DOCUMENTS, binary=True),
                LogisticRegression(featuresCol="__mix_features", labelCol="__mix_label", predictionCol="__mix_prediction",
                                   rawPredictionCol="__mix_raw", probabilityCol="__mix_p", regParam=SPARSITY, elasticNetParam=1.0,
                                   maxIter=30, family="multinomial"),
            ]).fit(rows)

    def score(self, docs: DataFrame) -> DataFrame:
        """`docs` with mix_tokens and mix_p (array of posteriors in the order of DOMAINS)."""
        out = docs.withColumn(WORDS, features(F.col("text"))).withColumn("mix_tokens", (F.size(WORDS) - 1).cast("long"))
        if self.model:
            out = self.model.transform(out)
            got = vector_to_array(F.col("__mix_p"))
        else:
            got = F.array(F.lit(1.0))
        p = F.array(*[got[self.found.index(d)] if d in self.found else F.lit(0.0) for d in DOMAINS])
        return out.select(*docs.columns, "mix_tokens", p.alias("mix_p"))


def rate(p: Column, pulls: list[np.ndarray], step: float) -> Column:
    """A document's rate after the gradient steps so far: `pulls` are W (A r - t) of each step."""
    r, low = F.lit(1.0), F.when(p[DOMAINS.index("clean")] >= KEEP_CLEAN, 1.0).otherwise(0.0)
    for pull in pulls:
        along = sum((p[i] * F.lit(float(x)) for i, x in enumerate(pull)), F.lit(0.0))
        r = F.greatest(low, r * F.lit(1 - step * RIDGE) + F.lit(step * RIDGE) - along * F.lit(step))
    return r


def sums(scored: DataFrame, total: int, weight: Column, moments: bool = False) -> np.ndarray:
    """Expected domain shares under `weight`, or the posteriors' second moments: a few numbers in one row."""
    share = F.col("mix_tokens") / F.lit(float(total)) * weight
    n = range(len(DOMAINS))
    cells = [F.col("mix_p")[i] * (F.col("mix_p")[j] if moments else F.lit(1.0)) for i in n for j in (n if moments else (0,))]
    got = np.array([float(x or 0.0) for x in scored.agg(*[F.sum(c * share) for c in cells]).first()])
    return got.reshape(len(DOMAINS), -1) if moments else got


def fit_rates(scored: DataFrame, weights: dict[str, float], gain: float = GAIN) -> tuple[Column, dict[str, tuple[float, float]]]:
    """The rate as a column over mix_p, and per domain (target, reached) as shares of all tokens."""
    total = scored.agg(F.sum("mix_tokens")).first()[0]
    if not total:
        return F.lit(1.0), {}
    natural = sums(scored, total, F.lit(1.0))
    there = natural > 0
    want = np.array([weights.get(d, 0.0) for d in DOMAINS]) * there
    lead = int(np.argmax(want))
    if not want[lead]:
        return F.lit(1.0), {}
    target = want / want[lead] * natural[lead] * gain
    pull_by = np.linalg.pinv(sums(scored, total, F.lit(1.0), moments=True), rcond=1e-9)
    step = 1.0 / (1.0 + RIDGE)
    pulls: list[np.ndarray] = []
    reached, moved = natural, 1.0
    while len(pulls) < STEPS and min(moved, np.abs(reached - target).max()) > TOLERANCE:
        pulls.append(pull_by @ (reached - target))
        before, reached = reached, sums(scored, total, rate(F.col("mix_p"), pulls, step))
        moved = np.abs(reached - before).max()
    return rate(F.col("mix_p"), pulls, step), {d: (float(target[i]), float(reached[i])) for i, d in enumerate(DOMAINS) if there[i]}


def copies(rate_column: str, *identity: str) -> Column:
    """floor(rate + u), u in [0, 1) by hash of the identity columns."""
    u = F.pmod(F.xxhash64(*identity, F.lit("mix")), F.lit(1 << 31)) / F.lit(float(1 << 31))
    return F.floor(F.col(rate_column) + u).cast("int")


def mix(docs: DataFrame, labels: DataFrame, keep_columns: list[str], weights: dict[str, float] | None = None, gain: float = GAIN) -> DataFrame:
    """The kept columns of every document with mix_tokens, mix_p, mix_rate and mix_copies."""
    scored = Classifier(labelled_sample(docs, labels)).score(docs)
    kept = scored.select(*keep_columns, F.xxhash64("doc_id", "text").alias("mix_of"), "mix_tokens", "mix_p")
    kept = materialise(kept, "mix-scored")
    rate_of, _ = fit_rates(kept.select("mix_tokens", "mix_p"), weights or TARGET_WEIGHTS, gain)
    return kept.withColumn("mix_rate", rate_of).withColumn("mix_copies", copies("mix_rate", "mix_of")).drop("mix_of")


def op5_soft_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return got.select("doc_id", F.col("mix_tokens").alias("tokens"), *[F.col("mix_p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
                      F.col("mix_rate").alias("rate"), F.col("mix_copies").alias("copies"))
