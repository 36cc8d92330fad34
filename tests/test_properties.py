"""Property tests: Spark operators against brute-force Python on random inputs."""

import math
import re
from itertools import permutations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendlens.functions import text
from trendlens.operators import rules
from trendlens.params import Params

ITEMS = st.sampled_from(list("abcdefg"))
BASKETS = st.lists(st.sets(ITEMS, min_size=1, max_size=5), min_size=1, max_size=25)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _brute_rules(baskets, min_support, min_conf):
    n = len(baskets)
    min_count = math.ceil(min_support * n)
    sup = {}
    for b in baskets:
        for i in b:
            sup[i] = sup.get(i, 0) + 1
    out = {}
    for a, c in permutations(sorted(sup), 2):
        n_ac = sum(1 for b in baskets if a in b and c in b)
        if n_ac >= min_count and sup[a] >= min_count and n_ac / sup[a] >= min_conf:
            out[(a, c)] = n_ac / sup[a]
    return out


@SLOW
@given(BASKETS, st.sampled_from([0.05, 0.1, 0.3]), st.sampled_from([0.1, 0.5, 0.9]))
def test_pair_rules_match_brute_force(spark, baskets, min_support, min_conf):
    df = spark.createDataFrame([(i, sorted(b)) for i, b in enumerate(baskets)], "basket_id long, items array<string>")
    p = Params(min_support=min_support, min_confidence=min_conf)
    got = {(r["source"], r["target"]): r["confidence"] for r in rules.assoc_rules(df, p).collect()}
    assert got == _brute_rules(baskets, min_support, min_conf)


TEXTS = st.text(alphabet=st.sampled_from(list("ab ,;，；\t")), max_size=30)


@SLOW
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_keyword_split_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(text.split_keywords(F.col("s"))).collect()]
    want = [[k.strip() for k in re.split(r"[,，;；]+", t) if k.strip()] for t in texts]
    assert got == want
