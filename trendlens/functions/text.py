"""Column expressions for the title text pipeline and keyword handling.

All of these are Spark SQL built-ins (codegen-able, no Python per row).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlens.functions import vocab

# Java regex classes; `\s` is ASCII whitespace [ \t\n\x0B\f\r].
# Runs, and the named class (ASCII letters too): a union of two ranges is matched about ten times slower.
NON_LETTER = r"[^\p{Alpha}\s]+"
WHITESPACE = r"\s"
SPACES = " \t\n\x0b\f\r"
KEYWORD_SEPARATORS = "[,，;；]+"
EDGE_SPACE = r"^\s+|\s+$"


def clean_title(title: Column) -> Column:
    """Drop everything but ASCII letters and whitespace, then lower-case.

    Letters on both sides of a dropped character are joined: "lithium-ion" -> "lithiumion".
    """
    return F.lower(F.regexp_replace(title, NON_LETTER, ""))


def tokens(title: Column) -> Column:
    """Split the cleaned title on every single whitespace character. Empty tokens in front and in between
    are kept, those at the end are not; a title of whitespace alone has no token, an empty one has one."""
    def split(clean: Column) -> Column:
        kept = F.rtrim(clean, F.lit(SPACES))
        return F.when((kept == "") & (clean != ""), F.array().cast("array<string>")).otherwise(F.split(kept, WHITESPACE))

    # bound to a lambda variable, so that the cleaning regex runs once per title
    return F.get(F.transform(F.array(clean_title(title)), split), F.lit(0))


def _not_stop(words: tuple[str, ...]):
    # `isin` over more than 10 literals is planned as a hash-set lookup (InSet), not a list scan;
    # tokens are never NULL, so NOT IN has no three-valued surprises here
    stop = list(words)
    return lambda w: ~w.isin(stop)


def drop_stop_words(words: Column) -> Column:
    """Remove every stop word, keep repeats and order (the full 197-word list)."""
    return F.filter(words, _not_stop(vocab.stop_words()))


def long_words(words: Column, min_len: int) -> Column:
    """Words with at least `min_len` letters that are not stop words, repeats and order kept.

    The length test runs first so the stop-word probe only sees the few long stop words.
    """
    not_stop = _not_stop(vocab.stop_words_longer_than(min_len - 1))
    return F.filter(words, lambda w: (F.length(w) >= min_len) & not_stop(w))


def is_long_word(word: Column, min_len: int) -> Column:
    """Row-level form of `long_words` for exploded words."""
    return (F.length(word) >= min_len) & _not_stop(vocab.stop_words_longer_than(min_len - 1))(word)


def basket_items(discipline: Column, words: Column, min_len: int) -> Column:
    """A title basket: the discipline plus its long words, as a set (first occurrence order)."""
    return F.array_union(F.array(discipline), long_words(words, min_len))


def normalise_year(year: Column) -> Column:
    """First four characters of the year as text, as an int; NULL when that is not a number.

    `try_cast`, not `cast`: under ANSI mode a bad cast raises instead of giving NULL.
    """
    return F.substring(year.cast("string"), 1, 4).try_cast("int")


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def split_keywords(text: Column) -> Column:
    """User keyword list -> whitespace-stripped, non-empty parts, in order."""
    parts = F.transform(F.split(text, KEYWORD_SEPARATORS), lambda p: strip(p))
    return F.filter(parts, lambda p: p != F.lit(""))


def _any_substring(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda k: F.contains(text, k))


def domain_of(keyword: Column) -> Column:
    """Domain by substring dictionary; precedence soc_sci > med_bio > cs_eng, else generic.

    Substring semantics are kept on purpose: 'ai' matches "training", 'art' matches "smart".
    """
    low = F.lower(keyword)
    expr = F.lit(vocab.GENERIC_DOMAIN)
    for name, words in reversed(vocab.DOMAIN_PRECEDENCE):
        expr = F.when(_any_substring(low, words), F.lit(name)).otherwise(expr)
    return expr


def volume_band(count: Column) -> Column:
    """Evidence volume: more than 2000 rich, fewer than 100 scarce, else sufficient."""
    return (F.when(count > 2000, F.lit("rich"))
            .when(count < 100, F.lit("scarce"))
            .otherwise(F.lit("sufficient")))


def _accents() -> tuple[str, str]:
    """Every character whose canonical decomposition is one base character and marks, and those bases; then the
    combining marks themselves, which have no counterpart and so are dropped by `translate`."""
    pairs, marks = [], []
    for c in map(chr, range(0x80, 0x2000)):
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if len(base) == 1 and base != c:
            pairs.append((c, base))
        elif not base:
            marks.append(c)
    return "".join(c for c, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


ACCENTED, BASES = _accents()
CI_AI = "UNICODE_CI_AI"         # Spark's collation for values compared whole: neither case nor accents count


def fold(text: Column) -> Column:
    """Lower case without accents: what a search compares. Literal: a user's `%` and `_` are plain characters."""
    return F.translate(F.lower(text), ACCENTED, BASES)


def ci_ai(value: Column | str) -> Column:
    """A value for equality and grouping that ignore case and accents."""
    return F.collate(value, CI_AI)
