"""Text column expressions.

All of them are built-in Spark expressions except Unicode NFKC, which Spark lacks:
that one is an Arrow UDF, and it receives only the few texts NFKC could change.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.functions import lexicons

# Unicode white space plus the four information separators.
SPACE = r"(?U)[\s\x1c-\x1f]+"
# Word characters in the sense "letter or number", which splits at combining marks.
WORD_RUN = r"[\p{L}\p{N}]+"
# Latin letters incl. the accented block, the Devanagari block, ASCII digits.
CLAIM_TOKEN = r"[a-zA-ZÀ-ÿऀ-ॿ0-9]+"
INDEX_TOKEN = r"[\p{L}\p{N}_]{2,}"
# Anything outside these characters may change under NFKC: ASCII, the Latin blocks without
# their compatibility characters, Devanagari without nukta, accents and nukta letters.
MAY_CHANGE_UNDER_NFKC = (
    r"[^\x00-\x7F¡-§©«-®°±¶·»"
    r"¿-ıĴ-ľŁ-ňŊ-ž"
    r"ऄ-नप-रलळव-ऻऽ-ॐॠ-ॿऀ-ः"
    r"‐‒-‖‘-”]"
)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression named inside a lambda is computed again for every element; passed through
    a one-element array it becomes a variable of an outer lambda instead.
    """
    return F.transform(F.array(value), body)[0]


def text_or_blank(c: Column) -> Column:
    """Null becomes the empty string, anything else its string form."""
    return F.coalesce(c.cast("string"), F.lit(""))


def may_change_under_nfkc(text: Column) -> Column:
    """Whether NFKC may change the text. Only what is left without ASCII meets the long character class."""
    rest = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return (F.octet_length(text) != F.length(text)) & rest.rlike(MAY_CHANGE_UNDER_NFKC)


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def nfkc(c: Column) -> Column:
    """Unicode NFKC. Texts that cannot change never leave the JVM."""
    text = text_or_blank(c)
    return F.coalesce(_nfkc(F.when(may_change_under_nfkc(text), text)), text)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_all(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else [unicodedata.normalize("NFKC", x) for x in v])


def nfkc_array(c: Column) -> Column:
    """NFKC of every element; nulls become blank, a null array becomes empty.

    Lists without an element that may change never leave the JVM.
    """
    clean = F.transform(c, text_or_blank)
    changing = F.exists(clean, may_change_under_nfkc)
    return F.coalesce(_nfkc_all(F.when(changing, clean)), clean, F.array().cast("array<string>"))


def fold(c: Column) -> Column:
    """Lower case, white space runs to one space, no outer space."""
    return F.trim(F.regexp_replace(F.lower(c), SPACE, " "))


def normalize_text(c: Column) -> Column:
    """NFKC followed by :func:`fold`; null gives the empty string."""
    return fold(nfkc(c))


def collapse_ws(c: Column) -> Column:
    """White space runs to one space and no outer space; case is kept."""
    return F.trim(F.regexp_replace(text_or_blank(c), SPACE, " "))


def strip_ws(c: Column) -> Column:
    """Remove any white space at both ends; inner white space is kept."""
    head = F.regexp_replace(text_or_blank(c), r"(?U)^[\s\x1c-\x1f]+", "")
    return F.regexp_replace(head, r"(?U)[\s\x1c-\x1f]+$", "")


def tokens(c: Column, pattern: str = CLAIM_TOKEN) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def token_set(normalized: Column) -> Column:
    """Distinct claim tokens of an already normalised text."""
    return F.array_distinct(tokens(normalized, CLAIM_TOKEN))


def word_set(normalized: Column) -> Column:
    """Distinct letter-or-number runs of an already normalised text."""
    return F.array_distinct(tokens(normalized, WORD_RUN))


def words_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def drop_stopwords(words: Column, stopwords) -> Column:
    """Keep order and repeats, drop every word of the lexicon."""
    stop = list(stopwords)
    return F.filter(words, lambda w: ~w.isin(stop))


def normalize_entity(nfkc_text: Column) -> Column:
    """Entity form of NFKC text: punctuation other than the hyphen becomes a space."""
    spaced = F.regexp_replace(fold(nfkc_text), r"(?U)[^\p{L}\p{N}_\sऀ-ॿ-]", " ")
    return F.trim(F.regexp_replace(spaced, SPACE, " "))


def entity_variants(entity: Column) -> Column:
    """The normalised entity, its last two and its last three words, distinct."""
    parts = F.split(entity, " ")

    def last(n):
        return F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), " "))

    return F.when(
        entity != "", F.array_distinct(F.array_compact(F.array(entity, last(2), last(3))))
    ).otherwise(F.array().cast("array<string>"))


def word_ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring words, joined by a space.

    Reads the elements by position: slicing would copy the whole array for every run.
    """

    def runs(w):
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
        run = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(n)]))
        return F.when(F.size(w) >= n, run).otherwise(F.array().cast("array<string>"))

    return bind(words, runs)


def _longer_than(least: int):
    return lambda p: F.length(p) >= least


def at_most(items: Column, limit: int | None) -> Column:
    """The first ``limit`` items of an array, all without a limit."""
    return F.slice(items, 1, limit) if limit else items


def important_phrases(normalized: Column, limit: int | None = None) -> Column:
    """Distinctive phrases of a normalised claim: longer n-grams first, first-seen distinct."""
    words = F.filter(
        drop_stopwords(tokens(normalized), lexicons.RETRIEVAL_STOPWORDS), lambda w: F.length(w) >= 3
    )
    # (words per phrase, least number of characters)
    sizes = [(4, 12), (3, 10), (2, 8), (1, 7)]

    def phrases(w):
        grams = [F.filter(word_ngrams(w, n), _longer_than(m)) for n, m in sizes]
        return at_most(F.array_distinct(F.concat(*grams)), limit)

    return bind(words, phrases)


def search_text(title: Column, content: Column) -> Column:
    """Indexed text: the title counts twice."""
    t, c = text_or_blank(title), text_or_blank(content)
    return collapse_ws(F.concat_ws(" ", t, t, c))


def embedding_text(title: Column, content: Column, content_chars: int = 1500) -> Column:
    """Encoder input: title twice and the head of the content."""
    t, c = text_or_blank(title), text_or_blank(content)
    return collapse_ws(F.concat_ws(" ", t, t, F.substring(c, 1, content_chars)))


def truncate_middle(c: Column, max_chars: int) -> Column:
    """Long text keeps its first and last half around a marker."""
    text = strip_ws(c)
    head, tail = max_chars // 2, max_chars - max_chars // 2
    cut = F.concat(F.substring(text, 1, head), F.lit("\n...[TRUNCATED]...\n"), F.right(text, F.lit(tail)))
    return F.when(F.length(text) <= max_chars, text).otherwise(cut)


def snippet(c: Column, chars: int) -> Column:
    """Null-safe prefix."""
    return F.substring(text_or_blank(c), 1, chars)


def contains_any(text: Column, terms) -> Column:
    """Whether any term occurs; ``terms`` is a list of words or an array column."""
    array = terms if isinstance(terms, Column) else words_array(terms)
    return bind(text, lambda x: F.exists(array, lambda t: F.contains(x, t)))


def count_terms(text: Column, terms) -> Column:
    """Number of terms that occur; ``terms`` is a list of words or an array column."""
    array = terms if isinstance(terms, Column) else words_array(terms)
    return F.size(bind(text, lambda x: F.filter(array, lambda t: F.contains(x, t))))


def digits(c: Column) -> Column:
    """Only the decimal digits."""
    return F.regexp_replace(c, r"[^\p{Nd}]+", "")
