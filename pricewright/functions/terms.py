"""Words, tokens and search terms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def longest_words(text: Column, limit: int) -> Column:
    """The ``limit`` longest distinct words, ties in alphabetical order."""
    sized = F.transform(
        F.array_distinct(words(text)),
        lambda w: F.struct((-F.length(w)).alias("size"), w.alias("word")),
    )
    return F.transform(F.slice(F.sort_array(sized), 1, limit), lambda pair: pair["word"])


def tokens(text: Column) -> Column:
    """The built-in tokenizer: words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0))


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def cut_tokens(text: Column, limit: int) -> Column:
    """``text`` up to the end of its ``limit``-th token, whole when it has fewer."""
    # possessive, so that a text with fewer tokens fails in one pass
    longer = r"(?s)^((?:\s*+(?:[\p{L}\p{N}]++|[^\p{L}\p{N}\s])){%d}+)\s*+\S.*$" % limit
    return F.regexp_replace(text, longer, "$1")


def term_score(text: Column, terms: Column, limit: int) -> Column:
    """How many of the first ``limit`` terms occur in the text, ignoring case."""
    lowered = F.lower(text)
    return F.size(
        F.filter(F.slice(terms, 1, limit), lambda t: lowered.contains(F.lower(t)))
    ).cast("long")
