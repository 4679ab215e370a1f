"""Text cleaning and tokenising as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every ASCII punctuation mark except the full stop, which is
# kept so that the tokeniser splits decimals such as 6.5 in two.
PUNCTUATION = r"[!-\-/:-@\[-`{-~]"

# A token is a run of ASCII letters and digits. After lower-casing this is what
# splitting on the gap pattern [\W_]+ leaves, without the empty strings.
TOKEN = "[0-9a-z]+"


def clean_special(text: Column) -> Column:
    """Drop a capitalised "Some" before a word, spell out the degree sign and
    delete punctuation. Deleting glues the neighbours: foo-bar gives foobar."""
    known = F.coalesce(text, F.lit(""))
    # The plain search is cheap and spares most texts the pattern.
    no_some = F.when(F.contains(known, F.lit("Some")), F.regexp_replace(known, r"\bSome.\b", " ")).otherwise(known)
    degrees = F.replace(no_some, F.lit("°"), F.lit("degrees"))
    return F.regexp_replace(degrees, PUNCTUATION, "")


def regex_tokenize(text: Column) -> Column:
    """Lower-case and split into ASCII word tokens; null gives an empty array."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))


def is_stopword(term: Column, words: Iterable[str]) -> Column:
    return term.isin(sorted({w.lower() for w in words}))


def remove_stopwords(tokens: Column, words: Iterable[str]) -> Column:
    """Keep the other tokens with their duplicates and their order."""
    listed = sorted({w.lower() for w in words})
    return F.filter(tokens, lambda t: ~t.isin(listed))


def default_stopwords() -> list[str]:
    """Spark's own English list; pass any other list in its place."""
    return StopWordsRemover.loadDefaultStopWords("english")


def prose_tokens(text: Column, words: Iterable[str]) -> Column:
    """Descriptions and attribute values: clean the raw text, then tokenise."""
    return remove_stopwords(regex_tokenize(clean_special(text)), words)


def title_tokens(text: Column, words: Iterable[str]) -> Column:
    """Titles: tokenise first, so punctuation separates words instead of gluing
    them. Nothing is left for the cleaning step afterwards."""
    return remove_stopwords(regex_tokenize(text), words)
