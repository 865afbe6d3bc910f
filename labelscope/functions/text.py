"""Text column expressions. All stay inside the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from labelscope.functions.bind import bind

# The characters a Unicode-aware strip or whitespace split removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       "
    "         　"
)
# The same set as pattern; Unicode \\s lacks the four separators. Spelling all characters out
# is three times slower to match.
SPACE = r"(?U)[\s\x1c-\x1f]"
NON_SPACE = r"(?U)[^\s\x1c-\x1f]"
# Characters with a digit value that are not decimal numbers (superscripts,
# subscripts, circled and bracketed digits), besides the decimal numbers of category Nd.
DIGIT_CLASS = (
    r"[\p{Nd}²³¹፩-፱᧚⁰⁴-⁹₀-₉"
    r"①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿"
    r"❶-❾➀-➈➊-➒"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{11F50}-\x{11F59}\x{16AC0}-\x{16AC9}\x{1E4F0}-\x{1E4F9}\x{1F100}-\x{1F10A}]"
)
WORD = "[a-z]+"
TERM = r"[\p{L}\p{N}_]{2,}"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def normalise_text(text: Column) -> Column:
    """Key for equality checks: stripped and lower-cased."""
    return F.lower(strip(text))


def tokenise_alpha(text: Column) -> Column:
    """Lower-case runs of a-z; digits, punctuation and accented letters separate words."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokenise_terms(text: Column) -> Column:
    """Lower-case runs of two or more word characters (the vectoriser's tokens)."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def characters(text: Column) -> Column:
    """Characters of the lower-cased text; two or more whitespace characters count as one blank."""
    clean = F.regexp_replace(F.lower(text), SPACE + "{2,}", " ")
    return F.regexp_extract_all(clean, F.lit("(?s)."), F.lit(0))


def grams(units: Column, low: int, high: int, glue: str) -> Column:
    """All n-grams of ``units`` for n = low..high, joined by ``glue``."""
    if low == high == 1:
        return units
    return bind(units, lambda u: F.concat(*[_grams(u, n, glue) for n in range(low, high + 1)]))


def _grams(units: Column, n: int, glue: str) -> Column:
    """Each step glues the units moved on by one place; no slice per n-gram."""
    joined = units
    for step in range(1, n):
        left = F.greatest(F.size(units) - step, F.lit(0))
        joined = F.zip_with(
            F.slice(joined, F.lit(1), left), F.slice(units, F.lit(step + 1), left),
            lambda a, b: F.concat(a, F.lit(glue), b),
        )
    return joined


def drop_stopwords(tokens: Column, stop_words: list[str]) -> Column:
    """Tokens outside the stop list; repeated tokens are kept."""
    stops = F.lit(sorted(set(stop_words)))
    return F.filter(tokens, lambda t: ~F.array_contains(stops, t))


def words(text: Column) -> Column:
    """Words of a whitespace split, in order."""
    return F.regexp_extract_all(text, F.lit(NON_SPACE + "+"), F.lit(0))


def word_count(text: Column) -> Column:
    """Words of a whitespace split: runs of other characters."""
    return F.regexp_count(text, F.lit(NON_SPACE + "+")).cast("bigint")


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def has_non_ascii(text: Column) -> Column:
    return text.rlike(r"[^\x00-\x7F]")


def is_blank(text: Column) -> Column:
    return ~text.rlike(NON_SPACE)


def has_digit(text: Column) -> Column:
    return text.rlike(DIGIT_CLASS)


def has_brace(text: Column) -> Column:
    return text.contains("{") | text.contains("}")


def non_ascii_chars(text: Column) -> Column:
    """Distinct non-ASCII characters of one text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"[^\x00-\x7F]"), F.lit(0)))


@F.pandas_udf(StringType())
def char_name(chars: pd.Series) -> pd.Series:
    """Unicode name; applied to the short table of distinct characters only."""
    return chars.map(lambda c: unicodedata.name(c, "?"))


def shorten(text: Column, limit: int = 80, keep: int = 77) -> Column:
    cut = F.concat(F.substring(text, 1, keep), F.lit("…"))
    return F.when(F.length(text) <= limit, text).otherwise(cut)


def seeded_hash(*parts: Column | str | int) -> Column:
    """Reproducible pseudo-random text key; equal in every engine that has md5."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.substring(F.md5(F.concat(*[c.cast("string") for c in columns])), 1, 8)


def hash_number(*parts: Column | str | int) -> Column:
    return F.conv(seeded_hash(*parts), 16, 10).cast("bigint")
