"""Text normalisation as column expressions, in the four modes of cleaning.

Mode A shortens company forms, mode B removes them and spells addresses out, mode D spells both out; features only lower
and trim. A null is an empty string everywhere. (?U) makes the JVM's digit and white space classes those of Unicode.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Word replacements and word lists of the cleaning modes.
SHORT_FORMS = (("private", "pvt"), ("limited", "ltd"), ("incorporated", "inc"), ("corporation", "corp"), ("company", "co"))
LONG_FORMS = (
    ("pvt", "private"), ("ltd", "limited"), ("inc", "incorporated"), ("corp", "corporation"), ("co", "company"),
    ("llp", "limited liability partnership"), ("rd", "road"), ("st", "street"), ("ave", "avenue"), ("ste", "suite"),
)
ADDRESS_FORMS = (
    ("st", "street"), ("rd", "road"), ("ave", "avenue"), ("blvd", "boulevard"), ("ln", "lane"), ("dr", "drive"),
    ("hwy", "highway"), ("apt", "apartment"), ("ste", "suite"), ("fl", "floor"), ("bldg", "building"),
)
COMPANY_WORDS = (
    "incorporated", "inc", "corporation", "corp", r"limited\s+liability\s+company", "llc", r"limited\s+liability\s+partnership", "llp",
    r"limited\s+partnership", "lp", "limited", "ltd", "company", "co", r"professional\s+corporation", "pc", "pllc", r"private\s+limited",
    r"pvt\s+ltd", "pvt", r"p\s+ltd", r"societe\s+anonyme", "sarl", "sasu", "sas", "eurl", "snc", "gie", "sca", "scs", "sa", "holdings?",
    "enterprises?", "services?", "solutions?", "group", "consulting",
)


def _full(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def collapse(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def plain(c: Column) -> Column:
    """Lower case; all but a-z, 0-9 and white space becomes a blank."""
    return F.regexp_replace(F.lower(c), r"(?U)[^a-z0-9\s]", " ")


def replaced(c: Column, forms: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda x, f: F.regexp_replace(x, rf"\b{f[0]}\b", f[1]), forms, c)


def clean_canonical(c: Column | str) -> Column:
    return replaced(collapse(plain(_full(c))), SHORT_FORMS)


def canonical_tokens(*parts: Column | str, least: int = 2) -> Column:
    """The tokens of clean_canonical over parts joined by a blank: what stands between other characters than a-z and 0-9, with one regular expression instead of seven."""
    cut = F.filter(F.split(F.lower(F.concat_ws(" ", *[_full(p) for p in parts])), "[^a-z0-9]+"), lambda t: F.length(t) >= least)
    short = lambda t: reduce(lambda x, f: x.when(t == f[0], F.lit(f[1])), SHORT_FORMS[1:], F.when(t == SHORT_FORMS[0][0], F.lit(SHORT_FORMS[0][1]))).otherwise(t)
    return F.transform(cut, short)


def clean_expanded(c: Column | str) -> Column:
    return collapse(replaced(plain(_full(c)), LONG_FORMS))


def _fold(batch: pd.Series) -> pd.Series:
    return batch.map(lambda t: t if t.isascii() else "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)))


def _folded(c: Column) -> Column:
    return F.pandas_udf(lambda batch: _fold(batch), StringType())(c)


def strip_accents(c: Column | str) -> Column:
    """Compatibility decomposition without combining marks; Python sees texts that aren't plain ASCII only."""
    whole = _full(c)
    return F.when(whole.rlike(r"^[\x00-\x7F]*$"), whole).otherwise(_folded(F.when(~whole.rlike(r"^[\x00-\x7F]*$"), whole).otherwise("")))


def clean_name(c: Column | str, fold: bool = True) -> Column:
    low = F.lower(strip_accents(c) if fold else _full(c))
    return collapse(plain(F.regexp_replace(low, rf"\b(?:{'|'.join(COMPANY_WORDS)})\b", "")))


def clean_address(c: Column | str, fold: bool = True) -> Column:
    return collapse(replaced(plain(strip_accents(c) if fold else _full(c)), ADDRESS_FORMS))


def feature_text(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(_full(c)), r"(?U)^\s+|\s+$", "")


def digits(c: Column | str) -> Column:
    """Runs of digits in order, repeats kept."""
    return F.regexp_extract_all(_full(c), F.lit(r"(?U)\d+"), F.lit(0))


def tokens(c: Column | str, least: int = 2) -> Column:
    return F.filter(F.split(_full(c), r"(?U)\s+"), lambda t: F.length(t) >= least)


def words(c: Column | str) -> Column:
    """Words of two or more word characters, in lower case."""
    return F.regexp_extract_all(F.lower(_full(c)), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """Of the text without blanks; a text of at most n characters is its own n-gram, an empty one has none."""
    dense = F.replace(_full(c), F.lit(" "), F.lit(""))
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(dense) - (n - 1), F.lit(1))), lambda i: F.substr(dense, i, F.lit(n)))
    return F.when(dense == "", F.array().cast("array<string>")).otherwise(cut)


def word_ngrams(c: Column | str) -> Column:
    """Words, then pairs of neighbouring words."""
    one = words(c)
    pairs = F.transform(F.sequence(F.lit(1), F.size(one) - 1), lambda i: F.concat_ws(" ", F.element_at(one, i), F.element_at(one, i + 1)))
    return F.when(F.size(one) > 1, F.concat(one, pairs)).otherwise(one)


def char_wb_ngrams(c: Column | str, least: int = 3, most: int = 5) -> Column:
    """n-grams inside words with a blank on both sides; a padded word shorter than n counts once."""

    def of(word: Column, n: int) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))), lambda i: F.substr(padded, i, F.lit(n)))

    def all_of(word: Column) -> Column:
        parts = [F.when(F.length(word) + 2 > n - 1, of(word, n)).otherwise(F.array().cast("array<string>")) if n > least else of(word, n) for n in range(least, most + 1)]
        return F.concat(*parts)

    return F.flatten(F.transform(F.filter(F.split(F.lower(_full(c)), r"(?U)\s+"), lambda w: w != ""), all_of))


def combined(name: Column, address: Column, trim: bool = False) -> Column:
    both = F.concat_ws(" ", name, address)
    return F.trim(both) if trim else both


def block_key(c: Column | str) -> Column:
    """nt1: and the first word of a cleaned name; null if it has none."""
    first = F.filter(F.split(_full(c), " "), lambda t: t != "")[0]
    return F.when(F.size(F.filter(F.split(_full(c), " "), lambda t: t != "")) > 0, F.concat(F.lit("nt1:"), first))


def country_or_unknown(c: Column | str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("UNKNOWN"))))
