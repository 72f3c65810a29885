"""Text column expressions: normalizers, term matching and n-grams.

The normalizers are deliberately separate, because each consumer compares
texts that were cleaned in its own way.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a Unicode-aware strip() or \s treats as blank.
BLANK = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NOT_WORD = r"[^\p{L}\p{N}_\s]"
NULL_WORDS = ("nan", "none", "null")


def strip(col: Column) -> Column:
    """Remove blanks of every kind from both ends; NULL stays NULL."""
    return F.regexp_replace(col, f"^{BLANK}+|{BLANK}+$", "")


def squeeze(col: Column) -> Column:
    """Turn each run of blanks into one space and strip the ends."""
    return F.trim(F.regexp_replace(col, f"{BLANK}+", " "))


def normalize_evidence(col: Column) -> Column:
    """Lower case, no punctuation, no standalone numbers of two or more digits."""
    spaced = F.regexp_replace(squeeze(F.lower(col)), NOT_WORD, " ")
    words = F.filter(
        F.split(spaced, " "), lambda w: (w != "") & ~w.rlike(r"^\p{Nd}{2,}$")
    )
    return F.coalesce(F.array_join(words, " "), F.lit(""))


def normalize_cascade(col: Column) -> Column:
    """Lower case with single blanks; punctuation stays; null words become empty."""
    text = strip(F.lower(col))
    return F.coalesce(
        F.when(text.isin(*NULL_WORDS), "").otherwise(F.regexp_replace(text, f"{BLANK}+", " ")),
        F.lit(""),
    )


def normalize_type(col: Column) -> Column:
    return F.coalesce(strip(F.lower(col)), F.lit(""))


def normalize_category_id(col: Column) -> Column:
    """``5.0`` -> ``5``; text that is no number is kept; blanks become empty."""
    text = strip(col.cast("string"))
    number = text.try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < 1e18)
    return F.coalesce(
        F.when(F.lower(text).isin("", *NULL_WORDS), "")
        .when(whole, number.cast("decimal(20,0)").cast("string"))
        .when(number.isNotNull(), number.cast("string"))
        .otherwise(text),
        F.lit(""),
    )


def normalize_training(col: Column) -> Column:
    return F.coalesce(squeeze(F.lower(col)), F.lit(""))


def normalize_ml(col: Column) -> Column:
    """Blanks collapsed, case kept: the classifier lower-cases on its own."""
    return F.coalesce(squeeze(col), F.lit(""))


def normalize_diagnostic(col: Column) -> Column:
    return F.coalesce(strip(F.lower(col)), F.lit(""))


def map_values(col: Column, table: Mapping[str, str]) -> Column:
    """Literal lookup of a small fixed table, NULL where the key is absent."""
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(literal, col)


def family_alias(col: Column, aliases: Mapping[str, str]) -> Column:
    """Alias -> family; unknown names pass through stripped, NULL becomes empty."""
    name = strip(col)
    return F.coalesce(map_values(F.lower(name), aliases), name, F.lit(""))


def contains_any(col: Column, terms: Iterable[str]) -> Column:
    """True where any term occurs as a plain substring."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | col.contains(term)
    return F.coalesce(hit, F.lit(False))


def contains_term_any(col: Column, terms: Iterable[str]) -> Column:
    """Phrases match as substrings, single words only as whole blank-separated tokens."""
    terms = list(terms)
    words = [t for t in terms if " " not in t]
    hit = F.arrays_overlap(F.split(col, " "), F.array(*[F.lit(w) for w in words]))
    for phrase in (t for t in terms if " " in t):
        hit = hit | col.contains(phrase)
    return F.coalesce(hit & (col != ""), F.lit(False))


def matches_any(col: Column, terms: Iterable[str]) -> Column:
    """Regex alternation over the terms; a blank in a term matches any run of blanks."""
    pattern = "|".join(r"\s+".join(re.escape(w) for w in t.split(" ")) for t in terms)
    return F.coalesce(F.lower(col).rlike(pattern), F.lit(False))


def char_wb_ngrams(col: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside word boundaries, as an array with repeats.

    Each word is padded by one blank on both sides; a padded word shorter than
    ``low`` counts once as it is.
    """
    words = F.filter(F.split(col, " "), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    none = F.array().cast("array<string>")

    def of_length(n: int):
        short = F.array if n == low else lambda _: none
        return lambda word: F.when(
            F.length(word) >= n,
            F.transform(
                F.sequence(F.lit(1), F.length(word) - (n - 1)),
                lambda i: F.substring(word, i, F.lit(n)),
            ),
        ).otherwise(short(word))

    return F.concat(*[F.flatten(F.transform(padded, of_length(n))) for n in range(low, high + 1)])


def _plain_letters() -> dict[str, str]:
    """Lower-case letters that decompose into a base letter and marks -> the base letter."""
    found = {}
    for code in range(0xC0, 0x1F00):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isalpha() and all(unicodedata.combining(c) for c in parts[1:]):
            found[chr(code)] = parts[0]
    return found


PLAIN_LETTERS = _plain_letters()
ACCENTED, PLAIN = "".join(PLAIN_LETTERS), "".join(PLAIN_LETTERS.values())


def classifier_tokens(col: Column) -> Column:
    """Lower-cased, accent-free word 1- and 2-grams of words with two or more characters."""
    text = F.regexp_replace(F.translate(F.lower(col), ACCENTED, PLAIN), r"\p{Mn}", "")
    words = F.filter(
        F.split(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " "), " "), lambda w: F.length(w) >= 2
    )
    pairs = F.when(
        F.size(words) >= 2,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(words, pairs)
