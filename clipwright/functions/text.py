"""Text keys as native column expressions: no Python leaves the JVM for any of these."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the label rules.
VOWELS = "aeıioöuüâîû"
CIRCUMFLEX_FROM, CIRCUMFLEX_TO = "âîûÂÎÛ", "aiuAİU"
APOSTROPHES = ("'", "’")
LATIN_EXTRA = "çğıöşüâîûÇĞİÖŞÜÂÎÛéèêëáàäóòôúùñßøåæœ"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def turkish_lower(c: Column | str) -> Column:
    """Lower case with the dotted/dotless i kept apart; null stays null."""
    return F.lower(F.translate(_c(c), "İI", "iı"))


def strip_edges(c: Column | str) -> Column:
    """Cut characters that are neither letter nor digit from both ends."""
    return F.regexp_replace(_c(c), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def surface_class(c: Column | str) -> Column:
    return turkish_lower(strip_edges(c))


def lemma_class(c: Column | str) -> Column:
    return turkish_lower(c)


def circumflex_fold(c: Column | str) -> Column:
    return F.translate(_c(c), CIRCUMFLEX_FROM, CIRCUMFLEX_TO)


def lemma_fallback(c: Column | str) -> Column:
    """The lemma used without a morphological analyser; pure punctuation returns unchanged."""
    folded = circumflex_fold(surface_class(c))
    return F.when(folded == "", _c(c)).otherwise(folded)


def syllables(c: Column | str) -> Column:
    return F.length(_c(c)) - F.length(F.translate(_c(c), VOWELS, ""))


def is_suffix(c: Column | str) -> Column:
    """A token that continues the word before it: an apostrophe and something after it."""
    return F.substring(_c(c), 1, 1).isin(*APOSTROPHES) & (F.length(_c(c)) > 1)


def has_label(c: Column | str) -> Column:
    """A usable label: some letter or digit, and not a bare suffix."""
    c = _c(c)
    return (F.coalesce(surface_class(c), F.lit("")) != "") & ~F.substring(c, 1, 1).isin(*APOSTROPHES)


def is_latin(c: Column | str) -> Column:
    """Every letter is ASCII or one of the extra letters of the label alphabet."""
    return ~_c(c).rlike(rf"[\p{{L}}&&[^\x00-\x7F{LATIN_EXTRA}]]")


def has_digit(c: Column | str) -> Column:
    return _c(c).rlike(r"\p{Nd}")


def trimmed(c: Column | str) -> Column:
    """Trim every kind of white space, not only U+0020."""
    return F.regexp_replace(_c(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def nfc(c: Column | str) -> Column:
    """Canonical composition. Spark has no function for it; only values with a character beyond ASCII reach Python, in Arrow batches."""

    @F.pandas_udf("string")
    def composed(values: pd.Series) -> pd.Series:
        return values.str.normalize("NFC")

    c = _c(c)
    odd = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.coalesce(composed(odd), c)


def normalize_text(c: Column | str) -> Column:
    """Composed, and without white space or separators at both ends; null is empty."""
    edge = r"[\s\p{Z}\x1C-\x1F\x85]"
    # A run is tried from its first character only; from each of them, a long run inside a text costs its square.
    return F.coalesce(F.regexp_replace(nfc(c), f"^{edge}++|(?<!{edge}){edge}++$", ""), F.lit(""))


def clean_key(c: Column | str, *unknown: str) -> Column:
    """An id or name as compared: trimmed, lower case; null, empty and the given words are unknown (null)."""
    k = F.lower(trimmed(c))
    return F.when(~k.isin("", *unknown), k)


def safe_name(c: Column | str, default: str = "unnamed") -> Column:
    s = F.regexp_replace(F.regexp_replace(_c(c), r"[^\p{L}\p{N}._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(default)).otherwise(s)


def words_of(c: Column | str) -> Column:
    """White-space separated tokens, empty ones removed."""
    return F.filter(F.split(_c(c), r"\s+"), lambda w: w != "")
