"""Which product line a text is about: model names, sizes, subject words, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathomline.functions import text as tx
from fathomline.operators.aggregates import unique_top

# Model names, what their first letter means, display sizes per line, subject words.
MODEL = r"\b([BMT])\d{3}[A-Z]{3}\d{2}\.[A-Z0-9]+"
PREFIX_LINE = {"B": "NB", "M": "MNT", "T": "TV"}
SIZE = r"(\d{2}(?:\.\d)?)\s*[\"”吋]"
SIZE_WITH_RATE = r"(\d{2}(?:\.\d)?)\s*[\"”吋]\s*[^\n]{0,30}?\d{2,3}\s*(?i:Hz)"
SIZES = {
    "MNT": ["23.8", "24", "25", "27", "31.5", "32", "34", "37.5", "49"],
    "TV": ["43", "50", "55", "58", "65", "75", "85", "98"],
    "NB": ["11.6", "13.3", "14", "15.6", "16", "17.3", "18"],
}
SUBJECT = {
    "MNT": r"(?i)\bMNT\b|monitor|顯示器|显示器",
    "NB": r"(?i)\bNB\b|notebook|筆電|笔电",
    "TV": r"(?i)\bTV\b|電視|电视",
}


def app_hint(text: Column, subject: Column, defaults: Column, *, model: str = MODEL, size: str = SIZE,
             size_with_rate: str | None = SIZE_WITH_RATE, prefixes: dict[str, str] = PREFIX_LINE,
             sizes: dict[str, list[str]] = SIZES, words: dict[str, str] = SUBJECT) -> Column:
    """Majority of model letters, else of sizes, else the only subject word, else the only default.

    All votes are counted inside the row, so nothing is exploded or shuffled.
    """
    letters = F.transform(F.regexp_extract_all(text, F.lit(model), F.lit(1)), lambda m: F.upper(m))
    by_model = unique_top({line: F.size(F.filter(letters, _equals(letter)))
                           for letter, line in prefixes.items()})
    plain = F.regexp_extract_all(text, F.lit(size), F.lit(1))
    if size_with_rate:
        rated = F.regexp_extract_all(text, F.lit(size_with_rate), F.lit(1))
        plain = F.when(F.size(rated) > 0, rated).otherwise(plain)
    by_size = unique_top({line: F.size(F.filter(plain, _within(values))) for line, values in sizes.items()})
    named = tx.dictionary_hits(subject, words)
    by_word = F.when(F.size(named) == 1, F.get(named, F.lit(0)))
    only = F.when(F.size(defaults) == 1, F.get(defaults, F.lit(0)))
    return F.coalesce(by_model, by_size, by_word, only)


def _equals(letter: str):
    return lambda m: m == letter


def _within(values: list[str]):
    return lambda s: s.isin(*values)


def weighted_hint(text: Column, subject: Column, names: list[str], subject_weight: int = 3) -> Column:
    """Name with the most whole-word hits, those of the subject weighing more; an equal top gives NULL."""
    return unique_top({n: tx.count_word(text, n) + subject_weight * tx.count_word(subject, n) for n in names})
