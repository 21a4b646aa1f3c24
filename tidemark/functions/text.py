"""Text expressions: normal forms, first-match replacement, patterns of word roots, sets kept as comma-separated text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word roots of the homicide filter (fixed values).
ABSOLUTE_ROOTS = ("slain", "slaying", "murder", "homicide", "manslaughter")
CONDITIONAL_ROOTS = ("shot", "shooting", "injur", "wounded", "stabb", "kidnap", "strangl", "beat", "bludgeon", "asphyxiat")
DEATH_ROOTS = ("fatal", "dead", "died", "dies", "kill", "death")
ROOT_DISTANCE = 300


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def summary_norm(c: Column) -> Column:
    """Control characters out, white space collapsed; blank text is null."""
    return F.nullif(collapse_space(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")), F.lit(""))


def replace_first(c: Column, pattern: str, by: str) -> Column:
    """Only the first match is replaced, as engines do without a global flag."""
    return F.regexp_replace(c, f"(?s)^(.*?)(?:{pattern})", "$1" + by)


def snake_case(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"([a-z0-9])([A-Z])", "$1_$2"))


def plain_quotes(c: Column) -> Column:
    """Curly quotes and primes as straight ones."""
    return F.translate(c, "‘’‚“”„′″", "'''\"\"\"'\"")


def long_date(c: Column) -> Column:
    """YYYYMMDD as 'Month dd, yyyy'; null where it is no date."""
    return F.date_format(F.try_to_date(c, "yyyyMMdd"), "MMMM dd, yyyy")


def clip(c: Column, charset: str) -> Column:
    """Trailing characters of ``charset`` off, in any order."""
    return F.rtrim(c, F.lit(charset))


def contains_any_case(c: Column, part: str) -> Column:
    """LIKE '%part%' that ignores case."""
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return c.ilike(f"%{escaped}%")


def _word_of(roots: Iterable[str]) -> str:
    """A root at a word's start; scanning and hyphenation may have put one blank between any two letters."""
    loose = [re.sub(r"\B", r"\\s?", root) for root in roots]
    return "(?:" + "|".join(loose) + ")"


def mentions_homicide(c: Column, most: int = ROOT_DISTANCE) -> Column:
    """An absolute root, or a conditional one near a root of death: at most ``most`` characters between the words, on
    one line.

    The text is cut at every word with a conditional or death root. Of any two words of different kinds some two
    neighbours differ too and are no farther apart, so only the stretches between neighbours are measured."""
    start, rest = "(?i)(?<![A-Za-z0-9_])", "[A-Za-z0-9_]*"
    either = F.lit(f"{start}(?:({_word_of(CONDITIONAL_ROOTS)})|{_word_of(DEATH_ROOTS)}){rest}")
    kinds = F.transform(F.regexp_extract_all(c, either, F.lit(1)), lambda w: w != "")  # true: conditional
    between = F.split(c, either, F.lit(-1))
    close = lambda i: (F.get(kinds, i - 1) != F.get(kinds, i)) & (F.length(F.get(between, i)) <= most) & ~F.contains(F.get(between, i), F.lit("\n"))
    near = (F.size(kinds) > 1) & F.exists(F.sequence(F.lit(1), F.greatest(F.size(kinds) - 1, F.lit(1))), close)
    return F.coalesce(c.rlike(start + _word_of(ABSOLUTE_ROOTS)) | near, F.lit(False))


def keywords(c: Column, words: Iterable[str]) -> Column:
    """The distinct keywords of a text in order, in lower case; longer ones win where they overlap."""
    by_length = "|".join(sorted((w.lower() for w in words), key=lambda w: (-len(w), w)))
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(rf"(?<![a-z0-9_])({by_length})(?![a-z0-9_])"), F.lit(1))))


def csv_members(c: Column) -> Column:
    """The members of a comma-separated set: trimmed, none empty, sorted, once each; null is the empty set."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")))


def csv_union(*cs: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.array(*[csv_members(c) for c in cs])))), ",")
