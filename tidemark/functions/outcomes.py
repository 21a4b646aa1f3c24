"""Codes of a classifier's answers about an article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes by what the article is about, and by the kind of the killing where place and time fit (fixed values).
BY_OUTCOME = {"none": "N_NOHOM", "before": "E", "outside": "O"}
BY_KIND = {"vehicular": "N_VEH", "fictional": "N_FIC", "military": "N_MIL"}
NO_KIND, ANY_KIND, OTHER = "ERR_M_NONE", "M_PRELIM", "ERR_OTHER"
NO_INCIDENT, IN_SCOPE, EARLIER = "N_NOINC", "M", "E"


def _looked_up(table: dict[str, str], c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def answer_code(outcome: Column, kind: Column) -> Column:
    """``outcome``: none, before, outside or inside (the place and time in question); ``kind`` counts for inside only."""
    inside = F.when(kind.isNull(), NO_KIND).otherwise(F.coalesce(_looked_up(BY_KIND, kind), F.lit(ANY_KIND)))
    return F.when(outcome == "inside", inside).otherwise(F.coalesce(_looked_up(BY_OUTCOME, outcome), F.lit(OTHER)))


def extract_code(years: Column, first: int) -> Column:
    """By the years of the extracted incidents: none, one in scope (from ``first`` on), or earlier ones only."""
    in_scope = F.coalesce(F.exists(years, lambda y: y >= first), F.lit(False))
    return F.when(F.coalesce(F.size(years), F.lit(0)) < 1, NO_INCIDENT).when(in_scope, IN_SCOPE).otherwise(EARLIER)
