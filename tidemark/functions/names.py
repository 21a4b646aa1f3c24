"""Personal names taken apart with column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLES = ("mr", "mrs", "ms", "miss", "dr", "rev", "ofc", "officer")
SUFFIXES = ("jr", "sr", "ii", "iii", "iv")
PARTICLES = ("de la", "del", "de", "van", "von", "da", "di", "la", "le", "st")
_PART = r"[a-z'\-]+"


def core_name(c: Column) -> Column:
    """Lower-case letters, apostrophes, hyphens and single blanks, without title and suffix; null stays null."""
    s = F.trim(F.lower(F.regexp_replace(c, r"[^A-Za-z'\- ]", " ")))
    s = F.regexp_replace(s, rf"^(?:{'|'.join(TITLES)})\s+", "")
    return F.regexp_replace(F.trim(F.regexp_replace(s, rf"\s+(?:{'|'.join(SUFFIXES)})$", "")), " +", " ")


def name_parts(c: Column, lone: str = "surname") -> dict[str, Column]:
    """forename, middle, surname and full of a name. A leading initial is the forename only if one word follows;
    surnames keep their particles; a name of one word is a surname for ``lone='surname'`` (victims), else a
    forename (offenders). Blank names give nulls."""
    core = F.nullif(core_name(c), F.lit(""))
    several = core.contains(" ")
    behind_initial = F.regexp_extract(core, rf"^[a-z] ({_PART}) ", 1)
    forename = F.when(several, F.when(behind_initial != "", behind_initial).otherwise(F.regexp_extract(core, rf"^({_PART})", 1)))
    particle = F.regexp_extract(core, rf"(?:^| )((?:{'|'.join(PARTICLES)}) {_PART})$", 1)
    last = F.regexp_extract(core, rf"({_PART})$", 1)
    surname = F.when(several, F.when(particle != "", particle).otherwise(last))
    if lone == "surname":
        surname = F.coalesce(surname, core)
    else:
        forename = F.coalesce(forename, core)
    inner = F.regexp_replace(core, rf"^{_PART} ", "")
    middle = F.nullif(F.trim(F.when(F.size(F.split(core, " ")) > 2, F.substring(inner, F.lit(1), F.greatest(F.length(inner) - F.length(surname), F.lit(0))))), F.lit(""))
    return {"forename": forename, "middle": middle, "surname": surname, "full": F.nullif(F.concat_ws(" ", forename, surname), F.lit(""))}


def phonetic(c: Column) -> Column:
    """Soundex of the letters; null where there are none."""
    return F.when(c.rlike("[A-Za-z]"), F.soundex(F.regexp_replace(c, "[^A-Za-z]", "")))


def age_bucket(c: Column, width: int = 5) -> Column:
    return (F.floor(c / width) * width).cast("int")
