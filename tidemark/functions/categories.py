"""Ordered category maps between the register's wording and the articles' (fixed values: first arm that fits wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import ordered_like

WEAPON_ARMS = (
    ("knife", "knife"), ("shotgun", "shotgun"), ("rifle", "rifle"), ("handgun", "firearm"), ("firearm", "firearm"), ("gun", "firearm"), ("blunt", "blunt object"),
    ("personal", "personal weapon"), ("fire", "fire"), ("strangulation", "strangulation"), ("asphyxiation", "asphyxiation"), ("drugs", "drugs"), ("explosives", "explosives"),
    ("drowning", "drowning"), ("poison", "poison"), ("pushed", "pushed from height"), ("other", "other"), ("unknown", "unknown"),
)
CIRCUMSTANCE_ARMS = (
    ("narcotic", "narcotics related"), ("lover", "lover's triangle"), ("undetermined", "undetermined"), ("argument", "argument"), ("robbery", "robbery"), ("brawl", "brawl"),
    ("motor vehicle", "other felony related"), ("felony", "other felony related"), ("arson", "arson"), ("negligent", "negligence"), ("manslaughter", "negligence"),
    ("babysitter", "child killed by babysitter"), ("gang", "gang killing"), ("burglary", "burglary"), ("rape", "rape"), ("playing with gun", "negligence"),
    ("hunting accident", "negligence"), ("institutional", "institutional killing"), ("prostitution", "other felony related"), ("larceny", "other felony related"),
    ("gambling", "other felony related"), ("sex offense", "rape"), ("police", "felon killed by police"), ("private citizen", "felon killed by private citizen"), ("other", "other"),
)
RELATIONSHIPS = (
    "acquaintance", "son", "daughter", "husband", "stranger", "wife", "ex-wife", "ex-husband", "brother", "sister", "other family", "girlfriend", "boyfriend", "neighbor",
    "stepfather", "stepmother", "stepson", "friend", "other known to victim", "mother", "father", "in-law", "employee", "homosexual relationship",
)
RELATIONSHIP_ALIASES = {"other - known to victim": "other known to victim", "common-law wife": "wife", "common-law husband": "husband"}
WEAPON_PRIORITY = ("handgun", "rifle", "shotgun", "firearm")
WEAPON_FAMILY = {w: "firearm" for w in WEAPON_PRIORITY}


def weapon(c: Column) -> Column:
    return ordered_like(c, WEAPON_ARMS, "unknown")


def circumstance(c: Column) -> Column:
    return ordered_like(c, CIRCUMSTANCE_ARMS, "undetermined")


def relationship(c: Column) -> Column:
    s = F.lower(F.trim(c))
    out = F.when(s.isin(*RELATIONSHIPS), s)
    for alias, value in RELATIONSHIP_ALIASES.items():
        out = out.when(s == alias, value)
    return out


def family(c: Column, families: dict[str, str]) -> Column:
    out = c
    for member, name in families.items():
        out = F.when(c == member, name).otherwise(out)
    return out
