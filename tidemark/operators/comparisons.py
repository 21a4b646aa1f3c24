"""The catalogue of comparisons and blocking rules for victims, offenders, places and dates.

Conditions are SQL over the records l and r. ``register_functions`` makes jaro_winkler and km_between available to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.functions.similarity import jaro_winkler
from tidemark.operators.blocking import Rule, date_bucket_rules
from tidemark.operators.linkage import Comparison, Level, Training

# Groups of circumstances that are close to one another (fixed values).
CIRCUMSTANCE_GROUPS = (
    ("other felony related", "robbery", "burglary", "rape"),
    ("argument", "brawl", "gang killing", "other felony related", "narcotics related", "felon killed by police"),
    ("argument", "brawl", "lover's triangle", "rape"),
    ("child killed by babysitter", "negligence"),
)
# Cosine floors of the summary levels (fixed values).
COSINE_FLOORS = (0.80, 0.70, 0.65, 0.625, 0.60, 0.50, 0.45, 0.40)
BOX = "l.lat is not null and r.lat is not null and abs(l.lat - r.lat) <= 0.0045 and abs(l.lon - r.lon) <= 0.0055"
KM = "2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(r.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - l.lon) / 2), 2))))"


def register_functions(spark: SparkSession) -> None:
    spark.udf.register("jaro_winkler", jaro_winkler)


def levels(*conditions: tuple[str, str]) -> tuple[Level, ...]:
    """Levels with the last one for what is left, and m and u that fall and rise evenly until they are trained."""
    n = len(conditions) + 1
    m = [2.0 ** (n - i) for i in range(n)]
    u = [2.0 ** (1 + 2 * i) for i in range(n)]
    named = [*conditions, ("else", "true")]
    return tuple(Level(name, cond, m[i] / sum(m), u[i] / sum(u)) for i, (name, cond) in enumerate(named))


def _in_group(column: str, group: Sequence[str]) -> str:
    quoted = ", ".join("'" + g.replace("'", "\\'") + "'" for g in group)
    return f"(l.{column} in ({quoted}) and r.{column} in ({quoted}))"


def _missing(column: str) -> str:
    return f"l.{column} is null or r.{column} is null"


def name(forename: str = "victim_forename", surname: str = "victim_surname", full: str = "victim_fullname", middle: str | None = None) -> Comparison:
    """Exact; both parts nearly; turned round, loosely or the middle name as surname; one part nearly."""
    jw = lambda a, b, least: f"jaro_winkler(l.{a}, r.{b}) >= {least}"
    loose = [f"(l.{forename} = r.{surname} and l.{surname} = r.{forename})", f"({jw(forename, forename, 0.80)} and {jw(surname, surname, 0.80)})"]
    if middle:
        loose.append(f"(l.{forename} = r.{forename} and (l.{middle} = r.{surname} or l.{surname} = r.{middle}))")
    return Comparison(
        "name", f"(l.{surname} is null and l.{forename} is null) or (r.{surname} is null and r.{forename} is null)",
        levels(("exact", f"l.{full} = r.{full}"), ("both near", f"{jw(forename, forename, 0.95)} and {jw(surname, surname, 0.95)}"), ("turned or loose", " or ".join(loose)), ("one near", f"{jw(forename, forename, 0.95)} or {jw(surname, surname, 0.95)}")),
        tf=full,
    )


def date(steps: Sequence[tuple[int, int, int]] = ((0, 0, 0), (2, 31, 0), (15, 92, 366), (30, 731, 731), (60, 1827, 1827))) -> Comparison:
    """Days apart by the worse precision of the two: (days if both are known to the day, to the month, to the year)."""
    worst = "case when 'year' in (l.date_precision, r.date_precision) then 'year' when 'month' in (l.date_precision, r.date_precision) then 'month' else 'day' end"
    gap = "abs(l.midpoint_day - r.midpoint_day)"
    month = "(l.year = r.year and l.month = r.month)"
    conds = []
    for i, (d, m, y) in enumerate(steps):
        exact_month = month if i == 0 else f"{gap} <= {m}"
        exact_year = "l.year = r.year" if i == 0 else f"{gap} <= {y}"
        conds.append((f"within {d}/{m}/{y}", f"case {worst} when 'day' then {gap} <= {d} when 'month' then {exact_month} else {exact_year} end"))
    return Comparison("date", _missing("midpoint_day"), levels(*conds))


def age(column: str = "victim_age", steps: Sequence[int] = (0, 2, 5, 10), label: str = "age") -> Comparison:
    return Comparison(label, _missing(column), levels(*[(f"within {s}", f"abs(l.{column} - r.{column}) <= {s}") for s in steps]), tf=column)


def same(column: str, label: str | None = None, tf: bool = False) -> Comparison:
    """Equal or not: sex, race, ethnicity, counts."""
    return Comparison(label or column, _missing(column), levels(("same", f"l.{column} = r.{column}")), tf=column if tf else None)


def weapon() -> Comparison:
    guns = ("firearm", "handgun", "rifle", "shotgun")
    return Comparison("weapon", _missing("weapon"), levels(("same", "l.weapon = r.weapon"), ("same group", _in_group("weapon", guns))), tf="weapon")


def circumstance() -> Comparison:
    close = " or ".join(_in_group("circumstance", g) for g in CIRCUMSTANCE_GROUPS)
    missing = f"{_missing('circumstance')} or (l.circumstance <> r.circumstance and 'other' in (l.circumstance, r.circumstance))"
    return Comparison("circumstance", missing, levels(("same", "l.circumstance = r.circumstance"), ("close", close)), tf="circumstance")


def relationship() -> Comparison:
    return Comparison("relationship", _missing("relationship"), levels(("same", "l.relationship = r.relationship"), ("friend or acquaintance", _in_group("relationship", ("friend", "acquaintance")))), tf="relationship")


def offender() -> Comparison:
    """Both parts of the name close; no evidence where one of several offenders may be meant."""
    close = "jaro_winkler(l.offender_forename_norm, r.offender_forename_norm) >= 0.85 and jaro_winkler(l.offender_surname_norm, r.offender_surname_norm) >= 0.85"
    missing = "(l.offender_surname_norm is null and l.offender_forename_norm is null) or (r.offender_surname_norm is null and r.offender_forename_norm is null)"
    return Comparison("offender", missing, levels(("close", close)))


def place() -> Comparison:
    """The same spot or address; within 150 m or a similar street; within 500 m, more where only a street is known."""
    street = "'STREET_ONLY' in (l.address_type, r.address_type)"
    return Comparison(
        "place", "coalesce(l.geo_address_norm, '') in ('', 'UNKNOWN') or coalesce(r.geo_address_norm, '') in ('', 'UNKNOWN')",
        levels(("same", f"l.geo_address_norm = r.geo_address_norm or {KM} <= 0.0005"), ("150 m or similar street", f"{KM} <= 0.15 or (jaro_winkler(l.geo_address_short, r.geo_address_short) >= 0.90 and {KM} <= 0.5)"), ("near", f"{KM} <= case when {street} then 1.0 else 0.5 end")),
    )


def summary(column: str = "summary_vec") -> Comparison:
    dot = lambda a, b: f"aggregate(zip_with({a}, {b}, (x, y) -> x * y), double(0), (s, x) -> s + x)"
    l, r = f"l.{column}", f"r.{column}"
    cosine = f"{dot(l, r)} / sqrt({dot(l, l)} * {dot(r, r)})"
    empty = lambda v: f"{v} is null or not exists({v}, x -> x <> 0)"
    return Comparison("summary", f"{empty(l)} or {empty(r)} or size({l}) <> size({r})", levels(*[(f"cosine {c}", f"{cosine} >= {c}") for c in COSINE_FLOORS]))


APART = "l.exclusion_id <> r.exclusion_id"
NOT_LISTED = "not array_contains(coalesce(r.exclusion_ids, array()), l.unique_id)"


def named_victim_rules(city: str = "city_id") -> tuple[Rule, ...]:
    """Blocks for named victims, all within a city and across articles."""
    years = f"abs(l.year - r.year) <= 2 and {APART}"
    return (
        Rule("names", (city, "victim_surname", "victim_forename"), years),
        Rule("left forename missing", (city, "soundex(victim_surname)"), f"l.victim_forename is null and {years}"),
        Rule("right forename missing", (city, "soundex(victim_surname)"), f"r.victim_forename is null and {years}"),
        Rule("month", (city, "year", "month"), APART),
        *date_bucket_rules("date and box", "midpoint_day", 213, (city,), f"{BOX} and {APART}"),
        Rule("year and surname sound", (city, "year", "soundex(victim_surname)"), APART),
        Rule("year and forename sound", (city, "year", "soundex(victim_forename)"), APART),
        Rule("year, age, sex", (city, "year", "victim_age", "victim_sex"), APART),
    )


def named_victim_training(city: str = "city_id") -> tuple[Training, ...]:
    """Blocks that train the weights for named victims. A block of one month implies the two upper levels of dates."""
    years = f"abs(l.year - r.year) <= 2 and {APART}"
    either = (Rule("surname", (city, "victim_surname"), years), Rule("forename", (city, "victim_forename"), years))
    return (
        Training((Rule("month", (city, "year", "month"), APART),), ("date",), {"date": 2}),
        Training(either, ("name",)),
        Training((Rule("age and sex", (city, "victim_age", "victim_sex"), APART),)),
        Training((Rule("offender age and sex", (city, "offender_age", "offender_sex"), APART),)),
    )


def named_victim_sure(city: str = "city_id") -> tuple[Rule, ...]:
    """Full name, date and place at once."""
    return (Rule("name, date, place", (city, "victim_fullname", "midpoint_day"), f"{BOX} and {APART}"),)


def orphan_rules(city: str = "city_id") -> tuple[Rule, ...]:
    """Blocks between named entities (left) and unnamed victims (right); articles they share are excluded."""
    apart = NOT_LISTED
    return (
        Rule("month", (city, "year", "month"), apart),
        *date_bucket_rules("date and box", "midpoint_day", 213, (city,), f"{BOX} and {apart}"),
        Rule("years, age, sex", (city, "victim_age", "victim_sex"), f"abs(l.year - r.year) <= 2 and {apart}"),
        Rule("years, age, weapon", (city, "victim_age", "weapon"), f"abs(l.year - r.year) <= 2 and {apart}"),
        Rule("offender age, sex", (city, "offender_age", "offender_sex"), apart),
        Rule("weapon, circumstance", (city, "weapon", "circumstance"), apart),
        Rule("relationship, weapon", (city, "relationship", "weapon"), apart),
        Rule("offender surname", (city, "offender_surname_norm"), apart),
        Rule("offender forename", (city, "offender_forename_norm"), apart),
    )


def orphan_training(city: str = "city_id") -> tuple[Training, ...]:
    year = f"abs(l.midpoint_day - r.midpoint_day) <= 370 and {NOT_LISTED}"
    return (
        Training((Rule("month", (city, "year", "month"), NOT_LISTED),), ("date",), {"date": 2}),
        Training((Rule("age and sex", (city, "victim_age", "victim_sex"), year),)),
        Training((Rule("sex and street", (city, "victim_sex", "geo_address_short"), NOT_LISTED),), ("place",)),
        Training((Rule("offender", (city, "offender_age", "offender_sex"), year),)),
    )


def orphan_sure(city: str = "city_id") -> tuple[Rule, ...]:
    return (Rule("day, place, sex", (city, "year", "month", "day", "victim_sex"), f"{BOX} and {NOT_LISTED}"),)


def register_training(city: str = "city_id") -> tuple[Training, ...]:
    """A month with a weapon, and victim and offender alike under one circumstance."""
    return (
        Training((Rule("month and weapon", (city, "year", "month", "weapon")),), ("date",), {"date": 2}),
        Training((Rule("ages, sex, circumstance", (city, "victim_age", "victim_sex", "circumstance", "offender_age")),)),
    )


def register_sure(city: str = "city_id") -> tuple[Rule, ...]:
    return (Rule("month, age, sex, weapon, circumstance", (city, "year", "month", "victim_age", "victim_sex", "weapon", "circumstance")),)


def register_rules(city: str = "city_id") -> tuple[Rule, ...]:
    """Blocks between entities (left) and register rows (right)."""
    return (*date_bucket_rules("date", "midpoint_day", 213, (city,)), Rule("age, sex", (city, "victim_age", "victim_sex"), "r.year >= l.year"))
