"""Register rows and unnamed victims of articles brought to one form, and their similarity vectors."""

from __future__ import annotations

import json
import math
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mixture import Block
from tidemark.session import Scratch

MONTHS = "January February March April May June July August September October November December".split()
#: Spellings of weapons in either source and the family each belongs to (fixed values).
WEAPONS = {
    "strangulation": "asphyxiation|strangulation|strangulation or hanging",
    "blunt": "blunt object|blunt object (club, hammer)|club|hammer",
    "fire": "fire|arson",
    "firearm": "firearm, type not stated|firearm|gun",
    "handgun": "handgun|handgun (pistol, revolver)|pistol|revolver",
    "rifle": "rifle",
    "shotgun": "shotgun",
    "knife": "knife or cutting tool|knife/cutting|knife|sharp object|stabbing",
    "drugs": "narcotics or drugs|drugs|poison",
    "hands": "personal weapons|personal weapons (hands, feet)|personal weapon|beating|fists",
}
GUNS = ("firearm", "handgun", "rifle", "shotgun")
CIRCUMSTANCES = {
    "argument": "argument, other|argument", "brawl": "brawl under alcohol|brawl", "burglary": "burglary", "gang killing": "gang killing, juvenile|gang killing",
    "lover's triangle": "lovers triangle|lover's triangle", "narcotics": "narcotic drug laws|narcotics related", "other": "other, not felony|other", "robbery": "robbery",
}
UNKNOWN = ("", "unknown", "u", "relationship not known", "unknown relationship", "not stated", "999", "9", "undetermined", "circumstances undetermined")
#: The attributes compared for equality, by the group their evidence counts in.
SAME = {"sex": "victim", "race": "victim", "ethnicity": "victim", "relationship": "event", "circumstance": "event", "weapon": "event", "o_sex": "offender", "o_race": "offender", "o_ethnicity": "offender"}
GROUPS = ("victim", "event", "offender")
#: Attributes whose values come from a fixed set, whatever the sources say.
CLOSED = ("sex", "weapon", "circumstance", "o_sex", "age", "o_age")
#: What the mixture sees. The months between article and register, the sex, and contradictions are similarities of their
#: own, independent of the rest given the class; they take few values close together, so their variances need less of a ridge.
BLOCKS = (Block(GROUPS), Block(("month",), ridge=0.05), Block(("sex",), ridge=0.05), Block(("conflict",), ridge=0.05))
#: Widest band of ages in a key, and how far two ages of one person may be apart.
AGE_BAND, AGE_SLACK = 7, 3
#: How many months the register may be behind the article: a few by mistake, and a year where a killing was booked late.
MONTHS_AFTER = (0, 1, -1, 2, 12)
YEARS_AFTER = (0, 1)


def _known(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return F.when(~s.isin(*UNKNOWN), s)


def _mapped(c: Column, table: dict[str, str]) -> Column:
    pairs = chain.from_iterable((F.lit(w), F.lit(k)) for k, ws in table.items() for w in ws.split("|"))
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(c)))


def _sex(c: Column) -> Column:
    s = F.substring(F.lower(F.trim(c)), 1, 1)
    return F.when(s.isin("m", "f"), s)


def _age(c: Column) -> Column:
    return F.when(c.between(0, 120), c.cast("int"))


def register_records(shr: DataFrame) -> DataFrame:
    """One row per register row (index): town, month number, attributes in common terms."""
    month = F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(F.trim("Month"))).cast("int")
    return shr.select(
        F.col("index").alias("r_id"), F.upper(F.trim(F.regexp_replace("CNTYFIPS", r"(?i)\s+county\s*$", ""))).alias("town"),
        F.col("Year").alias("year"), (F.col("Year") * 12 + F.when(month > 0, month)).alias("ym"), _age(F.col("VicAge")).alias("age"), _age(F.col("OffAge")).alias("o_age"),
        _sex(F.col("VicSex")).alias("sex"), _known(F.col("VicRace")).alias("race"), _known(F.col("VicEthnic")).alias("ethnicity"),
        _known(F.col("Relationship")).alias("relationship"), _mapped(F.col("Circumstance"), CIRCUMSTANCES).alias("circumstance"), _mapped(F.col("Weapon"), WEAPONS).alias("weapon"),
        _sex(F.col("OffSex")).alias("o_sex"), _known(F.col("OffRace")).alias("o_race"), _known(F.col("OffEthnic")).alias("o_ethnicity"),
        (F.col("VicCount") + 1).cast("int").alias("count"), (F.col("OffCount") + 1).cast("int").alias("o_count"),
    ).filter("r_id is not null").dropDuplicates(["r_id"])


def orphan_records(orphans: DataFrame) -> DataFrame:
    """One row per unique_id: town (the one most addresses of its city name; null where none does), month number or year."""
    town = F.upper(F.trim(F.regexp_extract("geo_address_norm", r",\s*([^,]+?)\s*$", 1)))
    named = orphans.select("city_id", town.alias("town")).filter("town != ''").groupBy("city_id", "town").count()
    first = F.row_number().over(Window.partitionBy("city_id").orderBy(F.desc("count"), "town"))
    cities = named.withColumn("n", first).filter("n = 1").select("city_id", "town")
    # By the day's own month where there is a day, else the stated month, else any month of the year.
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor("midpoint_day").cast("int"))
    by_day = F.when((F.col("date_precision") == "day") & F.col("midpoint_day").isNotNull(), F.year(day) * 12 + F.month(day))
    ym = F.coalesce(by_day, F.when(F.coalesce(F.col("date_precision"), F.lit("")) != "year", F.col("year") * 12 + F.col("month")))
    rows = orphans.select(
        F.col("unique_id").alias("l_id"), "city_id", F.regexp_extract("unique_id", r"^(.*):[^:]*$", 1).alias("incident"), ym.alias("ym"), "year",
        _age(F.col("victim_age")).alias("age"), _age(F.col("offender_age")).alias("o_age"), _sex(F.col("victim_sex")).alias("sex"), _known(F.col("victim_race")).alias("race"),
        _known(F.col("victim_ethnicity")).alias("ethnicity"), _known(F.col("relationship")).alias("relationship"), _mapped(F.col("circumstance"), CIRCUMSTANCES).alias("circumstance"),
        _mapped(F.col("weapon"), WEAPONS).alias("weapon"), _sex(F.col("offender_sex")).alias("o_sex"), _known(F.col("offender_race")).alias("o_race"),
        _known(F.col("offender_ethnicity")).alias("o_ethnicity"), F.col("victim_count").cast("int").alias("count"), F.col("offender_count").cast("int").alias("o_count"),
    ).filter("l_id is not null").dropDuplicates(["l_id"])
    return rows.join(cities, "city_id", "left").drop("city_id")


def candidate_pairs(orphans: DataFrame, register: DataFrame, shift: int = 60) -> DataFrame:
    """Pairs of one town, about one month and about one age, with their similarities and, under ``chance``, as many as
    such a search brings up by chance.

    Keys are town, month (an orphan record stands in the months of ``MONTHS_AFTER``, or in all months of the years of
    ``YEARS_AFTER`` where only the year is known; a register row without a month in all of its year) and age band (an unknown
    age meets all). The register takes part twice: as it is, and with every month moved by ``shift`` (those past the last
    month come in at the first). What the moved copy meets is no match, but as alike by chance as unmatched candidates are.

    Similarities: for each of GROUPS the sum, over its attributes known on both sides, of the bits an agreement is worth
    (-log2 of how common the value is, less with the distance of ages; null if there is none); ``month``: minus the root
    of the months between, where both are known (a year late counts as two); ``sex``: 1 or 0; ``conflict``: the number
    of attributes that contradict. A pair with two contradictions or more is no candidate. A record without a town,
    and one without any year, has no candidates.
    """
    lo, hi = register.agg(F.min("ym"), F.max("ym")).first()
    by_month = F.array(*[F.col("ym") + d for d in MONTHS_AFTER])
    first = F.col("year") * 12 + 1
    by_year = F.sequence(first, F.col("year") * 12 + 12 * len(YEARS_AFTER))
    age = F.col("age")
    # Negative bands: -10 = any register age for an unknown one, -20 = the register's unknown.
    band = lambda c: F.floor(c / AGE_BAND).cast("int")
    l_bands = F.when(age.isNull(), F.array(F.lit(-10), F.lit(-20))).otherwise(F.array_distinct(F.array(band(age - AGE_SLACK), band(age + AGE_SLACK), F.lit(-20))))
    r_bands = F.when(age.isNull(), F.array(F.lit(-20))).otherwise(F.array(band(age), F.lit(-10)))
    compared = (*SAME, "age", "o_age", "count", "o_count")
    left = orphans.filter("town is not null and (ym is not null or year is not null)").select(
        "l_id", "incident", F.col("ym").alias("l_ym"), F.col("year").alias("l_year"), *[F.col(c).alias(f"l_{c}") for c in compared],
        "town", F.explode(F.when(F.col("ym").isNotNull(), by_month).otherwise(by_year)).alias("key_ym"), l_bands.alias("bands"),
    ).withColumn("band", F.explode("bands")).drop("bands")
    months = F.when(F.col("ym").isNotNull(), F.array("ym")).otherwise(F.sequence(first, F.col("year") * 12 + 12))
    right = with_bits(register).filter("town is not null and (ym is not null or year is not null)").select(
        "r_id", F.col("ym").alias("r_ym"), *[F.col(c).alias(f"r_{c}") for c in compared], *[f"b_{c}" for c in compared], "place", "town",
        F.explode(months).alias("key_ym"), r_bands.alias("bands"),
    )
    if lo is not None:
        span = max(hi - lo + 1, 1)
        span += -span % 12
        moved = lambda c: F.pmod(F.col(c) - lo + shift, F.lit(span)) + lo
        copies = F.array(
            F.struct(F.lit(False).alias("chance"), F.col("r_ym").alias("r_ym"), F.col("key_ym").alias("key_ym")),
            F.struct(F.lit(True).alias("chance"), moved("r_ym").alias("r_ym"), moved("key_ym").alias("key_ym")),
        )
        right = right.withColumn("copy", F.explode(copies)).drop("r_ym", "key_ym").select("*", "copy.*").drop("copy")
    else:
        right = right.withColumn("chance", F.lit(False))
    right = right.withColumn("band", F.explode("bands")).drop("bands")

    both = lambda c: F.col(f"l_{c}").isNotNull() & F.col(f"r_{c}").isNotNull()
    same = {c: F.col(f"l_{c}") == F.col(f"r_{c}") for c in compared}
    either = (F.col("l_weapon") == "firearm") | (F.col("r_weapon") == "firearm")
    same["weapon"] = same["weapon"] | (F.col("l_weapon").isin(*GUNS) & F.col("r_weapon").isin(*GUNS) & either)
    apart = {c: F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) for c in ("age", "o_age")}
    same |= {c: d <= AGE_SLACK for c, d in apart.items()}
    conflict = sum((F.when(~same[c], 1).otherwise(0) for c in compared if c not in ("sex", "age")), F.lit(0))
    # A register row without a month stands in twelve; it meets a record once, in its month or in the first.
    once = F.when(F.col("r_ym").isNotNull(), True).when(F.col("l_ym").isNotNull(), (F.col("key_ym") - F.col("l_ym")).isin(0, 12)).otherwise((F.col("key_ym") - 1) % 12 == 0)
    met = left.join(right, ["town", "key_ym", "band"]).filter(F.coalesce(same["age"], F.lit(True)) & once)
    met = met.withColumn("conflict", conflict.cast("double")).filter("conflict < 2")

    def bits(c: str) -> Column:
        value = F.col(f"b_{c}")
        if c in apart:
            value = value * F.pow(F.lit(4.0), -apart[c])
        return F.when(both(c), F.when(same[c], value).otherwise(0.0))

    members = {g: [c for c, of in SAME.items() if of == g] for g in GROUPS}
    members["victim"] += ["age", "count"]
    members["offender"] += ["o_age", "o_count"]
    group = {g: F.when(F.greatest(*[both(c) for c in cs]), sum((F.coalesce(bits(c), F.lit(0.0)) for c in cs), F.lit(0.0))) for g, cs in members.items()}
    months_off = F.col("r_ym") - F.col("l_ym")
    late = F.floor((F.col("r_ym") - 1) / 12) - F.col("l_year")
    month = F.when(months_off.isNotNull(), -F.sqrt(F.when(months_off == 12, 2).otherwise(F.abs(months_off)))).when(late == 1, -math.sqrt(2))
    return met.select(
        "l_id", "r_id", "incident", "chance", "l_sex", "l_race", group["victim"].alias("victim"), (F.coalesce(group["event"], F.lit(0.0)) + F.col("place")).alias("event"),
        group["offender"].alias("offender"), month.alias("month"), F.when(both("sex"), same["sex"].cast("double")).alias("sex"), "conflict",
    )


def with_bits(register: DataFrame) -> DataFrame:
    """The register with b_<attribute>: -log2 of the share of the row's value among the known ones, and ``place``, that of its
    town among all rows. A generic gun is worth what any gun is. Every value is counted. Counts of attributes with a
    fixed set of values (CLOSED, a few hundred in all) become constant maps; those of the others join by value, as a
    broadcast where Spark finds them small."""
    names = [*SAME, "age", "o_age", "count", "o_count"]
    scratch = Scratch(register.sparkSession)
    cells = register.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in (*names, "town")]))).filter("v is not null")
    counts = scratch.keep(cells.groupBy("c", "v").agg(F.count("*").alias("n")), "counts")
    totals = {r["c"]: r["t"] for r in counts.groupBy("c").agg(F.sum("n").alias("t")).collect()}  # one row per attribute
    closed: dict[str, dict[str, int]] = {}
    for r in counts.filter(F.col("c").isin(*CLOSED)).collect():
        closed.setdefault(r["c"], {})[r["v"]] = r["n"]
    guns = sum(closed.get("weapon", {}).get(g, 0) for g in GUNS)
    out = register
    for c in (*names, "town"):
        b, total = "place" if c == "town" else f"b_{c}", totals.get(c)
        if not total:
            out = out.withColumn(b, F.lit(None).cast("double"))
        elif c in CLOSED:
            worth = {v: -math.log2((guns if c == "weapon" and v in GUNS else n) / total) for v, n in closed[c].items()}
            out = out.withColumn(b, F.try_element_at(F.from_json(F.lit(json.dumps(worth)), "map<string, double>"), F.col(c).cast("string")))
        else:
            known = counts.filter(F.col("c") == c).select(F.col("v").alias(f"_{c}"), (-F.log2(F.col("n") / F.lit(float(total)))).alias(b))
            out = out.join(known, out[c].cast("string") == known[f"_{c}"], "left").drop(f"_{c}")
    return scratch.keep(out, "worth")
