"""Best representative of each duplicate group: skyline selection, field by field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that stand for a missing name, as letters only.
NO_NAME = (
    "unknown", "victim", "xxx", "na", "nk", "none", "null", "unnamed", "unidentified", "withheld", "notreleased", "notstated", "notknown",
    "johndoe", "janedoe", "babyboy", "babygirl", "unidentifiedman", "unidentifiedwoman", "unidentifiedmale", "unidentifiedfemale",
    "unknownman", "unknownwoman", "unknownmale", "unknownfemale", "nametobereleased",
)
TITLES = r"^(?:mr|mrs|ms|miss|dr|rev|sgt|det|officer)\.?\s+"
SUFFIXES = r"[\s,]+(?:jr|sr|ii|iii|iv)\.?$"
SEXES = {"m": "male", "male": "male", "man": "male", "boy": "male", "f": "female", "female": "female", "woman": "female", "girl": "female"}
RACES = {
    "b": "black", "black": "black", "african american": "black", "w": "white", "white": "white", "caucasian": "white", "a": "asian", "asian": "asian",
    "pacific islander": "asian", "i": "native", "native": "native", "native american": "native", "american indian": "native", "indian": "native",
}


def usable_name(c: Column) -> Column:
    """Given name and surname spelled out: two words of two or more letters besides title and suffix, no
    placeholder. Initials between them do no harm."""
    s = F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    s = F.regexp_replace(F.regexp_replace(s, TITLES, ""), SUFFIXES, "")
    # "Surname, Given" is turned round; what stands first must be a word, what stands last too.
    s = F.regexp_replace(s, r"^([^,]+), (.+)$", "$2 $1")
    letters = F.regexp_replace(s, r"[^\p{L}]", "")
    doe = s.rlike(r"\b(?:doe|unidentified|unknown|withheld|victim|unnamed)\b") | s.rlike(r"^baby\b")
    full = s.rlike(r"^\p{L}[\p{L}'’-]+ (?:.* )?\p{L}[\p{L}'’-]+$")
    return F.coalesce(full & ~doe & ~letters.isin(*NO_NAME), F.lit(False))


def usable_code(c: Column, known: Mapping[str, str]) -> Column:
    return F.coalesce(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))).isin(*known), F.lit(False))


def usable_date(c: Column, first: int = 1976, last: int = 2017) -> Column:
    return F.coalesce(F.year(c).between(first, last), F.lit(False))


def field_sources(
    rows: DataFrame,
    group: str,
    fields: Mapping[str, Column],
    row_id: str,
    trust: str,
    recency: str,
    min_rows: int = 2,
    completeness: str = "fields",
) -> DataFrame:
    """The row that supplies each field of each group's surviving record: (group, field_name, row_id, layer).

    ``fields`` maps a field to the condition under which its value is usable. Whole rows are points of completeness,
    recency (latest first, null = oldest, the smaller row id first among equals) and trust (smallest rank first). A row
    dominates another if it is as trusted, more recent and as complete; rows that none dominates are the first layer,
    those that only rows of the first dominate the second, and so on. A field comes from the first layer that has a
    usable value of it; within the layer the policy decides: trust, then recency, then row id.

    ``completeness`` says when a row is as complete as another: ``fields``, if it has every field the other has, or
    ``count``, if it has as many. By ``fields`` the outcome is the policy's first choice among all usable rows: whoever
    would dominate that row would have the field too and be preferred to it, so it stands in the first layer. By
    ``count`` a row with more fields may push it back, and the field then comes from the layer that has it first.

    Before any shuffle of whole groups, rows shrink to one per group, set of usable fields and trust: the latest, with
    the smallest id, which dominates the others and has what they have. A group that holds a third of all rows costs no
    more than these classes, at most 2 ** fields for each rank of trust, which must have few.

    Defined cases: groups of fewer than ``min_rows`` distinct row ids give nothing, nor does a null group; rows delivered
    twice count once; no usable value, no row for the field; a null trust is the least trusted; an empty table
    gives no rows; other columns are ignored.
    """
    if completeness not in ("fields", "count"):
        raise ValueError(f"unknown completeness: {completeness}")
    names = list(fields)
    id_ = F.col(f"`{row_id}`")
    when = F.col(f"`{recency}`").cast("timestamp")
    mask = sum((F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)) for i, cond in enumerate(fields.values())), F.lit(0))
    slim = rows.filter(F.col(f"`{group}`").isNotNull()).select(
        F.col(f"`{group}`").alias("g"), id_.alias("id"), F.coalesce(F.col(f"`{trust}`").cast("double"), F.lit(float("inf"))).alias("t"),
        F.coalesce(F.unix_micros(when), F.lit(-(2**62))).alias("r"), mask.alias("mask"),
    )
    # One row per class. max over (recency, -rank of the id) keeps the latest, the smallest id among equals.
    classes = slim.groupBy("g", "mask", "t").agg(F.min_by(F.struct("r", "id"), F.struct(-F.col("r"), F.col("id"))).alias("b"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    per = classes.groupBy("g").agg(
        F.array_sort(F.collect_list(F.struct(F.col("t").alias("t"), (-F.col("b.r")).alias("nr"), F.col("b.id").alias("id"), F.col("mask").alias("mask")))).alias("pts"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    if min_rows > 1:
        if min_rows > 2:
            enough = slim.select("g", "id").distinct().groupBy("g").count().filter(F.col("count") >= min_rows).select("g")
            per = per.join(enough, "g", "left_semi")
        per = per.filter("lo != hi")

    # Layers over the classes, a bounded array. Sorted by trust, recency and id, nobody is dominated by a later row, so one
    # fold settles every layer: one more than the deepest dominator's.
    def dominates(q: Column, p: Column) -> Column:
        newer = (q["nr"] < p["nr"]) | ((q["nr"] == p["nr"]) & (q["id"] < p["id"]))
        full = q["mask"].bitwiseAND(p["mask"]) == p["mask"] if completeness == "fields" else F.bit_count(q["mask"]) >= F.bit_count(p["mask"])
        return (q["t"] <= p["t"]) & newer & full

    point = f"struct<t: double, nr: bigint, id: {rows.schema[row_id].dataType.simpleString()}, mask: int>"
    deepest = lambda acc, p: F.coalesce(F.array_max(F.transform(F.filter(acc, lambda x: dominates(x["p"], p)), lambda x: x["layer"])), F.lit(0))
    layered = F.aggregate(
        "pts", F.array().cast(f"array<struct<p: {point}, layer: int>>"),
        lambda acc, p: F.concat(acc, F.array(F.struct(p.alias("p"), (deepest(acc, p) + 1).alias("layer")))),
    )
    per = per.select("g", layered.alias("pts"))

    def source(i: int) -> Column:
        usable = F.filter("pts", lambda x: x["p"]["mask"].bitwiseAND(1 << i) != 0)
        order = F.transform(usable, lambda x: F.struct(x["layer"].alias("layer"), x["p"]["t"].alias("t"), x["p"]["nr"].alias("nr"), x["p"]["id"].alias("id")))
        return F.struct(F.lit(names[i]).alias("field_name"), F.array_min(order).alias("s"))

    out = per.select(F.col("g").alias(group), F.inline(F.array(*[source(i) for i in range(len(names))])))
    return out.filter("s is not null").select(group, "field_name", F.col("s.id").alias(row_id), F.col("s.layer").alias("layer"))


def survivors(rows: DataFrame, group: str, fields: Mapping[str, Column], row_id: str, trust: str, recency: str, completeness: str = "fields") -> DataFrame:
    """One record per group, built field by field from the rows that ``field_sources`` names (groups of one, too).
    Row ids must be unique but for repeated delivery."""
    chosen = field_sources(rows, group, fields, row_id, trust, recency, 1, completeness).groupBy(group).pivot("field_name", list(fields)).agg(F.first(row_id))
    ids = chosen.select(group, F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(f"`{f}`") for f in fields])))).alias(row_id))
    values = rows.select(group, row_id, *fields).dropDuplicates([group, row_id]).join(ids, [group, row_id])
    joined = values.join(chosen.select(F.col(group), *[F.col(f"`{f}`").alias(f"_{f}") for f in fields]), group)
    return joined.groupBy(group).agg(
        *[F.max(F.when(F.col(row_id) == F.col(f"_{f}"), F.col(f"`{f}`"))).alias(f) for f in fields],
        *[F.max(F.when(F.col(row_id) == F.col(f"_{f}"), F.col(row_id))).alias(f"{f}_row") for f in fields],
    )
