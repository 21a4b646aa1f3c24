"""Same postal address written differently: deletion-neighbourhood index on names, component assignment with vetoes."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.address_parse import Address, deletions, name_tokens, parse, place_of, same_name, tokens
from tidemark.session import Scratch

_PARTS = "kind string, number string, s1 string, s2 string, t1 string, t2 string, quadrant string, town string"
GROUP, BESIDE = ["kind", "number", "s1", "s2"], ["t1", "t2", "quadrant", "town"]


def _row(a: Address) -> tuple:
    pad = lambda t: (*t, "", "")[:2]
    return (a.kind, a.number, *pad(a.streets), *pad(a.types), a.quadrant, a.town)


def _variants():
    @F.pandas_udf("array<string>")
    def variants(w: pd.Series) -> pd.Series:
        return w.map(lambda x: sorted(deletions(x)))

    return variants


def _close():
    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_name(x, y) for x, y in zip(a, b)], dtype=bool)

    return close


def name_index(texts: DataFrame, text_col: str, ratio: int = 10) -> DataFrame:
    """(word, canon, role) for names that need it: misspelt ones with the name meant, and those of towns and states.

    A name is a misspelling of another if one edit makes it and the other is at least ``ratio`` times as frequent.
    Candidates come from a deletion-neighbourhood index over the distinct names: two names meet where they share a
    name with one letter less. Of several, one that stands where the misspelling does (as a town, or as a street) is
    meant, then the most frequent. Rarer names are left to the blocks (``near_streets``, ``near_towns``). A name's role is that of
    the places it stands in: town where most of the places that tell are a town's, state where most are behind a town; where
    none tells, that of the most frequent name one edit away.
    """

    def count(batches):
        for pdf in batches:
            seen = Counter(x for t in pdf["t"] for x in name_tokens(tokens(t)))
            yield pd.DataFrame([(w, c, n) for (w, c), n in seen.items()], columns=["word", "context", "n"])

    raw = texts.select(F.col(f"`{text_col}`").alias("t")).filter("t is not null").mapInPandas(count, "word string, context int, n bigint")
    at = lambda c: F.sum(F.when(F.col("context") == c, F.col("n")).otherwise(0))
    scratch = Scratch(texts.sparkSession)
    names = scratch.keep(raw.groupBy("word").agg(F.sum("n").alias("n"), at(1).alias("street"), at(-1).alias("town"), at(-2).alias("state")), "names")

    variants, close = _variants(), _close()
    stands = F.when(F.col("town") + F.col("state") > 2 * F.col("street"), "town").when(F.col("street") > 0, "street")
    index = names.select("word", "n", stands.alias("as"), F.explode(variants("word")).alias("v"))
    meant = index.select(F.col("word").alias("canon"), F.col("n").alias("m"), F.col("as").alias("like"), "v")
    met = index.join(meant, "v").filter((F.col("m") > F.col("n")) & (F.col("word") != F.col("canon")))
    fits = F.coalesce((F.col("as") == F.col("like")).cast("int"), F.lit(0))
    near = scratch.keep(met.select("word", "canon", "n", "m", fits.alias("fits")).distinct().filter(close("word", "canon")), "near")
    best = lambda df, name: df.groupBy("word").agg(F.max_by("canon", F.struct("fits", "m", "canon")).alias(name))
    fixes = best(near.filter((F.col("m") >= ratio) & (F.col("m") >= F.col("n") * ratio)), "canon")
    whole = names.join(fixes, "word", "left").withColumn("canon", F.coalesce("canon", "word"))
    per = whole.groupBy("canon").agg(F.sum("street").alias("street"), F.sum("town").alias("town"), F.sum("state").alias("state"), F.sum("n").alias("n"))
    role = F.when(F.col("state") * 2 > F.col("n"), "state").when((F.col("town") + F.col("state")) > 2 * F.col("street"), "town").otherwise("")
    told = per.select("canon", role.alias("own"), (F.col("street") + F.col("town") + F.col("state") > 0).alias("tells"))
    like = best(near, "like").join(whole.select(F.col("word").alias("like"), F.col("canon").alias("_c")), "like").join(told.select(F.col("canon").alias("_c"), F.col("own").alias("theirs")), "_c")
    out = whole.select("word", "canon").join(told, "canon").join(like.select("word", "theirs"), "word", "left")
    out = out.withColumn("role", F.when(F.col("tells"), F.col("own")).otherwise(F.coalesce("theirs", F.lit(""))))
    return scratch.keep(out.select("word", "canon", "role").filter((F.col("word") != F.col("canon")) | (F.col("role") != "")), "index")


def near_streets(ways: DataFrame, counts: DataFrame, ratio: int = 10) -> DataFrame:
    """(kind, number, other, name, canon): street names that mean another of their block, one edit away, however rare that is.

    A block is the kind, the number and the other street; names meet by the deletion-neighbourhood index inside it,
    where nothing else they state (types, quadrant, a town more than one edit away) excludes that it is one place. Frequency
    chooses which of the two is right; a name that stands in ``ratio`` rows or more is one in its own right and stays."""
    variants, close = _variants(), _close()
    slot = lambda name, other, t, o: ways.select("kind", "number", F.col(other).alias("other"), F.col(name).alias("name"), F.col(t).alias("t"), F.col(o).alias("o"), "quadrant", "town")
    slots = slot("s1", "s2", "t1", "t2").unionByName(slot("s2", "s1", "t2", "t1").filter("name <> ''"))
    slots = slots.filter("name not like '#%'").join(counts, "name").withColumn("v", F.explode(variants("name")))
    block = ["kind", "number", "other", "v"]
    b = slots.select(*block, F.col("name").alias("canon"), F.col("n").alias("m"), *[F.col(c).alias(f"{c}_b") for c in ("t", "o", "quadrant", "town")])
    fits = lambda c: (F.col(c) == "") | (F.col(f"{c}_b") == "") | (F.col(c) == F.col(f"{c}_b"))
    met = slots.filter(F.col("n") < ratio).join(b, block).filter("name <> canon and (m > n or (m = n and canon < name))").filter(fits("t") & fits("o") & fits("quadrant"))
    met = met.select("kind", "number", "other", "name", "canon", "m", "town", "town_b").distinct().withColumn("near", close("name", "canon")).withColumn("same", close("town", "town_b"))
    met = met.filter(F.col("near") & (F.col("same") | (F.col("town") == "") | (F.col("town_b") == "")))
    key = ["kind", "number", "other"]
    fixes = Scratch(ways.sparkSession).keep(met.groupBy(*key, "name").agg(F.max_by("canon", F.struct("m", "canon")).alias("canon")), "streets")
    out = fixes
    for _ in range(2):  # a misspelling of a misspelling
        further = fixes.select(*key, F.col("name").alias("canon"), F.col("canon").alias("further"))
        out = out.join(further, [*key, "canon"], "left").select(*key, "name", F.coalesce("further", "canon").alias("canon"))
    return out


def near_towns(counts: dict[str, int], ratio: int = 10) -> dict[str, str]:
    """The towns of a block, each with the one it means: the most frequent one edit away, if it stands in fewer than ``ratio`` rows."""
    out: dict[str, str] = {}
    for t in sorted(counts, key=lambda t: (-counts[t], t)):
        out[t] = next((out[c] for c in out if same_name(t, c)), t) if counts[t] < ratio else t
    return out


def _parser(lookup: dict[str, tuple[str, str]]):
    fix = {w: c for w, (c, _) in lookup.items()}
    towns = {c for c, r in lookup.values() if r == "town"}
    states = {c for c, r in lookup.values() if r == "state"}
    return lambda text: parse(text, fix, towns, states) if text else Address()


def same_places(
    addresses: DataFrame,
    id_col: str = "addr_id",
    text_col: str = "addr_raw",
    hint_col: str | None = None,
    index: DataFrame | None = None,
    broadcast_names: int = 500_000,
) -> DataFrame:
    """(id_col, place_id, kind, number, s1, s2): place_id is the smallest id of the records that mean the place.

    Records are taken apart (``parse``) with the names corrected by ``name_index``; block on kind, number and street
    names, where names one edit apart in one block are one name (``near_streets``, ``near_towns``); within a block the distinct statements of type, quadrant and town are assigned to places under hard vetoes
    (``place_of``), so a block's work depends on how many ways there are to state them, not on its rows. The name
    index goes to the executors whole while it has at most ``broadcast_names`` entries; beyond, names are looked up by a
    join on words.

    Defined cases: null, empty and not understood texts (no number and no crossing) have no place and are left out;
    units make no difference; an id delivered twice counts with each of its texts; null ids are left out; equal
    texts under different ids are one place; other columns are ignored.
    """
    spark = addresses.sparkSession
    scratch = Scratch(spark)
    kind = addresses.schema[id_col].dataType.simpleString()
    hint = F.col(f"`{hint_col}`") if hint_col else F.lit(None).cast("string")
    slim = addresses.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), hint.alias("hint")).filter("id is not null and text is not null")
    index = index if index is not None else name_index(slim, "text")
    out = f"id {kind}, {_PARTS}, h1 string, h2 string, hq string, ht string"
    columns = ["id", *GROUP, *BESIDE, "h1", "h2", "hq", "ht"]

    def rows(pdf: pd.DataFrame, parsers) -> pd.DataFrame:
        made = []
        for i, text, said, p in zip(pdf["id"], pdf["text"], pdf["hint"], parsers):
            a = p(text)
            if not a.kind:
                continue
            h = p(said) if said else Address()
            same = (h.kind, h.number, len(h.streets)) == (a.kind, a.number, len(a.streets)) and all(x == y or ("#" not in (x + y) and same_name(x, y)) for x, y in zip(h.streets, a.streets))
            made.append((i, *_row(a), *(_row(h)[4:] if same else ("",) * 4)))
        return pd.DataFrame(made, columns=columns)

    if index.count() <= broadcast_names:
        shared = spark.sparkContext.broadcast({r["word"]: (r["canon"], r["role"]) for r in index.toLocalIterator()})

        def take_apart(batches):
            p = _parser(shared.value)
            for pdf in batches:
                yield rows(pdf, [p] * len(pdf))

        parsed = slim.mapInPandas(take_apart, out)
    else:

        def split(batches):
            for pdf in batches:
                pairs = [(k, w) for k, (t, h) in enumerate(zip(pdf["text"], pdf["hint"])) for w in {x for x, _ in name_tokens(tokens(t)) + name_tokens(tokens(h))}]
                yield pd.DataFrame({"row": [pdf["row"].iloc[k] for k, _ in pairs], "word": [w for _, w in pairs]})

        numbered = scratch.keep(slim.withColumn("row", F.monotonically_increasing_id()), "numbered")
        known = numbered.mapInPandas(split, "row bigint, word string").join(index, "word").groupBy("row").agg(F.collect_list(F.struct("word", "canon", "role")).alias("names"))

        def take_apart_alone(batches):
            for pdf in batches:
                yield rows(pdf, [_parser({n["word"]: (n["canon"], n["role"]) for n in (ns if ns is not None else [])}) for ns in pdf["names"]])

        parsed = numbered.join(known, "row", "left").select("id", "text", "hint", "names").mapInPandas(take_apart_alone, out)

    parsed = scratch.keep(parsed, "parsed")
    ways = scratch.keep(parsed.groupBy(*GROUP, *BESIDE).agg(F.count("*").alias("n")), "ways")
    counts = scratch.keep(ways.select(F.explode(F.array("s1", "s2", "town")).alias("name"), "n").filter("name <> ''").groupBy("name").agg(F.sum("n").alias("n")), "counts")
    fixes = scratch.keep(near_streets(ways, counts), "fixes")
    for name, other in (("s1", "s2"), ("s2", "s1")):
        fix = fixes.select("kind", "number", F.col("other").alias(other), F.col("name").alias(name), F.col("canon").alias(f"_{name}"))
        parsed = parsed.join(fix, ["kind", "number", other, name], "left")
    parsed = parsed.withColumns({"s1": F.coalesce("_s1", "s1"), "s2": F.coalesce("_s2", "s2")}).drop("_s1", "_s2")
    turn = (F.col("kind") == "X") & (F.col("s1") > F.col("s2"))
    turned = {c: F.when(turn, F.col(d)).otherwise(F.col(c)) for a, b in (("s1", "s2"), ("t1", "t2"), ("h1", "h2")) for c, d in ((a, b), (b, a))}
    parsed = scratch.keep(parsed.withColumns(turned).select(*columns), "corrected")
    hints = F.max(F.when(F.concat("h1", "h2", "hq", "ht") != "", F.struct("h1", "h2", "hq", "ht")))
    ways = parsed.groupBy(*GROUP, *BESIDE).agg(F.count("*").alias("n"), F.min("id").alias("lo"), hints.alias("hint"))
    ways = ways.join(counts.select(F.col("name").alias("town"), F.col("n").alias("rows")), "town", "left")
    blocks = ways.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct(*BESIDE, "n", "lo", "hint", "rows"))).alias("ways"))

    def settle(batches):
        for pdf in batches:
            made = []
            for r in pdf.itertuples(index=False):
                means = near_towns({w["town"]: w["rows"] for w in r.ways if w["town"]})
                stated: dict[tuple, list] = {}
                for w in r.ways:
                    h = w["hint"]
                    said = stated.setdefault(((w["t1"], w["t2"]), w["quadrant"], means.get(w["town"], "")), [0, None])
                    said[0] += w["n"]
                    said[1] = said[1] or (((h["h1"], h["h2"]), h["hq"], means.get(h["ht"], h["ht"]), 0, None) if h else None)
                places = dict(zip(stated, place_of([(*s, *said) for s, said in stated.items()])))
                at = [places[(w["t1"], w["t2"]), w["quadrant"], means.get(w["town"], "")] for w in r.ways]
                lowest: dict[int, object] = {}
                for k, w in zip(at, r.ways):
                    lowest[k] = min(lowest.get(k, w["lo"]), w["lo"])
                made += [(*r[:4], w["t1"], w["t2"], w["quadrant"], w["town"], lowest[k]) for k, w in zip(at, r.ways)]
            yield pd.DataFrame(made, columns=[*GROUP, *BESIDE, "place_id"])

    single = blocks.filter(F.size("ways") == 1).select(*GROUP, F.inline("ways")).select(*GROUP, *BESIDE, F.col("lo").alias("place_id"))
    several = blocks.filter(F.size("ways") > 1).mapInPandas(settle, f"{_PARTS}, place_id {kind}")
    placed = parsed.select("id", *GROUP, *BESIDE).distinct().join(single.unionByName(several), [*GROUP, *BESIDE])
    return placed.select(F.col("id").alias(id_col), "place_id", *GROUP)


def place_pairs(places: DataFrame, id_col: str = "addr_id") -> DataFrame:
    """All pairs of records of one place, the smaller id first. Only for results that must be pairs."""
    slim = places.select(F.col(id_col).alias("id"), "place_id", *GROUP).distinct()
    other = slim.withColumnRenamed("id", "other")
    return slim.join(other, ["place_id", *GROUP]).filter("id < other").select(F.col("id").alias(f"{id_col}_l"), F.col("other").alias(f"{id_col}_r")).distinct()
