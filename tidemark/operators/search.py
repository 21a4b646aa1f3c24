"""Full-text search over a postings table: BM25, phrases, document frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def token_array(c):
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def postings(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, term, tf, length)."""
    toks = docs.select(id_col, token_array(F.col(text)).alias("t"))
    return toks.select(id_col, F.size("t").alias("length"), F.explode("t").alias("term")).groupBy(id_col, "length", "term").agg(F.count("*").alias("tf"))


def refresh_postings(index: DataFrame, changed: DataFrame, removed: DataFrame, id_col: str, text: str) -> DataFrame:
    """The index after documents changed, came or went: only their postings are worked out anew; those of the others are kept
    by an anti join on the id."""
    gone = changed.select(id_col).unionByName(removed.select(id_col)).distinct()
    return index.join(gone, id_col, "left_anti").unionByName(postings(changed, id_col, text))


def bm25_postings(index: DataFrame, id_col: str, terms: Sequence[str], n_docs: int, mean_length: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) from a stored index: only the rows of the query's terms are read (an index written by term prunes the
    rest). ``n_docs`` and ``mean_length`` describe the corpus, documents without words included."""
    hits = index.filter(F.col("term").isin(*[t.lower() for t in terms]))
    df = hits.groupBy("term").agg(F.count("*").alias("_df"))  # a row per term of the query
    idf = F.log(1 + (F.lit(float(n_docs)) - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(float(mean_length))))
    return hits.join(F.broadcast(df), "term").groupBy(id_col).agg(F.sum(part).alias("score"))


def bm25_phrases(docs: DataFrame, id_col: str, text: str, phrases: Sequence[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) with a phrase as one term: its frequency is how often its words stand in a row."""
    flat = docs.select(id_col, F.concat(F.lit(" "), F.array_join(token_array(F.col(text)), "  "), F.lit(" ")).alias("_flat"), F.size(token_array(F.col(text))).alias("length"))
    padded = [" " + "  ".join(p.lower().split()) + " " for p in phrases]
    tf = [((F.length("_flat") - F.length(F.replace(F.col("_flat"), F.lit(p), F.lit("")))) / len(p)).cast("bigint") for p in padded]
    counted = flat.select(id_col, F.coalesce("length", F.lit(0)).alias("length"), *[F.coalesce(c, F.lit(0)).alias(f"_tf{i}") for i, c in enumerate(tf)])
    stats = counted.agg(F.count("*").alias("_n"), F.avg(F.greatest("length", F.lit(0))).alias("_avg"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(phrases))])
    both = counted.filter(" or ".join(f"_tf{i} > 0" for i in range(len(phrases)))).crossJoin(F.broadcast(stats))  # one row
    score = F.lit(0.0)
    for i in range(len(phrases)):
        idf = F.log(1 + (F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5))
        score = score + idf * F.col(f"_tf{i}") * (k1 + 1) / (F.col(f"_tf{i}") + k1 * (1 - b + b * F.col("length") / F.col("_avg")))
    return both.select(id_col, score.alias("score"))


def bm25(docs: DataFrame, id_col: str, text: str, terms: Sequence[str], k1: float = 1.2, b: float = 0.75, limit_share: float | None = None) -> DataFrame:
    """(id, score) of the documents that hold any of the terms. Counting the query's terms needs one pass over the texts
    and no postings shuffle: term counts are columns of the document. ``limit_share`` keeps that share of the corpus, one at
    least, by score and id."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    word = lambda w: rf"(?<![\p{{L}}\p{{N}}]){w.lower()}(?![\p{{L}}\p{{N}}])"
    tf = {f"_tf{i}": F.regexp_count(low, F.lit(word(w))) for i, w in enumerate(terms)}
    counted = docs.select(id_col, F.regexp_count(low, F.lit(r"[\p{L}\p{N}]+")).alias("_len"), *[c.alias(n) for n, c in tf.items()])
    stats = counted.agg(F.count("*").alias("_n"), F.avg("_len").alias("_avg"), *[F.count_if(F.col(n) > 0).alias(f"{n}_df") for n in tf])
    both = counted.filter(" or ".join(f"{n} > 0" for n in tf)).crossJoin(F.broadcast(stats))  # one row
    score = F.lit(0.0)
    for n in tf:
        idf = F.log(1 + (F.col("_n") - F.col(f"{n}_df") + 0.5) / (F.col(f"{n}_df") + 0.5))
        score = score + idf * F.col(n) * (k1 + 1) / (F.col(n) + k1 * (1 - b + b * F.col("_len") / F.col("_avg")))
    out = both.select(id_col, score.alias("score"))
    if limit_share is None:
        return out
    return out.orderBy(F.desc("score"), id_col).limit(max(1, int(docs.count() * limit_share)))


def phrase_hits(docs: DataFrame, id_col: str, text: str, phrases: Sequence[str]) -> DataFrame:
    """(id, phrase) for every phrase that a text holds as whole words."""
    flat = docs.select(id_col, F.concat(F.lit(" "), F.array_join(token_array(F.col(text)), " "), F.lit(" ")).alias("_flat"))
    found = F.array_compact(F.array(*[F.when(F.col("_flat").contains(f" {p.lower()} "), F.lit(p)) for p in phrases]))
    return flat.select(id_col, F.explode(found).alias("phrase"))


def anchor_frequencies(docs: DataFrame, text: str, anchors: dict[str, Sequence[str]], most_share: float = 0.2) -> DataFrame:
    """(anchor, variant, df): in how many texts each variant occurs, whatever its case; variants in more than ``most_share`` of the
    texts are dropped. All variants are counted in one pass."""
    variants = [(a, v) for a, vs in anchors.items() for v in vs]
    counts = docs.agg(F.count("*").alias("_n"), *[F.count_if(F.lower(text).contains(v.lower())).alias(f"_v{i}") for i, (_, v) in enumerate(variants)])
    cells = F.array(*[F.struct(F.lit(a).alias("anchor"), F.lit(v).alias("variant"), F.col(f"_v{i}").alias("df")) for i, (a, v) in enumerate(variants)])
    return counts.select("_n", F.inline(cells)).filter(F.col("df") <= F.col("_n") * most_share).drop("_n")


def variant_matches(hits: DataFrame, text: str, variants: Sequence[str]) -> DataFrame:
    """Hits with the variants their text holds; all of them where it holds none."""
    found = F.array_compact(F.array(*[F.when(F.lower(text).contains(v.lower()), F.lit(v)) for v in variants]))
    return hits.withColumn("variants", F.when(F.size(found) > 0, found).otherwise(F.array(*[F.lit(v) for v in variants])))
