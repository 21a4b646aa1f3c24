"""A linkage job from records to clusters or one-to-one matches, in one description."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import assignment, blocking, clustering, linkage
from tidemark.operators.blocking import Rule
from tidemark.operators.comparisons import register_functions
from tidemark.operators.linkage import Comparison, Model, Training
from tidemark.session import Scratch


@dataclass(frozen=True)
class Job:
    """comparisons and rules; ``training``: blocks to learn from, in at most ``em_runs`` outer runs that stop at ``em_stop``;
    ``copies``: (comparison, level, level whose m/u becomes the first's); ``deterministic`` rules and their recall give the
    prior. ``exclusion``: column with an id that two records of a cluster must not share. With ``two_passes``, unions the first
    clustering blocks are barred from the pairs of the second. ``model``: a trained one, for inference only."""

    id_col: str
    comparisons: tuple[Comparison, ...]
    rules: tuple[Rule, ...]
    training: tuple[Training, ...] = ()
    deterministic: tuple[Rule, ...] = ()
    recall: float = 0.5
    predict_threshold: float = 0.05
    cluster_threshold: float = 0.0
    random_pairs: int = 1_000_000
    em_rounds: int = 100
    em_runs: int = 1
    em_stop: float = 0.002
    copies: tuple[tuple[str, int, int], ...] = ()
    exclusion: str | None = None
    two_passes: bool = False
    one_to_one: bool = False
    term_frequencies: bool = True
    model: Model | None = None
    keep: tuple[str, ...] = field(default_factory=tuple)


@dataclass
class Result:
    model: Model
    pairs: DataFrame
    clusters: DataFrame | None = None
    blocked: DataFrame | None = None
    matches: DataFrame | None = None


def train(job: Job, left: DataFrame, right: DataFrame | None) -> Model:
    """The prior from deterministic pairs, u from random pairs, m by EM in the training blocks. A block's pairs are read once,
    whatever the number of runs."""
    n, m = left.count(), right.count() if right is not None else None
    all_pairs = n * (n - 1) / 2 if m is None else n * m
    prior = 1e-4
    if job.deterministic:
        prior = linkage.prior_from_rules(blocking.block_pairs(left, right, job.id_col, job.deterministic).count(), job.recall, all_pairs)
    model = Model(prior, linkage.estimate_u(left, right, job.comparisons, job.random_pairs))
    blocks = [(t, linkage.patterns(blocking.block_pairs(left, right, job.id_col, t.rules), model.comparisons, t.excluded(model.comparisons))) for t in job.training]
    if blocks:
        model, _ = linkage.train_runs(blocks, model, job.em_runs, stop=job.em_stop, rounds=job.em_rounds)
    for name, source, target in job.copies:
        model = linkage.copy_ratio(model, name, source, target)
    return model


def run(job: Job, left: DataFrame, right: DataFrame | None = None) -> Result:
    spark = left.sparkSession
    register_functions(spark)
    scratch = Scratch(spark)
    i = job.id_col
    model = job.model or train(job, left, right)
    tf = {}
    if job.term_frequencies:
        both = left if right is None else left.unionByName(right, allowMissingColumns=True)
        tf = {c.tf: linkage.term_frequencies(both, c.tf) for c in job.comparisons if c.tf}

    def predict(barred: DataFrame | None) -> DataFrame:
        pairs = blocking.block_pairs(left, right, i, job.rules)
        if barred is not None:
            pairs = blocking.drop_listed(pairs, barred, F.col(f"l.{i}"), F.col(f"r.{i}"), ("id", "x"))
        scored = linkage.score(pairs, model, tf, job.predict_threshold)
        gammas = [c for c in scored.columns if c.startswith("gamma_")]
        kept = scored.select(F.col(f"l.{i}").alias("id_l"), F.col(f"r.{i}").alias("id_r"), "rule", *gammas, "match_weight", F.round("match_probability", 9).alias("match_probability"))
        return scratch.keep(kept, "pairs")

    pairs = predict(None)
    if job.one_to_one:
        weights = pairs.select("id_l", "id_r", (F.col("match_weight") + 1000).alias("w"))  # all positive: more matches beat fewer
        chosen = assignment.match_one_to_one(weights, "id_l", "id_r", "w").drop("w")
        return Result(model, pairs, matches=chosen.join(pairs.select("id_l", "id_r", "match_probability"), ["id_l", "id_r"]))
    if right is not None:
        return Result(model, pairs, matches=linkage.best_per_right(pairs, F.col("id_l"), F.col("id_r")))
    barred = left.select(F.col(i).alias("member_id"), F.col(job.exclusion).alias("exclusion_id")) if job.exclusion else None

    def cluster(p: DataFrame) -> dict[str, DataFrame]:
        return clustering.constrained_clusters(p, "id_l", "id_r", "match_probability", barred, job.cluster_threshold)

    out = cluster(pairs)
    if job.two_passes:
        lists = clustering.exclusion_lists(out["blocked"]).select("id", F.explode("exclusion_ids").alias("x"))
        pairs = predict(lists)
        out = cluster(pairs)
    return Result(model, pairs, out["clusters"], out["blocked"])


def inference_only(job: Job, text: str, expect: dict[str, str] | None = None) -> Job:
    """The job with a saved model; refused where the model cannot score."""
    return replace(job, model=Model.from_json(text, expect))


def required_columns(df: DataFrame, names: Sequence[str], table: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
