"""Most similar vectors for every vector: vantage-point trees per shard with relaxed triangle pruning."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Scratch

#: Similarities closer than this count as equal (they are rounded to 9 places before they are compared).
PLACES = 9
SLACK = 2e-9


@dataclass
class Node:
    """A split by distance to a vantage point: inside is d <= mu. Leaves have a number instead of children."""

    vantage: np.ndarray | None = None
    mu: float = 0.0
    inside: Node | None = None
    outside: Node | None = None
    leaf: int = -1
    rows: np.ndarray | None = None


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Chord lengths on the unit sphere: a metric, and a smaller one means a larger cosine."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ p)))


def build(x: np.ndarray, leaf_rows: int, seed: int = 7) -> tuple[Node, int]:
    """A tree over unit rows x; leaves keep their row numbers. A split that separates nothing makes a leaf."""
    rng, count = np.random.default_rng(seed), 0

    def grow(rows: np.ndarray) -> Node:
        nonlocal count
        if len(rows) > leaf_rows:
            # The candidate whose distances spread most cuts off most.
            trial = rng.choice(rows, size=min(8, len(rows)), replace=False)
            probe = x[rng.choice(rows, size=min(256, len(rows)), replace=False)]
            vantage = x[max(trial, key=lambda i: np.std(distances(probe, x[i])))]
            d = distances(x[rows], vantage)
            mu = float(np.median(d))
            near = d <= mu
            if near.any() and not near.all():
                return Node(vantage, mu, grow(rows[near]), grow(rows[~near]))
        count += 1
        return Node(leaf=count - 1, rows=rows)

    return grow(np.arange(len(x))), count


def descend(node: Node, x: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    out = np.zeros(len(x), np.int64)

    def go(n: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if n.leaf >= 0:
            out[rows] = n.leaf
            return
        near = distances(x[rows], n.vantage) <= n.mu
        go(n.inside, rows[near])
        go(n.outside, rows[~near])

    go(node, np.arange(len(x)))
    return out


def reachable(node: Node, x: np.ndarray, tau: np.ndarray, factor: float):
    """(leaf node, rows of x whose ball of radius tau / factor can reach it), by the triangle inequality."""
    stack = [(node, np.arange(len(x)))]
    while stack:
        n, rows = stack.pop()
        if not len(rows):
            continue
        if n.leaf >= 0:
            yield n, rows
            continue
        d, reach = distances(x[rows], n.vantage), tau[rows] / factor
        stack.append((n.inside, rows[d - reach <= n.mu + 1e-9]))
        stack.append((n.outside, rows[d + reach >= n.mu - 1e-9]))


class Best:
    """The k best (similarity, id rank) per query; rank orders ties."""

    def __init__(self, n: int, k: int):
        self.k, self.sim, self.at = k, np.full((n, k), -2.0), np.full((n, k), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        return self.sim[:, -1]

    def add(self, rows: np.ndarray, sims: np.ndarray, ranks: np.ndarray) -> None:
        """sims: of the queries ``rows`` with candidates of rank ``ranks``."""
        r, c = np.nonzero(sims >= self.sim[rows, -1][:, None] - SLACK)
        if not len(r):
            return
        s, rank = np.round(sims[r, c], PLACES), ranks[c]
        touched, first, n = np.unique(r, return_index=True, return_counts=True)
        q = rows[touched]
        # Old and new entries of the touched queries in one list, ordered by query, similarity, rank.
        who = np.concatenate([np.repeat(np.arange(len(q)), self.k), np.repeat(np.arange(len(q)), n)])
        sim = np.concatenate([self.sim[q].ravel(), s])
        at = np.concatenate([self.at[q].ravel(), rank])
        order = np.lexsort((at, -sim, who))
        who, sim, at = who[order], sim[order], at[order]
        start = np.searchsorted(who, np.arange(len(q)))
        take = start[:, None] + np.arange(self.k)
        self.sim[q], self.at[q] = sim[take], at[take]


def leaves(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        n = stack.pop()
        if n.leaf >= 0:
            yield n
        else:
            stack += [n.outside, n.inside]


def bounds(node: Node, x: np.ndarray) -> dict[int, np.ndarray]:
    """For every leaf, how far each row of x is from its cell at least, by the triangle inequality."""
    out, stack = {}, [(node, np.zeros(len(x)))]
    while stack:
        n, least = stack.pop()
        if n.leaf >= 0:
            out[n.leaf] = least
            continue
        d = distances(x, n.vantage)
        stack.append((n.inside, np.maximum(least, d - n.mu)))
        stack.append((n.outside, np.maximum(least, n.mu - d)))
    return out


def radius(floor: np.ndarray) -> np.ndarray:
    """Of the ball in which vectors of at least this similarity lie."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (floor - SLACK)))


def search(node: Node, x: np.ndarray, ranks: np.ndarray, queries: np.ndarray, rows: np.ndarray, tau: np.ndarray, best: Best, factor: float, done: np.ndarray | None = None) -> None:
    """Search the tree ``node`` over x for the queries ``rows``, which lie in balls of radius ``tau``; ``done``: the leaf that each has seen."""
    step = 2048
    for n, at in reachable(node, queries[rows], tau[rows], factor):
        part = rows[at] if done is None else rows[at][done[rows[at]] != n.leaf]
        for i in range(0, len(part), step):
            best.add(part[i : i + step], queries[part[i : i + step]] @ x[n.rows].T, ranks[n.rows])


def pack(x: np.ndarray) -> list[bytes]:
    """Vectors as bytes that give their direction without loss: whole numbers of 16 or 32 bits where they are decimals of few
    places, single precision where that is exact, else unit vectors in double precision."""
    out: list[bytes] = [b""] * len(x)
    left = np.arange(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for places in range(10):
            v = x[left]
            whole = np.rint(v * 10.0**places)
            fit = (np.abs(whole) < 2**31).all(axis=1) & (whole / 10.0**places == v).all(axis=1)
            for i, n in zip(left[fit], whole[fit].astype(np.int64)):
                n //= np.gcd.reduce(n)  # multiples of one vector are one
                kind = "h" if np.abs(n).max() < 2**15 else "i"
                out[i] = kind.encode() + n.astype(kind).tobytes()
            left = left[~fit]
    if len(left):
        v = x[left]
        with np.errstate(over="ignore"):
            single = v.astype(np.float32)
        for i, row, short, same in zip(left, v, single, (single == v).all(axis=1)):
            if same:
                out[i] = b"f" + short.tobytes()
            else:
                row = row / np.abs(row).max()
                out[i] = b"d" + (row / np.linalg.norm(row)).tobytes()
    return out


def unpack(packed) -> np.ndarray:
    """The unit vectors."""
    packed, out = list(packed), None
    for kind in "hifd":
        at = [i for i, b in enumerate(packed) if b[:1] == kind.encode()]
        if at:
            x = np.frombuffer(b"".join(packed[i][1:] for i in at), kind).reshape(len(at), -1).astype(np.float64)
            if kind != "d":
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
            out = np.zeros((len(packed), x.shape[1])) if out is None else out
            out[at] = x
    return np.zeros((0, 1)) if out is None else out


def _planted(folder: str, shard: int) -> tuple[Node, list[bytes], np.ndarray, list]:
    """A shard's tree, its packed vectors, the ranks of their first ids, and their ids."""
    fs, path = pafs.FileSystem.from_uri(f"{folder}/shard={shard}") if "://" in folder else (pafs.LocalFileSystem(), f"{folder}/shard={shard}")
    for f in fs.get_file_info(pafs.FileSelector(path)):
        if f.base_name.endswith(".parquet"):
            with fs.open_input_file(f.path) as file:
                return pickle.loads(pq.ParquetFile(file).read(columns=["tree"])["tree"][0].as_py())
    raise FileNotFoundError(path)


def nearest_vectors(
    vectors: DataFrame,
    k: int = 5,
    factor: float = 1.0,
    id_col: str = "id",
    vec_col: str = "vec",
    width: int | None = None,
    shard_rows: int = 8192,
    block_rows: int = 4096,
    leaf_rows: int = 512,
    fit_rows: int = 20_000,
    seed: int = 7,
) -> DataFrame:
    """The k most cosine-similar vectors of every vector: (id, neighbour, similarity, rank).

    A vantage-point tree fitted to at most ``fit_rows`` sampled vectors splits space into shards of about
    ``shard_rows`` vectors (at most ``fit_rows`` shards); every vector is put into its shard. Each shard builds its own
    tree, once, and it is written to the shared folder. A task takes about ``block_rows`` vectors of one shard and
    searches their own tree first. The k-th similarity so far bounds the ball in which better ones can
    lie, and only shards (and, inside, only leaves) the ball reaches by the triangle inequality are searched next, the
    nearest first; their trees are read from the folder. So no vector is shuffled to those it is compared
    with, and disk holds each a fixed number of times, however many shards are searched. ``factor`` divides the ball's
    radius (of what the own shard gave): 1 is exact, more is faster and may miss some.

    Exact copies of a vector are one row in the trees, however many there are; of their ids the k + 1 smallest can
    be anybody's neighbours, and all of them get their own result.

    Defined cases: vectors that are null, all zero, not ``width`` long (if given; else of another length than
    most), or hold a null, NaN or infinity take no part; null ids neither; similarities are rounded to 9 places,
    ties go to the smaller id, a row is not its own neighbour; an id delivered twice counts once, with the first of its
    vectors in the order of their hashes; fewer than k others give fewer rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    idc, v = F.col(f"`{id_col}`"), F.col(f"`{vec_col}`").cast("array<double>")
    whole = vectors.filter(idc.isNotNull() & v.isNotNull()).select(idc.alias("id"), v.alias("v"))
    if width is None:
        lengths = whole.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
        width = lengths["w"] if lengths else 1
    good = F.forall("v", lambda e: e.isNotNull() & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    kind = vectors.schema[id_col].dataType.simpleString()

    def packing(batches):
        for batch in batches:
            if len(batch):
                col = batch.column("v")
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(pack(col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)), pa.binary())], ["id", "b"])

    fit = whole.filter((F.size("v") == width) & good)
    packed = scratch.keep(fit.mapInArrow(packing, f"id {kind}, b binary").withColumn("h", F.unhex(F.md5("b"))), "packed")
    members = scratch.keep(packed.groupBy("id").agg(F.min("h").alias("h")), "members")
    first = F.row_number().over(Window.partitionBy("h").orderBy("id"))
    heads = members.withColumn("n", first).filter(F.col("n") <= k + 1).groupBy("h").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    reps = packed.groupBy("h").agg(F.first("b").alias("b")).join(heads, "h").withColumn("rep", F.col("ids")[0])
    # Numbers in the order of the ids, so that ties are settled inside NumPy: partitions of an ordered frame are in order.
    reps = scratch.keep(reps.orderBy("rep").select("h", "b", "ids").withColumn("at", F.monotonically_increasing_id()), "reps")
    scratch.drop(packed)
    total = reps.count()
    out = f"id {kind}, neighbour {kind}, similarity double, rank int"
    if not total:
        return spark.createDataFrame([], out)

    # The upper tree: fitted to a bounded sample, used to place every vector.
    share = min(1.0, 1.2 * fit_rows / total)
    sample = reps.select("b") if share >= 1 else reps.select("b").sample(share, seed=seed)
    sample = unpack(sample.limit(fit_rows).toPandas()["b"])
    n_shards = max(1, -(-total // shard_rows))
    top, _ = build(sample, max(1, -(-len(sample) // n_shards)), seed)

    def place(batches):
        for batch in batches:
            if len(batch):
                shard = descend(top, unpack(batch.column("b").to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int64())], [*batch.schema.names, "shard"])

    def plant(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """A shard as one row, with its tree."""
        pdf = pdf.sort_values("at", ignore_index=True)
        node, _ = build(unpack(pdf["b"]), leaf_rows)
        tree = node, pdf["b"].tolist(), pdf["at"].to_numpy(), [tuple(i) for i in pdf["ids"]]
        return pd.DataFrame({"shard": [key[0]], "tree": [pickle.dumps(tree)], "n": [len(pdf)]})

    placed = reps.mapInArrow(place, f"h binary, b binary, ids array<{kind}>, at bigint, shard bigint")
    trees = scratch.keep(placed.groupBy("shard").applyInPandas(plant, "shard bigint, tree binary, n bigint"), "trees", by="shard")
    scratch.drop(reps)
    folder, want = trees._tidemark_path, k + 1

    def visit(batches):
        for pdf in batches:
            for shard, part, parts in zip(pdf["shard"], pdf["part"], pdf["parts"]):
                yield found(int(shard), int(part), int(parts))

    def found(home: int, part: int, parts: int) -> pd.DataFrame:
        """The nearest of a shard's vectors in every ``parts``-th leaf: (h, their ids and similarities in order)."""
        node, packed, ranks, ids = _planted(folder, home)
        x, hashes = unpack(packed), [hashlib.md5(b).digest() for b in packed]
        own = list(leaves(node))[part::parts]
        asked = np.concatenate([n.rows for n in own]) if own else np.zeros(0, np.int64)
        q, best, seen, done = x[asked], Best(len(asked), want), 0, np.concatenate([np.full(len(n.rows), n.leaf) for n in own]) if own else np.zeros(0, np.int64)
        for n in own:
            best.add(np.arange(seen, seen := seen + len(n.rows)), x[n.rows] @ x[n.rows].T, ranks[n.rows])
        names: dict[int, tuple] = {}

        def note(ranks: np.ndarray, ids: list) -> None:
            held = np.unique(best.at)
            at = np.searchsorted(ranks, held)
            new = np.flatnonzero(ranks[np.minimum(at, len(ranks) - 1)] == held)
            live = {int(r): names[int(r)] for r in held if int(r) in names}
            names.clear()
            names.update(live)
            names.update((int(held[i]), ids[at[i]]) for i in new)

        search(node, x, ranks, q, np.arange(len(q)), radius(best.floor()), best, factor, done)
        note(ranks, ids)
        tau, far = radius(best.floor()), bounds(top, q)
        for shard in sorted(far, key=lambda s: far[s].mean() if len(q) else 0.0):
            now = tau if factor > 1 else radius(best.floor())
            rows = np.flatnonzero(far[shard] <= now / factor + 1e-9)
            if shard != home and shard in planted and len(rows):
                node, packed, ranks, ids = _planted(folder, shard)
                search(node, unpack(packed), ranks, q, rows, now, best, factor)
                note(ranks, ids)
        near = []
        for at, sim in zip(best.at.tolist(), best.sim.tolist()):
            each = [(s, i) for a, s in zip(at, sim) if a in names for i in names[a]]
            if len(each) > len(at) or any(len(names[a]) > 1 for a in at if a in names):
                each.sort(key=lambda e: (-e[0], e[1]))
            near.append([{"s": s, "n": i} for s, i in each[:want]])
        return pd.DataFrame({"h": [hashes[i] for i in asked], "near": near})

    sizes = {r["shard"]: r["n"] for r in trees.select("shard", "n").collect()}  # at most `fit_rows` shards
    planted = frozenset(sizes)
    parts = [(s, i, -(-n // block_rows)) for s, n in sorted(sizes.items()) for i in range(-(-n // block_rows))]
    tasks = spark.createDataFrame(spark.sparkContext.parallelize(parts, len(parts)), "shard bigint, part bigint, parts bigint")
    near = scratch.keep(tasks.mapInPandas(visit, f"h binary, near array<struct<s: double, n: {kind}>>"), "near")
    scratch.drop(trees)
    others = F.slice(F.filter("near", lambda e: e["n"] != F.col("id")), 1, k)
    mine = members.join(near, "h").select("id", F.posexplode(others).alias("rank", "e"))
    return mine.select("id", F.col("e.n").alias("neighbour"), F.col("e.s").alias("similarity"), (F.col("rank") + 1).alias("rank"))
