import numpy as np
import pytest

from tidemark.llm.vptree import build, descend, nearest_vectors


def brute(ids, x, k):
    ok = {}
    for i, v in zip(ids, x):
        if i is not None and v is not None and len(v) == 8 and not any(e is None or np.isnan(e) for e in v) and any(v) and i not in ok:
            ok[i] = np.array(v, float) / np.linalg.norm(v)
    names = sorted(ok)
    m = np.array([ok[n] for n in names])
    s = np.round(m @ m.T, 9)
    return {(n, names[j]) for i, n in enumerate(names) for j in sorted((j for j in range(len(names)) if j != i), key=lambda j: (-s[i, j], names[j]))[:k]}


def data(seed=0, n=600):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    x = [(centres[i % 12] + 0.5 * rng.normal(size=8)).round(3).tolist() for i in range(n)]
    x[5:20] = [x[5]] * 15  # exact copies, more than k
    x[21] = [2 * e for e in x[22]]
    return [f"v{i:04d}" for i in range(n)], x


def run(spark, ids, x, **kw):
    df = spark.createDataFrame([(i, v, "c") for i, v in zip(ids, x)], "id string, vec array<double>, similarity string")
    out = nearest_vectors(df, k=5, width=8, **kw).collect()
    return {(r["id"], r["neighbour"]) for r in out}, out


@pytest.mark.parametrize("shard_rows,leaf_rows", [(100_000, 64), (120, 16)])
def test_exact_with_factor_one(spark, shard_rows, leaf_rows):
    ids, x = data()
    got, _ = run(spark, ids, x, shard_rows=shard_rows, leaf_rows=leaf_rows)
    assert got == brute(ids, x, 5)


def test_relaxed_keeps_most(spark):
    ids, x = data(1)
    got, _ = run(spark, ids, x, shard_rows=120, leaf_rows=16, factor=1.5)
    want = brute(ids, x, 5)
    assert len(got & want) / len(want) >= 0.9


def test_odd_rows(spark):
    ids, x = data(2, 30)
    ids += [None, "n1", "n2", "n3", "n4", "v0003"]
    x += [[1.0] * 8, None, [0.0] * 8, [1.0] * 5, [None] * 8, x[3]]
    got, out = run(spark, ids, x)
    assert got == brute(ids, x, 5)
    assert all(1 <= r["rank"] <= 5 for r in out)


def test_few_or_none(spark):
    assert run(spark, [], [])[0] == set()
    assert run(spark, ["a"], [[1.0] * 8])[0] == set()
    assert run(spark, ["a", "b"], [[1.0] * 8, [1.0] * 8])[0] == {("a", "b"), ("b", "a")}


def test_tree_places_every_row():
    x = np.random.default_rng(3).normal(size=(500, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    node, leaves = build(x, 40)
    at = descend(node, x)
    assert len(set(at)) == leaves and len(at) == 500
    same = np.ones((100, 4)) / 2
    assert build(same, 10)[1] == 1  # nothing to split by


def test_vectors_are_kept_a_few_times_whatever_the_shards(spark, monkeypatch):
    import os

    from tidemark.llm import vptree

    class Counting(vptree.Scratch):
        written = 0

        def keep(self, *args, **kw):
            df = super().keep(*args, **kw)
            Counting.written += sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(df._tidemark_path.removeprefix("file://")) for f in files)
            return df

    monkeypatch.setattr(vptree, "Scratch", Counting)
    x = np.random.default_rng(5).normal(size=(3000, 64)).round(4)
    df = spark.createDataFrame([(f"v{i:05d}", r) for i, r in enumerate(x.tolist())], "id string, vec array<double>")
    got = {(r["id"], r["neighbour"]) for r in vptree.nearest_vectors(df, k=5, width=64, shard_rows=400, leaf_rows=64).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    np.fill_diagonal(s, -2)
    assert got == {(f"v{i:05d}", f"v{j:05d}") for i in range(3000) for j in np.argsort(-s[i], kind="stable")[:5]}
    assert Counting.written < 2 * x.nbytes


def test_packed_vectors_keep_their_direction():
    from tidemark.llm.vptree import pack, unpack

    rng = np.random.default_rng(6)
    rows = [rng.normal(size=16).round(4), rng.normal(size=16).round(7), rng.normal(size=16).astype(np.float32).astype(float), rng.normal(size=16), rng.normal(size=16) * 1e300, np.eye(16)[3] * 5e-324]
    x = np.array(rows)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    want = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    packed = pack(x)
    assert [b[:1] for b in packed[:4]] == [b"h", b"i", b"f", b"d"]
    assert np.abs(unpack(packed) - want).max() < 1e-15
    assert pack(x[:1] * 2) == packed[:1]  # copies of one direction are one row
