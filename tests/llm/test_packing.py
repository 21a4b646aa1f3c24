import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm.packing import _Sizes, best_fit, dominating, fill_containers, pack_histogram, reduce_histogram, token_count


@pytest.mark.parametrize("seed", range(8))
def test_histogram(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 100), rng.randint(1, 30), 34, 51]) for _ in range(rng.randint(1, 400)))
    patterns, fixed = pack_histogram(counts, 100)
    held = Counter()
    for sizes, times in patterns:
        assert sum(sizes) <= 100 and times >= 1
        for s in sizes:
            held[s] += times
    bound = -(-sum(s * n for s, n in counts.items()) // 100)
    big = sum(n for s, n in counts.items() if s > 50)
    assert held == counts and sum(t for _, t in patterns) <= max(bound, big) * 1.15 + 2 and fixed >= 0


def test_dominance_takes_exact_pairs():
    assert pack_histogram({60: 3, 40: 3}, 100) == ([((60, 40), 3)], 3)
    assert pack_histogram({}, 100) == ([], 0)


def fewest(items, capacity):
    """The least number of containers, by dynamic programming over subsets."""
    best = {0: (0, capacity)}
    for mask in range(1, 1 << len(items)):
        options = []
        for i, s in enumerate(items):
            if mask >> i & 1:
                n, used = best[mask ^ (1 << i)]
                options.append((n, used + s) if used + s <= capacity else (n + 1, s))
        best[mask] = min(options)
    return best[(1 << len(items)) - 1][0]


def test_dominating_sets_keep_the_optimum():
    rng, seen = random.Random(5), Counter()
    for _ in range(1500):
        lo, hi = rng.choice([(20, 60), (25, 50), (15, 45), (28, 36), (1, 99)])
        items = sorted(rng.randint(lo, hi) for _ in range(rng.randint(3, 8)))
        best = fewest(items, 100)
        for w in set(items):
            beside = dominating(_Sizes(Counter(items)), w, 100)
            if beside is not None:
                rest = Counter(items) - Counter((w, *beside))
                assert w + sum(beside) <= 100 and sum(rest.values()) == len(items) - 1 - len(beside)
                assert 1 + fewest(list(rest.elements()), 100) == best, (items, w, beside)
                seen[len(beside)] += 1
        sizes = _Sizes(Counter(items))
        fixed = reduce_histogram(sizes, 100)
        left = [s for s, n in sizes.count.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (fewest(left, 100) if left else 0) == best
    assert min(seen[k] for k in (0, 1, 2)) > 50


def test_a_pair_with_the_largest_item_need_not_dominate():
    items = [21, 23, 26, 26, 27, 30, 32, 34, 35, 44]
    assert dominating(_Sizes(Counter(items)), 44, 100) is None and fewest(items, 100) == 3


def plain_best_fit(items, capacity):
    rooms = []
    for s in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


def test_best_fit_equals_one_by_one():
    rng = random.Random(9)
    for _ in range(300):
        items = [rng.randint(1, rng.choice([20, 60, 100])) for _ in range(rng.randint(1, 120))]
        fillings = best_fit(_Sizes(Counter(items)), 100)
        assert sorted(100 - sum(f) for f, n in fillings for _ in range(n)) == plain_best_fit(items, 100)


def test_tokens_are_counted_as_by_the_definition(spark):
    texts = ["a b-c, d...", "né 42 x_y ½ ²", "  ", "", None, "“q” — it’s", "tab\tnl\n\x1c!", "漢字 かな", "é ok"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(token_count(F.col("t"))).collect()]
    assert got == [len(re.findall(r"\w+|[^\w\s]+", t)) if t else 0 for t in texts]


def check(spark, sizes, capacity=100, **kw):
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)], "doc_id bigint, size int, container_id string")
    rows = fill_containers(df, capacity, **kw).collect()
    used, parts = Counter(), {}
    for r in rows:
        used[r["container_id"]] += r["size"]
        parts.setdefault(r["doc_id"], []).append((r["piece"], r["first"], r["size"]))
    assert all(u <= capacity for u in used.values())
    assert set(parts) == set(range(len(sizes)))
    for i, s in enumerate(sizes):
        s, p = max(s or 0, 0), sorted(parts[i])
        assert sum(n for *_, n in p) == s and [k for k, *_ in p] == list(range(len(p)))
        assert [f for _, f, _ in p] == [k * capacity for k in range(len(p))]
        assert len(p) == 1 if s <= capacity else all(n == capacity for *_, n in p[:-1])
    return used


def test_items_and_pieces(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 130) for _ in range(500)] + [250, 1000, 100, 200, None, 0, -5] + [40] * 300
    used = check(spark, sizes, block_rows=50)
    total = sum(max(s or 0, 0) for s in sizes)
    assert sum(u > 0 for u in used.values()) <= -(-total // 100) * 1.06 + 1
    assert set(used) == set(range(len(used)))


def test_edges(spark):
    assert fill_containers(spark.createDataFrame([], "doc_id bigint, size int"), 10).count() == 0
    check(spark, [0, None])
    check(spark, [100, 200, 300])
    check(spark, [7] * 2000, block_rows=100)
