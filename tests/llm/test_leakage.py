import random

import pandas as pd
import pytest

from tidemark.llm.leakage import Automaton, Limits, Screen, find_leaks, leaks, leaks_of, longest_chain, without_leaks, words, words_at

RNG = random.Random(0)
VOCAB = [f"w{i}" for i in range(400)]
ITEMS = {i: " ".join(RNG.choice(VOCAB) for _ in range(60)) for i in range(8)}
NOISE = lambda n: " ".join(f"z{RNG.randrange(900)}" for _ in range(n))


def automaton():
    a = Automaton()
    for i, t in ITEMS.items():
        a.add(i, words(t))
    return a.finish()


def test_longest_matches_against_brute_force():
    a = automaton()
    rng = random.Random(5)
    text = []
    for _ in range(60):
        t = ITEMS[rng.randrange(8)].split()
        k = rng.randrange(50)
        text += t[k : k + rng.randrange(1, 12)] + ["zz"] * rng.randrange(2)
    ids = [a.vocabulary.get(w, -1) for w in text]
    grams = {tuple(t[i : i + n]) for t in (v.split() for v in ITEMS.values()) for n in range(1, 61) for i in range(61 - n)}
    longest = [max((n for n in range(0, min(e, 60) + 1) if tuple(text[e - n : e]) in grams or n == 0)) for e in range(len(text) + 1)]
    got = list(a.walk(ids))
    assert [n for _, n in got] == longest[1:]
    holds = lambda run: {i for i, v in ITEMS.items() if f" {' '.join(run)} " in f" {v} "}
    for e, (s, n) in enumerate(got, 1):
        if n >= 3:
            assert {i for i, _ in a.occurrences(s)} == holds(text[e - n : e])
    # Every run that text and item share and that cannot be made longer, by diagonals.
    want = set()
    for item, v in ITEMS.items():
        t = v.split()
        for d in range(-len(text), len(t)):
            n = 0
            for j in range(len(text) + 1):
                if j < len(text) and 0 <= j + d < len(t) and t[j + d] == text[j]:
                    n += 1
                    continue
                if n >= 3:
                    want.add((item, j + d - n, j - n, n))
                n = 0
    runs = list(a.runs(ids, 3))
    assert set(runs) == want and len(runs) == len(want)


def test_leaks_of_texts_full_of_repeats_against_brute_force():
    """Few different words, so that many runs lie over one another: the same leaks as chaining every common run."""
    rng, lim = random.Random(11), Limits(span=12, share=0.6)
    found = 0
    for _ in range(60):
        vocab = [f"v{i}" for i in range(rng.choice([4, 8, 30]))]
        passage = [rng.choice(vocab) for _ in range(rng.randrange(15, 50))]
        k = rng.randrange(len(passage) - 5)
        text = [rng.choice(vocab) for _ in range(rng.randrange(60))] + passage[k : k + rng.randrange(4, 30)] + [rng.choice(vocab) for _ in range(rng.randrange(60))]
        a = Automaton()
        a.add(1, passage)
        a.finish()
        parts = [(i, j, n) for i in range(len(passage)) for j in range(len(text)) if not (i and j and passage[i - 1] == text[j - 1]) for n in [next((x for x in range(min(len(passage) - i, len(text) - j)) if passage[i + x] != text[j + x]), min(len(passage) - i, len(text) - j))] if n >= 3]
        best = longest_chain(parts, lim)
        got = list(leaks_of([a.vocabulary.get(w, -1) for w in text], a, lim))
        assert [x[1:3] for x in got] == ([best[:2]] if best[0] >= 12 else [])
        found += bool(got)
    assert 10 < found < 60


def test_nested_and_overlapping_items(spark):
    w = [f"u{i}" for i in range(120)]
    held = {1: w[:60], 2: w[20:100], 3: w[30:56], 4: [*w[40:70], *w[:10]]}
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in held.items()], "item_id int, passage string")
    texts = {"b alone": w[20:100], "end of a": w[30:100], "inner": w[25:62], "tail": w[38:75]}
    df = spark.createDataFrame([(k, " ".join(["x", *t, "y"])) for k, t in texts.items()], "doc_id string, text string")

    def common(a, b):
        return max(n for i in range(len(a)) for j in range(len(b)) for n in [next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))])

    want = {(k, i) for k, t in texts.items() for i, v in held.items() if common(t, v) >= 25}
    assert {(r["doc_id"], r["item_id"]) for r in leaks(df, items).collect()} == want


def test_chains_take_time_in_proportion():
    """Twice the text takes about twice the steps: chains out of the window are dropped."""
    import time

    took = []
    for n in (20_000, 40_000, 80_000):
        parts = [((k * 7) % 50, 6 * k, 4) for k in range(n // 6)]
        began = time.process_time()
        longest_chain(parts, Limits())
        took.append(time.process_time() - began)
    assert took[2] < took[0] * 4 * 2 + 0.2


def cases():
    t = ITEMS[2].split()
    changed = [w if i % 9 else "CHANGED" for i, w in enumerate(t)]
    dropped = [w for i, w in enumerate(t) if i % 10 != 5]
    return {
        "whole": ITEMS[2],
        "inside": f"{NOISE(300)} {' '.join(t[10:40])} {NOISE(100)}",
        "upper": ITEMS[2].upper().replace(" ", ", "),
        "marked": "<p>" + " ".join(f"<b>{w}</b>" if i % 7 == 0 else w for i, w in enumerate(t)) + "</p>",
        "wrapped": "\n> ".join(" ".join(t[i : i + 5]) for i in range(0, 60, 5)),
        "changed": " ".join(changed),
        "dropped": " ".join(dropped),
        "every fifth": " ".join(w if i % 5 else "CHANGED" for i, w in enumerate(t)),
        "long tag": " ".join(t[:15]) + " <a title='" + NOISE(80) + "'> " + " ".join(t[15:]),
        "line between": " ".join(t[:14]) + f"\n{NOISE(9)}\n" + " ".join(t[14:28]),
        "quotation": f"{NOISE(50)} {' '.join(t[5:19])} {NOISE(50)}",
        "shuffled": " ".join(sum((t[i : i + 6] for i in (48, 0, 24, 12, 36, 6, 30, 18, 42, 54)), [])),
        "nothing": NOISE(200),
        "empty": "",
        "long": NOISE(200_000) + " " + ITEMS[2],
    }


def test_found_and_not_found(spark):
    texts = cases()
    df = spark.createDataFrame([*[(k, v, 1) for k, v in texts.items()], ("null", None, 1)], "doc_id string, text string, item_id int")
    items = spark.createDataFrame([*[(k, v) for k, v in ITEMS.items()], (2, ITEMS[2]), (90, None), (91, ""), (92, "too short")], "item_id int, passage string")
    want = {(k, 2) for k in texts if k not in ("quotation", "shuffled", "nothing", "empty")}
    assert {(r["doc_id"], r["item_id"]) for r in leaks(df, items).collect()} == want
    assert {(r["doc_id"], r["item_id"]) for r in leaks(df, items, max_words=130).collect()} == want  # several automata
    assert leaks(df.limit(0), items).count() == 0 and leaks(df, items.limit(0)).count() == 0


def test_equal_passages_leak_together_and_tags_do_not_cross_texts():
    a = Automaton()
    for i in (1, 2):
        a.add(i, words(ITEMS[3]))
    a.finish()
    pdf = pd.DataFrame({"id": [1, 2, 3], "text": ["a < b", ITEMS[3], "c > d"]})
    assert {(r.id, r.item) for r in find_leaks(pdf, a, Screen([a], Limits()), Limits()).itertuples()} == {(2, 1), (2, 2)}


def test_spans_are_removed(spark):
    t = ITEMS[2].split()
    before, after = NOISE(40), NOISE(50)
    texts = {
        "inside": f"{before}. <b>{' '.join(t[10:40])}</b>, {after}",
        "twice": f"{before} {' '.join(t[:30])} {before} {ITEMS[3]} {after} {after}",
        "whole": ITEMS[2],
        "none": before,
    }
    df = spark.createDataFrame([*texts.items(), ("null", None)], "doc_id string, text string")
    items = spark.createDataFrame(list(ITEMS.items()), "item_id int, passage string")
    for most in (250_000, 130):
        got = {r["doc_id"]: r for r in without_leaks(df, items, max_words=most).collect()}
        assert set(got) == {"inside", "twice", "whole"}
        assert words(got["inside"]["text"]) == words(f"{before} {after}") and got["inside"]["removed_words"] == 30 and not got["inside"]["dropped"]
        assert words(got["twice"]["text"]) == words(f"{before} {before} {after} {after}") and len(got["twice"]["spans"]) == 2
        assert got["whole"]["dropped"] and got["whole"]["text"] is None
    kept = {r["doc_id"]: r for r in without_leaks(df, items, limits=Limits(coverage=1.0)).collect()}
    assert kept["whole"]["text"] == "" and not kept["whole"]["dropped"]
    clean = spark.createDataFrame([(k, r["text"]) for k, r in got.items() if r["text"]], "doc_id string, text string")
    assert leaks(clean, items).count() == 0


@pytest.mark.parametrize("text", ["The sexton's “Barrow”", "re-\nused <b>ink</b>&nbsp;pot", "x_y 5 < 6", "İstanbul ÉTÉ ß", "", "soft\u00adhyphen don’t <a href='x'>"])
def test_positions_of_words(text):
    said, begin, end = words_at(text)
    assert said == words(text)
    assert all(words(text[a:b]) == [w] for w, a, b in zip(said, begin, end))


@pytest.mark.parametrize("raw,want", [("The sexton's “Barrow”", "the sextons barrow"), ("re-\nused <b>ink</b>&nbsp;pot", "reused ink pot"), ("x_y 5 < 6", "x y 5 6")])
def test_words(raw, want):
    assert " ".join(words(raw)) == want
