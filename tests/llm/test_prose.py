import numpy as np
import pytest

from tests.llm.checked_documents import JUNK_IDS, PROSE_IDS
from tidemark.llm.prose import FEATURES, BoostedTrees, document_statistics, junk_probability, statistics, train, weak_labels
from tidemark.llm.prose_holdout import JUNK, PROSE


def by_name(text):
    return dict(zip(FEATURES, statistics([text])[0]))


def test_statistics():
    f = by_name("The cat sat.\nIt is 42 %!")
    assert f["n_words"] == 5 and f["mean_word_length"] == pytest.approx(13 / 5)
    assert f["digit_ratio"] == pytest.approx(2 / 18) and f["symbol_ratio"] == pytest.approx(1 / 18)
    assert f["common_share"] == pytest.approx(3 / 5) and f["stop_line_share"] == pytest.approx(1.0)


def test_batches_do_not_matter():
    texts = [*PROSE, "", None, *JUNK, "é" * 50, "\n\n\n"]
    whole = statistics(texts)
    assert np.allclose(whole, np.vstack([statistics([t]) for t in texts])) and np.allclose(whole, statistics(texts, chunk=10))
    assert statistics([]).shape == (0, len(FEATURES))


def test_trees_generalise_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    m = BoostedTrees().fit(x[:1000], y[:1000]).calibrate(x[1000:1200], y[1000:1200])
    p = m.probability(x[1200:])
    assert ((p > 0.5) == y[1200:]).mean() > 0.93
    assert abs(p.mean() - y[1200:].mean()) < 0.05


def test_weak_labels_agree_with_hand_checked_ones():
    y = weak_labels(statistics(list(PROSE + JUNK)))
    truth = np.array([0] * len(PROSE) + [1] * len(JUNK))
    said = y >= 0
    assert said.mean() > 0.7 and (y[said] == truth[said]).mean() > 0.95


def assess(p, truth):
    """Accuracy, Brier score and expected calibration error over five bins."""
    bins = np.minimum((p * 5).astype(int), 4)
    off = sum(abs(p[bins == b].sum() - truth[bins == b].sum()) for b in range(5)) / len(p)
    return ((p >= 0.5) == truth).mean(), ((p - truth) ** 2).mean(), off


def test_held_out_accuracy_and_calibration(spark):
    """Fitted to weak labels without the checked documents, calibrated on the texts of prose_holdout or on one half of
    the checked documents, judged on documents neither step has seen."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    ids = [*PROSE_IDS, *JUNK_IDS]
    truth = np.array([0] * len(PROSE_IDS) + [1] * len(JUNK_IDS))
    text = {r["doc_id"]: r["text"] for r in docs.filter(docs.doc_id.isin(ids)).collect()}
    rest, x = docs.filter(~docs.doc_id.isin(ids)), statistics([text[i] for i in ids])
    accuracy, brier, off = assess(train(rest).probability(x), truth)
    print(f"all {len(ids)}: accuracy {accuracy:.3f}, Brier {brier:.4f}, calibration error {off:.4f}")
    assert accuracy >= 0.97 and brier < 0.03 and off < 0.06
    half = np.arange(len(ids)) % 2 == 0
    model = train(rest, checked=([text[i] for i, h in zip(ids, half) if h], truth[half]))
    accuracy, brier, off = assess(model.probability(x[~half]), truth[~half])
    print(f"other half: accuracy {accuracy:.3f}, Brier {brier:.4f}, calibration error {off:.4f}")
    assert accuracy >= 0.97 and brier < 0.03 and off < 0.06


def test_a_table_of_one_kind_only(spark):
    """Half of the checked texts stand in for the other kind; those left out of the fit are judged right."""
    one = spark.createDataFrame([(i, t) for i, t in enumerate(PROSE * 3)], "doc_id bigint, text string")
    p = train(one).probability(statistics(list(PROSE + JUNK)[1::2]))
    assert ((p >= 0.5) == (np.arange(1, 32, 2) >= len(PROSE))).mean() >= 0.8


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (None, PROSE[0], "x"), (5, JUNK[0], "x"), (5, JUNK[0], "x"), (6, "word " * 300_000, "x")], "doc_id bigint, text string, junk string")
    got = junk_probability(df).collect()
    assert len(got) == 7 and all(r["junk"] is None for r in got if r["doc_id"] in (1, 2, 3))
    assert all(r["junk"] > 0.5 for r in got if r["doc_id"] == 5)
    assert junk_probability(df.limit(0)).count() == 0 and document_statistics(df.limit(0)).count() == 0
