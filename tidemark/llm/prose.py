"""Per-document text statistics, and boosted trees over them that tell prose from lists, tables and junk."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.prose_holdout import JUNK, PROSE

#: Common short words of six languages, as they occur in running text (fixed values).
COMMON = (
    "the of and to in a is was that for on it with as his he be at by had not are but from or have an they which one you were her all she there would "
    "their we him been has when who will no more if out so said what up its about into than them can only other new some could these two may then do first "
    "any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just "
    "those people mr how too little state good very make world still own see men work long get here between both life being under never day same another know while last "
    "de la que el en y los se del las un por con no una su para es al lo como mas pero sus le ya o fue este ha si porque esta son entre cuando muy sin sobre ser tiene "
    "le les des et une du dans qui est pour pas au sur ne se plus ce par avec sont mais ont il elle ses aux nous vous cette "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem "
    "di che il per non si da sono gli dei della delle nel alla ma anche "
    "do da em um os uma dos na mais foi ao ele das seu sua ou quando "
    "het een van dat niet zijn op te voor met er maar om hem dan zou wat mijn dit zo door over"
)
COMMON_WORDS = frozenset(COMMON.split())

#: Classes of bytes: everything above ASCII counts as a small letter (of a word in any script).
LOWER, UPPER, DIGIT, SPACE, NEWLINE, STOP, COMMA, QUOTE, SYMBOL = range(9)
_TABLE = np.full(256, SYMBOL, np.uint8)
_TABLE[128:] = LOWER
for _chars, _class in (("abcdefghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), ("0123456789", DIGIT), (" \t\r\v\f", SPACE), ("\n", NEWLINE), (".!?", STOP), (",;:-", COMMA), ("'\"()`<>", QUOTE)):
    for _c in _chars:
        _TABLE[ord(_c)] = _class
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32

_WIDE = 7


def _code(word: bytes) -> int:
    return sum(b << (8 * i) for i, b in enumerate(word))


_CODES = np.array(sorted(_code(w.encode()) for w in COMMON_WORDS if len(w) <= _WIDE), np.uint64)

FEATURES = (
    "n_words", "mean_word_length", "symbol_ratio", "digit_ratio", "upper_ratio", "space_ratio", "common_share", "stop_line_share", "short_line_share",
    "words_per_line", "prose_share", "common_lines", "stops_per_word", "capital_words", "single_letters", "long_words", "line_spread", "lower_starts", "digit_lines", "comma_ratio",
)


def statistics(texts: list[str], chunk: int = 2_000_000) -> np.ndarray:
    """One row of FEATURES per text (see ``_statistics``), worked out for about ``chunk`` characters at a time."""
    parts, begin, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chunk or i + 1 == len(texts):
            parts.append(_statistics(texts[begin : i + 1]))
            begin, size = i + 1, 0
    return np.vstack(parts) if parts else np.zeros((0, len(FEATURES)))


def _statistics(texts: list[str]) -> np.ndarray:
    """One row of FEATURES per text, computed over the bytes of the whole batch at once.

    n_words: runs of letters. mean_word_length: letters per word. *_ratio: share of the non-blank characters.
    common_share: words that are common ones. stop_line_share: lines that end in sentence punctuation, weighted by
    their words. prose_share: share of the words that stand in blocks of prose, that is, lines or paragraphs with
    common words, few digits and few symbols. The others describe lines and words in the same way.
    """
    n_docs = len(texts)
    raw = ["\n" + (t or "") + "\n\n" for t in texts]
    data = [r.encode("utf-8", "replace") for r in raw]
    sizes = np.array([len(b) for b in data], np.int64)
    buf = np.frombuffer(b"".join(data), np.uint8)
    cls = _TABLE[buf]
    doc_start = np.concatenate([[0], np.cumsum(sizes)[:-1]])

    newline = np.nonzero(cls == NEWLINE)[0]
    # Lines run from newline to newline; each document begins and ends with one.
    begin, end = newline[:-1] + 1, newline[1:]
    keep = end > begin
    begin, end = begin[keep], end[keep]

    def spread(flag: np.ndarray) -> np.ndarray:
        """Running count, so that the count of any stretch is a difference."""
        out = np.zeros(len(flag) + 1, np.int32)
        np.cumsum(flag, out=out[1:])
        return out

    letter = cls <= UPPER
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    word_at = np.nonzero(starts)[0]
    ends = letter.copy()
    ends[:-1] &= ~letter[1:]
    word_end = np.nonzero(ends)[0] + 1
    length = word_end - word_at
    codes = np.zeros(len(word_at), np.uint64)
    for i in range(_WIDE):
        has = length > i
        codes[has] |= _FOLD[buf[word_at[has] + i]] << np.uint64(8 * i)
    slot = np.minimum(np.searchsorted(_CODES, codes), len(_CODES) - 1)
    common = (_CODES[slot] == codes) & (length <= _WIDE)

    counts = {k: spread(cls == c) for k, c in (("digit", DIGIT), ("symbol", SYMBOL), ("stop", STOP), ("upper", UPPER), ("comma", COMMA))}
    ink, letters = spread((cls != SPACE) & (cls != NEWLINE)), spread(letter)
    word_no = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)]).astype(np.int32)
    common_no = spread(common)
    capital = (cls[word_at] == UPPER) if len(word_at) else np.zeros(0, bool)
    capital_no, single_no, long_no = spread(capital), spread(length == 1), spread(length > 12)

    def of(name_or_run, a, b):
        run = counts[name_or_run] if isinstance(name_or_run, str) else name_or_run
        return (run[b] - run[a]).astype(np.float64)

    def words_in(a, b, run=None):
        if run is None:
            return (word_no[b] - word_no[a]).astype(np.float64)
        return (run[word_no[b]] - run[word_no[a]]).astype(np.float64)

    # Lines.
    l_doc = np.searchsorted(doc_start, begin, side="right") - 1
    l_ink, l_words, l_common = of(ink, begin, end), words_in(begin, end), words_in(begin, end, common_no)
    l_digit, l_symbol, l_letters = of("digit", begin, end), of("symbol", begin, end), of(letters, begin, end)
    full = l_ink > 0
    # Where a line's ink ends: a quote or bracket may follow the stop.
    tail = np.maximum(end - 3, begin)
    ends_stop = of("stop", tail, end) > 0
    first = cls[np.minimum(begin, len(cls) - 1)]
    # Paragraphs: lines between blank ones; a list is one too, so its lines' length and words decide.
    gap = np.ones(len(begin), bool)
    gap[1:] = (begin[1:] - end[:-1] > 1) | (l_doc[1:] != l_doc[:-1]) | ~full[:-1]
    par = np.cumsum(gap) - 1
    n_par = int(par[-1]) + 1 if len(par) else 0
    total = lambda x, by, n: np.bincount(by, weights=x, minlength=n)
    p_words, p_common, p_ink = total(l_words, par, n_par), total(l_common, par, n_par), total(l_ink, par, n_par)
    p_lines, p_digit, p_symbol = total(full.astype(float), par, n_par), total(l_digit, par, n_par), total(l_symbol, par, n_par)
    p_stops = total(of("stop", begin, end), par, n_par)
    div = lambda a, b: a / np.maximum(b, 1.0)
    p_prose = (p_words >= 5) & (div(p_common, p_words) >= 0.15) & (div(p_digit, p_ink) < 0.15) & (div(p_symbol, p_ink) < 0.08) & (div(p_words, p_lines) >= 4) & (p_stops * 60 >= p_words)
    l_prose = (l_words >= 5) & (div(l_common, l_words) >= 0.12) & (div(l_digit, l_ink) < 0.2) & (div(l_symbol, l_ink) < 0.08)
    in_prose = l_prose & p_prose[par] if n_par else l_prose

    # Documents.
    a, b = doc_start, doc_start + sizes
    d_ink, d_words = of(ink, a, b), words_in(a, b)
    by_doc = lambda x: np.bincount(l_doc, weights=x, minlength=n_docs)
    lines = by_doc(full.astype(float))
    per_line = div(d_words, lines)
    sq = by_doc(np.where(full, l_ink, 0) ** 2)
    mean_ink = div(d_ink, lines)
    out = np.column_stack([
        d_words, div(of(letters, a, b), d_words), div(of("symbol", a, b), d_ink), div(of("digit", a, b), d_ink), div(of("upper", a, b), of(letters, a, b)),
        1 - d_ink / np.maximum(sizes - 3, 1), div(words_in(a, b, common_no), d_words), div(by_doc(l_words * ends_stop), d_words), div(by_doc(full * (l_words < 4.0)), lines),
        per_line, div(by_doc(l_ink * in_prose), d_ink), div(by_doc(full * (l_common > 0)), lines), div(of("stop", a, b), d_words), div(words_in(a, b, capital_no), d_words),
        div(words_in(a, b, single_no), d_words), div(words_in(a, b, long_no), d_words), np.sqrt(np.maximum(div(sq, lines) - mean_ink**2, 0)) / np.maximum(mean_ink, 1),
        div(by_doc(full * (first == LOWER)), lines), div(by_doc(full * (l_digit > 0)), lines), div(of("comma", a, b), d_ink),
    ])
    out[:, 5] = np.clip(out[:, 5], 0, 1)
    return out


def weak_labels(x: np.ndarray) -> np.ndarray:
    """1 = junk, 0 = prose, -1 = no opinion: several plain rules that must agree."""
    f = {n: x[:, i] for i, n in enumerate(FEATURES)}
    votes = np.column_stack([f["prose_share"] < 0.25, f["common_share"] < 0.12, (f["symbol_ratio"] > 0.08) | (f["digit_ratio"] > 0.2), f["stop_line_share"] < 0.2])
    prose = (f["prose_share"] > 0.6) & (f["common_share"] > 0.15) & (f["symbol_ratio"] < 0.05) & (f["digit_ratio"] < 0.15)
    junk = votes[:, 0] & (votes[:, 1:].sum(axis=1) >= 1)
    return np.where(prose & ~junk, 0, np.where(junk & ~prose, 1, -1))


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


class BoostedTrees:
    """Gradient boosting on the logistic loss with trees over binned features; small data, fixed seed."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 4.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.a, self.b = 1.0, 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)])
        w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        score, self.forest = np.zeros(len(y)), []
        for _ in range(self.trees):
            p = _sigmoid(score)
            g, h = w * (y - p), w * p * (1 - p)
            tree: list = []
            self._grow(tree, binned, g, h, np.arange(len(y)), 0)
            self.forest.append(tree)
            score += self.rate * self._tree(tree, binned)
        return self

    def _grow(self, tree: list, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> int:
        me, gain, split = len(tree), 1e-6, None
        big_g, big_h = g[rows].sum(), h[rows].sum()
        tree.append([-1, 0, 0, 0, float(big_g / (big_h + 1.0))])
        if depth < self.depth:
            for j in range(x.shape[1]):
                n = len(self.cuts[j]) + 1
                gl = np.cumsum(np.bincount(x[rows, j], weights=g[rows], minlength=n))[:-1]
                hl = np.cumsum(np.bincount(x[rows, j], weights=h[rows], minlength=n))[:-1]
                score = gl**2 / (hl + 1) + (big_g - gl) ** 2 / (big_h - hl + 1) - big_g**2 / (big_h + 1)
                score[(hl < self.least * 0.05) | (big_h - hl < self.least * 0.05)] = -1
                if len(score) and score.max() > gain:
                    gain, split = score.max(), (j, int(score.argmax()))
        if split:
            left = x[rows, split[0]] <= split[1]
            tree[me][:2] = split
            tree[me][2] = self._grow(tree, x, g, h, rows[left], depth + 1)
            tree[me][3] = self._grow(tree, x, g, h, rows[~left], depth + 1)
        return me

    @staticmethod
    def _tree(tree: list, x: np.ndarray) -> np.ndarray:
        t = np.array(tree)
        at = np.zeros(len(x), np.int64)
        for _ in range(12):
            inner = t[at, 0] >= 0
            if not inner.any():
                break
            r = np.nonzero(inner)[0]
            node = t[at[r]]
            at[r] = np.where(x[r, node[:, 0].astype(int)] <= node[:, 1], node[:, 2], node[:, 3]).astype(int)
        return t[at, 4]

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)])
        return self.rate * sum(self._tree(t, binned) for t in self.forest)

    def calibrate(self, x: np.ndarray, y: np.ndarray, rounds: int = 200, pull: float = 1.0) -> BoostedTrees:
        """Platt scaling with a mild pull towards the raw score, by Newton steps."""
        s = self.raw(x)
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(rounds):
            p = _sigmoid(a * s + b)
            r, h = p - target, p * (1 - p)
            grad = np.array([(r * s).sum() + pull * (a - 1), r.sum() + pull * b])
            hess = np.array([[(h * s * s).sum() + pull, (h * s).sum()], [(h * s).sum(), h.sum() + pull]])
            step = np.clip(np.linalg.solve(hess, grad), -0.25, 0.25)
            a, b = np.clip(a - step[0], 0.1, 4.0), b - step[1]
            if np.abs(step).max() < 1e-9:
                break
        self.a, self.b = float(a), float(b)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.a * self.raw(x) + self.b)


def document_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, FEATURES...) of every document; null and empty texts have zeros everywhere."""
    kind = documents.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                stats = pd.DataFrame(statistics(pdf["text"].tolist()), columns=list(FEATURES))
                stats.insert(0, id_col, pdf["id"].to_numpy())
                yield stats

    slim = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return slim.mapInPandas(scan, f"{id_col} {kind}, " + ", ".join(f"{n} double" for n in FEATURES))


def train(documents: DataFrame, text_col: str = "text", fit_rows: int = 4000, seed: int = 11, checked: tuple[Sequence[str], Sequence[int]] | None = None) -> BoostedTrees:
    """Trees fitted to at most ``fit_rows`` weakly labelled documents and calibrated on a hand-checked holdout: texts and
    labels (1 = junk) the fit does not see.

    ``checked`` defaults to the texts of ``prose_holdout``; documents checked by hand must be left out of ``documents``.
    The sample is random over the whole table. Where it shows one kind only, every second checked text stands in
    for the other kind in the fit and only the rest calibrate."""
    total = documents.count()
    share = min(1.0, 1.2 * fit_rows / max(1, total))
    texts = documents.select(F.col(f"`{text_col}`").alias("text"), F.lit(0).alias("id"))
    picked = texts if share >= 1 else texts.sample(share, seed=seed)
    x = document_statistics(picked, "id").limit(fit_rows).toPandas()[list(FEATURES)].to_numpy(np.float64)
    checked_texts, labels = checked or (PROSE + JUNK, [0] * len(PROSE) + [1] * len(JUNK))
    held, truth = statistics(list(checked_texts)), np.asarray(labels)
    y = weak_labels(x) if len(x) else np.zeros(0)
    x, y = x[y >= 0], y[y >= 0]
    if len(np.unique(y)) < 2:
        x, y = np.vstack([x, held[::2]]), np.concatenate([y, truth[::2]])
        held, truth = held[1::2], truth[1::2]
    return BoostedTrees().fit(x, y).calibrate(held, truth)


def junk_probability(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: BoostedTrees | None = None) -> DataFrame:
    """(id_col, FEATURES..., junk): the calibrated probability that most of a text is not sentences of natural language.

    Every document is scored, whole, in one pass without a shuffle; only the fit uses a bounded sample (see train).
    Defined cases: null, empty and blank texts hold no sentences and get probability null; ids may be null or
    repeated, each row is scored; an empty table gives no rows; other columns are ignored.
    """
    model = model or train(documents, text_col)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a few hundred tree nodes
    kind = documents.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = statistics(pdf["text"].tolist())
                stats = pd.DataFrame(x, columns=list(FEATURES))
                stats.insert(0, id_col, pdf["id"].to_numpy())
                p = shared.value.probability(x)
                p[x[:, FEATURES.index("space_ratio")] >= 1] = np.nan
                yield stats.assign(junk=p)

    slim = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    scored = slim.mapInPandas(scan, f"{id_col} {kind}, " + ", ".join(f"{n} double" for n in FEATURES) + ", junk double")
    return scored.withColumn("junk", F.nanvl("junk", F.lit(None).cast("double")))
