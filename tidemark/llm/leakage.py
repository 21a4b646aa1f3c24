"""Evaluation texts leaking into training text: a suffix automaton of the test items, streamed over by the corpus."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import Scratch

MARKUP = re.compile(r"</?[a-z][^<>ꙮ]*>|&#?\w{1,8};|­|-\n\s*(?=[a-z])")
APOSTROPHE = re.compile(r"(?<=\w)['’‘`´ʼ](?=\w)")
WORD = re.compile(r"[^\W_]+")
#: A word no text holds, between the texts of a batch.
BOUNDARY = "ꙮꙮboundaryꙮꙮ"
MARKUP_SIGNS = re.compile(r"[<&­]|-\n")


def words(text: str) -> list[str]:
    """The words of a text in lower case, without mark-up, punctuation, quotes and line breaks."""
    text = text.lower()
    if MARKUP_SIGNS.search(text):
        text = MARKUP.sub(lambda m: "" if m[0][0] in "-­" else " ", text)
    return WORD.findall(APOSTROPHE.sub("", text))


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers. ends[s] lists the (item, position) pairs of which state s is
    the prefix state; the occurrences of a state are those of its subtree in the link tree."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    texts: dict[int, list[int]] = field(default_factory=dict)
    follow: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])
    children: list[list[int]] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    known: dict[int, set[tuple[int, int]]] = field(default_factory=dict)
    earlier: dict[int, set[tuple[int, int]]] = field(default_factory=dict)

    def add(self, item: int, text: list[str]) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text]
        self.texts[item] = ids
        last = 0
        for at, c in enumerate(ids):
            last = self._extend(last, c)
            self.ends[last].append((item, at + 1))

    def _new(self, length: int, follow: dict[int, int]) -> int:
        self.follow.append(follow)
        self.link.append(0)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.follow[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p != -1 and self.follow[p].get(c) == q:
            self.follow[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.follow[last].get(c)
        if q is not None:  # the prefix is known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._new(self.length[last] + 1, {}), last
        while p != -1 and c not in self.follow[p]:
            self.follow[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.follow[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def finish(self) -> Automaton:
        self.children = [[] for _ in self.link]
        for s in range(1, len(self.link)):
            self.children[self.link[s]].append(s)
        # Occurrences of each state: its own ends and those of its subtree; links lead to shorter states.
        self.count = [len(e) for e in self.ends]
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.count[self.link[s]] += self.count[s]
        return self

    def occurrences(self, state: int) -> set[tuple[int, int]]:
        """(item, end) wherever the words of a state stand; kept once asked for, as stock phrases are asked for often."""
        if state not in self.known:
            out, stack = set(), [state]
            while stack:
                s = stack.pop()
                out.update(self.ends[s])
                stack += self.children[s]
            self.known[state] = out
        return self.known[state]

    def one_before(self, state: int) -> set[tuple[int, int]]:
        """The occurrences of a state without its last word."""
        if state not in self.earlier:
            self.earlier[state] = {(i, e - 1) for i, e in self.occurrences(state)}
        return self.earlier[state]

    def walk(self, ids: list[int]):
        """(state, length) of the longest match that ends with each word."""
        s, n = 0, 0
        for c in ids:
            if c not in self.follow[s]:
                while s != -1 and c not in self.follow[s]:
                    s = self.link[s]
                if s == -1:
                    s, n = 0, 0
                    yield s, n
                    continue
                n = self.length[s]
            s, n = self.follow[s][c], n + 1
            yield s, n

    def runs(self, ids: list[int], least: int):
        """(item, passage start, text start, words) of every run of ``least`` words or more that text and item have in common and
        that cannot be made longer on either side, in order of its end in the text.

        A match and its shorter ends are looked at wherever the next word leaves occurrences behind; an occurrence is left
        behind once, with the longest match that holds it. So an item that ends in, or is contained in, a stretch that
        another item continues is seen too."""
        before, had = 0, 0
        for at, (c, (s, n)) in enumerate(zip(chain(ids, [-1]), chain(self.walk(ids), [(0, 0)]))):
            u, words_, told = before, had, set()
            while u > 0 and words_ >= least:
                after = self.follow[u].get(c)
                if after is None or self.count[after] < self.count[u]:
                    gone = self.occurrences(u) - told
                    if after is not None:
                        gone -= self.one_before(after)
                    for item, end in gone:
                        yield item, end - words_, at - words_, words_
                    told |= gone
                u = self.link[u]
                words_ = self.length[u]
            before, had = s, n


@dataclass(frozen=True)
class Limits:
    """What counts as a leak, in words. seed: shortest run that anchors a part. changed: words that may be changed,
    dropped or added between two parts. foreign: words a foreign line between two parts may have. span: successive
    words of the passage that must be there. share: of those, the part that must be literally there. coverage: share of
    a document's words beyond which the whole document goes when leaks are removed."""

    seed: int = 3
    changed: int = 3
    foreign: int = 24
    span: int = 25
    share: float = 0.6
    coverage: float = 0.5


def longest_chain(parts: list[tuple[int, int, int]], lim: Limits) -> tuple[int, int, int, int]:
    """(passage words spanned, of them literal, first and end text position) of the longest chain of common runs (passage start,
    text start, words) that advance in both with small gaps."""
    best = (0, 0, 0, 0)
    # Chains that can still go on: passage start, end, text start, end, literal. Parts come in order of the text, so a
    # chain that ends before the window is done with; the work is the parts times what one window holds.
    chains: list[tuple[int, int, int, int, int]] = []
    for i, j, n in sorted(parts, key=lambda p: (p[1], p[0])):
        top = (i, i + n, j, j + n, n)
        chains = [x for x in chains if x[3] >= j - lim.foreign - lim.changed]
        for a, b, c, d, m in reversed(chains):
            cut = max(0, b - i, d - j)  # overlapping ends belong to the earlier part
            if cut >= n or b > i + cut or d > j + cut:
                continue
            if i + cut - b <= lim.changed and j + cut - d <= lim.foreign and m + n - cut > top[4]:
                top = (a, i + n, c, j + n, m + n - cut)
        chains.append(top)
        a, b, c, d, m = top
        if m >= lim.share * (b - a) and (b - a, m) > best[:2]:
            best = (b - a, m, c, d)
    return best


class Screen:
    """The word groups (as many words as a run has at least) of several automata, each with its own vocabulary: which texts can
    hold a leak at all. A leak has a number of them in one stretch of the text, no farther apart than runs may be."""

    def __init__(self, automata: Sequence[Automaton], lim: Limits):
        self.parts, self.gap = [], lim.foreign + lim.seed
        for a in automata:
            n = max(len(a.vocabulary), 1)
            k = lim.seed if n**lim.seed < 2**62 else 2
            codes = {sum(w * n**x for x, w in enumerate(t[i : i + k])) for t in a.texts.values() for i in range(len(t) - k + 1)}
            least = max(1, int(lim.share * lim.span * (lim.seed - k + 1) / lim.seed))
            self.parts.append((a.vocabulary | {BOUNDARY: -2}, n, k, np.array(sorted(codes), np.int64), least))

    def look(self, texts: list[str]):
        """(automaton, text number, the text's word numbers) of each text that can hold a leak of an automaton. One pass of the
        tokeniser over the whole batch; BOUNDARY stands between the texts."""
        said = words(f" {BOUNDARY} ".join(texts))
        for which, (numbers, n, k, grams, least) in enumerate(self.parts):
            flat = np.fromiter(map(numbers.get, said, repeat(-1)), np.int64)
            cuts = np.concatenate([[-1], np.nonzero(flat == -2)[0], [len(flat)]])
            size = max(len(flat) - k + 1, 0)
            known = flat >= 0
            at = np.nonzero(np.logical_and.reduce([known[x : x + size] for x in range(k)]))[0]
            at = at[np.isin(sum(flat[at + x] * n**x for x in range(k)), grams)]
            # Stretches: a new one begins with a new text or after too long a gap.
            owner = np.searchsorted(cuts, at, side="right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (np.diff(at) > self.gap)
            first = np.nonzero(new)[0]
            enough = np.diff(np.append(first, len(at))) >= least
            for t in np.unique(owner[first[enough]]):
                yield which, int(t), flat[cuts[t] + 1 : cuts[t + 1]].tolist()


def leaks_of(ids: list[int], auto: Automaton, lim: Limits):
    """(item, span, literal, first word, end word) of one text given as word numbers."""
    need = lim.share * lim.span
    # Stretches of the text in which an item's runs are near enough to be one chain: [first, end, runs]. Runs come by
    # their ends, so one that begins early joins the stretches it reaches back over.
    seen: dict = {}
    for item, i, j, n in auto.runs(ids, lim.seed):
        near = seen.setdefault(item, [])
        first, end, parts = j, j + n, [(i, j, n)]
        while near and first - near[-1][1] <= lim.foreign:
            a, b, more = near.pop()
            first, end = min(first, a), max(end, b)
            more += parts
            parts = more
        near.append((first, end, parts))
    for item, near in seen.items():
        best = (0, 0, 0, 0)
        for first, end, parts in near:
            # A chain's literal words are disjoint in the text, so they are no more than its runs are long or cover.
            if end - first >= need and sum(n for *_, n in parts) >= need and _covered(parts) >= need:
                span, literal, a, b = longest_chain(parts, lim)
                best = max(best, (span, literal, -a, b))
        if best[0] >= lim.span:
            yield item, best[0], best[1], -best[2], best[3]


def _covered(parts: list[tuple[int, int, int]]) -> int:
    """How many text words the runs cover together."""
    total, reach = 0, -1
    for _, j, n in sorted(parts, key=lambda p: p[1]):
        total += max(0, j + n - max(j, reach))
        reach = max(reach, j + n)
    return total


_FOUND = ["id", "item", "span", "literal", "first_word", "last_word"]


def find_leaks(batch: pd.DataFrame, auto: Automaton, screen: Screen, lim: Limits) -> pd.DataFrame:
    """One row per text and item of a batch, with the text; ``screen`` is that of this automaton."""
    texts = [t or "" for t in batch["text"]]
    found = [(batch["id"].iloc[t], *leak, texts[t]) for _, t, ids in screen.look(texts) for leak in leaks_of(ids, auto, lim)]
    return pd.DataFrame(found, columns=[*_FOUND, "text"])


def automata_of(items: DataFrame, item_col: str, passage_col: str, lim: Limits, max_words: int) -> list[Automaton]:
    """Suffix automata of the items, each of at most ``max_words`` words unless one item alone is longer. The held-out
    items are small by nature; they come to the driver in id order, piece by piece."""
    item, passage = F.col(f"`{item_col}`"), F.col(f"`{passage_col}`")
    held = items.filter(item.isNotNull() & passage.isNotNull()).groupBy(item.alias("i")).agg(F.min(passage).alias("p")).orderBy("i")
    automata, current, size = [], Automaton(), 0
    for row in held.toLocalIterator():
        text = words(row["p"])
        if len(text) < lim.span:
            continue
        if size and size + len(text) > max_words:
            automata.append(current.finish())
            current, size = Automaton(), 0
        current.add(row["i"], text)
        size += len(text)
    return automata + ([current.finish()] if size else [])


def leaks(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    passage_col: str = "passage",
    limits: Limits = Limits(),
    max_words: int = 250_000,
) -> DataFrame:
    """Which documents hold which test items: (id_col, item_col, span, literal, first_word, last_word).

    The items make generalised suffix automata of at most ``max_words`` words, so what a worker holds has a fixed
    bound. Documents stream through in Arrow batches, whole: the automaton gives the longest match at every word,
    the items behind matches of ``limits.seed`` words or more are candidates, and an exact chain of common runs
    decides. Nothing is shuffled. Where the items need several automata, the documents are still read once: that pass
    writes the texts with enough word pairs of an automaton beside its number, and each automaton reads its own.

    Defined cases: null and empty texts and passages hold nothing and are held by nothing; passages shorter than
    ``limits.span`` words never leak; equal passages all leak together, and so do items that overlap or contain one
    another, as far as the text shows them; an item id delivered twice counts once, with its smallest passage; a
    document delivered twice is reported twice; other columns are ignored.
    """
    found = _scan(documents, items, id_col, text_col, item_col, passage_col, limits, max_words)
    return found.select(*_FOUND).withColumnsRenamed({"id": id_col, "item": item_col})


def _scan(documents: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, passage_col: str, limits: Limits, max_words: int) -> DataFrame:
    """``leaks`` with the text of each document found."""
    spark = documents.sparkSession
    kind, item_kind = documents.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    out = f"id {kind}, item {item_kind}, span int, literal int, first_word int, last_word int, text string"
    automata = automata_of(items, item_col, passage_col, limits, max_words)
    if not automata:
        return spark.createDataFrame([], out)
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("text is not null")

    def scan(texts: DataFrame, auto: Automaton) -> DataFrame:
        shared = spark.sparkContext.broadcast((auto, Screen([auto], limits)))

        def run(batches):
            for pdf in batches:
                yield find_leaks(pdf, *shared.value, limits)

        return texts.mapInPandas(run, out)

    if len(automata) == 1:
        return scan(texts, automata[0])
    screen = spark.sparkContext.broadcast(Screen(automata, limits))

    def pick(batches):
        for pdf in batches:
            hits = [(k, t) for k, t, _ in screen.value.look(pdf["text"].tolist())]
            yield pdf.iloc[[t for _, t in hits]].assign(part=np.array([k for k, _ in hits], np.int32))

    picked = Scratch(spark).keep(texts.mapInPandas(pick, f"id {kind}, text string, part int"), "picked", by="part")
    scans = [scan(picked.filter(F.col("part") == k).select("id", "text"), auto) for k, auto in enumerate(automata)]
    return reduce(DataFrame.unionByName, scans)


def words_at(text: str) -> tuple[list[str], list[int], list[int]]:
    """The words of ``words`` with their first and end position in the text."""
    chars, at = [], []
    for i, c in enumerate(text):
        low = c.lower()
        chars.append(low)
        at += [i] * len(low)
    low = "".join(chars)
    keep: list[tuple[str, int]] = []
    done = 0
    for m in MARKUP.finditer(low) if MARKUP_SIGNS.search(low) else ():
        keep += zip(low[done : m.start()], at[done : m.start()])
        if m[0][0] not in "-\u00ad":
            keep.append((" ", at[m.start()]))
        done = m.end()
    keep += zip(low[done:], at[done:])
    plain = "".join(c for c, _ in keep)
    quotes = {m.start() for m in APOSTROPHE.finditer(plain)}
    keep = [x for i, x in enumerate(keep) if i not in quotes]
    found = list(WORD.finditer("".join(c for c, _ in keep)))
    return [m[0] for m in found], [keep[m.start()][1] for m in found], [keep[m.end() - 1][1] + 1 for m in found]


def without_leaks(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    passage_col: str = "passage",
    limits: Limits = Limits(),
    max_words: int = 250_000,
) -> DataFrame:
    """The documents that show test items, cleaned: (id_col, text, removed_words, n_words, spans, dropped).

    Every span of ``leaks`` is cut out, from its first word to the end of its last, and a blank line left in its place;
    overlapping spans are one. ``spans`` lists (first_word, last_word) of what went. Where the spans make up more than
    ``limits.coverage`` of the words, the whole document is dropped: ``dropped`` is true and the text null. Documents
    without leaks are not listed: they stay as they are. One row per distinct id and text; see ``leaks`` for the
    other cases.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    found = _scan(documents, items, id_col, text_col, item_col, passage_col, limits, max_words)
    hit = found.groupBy("id", "text").agg(F.collect_set(F.struct("first_word", "last_word")).alias("spans"))  # only what leaks is shuffled

    def cut(batches):
        for pdf in batches:
            made = []
            for i, text, spans in zip(pdf["id"], pdf["text"], pdf["spans"]):
                said, begin, end = words_at(text)
                merged: list[list[int]] = []
                for a, b in sorted((s["first_word"], s["last_word"]) for s in spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                gone = sum(b - a for a, b in merged)
                dropped = gone > limits.coverage * len(said)
                pieces, done = [], 0
                for a, b in merged:
                    pieces.append(text[done : begin[a]].rstrip())
                    done = end[b - 1]
                pieces.append(text[done:].lstrip())
                left = None if dropped else "\n\n".join(p for p in pieces if p)
                made.append((i, left, gone, len(said), [{"first_word": a, "last_word": b} for a, b in merged], dropped))
            yield pd.DataFrame(made, columns=["id", "text", "removed_words", "n_words", "spans", "dropped"])

    out = hit.mapInPandas(cut, f"id {kind}, text string, removed_words int, n_words int, spans array<struct<first_word: int, last_word: int>>, dropped boolean")
    return out.withColumnRenamed("id", id_col)
