"""Passages of held-out items inside a training corpus.

A generalised suffix automaton of all normalised test items is streamed over the
words of every document. It tracks the longest match that ends at each word; a
match of ``least_words`` or more names the items that hold it. Words that no item
has cut the stream (no match crosses them), so only runs of known words are
walked.

An automaton holds at most about ``block_words`` words of items, so what is
broadcast is bounded whatever the test set's size: an automaton of n words has at
most 2n states and takes space in proportion to n. A test set that needs several of
them is met in two steps: one pass over the documents tests every run of words
against a table of hashed item runs (32 MB, a false hit costs time only), and
just the documents with a hit are stored and streamed through each automaton.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.llm.labels import option_text
from nasaq.session import stored

VOWEL_MARKS = re.compile("[\u0610-\u061a\u064b-\u0652\u0656-\u065f\u0670\u06d6-\u06dc\u06df-\u06e4\u06e7\u06e8\u06ea-\u06ed]+")
WORD = re.compile(r"[^\W_]+")
#: A word with its marks, in a text that isn't composed yet.
SPAN = regex.compile(r"(?:[^\W_]|\p{M})+")
#: Bits of the table of hashed runs.
TABLE_BITS = 28


def normalised(text: str) -> str:
    """Without case (the two forms of the small sigma as one) and Arabic vowel marks."""
    return VOWEL_MARKS.sub("", unicodedata.normalize("NFC", text).lower().replace("ς", "σ"))


def words_of(text: str | None) -> list[str]:
    return WORD.findall(normalised(text)) if text else []


class ItemAutomaton:
    """Suffix automaton over the word sequences of items (id, words).

    ``needs`` gives the least length of a match that counts for an item; by default
    ``least`` for every item.
    """

    def __init__(self, items: list[tuple[int, list[str]]], least: int, needs: dict[int, int] | None = None):
        self.least = least
        self.word_ids: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.size = {i: len(words) for i, words in items}
        ends: dict[int, set[int]] = {}  # by item, the states of its prefixes
        for item, words in items:
            last = 0
            for w in words:
                last = self._add(self.word_ids.setdefault(w, len(self.word_ids)), last)
                ends.setdefault(item, set()).add(last)
        link, length = self.link, self.length
        by_length = sorted(range(1, len(link)), key=length.__getitem__)
        #: The state of the last ``least`` words of a match.
        self.base = list(range(len(link)))
        for v in by_length:
            if length[link[v]] >= least:
                self.base[v] = self.base[link[v]]
        #: By that state, the items that hold its words; in sum at most as many entries as words.
        self.items: dict[int, list[int]] = {}
        for item, states in ends.items():
            for b in {self.base[v] for v in states if length[v] >= least}:
                self.items.setdefault(b, []).append(item)
        # An item holds the words of a state exactly if one of its prefixes is below that state in the tree of links.
        self.enter, self.leave = self._tour(by_length)
        self.places = {item: sorted(self.enter[v] for v in states) for item, states in ends.items()}
        #: By state: the least match length that counts for some item of it, and the longest counting suffix above it.
        self.need = [math.inf] * len(link)
        for item, states in ends.items():
            own = needs[item] if needs else least
            for v in states:
                self.need[v] = min(self.need[v], own)
        for v in reversed(by_length):
            self.need[link[v]] = min(self.need[link[v]], self.need[v])
        self.above = [0] * len(link)
        for v in by_length:
            u = link[v]
            self.above[v] = length[u] if length[u] >= self.need[u] else self.above[u]

    def _tour(self, by_length: list[int]) -> tuple[list[int], list[int]]:
        """The first and last number of each state's subtree in the tree of links, numbered parents first."""
        below = [1] * len(self.link)
        for v in reversed(by_length):
            below[self.link[v]] += below[v]
        enter, free = [0] * len(self.link), [1] * len(self.link)
        for v in by_length:
            u = self.link[v]
            enter[v] = free[u]
            free[u] += below[v]
            free[v] = enter[v] + 1
        return enter, [e + b - 1 for e, b in zip(enter, below, strict=True)]

    def holds(self, item: int, v: int) -> bool:
        places = self.places[item]
        k = bisect.bisect_left(places, self.enter[v])
        return k < len(places) and places[k] <= self.leave[v]

    def _add(self, c: int, last: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(q, last, c)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[p] + 1 == length[q] else self._clone(q, p, c)
        return cur

    def _clone(self, q: int, p: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        k = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = k
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        return k

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position after the match, its length, its state) wherever at least ``least`` words match."""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        v = n = 0
        for at, c in enumerate(words, 1):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            if n >= least:
                yield at, n, v

    def counting(self, n: int, v: int) -> int:
        """The longest suffix of a match of n words at v that counts for some item; 0 for none."""
        return n if n >= self.need[v] else self.above[v]


def _known_runs(ids: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Stretches of at least ``least`` known words."""
    known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
    edges = np.flatnonzero(np.diff(known))
    for a, b in edges.reshape(-1, 2):
        if b - a >= least:
            yield int(a), int(b)


def _scan(shared, key: int, text: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: ItemAutomaton = shared.value
        get, least = auto.word_ids.get, auto.least
        for batch in batches:
            docs, items, longest, covered = [], [], [], []
            words = [words_of(t) for t in batch.column(text).to_pylist()]
            # One stream for the batch, with an unknown word after each document.
            flat = itertools.chain.from_iterable(itertools.chain(w, ("",)) for w in words)
            ids = np.fromiter(map(get, flat, itertools.repeat(-1)), np.int32, sum(map(len, words)) + len(words))
            ends = np.cumsum([len(w) + 1 for w in words])
            found: dict[tuple[int, int], list] = {}
            for a, b in _known_runs(ids, least):
                doc = int(np.searchsorted(ends, a, side="right"))
                for at, n, v in auto.matches(ids[a:b].tolist()):
                    for item in auto.items[auto.base[v]]:
                        got = found.setdefault((doc, item), [0, set()])
                        u = v
                        while not auto.holds(item, u):
                            u = auto.link[u]
                        held = min(n, auto.length[u])
                        got[0] = max(got[0], held)
                        got[1].update(range(a + at - held, a + at))
            keys = batch.column(key)
            for (doc, item), (n, places) in found.items():
                docs.append(keys[doc].as_py())
                items.append(item)
                longest.append(n)
                covered.append(min(1.0, len(places) / auto.size[item]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(longest, pa.int32()), pa.array(covered, pa.float64())],
                names=["doc_id", "test_id", "longest", "coverage"],
            )

    return run


class _Items:
    """The items in blocks. ``needs``: least length of a match that counts, by the number of words; 0 for an item that can't leak."""

    def __init__(self, items: DataFrame, least: int, needs, block_words: int):
        self.least, self.needs = least, needs
        self.items = items.where("test_id IS NOT NULL AND text IS NOT NULL").select("test_id", "text")
        # A word has a character and, but for the last, a gap.
        chars = self.items.agg(F.sum(F.length("text"))).first()[0] or 0
        self.blocks = max(1, -(-chars // (4 * block_words)))

    def automaton(self, block: int) -> ItemAutomaton:
        part = F.pmod(F.xxhash64("test_id"), F.lit(self.blocks)) == block
        words = [(r.test_id, words_of(r.text)) for r in self.items.where(part).orderBy("test_id", "text").collect()]
        kept = [(i, w) for i, w in words if self.needs(len(w))]
        return ItemAutomaton(kept, self.least, {i: self.needs(len(w)) for i, w in kept})

    def automata(self) -> Iterator[ItemAutomaton]:
        return (self.automaton(b) for b in range(self.blocks))

    def run_table(self) -> np.ndarray:
        """A bit for each hashed run of ``least`` words of the items. The distinct places go through the driver in slices."""
        least = self.least

        def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [_hashed_runs(words_of(t), least) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)) if found else [], pa.int64())], names=["place"])

        table = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
        packed = (
            self.items.select("text").mapInArrow(places, "place long").distinct()
            .groupBy(F.shiftright("place", 16).alias("slice")).agg(F.collect_list("place").alias("places"))
        )
        for r in packed.toLocalIterator():
            p = np.array(r.places, np.int64)
            np.bitwise_or.at(table, p >> 3, (1 << (p & 7)).astype(np.uint8))
        return table


def _hashed_runs(words: list[str], least: int) -> np.ndarray:
    """The places in the table of all runs of ``least`` words."""
    n = len(words) - least + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    each = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    out = np.zeros(n, np.uint64)
    for k in range(least):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n]
    return ((out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _with_hits(documents: DataFrame, items: _Items) -> DataFrame:
    """The documents (doc_id, text) with a row number ``rid`` and whether a run of words is in the table of the items; stored."""
    sc, least = documents.sparkSession.sparkContext, items.least
    shared = sc.broadcast(items.run_table())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            hits = []
            for t in batch.column(1).to_pylist():
                p = _hashed_runs(words_of(t), least)
                hits.append(bool(len(p) and (table[p >> 3] >> (p & 7) & 1).any()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.bool_())], names=["doc_id", "text", "hit"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, hit boolean").withColumn("rid", F.monotonically_increasing_id())


def item_text(questions: DataFrame) -> DataFrame:
    """(test_id, text): the question followed by the option texts in order without their labels, null parts left out."""
    return questions.select("test_id", F.concat_ws("\n", "question", F.transform("options", option_text)).alias("text"))


def leaks(documents: DataFrame, items: DataFrame, least_words: int = 8, block_words: int = 250_000) -> DataFrame:
    """Rows (doc_id, test_id, longest, coverage): each document with each item it leaks.

    ``documents`` has doc_id long and text string, ``items`` test_id long (unique) and
    text string; other columns don't matter. longest is the longest common run of
    words, coverage the share of the item's words that such runs cover. Copies of a
    document count each; null, blank and empty texts leak nothing; an item of fewer
    words than ``least_words`` can't leak.
    """
    docs = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    sc = documents.sparkSession.sparkContext
    held = _Items(items, least_words, lambda n: least_words if n >= least_words else 0, block_words)
    if held.blocks > 1:
        docs = stored(_with_hits(docs, held).where("hit").select("doc_id", "text"), "leak-candidates")
    parts = [docs.mapInArrow(_scan(sc.broadcast(auto), 0, 1), "doc_id long, test_id long, longest int, coverage double") for auto in held.automata()]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _cuts_of(auto: ItemAutomaton, text: str | None) -> list[int]:
    """Numbers of the spans (words with their marks) that a counting match covers."""
    if not text:
        return []
    get = auto.word_ids.get
    words, at_span = [], []
    for i, m in enumerate(SPAN.finditer(text)):
        for w in WORD.findall(normalised(m.group())):
            words.append(get(w, -1))
            at_span.append(i)
    ids, cut = np.array(words, np.int32), set()
    for a, b in _known_runs(ids, auto.least):
        for at, n, v in auto.matches(ids[a:b].tolist()):
            if n := auto.counting(n, v):
                cut.update(at_span[a + at - n : a + at])
    return sorted(cut)


def _without(text: str | None, cuts: Iterable[int]) -> tuple[str | None, int]:
    """The text without these spans and what is between neighbours of them, and their number."""
    gone = set(cuts)
    if not gone or text is None:
        return text, 0
    pieces, at, last_cut = [], 0, False
    for i, m in enumerate(SPAN.finditer(text)):
        if i in gone:
            if not last_cut:
                pieces.append(text[at : m.start()])
            at = m.end()
        last_cut = i in gone
    return "".join(pieces) + text[at:], len(gone)


def without_leaks(
    documents: DataFrame, items: DataFrame, least_words: int = 8, coverage: float = 0.5, shortest: int = 4, block_words: int = 250_000
) -> DataFrame:
    """Rows (doc_id, text, removed_words): every document without the spans that exceed a limit.

    A span is removed if it matches ``least_words`` words of an item, or ``shortest``
    words that are at least the share ``coverage`` of an item's words; so a short item
    goes too. Items of fewer than ``shortest`` words can't be told from other text and
    are left out. Null texts stay null; repeated rows stay repeated.
    """
    sc = documents.sparkSession.sparkContext
    shortest = min(shortest, least_words)
    need = lambda n: min(least_words, max(shortest, math.ceil(coverage * n - 1e-9))) if n >= shortest else 0
    held = _Items(items, shortest, need, block_words)
    schema = "doc_id long, text string, removed_words int"

    if held.blocks == 1:
        shared = sc.broadcast(held.automaton(0))

        def at_once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = [_without(t, _cuts_of(shared.value, t)) for t in batch.column(1).to_pylist()]
                yield _cleaned(batch.column(0), new)

        return documents.select("doc_id", "text").mapInArrow(at_once, schema)
    docs = stored(_with_hits(documents, held), "leak-hits")
    cuts = None
    for auto in held.automata():
        part = docs.where("hit").select("rid", "text").mapInArrow(_cut_rows(sc.broadcast(auto)), "rid long, cuts array<int>")
        cuts = part if cuts is None else cuts.unionByName(part)
    cuts = cuts.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("cuts"))).alias("cuts"))  # at most the words of one document

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _cleaned(batch.column(0), [_without(t, c or ()) for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)])

    return docs.join(cuts, "rid", "left").select("doc_id", "text", "cuts").mapInArrow(cut, schema)


def _cut_rows(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [_cuts_of(shared.value, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, pa.list_(pa.int32()))], names=["rid", "cuts"])

    return run


def _cleaned(ids: pa.Array, new: list[tuple[str | None, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([t for t, _ in new], pa.string()), pa.array([n for _, n in new], pa.int32())], names=["doc_id", "text", "removed_words"]
    )
