"""Groups of texts whose word sets have at least a given Jaccard similarity.

Meet in the middle over deletion balls. The fingerprint of a text is its word set in
one global order, rare words first. Two sets of similarity t or more meet in the
variant that is their intersection: the smaller set reaches it by at most
n - ceil(2t/(1+t) n) deletions (half of the radius when sizes are equal), the larger
by at most n - ceil(t n). Every text emits all its variants within its part of the
radius. A variant is known by its leading words alone, so the variants that agree
in them are emitted as one key: one leading word if few texts have that word, more
of them while the expected bucket exceeds ``bucket`` texts.

Why this is the same join: let V(A) be the variants of A within its part, and p a map
that cuts a variant to its leading words, the same for both sides. A and B share a
variant, their intersection I; so both emit p(I), and they collide. Two sets that
collide in p but share no variant are false candidates, which the tests below and
verification remove. So the pairs found are those of the full balls exactly; what
p saves is the size of the ball. At t = 0.7 a set of n words has up to
C(n, n - ceil(0.7 n)) variants of the largest deletion alone (38,760 for 20 words)
and emits at most 7 keys of one rare word, and some more where its first words are
frequent. Keys are shuffled,
colliding pairs are filtered by length, position and a 64-bit parity sketch (each
word flips one bit, so the sketches differ in at most as many bits as the sets in
words: no link is lost), made distinct, and verified on the full word sets.

Equal word sets collapse before, so a hot text costs one row. In a bucket that is
still large (say, a family of variants that holds a third of all rows), ``groups``
needs connections only: it is linked through its least member first, and only pairs
that this leaves in different components are compared. ``run`` also counts the
links, so there every pair of such a bucket is compared, in blocks of bounded size:
no link is lost or capped, and the work grows with the pairs of the bucket.

What is shuffled by a hash (word sets, keys, words of the sets in a pair) lies in slices
by it, which are taken in up to eight passes: equal hashes are in one slice, so no pair
is lost, and only the shuffles of one pass are on disk at a time.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.functions.components import components
from nasaq.functions.skew import join_unique
from nasaq.llm.lookalikes import all_as_they_look
from nasaq.session import Slices, checkpointed, release

PUNCTUATION = regex.compile(r"\p{P}+")
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: The punctuation of the basic plane as one set, which is searched faster.
BASIC = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c))[0] == "P"]
BASIC_PUNCTUATION = re.compile(f"[{re.escape(''.join(BASIC))}]+")
EPS = 1e-9
#: Bits of the table of hashed keys.
TABLE_BITS = 28


@dataclass(frozen=True)
class Settings:
    """similarity: of the groups, inclusive. bucket: texts expected in one bucket at
    most before its key takes another word. depth: most words of a key. hot: rows of
    a bucket above which it is linked through its least member first, or compared
    in blocks of about so many rows. words: most
    words whose frequency is broadcast (others count as rare, which costs time but
    no link). tail: most keys of frequent words that prune the other side word by word;
    more of them do it by a table of hashed bits. hot_rows:
    rows of a set or a group above which they aren't shuffled to one task. per_pass:
    word sets whose keys are shuffled at a time, if eight passes are enough."""

    similarity: float = 0.7
    bucket: int = 128
    depth: int = 4
    hot: int = 512
    words: int = 100_000
    tail: int = 400_000
    hot_rows: int = 1_000_000
    per_pass: int = 200_000


def words_of(text: str) -> list[str]:
    """The sorted distinct words of a rewritten text: lower case, punctuation as blanks."""
    pattern = PUNCTUATION if ASTRAL.search(text) else BASIC_PUNCTUATION
    return sorted(set(pattern.sub(" ", text.lower()).split()))


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group key, id, text) -> (group key, id, words joined by blanks); texts without words go."""
    for batch in batches:
        texts = all_as_they_look(batch.column(2).to_pylist())
        words = [" ".join(words_of(t)) or None for t in texts]
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.string())], names=["task", "id", "words"])
        yield out.filter(out.column(2).is_valid())


def most_deletions(n: int, t: float) -> int:
    """Of a set of n words, on the way to its intersection with any similar set."""
    return n - math.ceil(t * n - EPS)


def half_deletions(n: int, t: float) -> int:
    """Of the smaller set of a similar pair."""
    return n - math.ceil(2 * t / (1 + t) * n - EPS)


class _Emitter:
    """Emits the keys of word sets. The frequency of a frequent word: freq[task][word]."""

    def __init__(self, freq: dict[str, dict[str, int]], totals: dict[str, int], s: Settings, tail: dict[str, dict] | np.ndarray | None):
        self.freq, self.totals, self.s, self.tail = freq, totals, s, tail
        #: The place of each frequent word in the global order.
        self.rank = {t: {w: i for i, w in enumerate(sorted(ws, key=lambda w: (ws[w], w)))} for t, ws in freq.items()}
        self.bits: dict[str, int] = {}

    def _key(self, task: str, words: tuple[str, ...]) -> int:
        """An unsigned 64-bit hash."""
        return xxhash.xxh3_64_intdigest("\x00".join((task, *words)).encode("utf-8", "surrogatepass"))

    def _extend(self, task, order, known, at, left, expected, key, out) -> None:
        """All keys (as words) that start with order[at]; ``left`` deletions remain after it."""
        key = (*key, order[at])
        df = known[at]
        expected = expected * df / self.totals[task] if len(key) > 1 else float(df)
        final = not df or expected <= self.s.bucket or len(key) >= self.s.depth
        if final or left >= len(order) - at - 1:  # the variant may also end here, all later words deleted
            out.append(key)
        if final:
            return
        last, scale = len(key) + 1 >= self.s.depth, expected / self.totals[task]
        for skip in range(min(left, len(order) - at - 2) + 1):
            i = at + 1 + skip
            if last or scale * known[i] <= self.s.bucket:  # final, as most are
                out.append((*key, order[i]))
            else:
                self._extend(task, order, known, i, left - skip, expected, key, out)

    def _walk(self, node, order, at, left, out) -> None:
        """All keys of the trie below ``node`` that the words from order[at] on spell with at most ``left`` deletions."""
        for i in range(at, min(at + left + 1, len(order))):
            child = node.get(order[i])
            if child is None:
                continue
            if "" in child:
                out.append(child[""])
            self._walk(child, order, i + 1, left - (i - at), out)

    def ordered(self, task: str, words: list[str]) -> tuple[list[str], list[int]]:
        """The words in the global order, and the frequency of each (0 for rare ones); the words are sorted."""
        rank, freq = self.rank.get(task, {}), self.freq.get(task, {})
        frequent = sorted([w for w in words if w in rank], key=rank.__getitem__)
        rare = [w for w in words if w not in rank]
        return rare + frequent, [0] * len(rare) + [freq[w] for w in frequent]

    def rare(self, task: str, words: list[str]) -> list[str]:
        """The rare words, in order (the words are sorted)."""
        freq = self.freq.get(task, {})
        return [w for w in words if w not in freq]

    def small_tail(self, task: str, words: list[str]) -> list[tuple[str, ...]]:
        """The smaller side's keys, as words, that start with a frequent word."""
        half = half_deletions(len(words), self.s.similarity)
        n_rare = len(self.rare(task, words))
        out: list[tuple[str, ...]] = []
        if n_rare <= half:
            order, known = self.ordered(task, words)
            for at in range(n_rare, min(half + 1, len(order))):
                self._extend(task, order, known, at, half - at, 1.0, (), out)
        return out

    def rare_keys(self, task: str, words: list[str]) -> list[int]:
        """Keys of one rare word, in the order of the words, so that the k-th has position k."""
        digest, head = xxhash.xxh3_64_intdigest, task + "\x00"
        most = most_deletions(len(words), self.s.similarity)
        return [digest((head + w).encode("utf-8", "surrogatepass")) for w in self.rare(task, words)[: most + 1]]

    def tail_keys(self, task: str, words: list[str]) -> list[int]:
        """Keys that a frequent word starts: those that the smaller side of some pair has too, if these are known by word."""
        most = most_deletions(len(words), self.s.similarity)
        n_rare = len(self.rare(task, words))
        if n_rare > most:
            return []
        order, known = self.ordered(task, words)
        if isinstance(self.tail, dict):
            found: list[int] = []
            if task in self.tail:
                self._walk(self.tail[task], order, n_rare, most - n_rare, found)
            return found
        out: list[tuple[str, ...]] = []
        for at in range(n_rare, min(most + 1, len(order))):
            self._extend(task, order, known, at, most - at, 1.0, (), out)
        return [self._key(task, key) for key in out]

    def sketch(self, words: list[str]) -> int:
        """Each word flips one bit of 64."""
        bits, sketch = self.bits, 0
        for w in words:
            b = bits.get(w)
            if b is None:
                b = 1 << (zlib.crc32(w.encode("utf-8", "surrogatepass")) & 63)
                if len(bits) < 200_000:
                    bits[w] = b
            sketch ^= b
        return sketch


KEYS = "key long, id long, n int, at int, sketch long"
NAMES = ["key", "id", "n", "at", "sketch"]
#: A set with its keys by slice, which takes a third of the room of a row for each key.
BY_SET = "id long, n int, sketch long, " + ", ".join(f"k{i} array<struct<key: long, at: int>>" for i in range(Slices.COUNT))


def _emit(shared: Broadcast, s: Settings):
    """Keys that rare words start, each with its position, and those that frequent words start, with position 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, totals, tail_set = shared.value
        emitter = _Emitter(freq, totals, s, tail_set)
        for batch in batches:
            keys: list[int] = []
            at: list[int] = []
            per_row, sizes, sketches = [], [], []
            for task, joined in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = joined.split(" ")
                rare, tail = emitter.rare_keys(task, words), emitter.tail_keys(task, words)
                keys += rare
                keys += tail
                at += range(1, len(rare) + 1)
                at += [0] * len(tail)
                per_row.append(len(rare) + len(tail))
                sizes.append(len(words))
                sketches.append(emitter.sketch(words) if rare or tail else 0)
            each, row, position = np.array(keys, np.uint64), np.repeat(np.arange(len(per_row)), per_row), np.array(at, np.int32)
            if isinstance(tail_set, np.ndarray):
                kept = (position > 0) | _in_table(tail_set, each)
                each, row, position = each[kept], row[kept], position[kept]
            slice_of = each % np.uint64(Slices.COUNT)
            columns = [batch.column(1), pa.array(sizes, pa.int32()), pa.array(np.array(sketches, np.uint64).view(np.int64))]
            for k in range(Slices.COUNT):
                own = slice_of == k
                ends = np.concatenate([[0], np.cumsum(np.bincount(row[own], minlength=len(per_row)))]).astype(np.int32)
                pair = pa.StructArray.from_arrays([pa.array(each[own].view(np.int64)), pa.array(position[own])], names=["key", "at"])
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pair))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "sketch", *(f"k{k}" for k in range(Slices.COUNT))])

    return run


def _small_tail(shared: Broadcast, s: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, totals, _ = shared.value
        emitter = _Emitter(freq, totals, s, None)
        for batch in batches:
            seen: set[tuple[str, ...]] = set()
            for task, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.update((task, *key) for key in emitter.small_tail(task, words.split(" ")))
            yield pa.RecordBatch.from_pydict({"key": pa.array([list(k) for k in seen], pa.list_(pa.string()))})

    return run


def _places(keys: np.ndarray) -> list[np.ndarray]:
    """Two places of each key in the table of bits."""
    return [(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64), (keys >> np.uint64(60 - 2 * TABLE_BITS) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)]


def _in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits are set: always for a key that was put in, rarely for another."""
    one, two = ((table[p >> 6] >> (p & 63)) & 1 for p in _places(keys))
    return (one & two).astype(bool)


def _small_places(shared: Broadcast, s: Settings):
    """The places of the smaller side's keys that a frequent word starts, each once in a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, totals, _ = shared.value
        emitter, seen = _Emitter(freq, totals, s, None), np.zeros(1 << (TABLE_BITS - 3), np.uint8)
        for batch in batches:
            keys = [
                emitter._key(task, key)
                for task, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for key in emitter.small_tail(task, words.split(" "))
            ]
            places = np.unique(np.concatenate(_places(np.array(keys, np.uint64))))
            places = places[(seen[places >> 3] >> (places & 7)) & 1 == 0]
            np.bitwise_or.at(seen, places >> 3, (1 << (places & 7)).astype(np.uint8))
            yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64())})

    return run


def _trie(keys: Iterable[list[str]]) -> dict[str, dict]:
    """By task and words; the hash of a key is under the empty word after its last word."""
    root: dict[str, dict] = {}
    for task, *words in keys:
        node = root.setdefault(task, {})
        for w in words:
            node = node.setdefault(w, {})
        node[""] = xxhash.xxh3_64_intdigest("\x00".join((task, *words)).encode("utf-8", "surrogatepass"))
    return root


def _pair_filter(s: Settings) -> str:
    """Conditions on a colliding pair: a the larger or equal set, b the smaller. All are necessary for similarity.

    The one on b alone names a too, so that it isn't pushed below the shuffle: with
    equal inputs both sides of the join read the same shuffle files.
    """
    t = s.similarity
    need = f"ceil({t / (1 + t)!r}D * (a.n + b.n) - {EPS!r}D)"
    half = f"b.n - ceil({2 * t / (1 + t)!r}D * b.n - {EPS!r}D) + 1"
    return (
        "(a.n > b.n OR (a.n = b.n AND a.id > b.id))"
        f" AND b.n >= ceil({t!r}D * a.n - {EPS!r}D)"
        f" AND CASE WHEN a.at = 0 THEN true ELSE b.at <= {half} AND 1 + least(a.n - a.at, b.n - b.at) >= {need} END"
        f" AND bit_count(a.sketch ^ b.sketch) <= a.n + b.n - 2 * {need}"
    )


class NearDuplicates:
    """Rows (task string, id long, text string) -> groups of similar texts within a task.

    Null and blank texts are in no group; a text that is all punctuation has no words
    and is in none either. Ids are unique within a task; an id that arrives again
    with the same text counts once. Ties and copies are fine.
    """

    def __init__(self, rows: DataFrame, settings: Settings = Settings()):
        self.s = settings
        texts = rows.select("task", "id", "text").where("id IS NOT NULL AND task IS NOT NULL AND length(trim(text)) > 0")
        self.all = texts.mapInArrow(_sets, "task string, id long, words string")
        self.spark = rows.sparkSession

    def run(self) -> DataFrame:
        """Rows (task, id, group_id, links): each record, the least id of its group, and the number
        of other word sets that its own is similar to."""
        return self._grouped(every=True)

    def groups(self) -> DataFrame:
        """Rows (task, id, group_id): the groups alone, for which large buckets needn't be compared pair by pair."""
        return self._grouped(every=False)

    def _grouped(self, every: bool) -> DataFrame:
        s = self.s
        members, sets = self._distinct_sets()
        links = self._links(sets, every)
        roots = components(links.select("a", "b"))
        # The group of a set is named by the least item id in its component.
        by_set = sets.rows().select("id", "task", "least", "copies").join(roots, "id", "left").select(
            "id", "least", "copies", F.coalesce("root", "id").alias("root")
        )
        by_set = checkpointed(by_set)
        sets.drop()
        release(self.spark)
        names = by_set.groupBy("root").agg(F.min("least").alias("group_id"), F.count(F.lit(1)).alias("sets"))
        named = join_unique(by_set, names, ["root"], "sets", s.hot_rows)
        items = members.rows().select("task", F.col("id").alias("item"), F.col("h1").alias("id"))
        if not every:
            named = checkpointed(named.select("id", "group_id", "copies"))
            return join_unique(items, named, ["id"], "copies", s.hot_rows).select("task", F.col("item").alias("id"), "group_id")
        degree = links.selectExpr("a AS id").unionByName(links.selectExpr("b AS id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
        named = named.join(degree, "id", "left")
        named = checkpointed(named.select("id", "group_id", "copies", F.coalesce("links", F.lit(0)).alias("links")))
        return join_unique(items, named, ["id"], "copies", s.hot_rows).select("task", F.col("item").alias("id"), "group_id", "links")

    def _distinct_sets(self) -> tuple[Slices, Slices]:
        """The items with the id of their word set, and one row for each distinct word set.

        A set's own id, unlike an item id, is unique over tasks.
        """
        texts = Slices(self.spark, "word-sets", "task string, id long, words string, h1 long", "h1")
        texts.add(self.all.select("task", "id", "words", F.xxhash64("words", "task").alias("h1")))
        members = Slices(self.spark, "members", "task string, id long, h1 long", "h1")
        sets = Slices(self.spark, "distinct-sets", "id long, task string, words string, least long, copies long", "id")
        for part in Slices.passes(texts.rows().count(), self.s.per_pass):
            rows = texts.rows(part)
            members.add(rows.select("task", "id", "h1"))
            sets.add(
                rows.groupBy("task", "words").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")).select(
                    F.xxhash64("words", "task").alias("id"), "task", "words", "least", "copies"
                )
            )
            texts.drop(part)
        return members, sets

    def _links(self, sets: Slices, every: bool) -> DataFrame:
        """Rows (a, b) of similar sets: with ``every`` all of them, else enough to connect each group."""
        keys, complete, passes = self._keys(sets)
        pairs = Slices(self.spark, "pairs", "a long, b long", "a")
        hot = Slices(self.spark, "hot-rows", KEYS, "key")
        for part in passes:
            self._candidates(_rows(keys.rows(), part), complete, every, pairs, hot)
        keys.drop()
        links = self._verified(pairs.rows(), sets, passes)
        pairs.drop()
        if every:
            return links
        rows = hot.rows()
        if not rows.isEmpty():
            links = checkpointed(links.unionByName(self._verified(self._between(rows, links), sets, passes)).distinct())
        hot.drop()
        release(self.spark)
        return links

    def _keys(self, sets: Slices) -> tuple[Slices, bool, list[list[int]]]:
        """The keys by set; whether no word that isn't known as frequent has a bucket of more than ``hot`` rows; the slices of each pass."""
        s, sc = self.s, self.spark.sparkContext
        columns = sets.rows().select("task", "id", "words")
        totals = {r.task: r["count"] for r in columns.groupBy("task").count().collect()}
        frequent = (
            columns.select("task", F.explode(F.split("words", " ")).alias("word"))
            .groupBy("task", "word")
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > s.bucket)
            .orderBy(F.desc("n"), "task", "word")
            .limit(s.words)
            .collect()
        )
        release(self.spark)
        freq: dict[str, dict[str, int]] = {}
        for r in frequent:
            freq.setdefault(r.task, {})[r.word] = r.n
        shared = sc.broadcast((freq, totals, None))
        # The list is by frequency: a word that isn't in it has no more texts than the last one in it.
        full = len(frequent) == s.words
        prune = None
        if not full:
            tail = columns.select("task", "words").mapInArrow(_small_tail(shared, s), "key array<string>").distinct().limit(s.tail + 1).collect()
            release(self.spark)
            prune = _trie(r.key for r in tail) if len(tail) <= s.tail else None
        if prune is None:  # with a full list there are too many of these keys, mostly
            prune = self._table(columns.select("task", "words").mapInArrow(_small_places(shared, s), "place long"))
        shared = sc.broadcast((freq, totals, prune))
        keys = Slices(self.spark, "keys", BY_SET)
        keys.add(columns.mapInArrow(_emit(shared, s), BY_SET))
        complete = not full or frequent[-1].n <= s.hot
        return keys, complete, Slices.passes(sum(totals.values()), s.per_pass)

    def _table(self, places: DataFrame) -> np.ndarray:
        """A table of bits (32 MB) in which these places are set."""
        words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")).toArrow()
        table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        release(self.spark)
        return table

    def _candidates(self, keys: DataFrame, complete: bool, every: bool, pairs: Slices, hot_rows: Slices) -> None:
        """Adds the colliding pairs of some keys, and the rows of their large buckets unless all pairs of these are added."""
        # If the list of frequent words is long enough, a word that isn't in it has at most ``hot`` texts.
        rest = keys.where("at = 0") if complete else keys
        sizes = rest.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        hot = checkpointed(sizes.where(F.col("size") > self.s.hot))
        if hot.isEmpty():
            found = self._colliding(keys, keys)
        else:
            cold = keys.join(hot.select("key"), "key", "left_anti")
            found = self._colliding(cold, cold)
            if every:
                cells = self._cells(rest.join(hot, "key"))
                found = found.unionByName(self._colliding(cells, cells, "(a.block <> b.block OR a.low = a.high)", ["key", "low", "high"]))
            else:
                rows = rest.join(hot, "key", "left_semi").select(*NAMES)
                hot_rows.add(rows)
                found = found.unionByName(self._pivots(rows))
        pairs.add(_in_order(found))

    def _colliding(self, larger: DataFrame, smaller: DataFrame, condition: str = "true", on: list[str] = ["key"]) -> DataFrame:
        joined = larger.alias("a").join(smaller.alias("b"), on)
        return joined.where(F.expr(f"{_pair_filter(self.s)} AND {condition}")).selectExpr("a.id AS a", "b.id AS b")

    def _cells(self, rows: DataFrame) -> DataFrame:
        """Each row of a large bucket in all cells (low, high) of two blocks, one of which is its own.

        A bucket of ``size`` rows has size / hot blocks. Two rows meet in the one cell of
        their two blocks, which has some 2 x hot rows at most.
        """
        blocks = F.ceil(F.col("size") / self.s.hot)
        rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id"), blocks))
        return rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).select(
            *NAMES, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
        )

    @staticmethod
    def _pivots(rows: DataFrame) -> DataFrame:
        """Each member of a bucket with the bucket's least member."""
        least = rows.groupBy("key").agg(F.min("id").alias("b"))
        return rows.join(least, "key").where("id <> b").select(F.col("id").alias("a"), "b")

    def _between(self, rows: DataFrame, links: DataFrame) -> DataFrame:
        """Pairs of a bucket whose members the links so far leave in different components."""
        roots = components(links.select("a", "b"))
        rooted = checkpointed(
            rows.join(roots, "id", "left").select(*NAMES, F.coalesce("root", "id").alias("root"))
        )
        main = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("key").agg(
            F.max_by("root", "size").alias("main"), F.count(F.lit(1)).alias("parts")
        ).where("parts > 1")
        # In cells of a block of the bucket and a block of what is outside its main component, so no task has a whole bucket.
        rest = rooted.join(main, "key").where("root <> main").select(*rooted.columns)
        counts = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("n_all")).join(rest.groupBy("key").agg(F.count(F.lit(1)).alias("n_rest")), "key")
        blocks = counts.select("key", F.ceil(F.col("n_all") / self.s.hot).alias("of_all"), F.ceil(F.col("n_rest") / self.s.hot).alias("of_rest"))

        def cells(side: DataFrame, own: str, other: str, own_blocks: str, other_blocks: str) -> DataFrame:
            placed = side.join(blocks, "key").withColumn(own, F.pmod(F.xxhash64("id"), F.col(own_blocks)))
            return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_blocks) - 1))).select(*rooted.columns, "x", "y")

        every, outside = cells(rooted, "x", "y", "of_all", "of_rest"), cells(rest, "y", "x", "of_rest", "of_all")
        differ, on = "a.root <> b.root", ["key", "x", "y"]
        return self._colliding(every, outside, differ, on).unionByName(self._colliding(outside, every, differ, on))

    def _verified(self, pairs: DataFrame, sets: Slices, passes: list[list[int]]) -> DataFrame:
        """Distinct pairs whose full word sets are similar."""
        distinct = Slices(self.spark, "distinct-pairs", "a long, b long", "a")
        distinct.add(_in_order(pairs))
        pairs = distinct.rows()
        # Only the words of sets in a pair go on.
        words = Slices(self.spark, "words-of-pairs", "id long, words string", "id")
        ids = Slices(self.spark, "ids-of-pairs", "id long", "id")
        ids.add(pairs.selectExpr("a AS id").unionByName(pairs.selectExpr("b AS id")).distinct())
        for part in passes:
            words.add(sets.rows(part).select("id", "words").join(ids.rows(part), "id", "left_semi"))
        ids.drop()
        links = Slices(self.spark, "links", "a long, b long", "a")
        for part in Slices.passes(pairs.count(), self.s.per_pass):
            # Both joins read the same shuffle of the words if one pass is enough.
            links.add(self._similar(distinct.rows(part), words.rows()))
        distinct.drop()
        words.drop()
        return links.rows()

    def _similar(self, pairs: DataFrame, words: DataFrame) -> DataFrame:
        both = pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a").join(
            words.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b"
        )
        both = both.select("a", "b", F.split("wa", " ").alias("sa"), F.split("wb", " ").alias("sb"))
        shared = F.size(F.array_intersect("sa", "sb"))
        return both.where(
            shared / (F.size("sa") + F.size("sb") - shared) >= F.lit(self.s.similarity) - F.lit(EPS)
        ).select("a", "b")


def _rows(keys: DataFrame, part: list[int]) -> DataFrame:
    """A row for each key of these slices."""
    each = F.explode(F.concat(*(f"k{i}" for i in part))).alias("k")
    return keys.select("id", "n", "sketch", each).select("k.key", "id", "n", "k.at", "sketch")


def _in_order(pairs: DataFrame) -> DataFrame:
    """The distinct pairs in one order, as a pair can be found both ways."""
    return pairs.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
