"""Similarity operators: Jaccard guard and nearest neighbour, and exact order-aware fuzzy deduplication."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasaq.functions.components import components
from nasaq.functions.text import tokens
from nasaq.session import checkpointed, spread, stored


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if one of them is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def unlike_seeds(items: DataFrame, seeds: list[str], text: str, most: float = 0.7) -> DataFrame:
    """Items whose words have no Jaccard similarity above ``most`` (strict) with any seed text.

    Seeds are few (a seed set has at most ten), so they are literals of one filter:
    no join, no shuffle. Null texts have no words and are kept.
    """
    if not seeds:
        return items
    sets = F.array(*[tokens(F.lit(s)) for s in seeds])
    own = F.coalesce(tokens(text), F.array().cast("array<string>"))
    # The one-element array binds the words, so that they are split once for all seeds.
    return items.where(~F.exists(F.array(own), lambda o: F.exists(sets, lambda s: jaccard(o, s) > F.lit(most))))


def nearest(items: DataFrame, key: str, text: str, real: DataFrame, real_text: str, block: int = 20_000, at_once: int = 8) -> DataFrame:
    """Rows (key, overlap): the largest Jaccard similarity of each item's words with any real text.

    Real texts are taken in blocks of bounded size, each broadcast as an inverted
    index of word numbers; items stream past it without a shuffle, ``at_once`` indexes
    in one pass. An item reads the lists of its words from the rarest on, and stops
    when no text outside the lists so far can be nearer than the best one found. A
    row without words, or null, has 0; so has every row if there are no real texts.
    """
    spark = items.sparkSession
    real = real.select(F.sort_array(F.array_distinct(tokens(real_text))).alias("words")).where(F.size("words") > 0).distinct()
    n_blocks = max(1, -(-real.count() // block))
    out = items.select(key, F.array_distinct(tokens(text)).alias("words"), F.lit(0.0).alias("overlap"))
    kind = items.schema[key].dataType.simpleString()
    for b in range(n_blocks):
        rows = real.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == b).collect()
        index: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            for w in r.words:
                index.setdefault(w, []).append(i)
        shared = spark.sparkContext.broadcast(
            ({w: np.array(x, np.int32) for w, x in index.items()}, np.array([len(r.words) for r in rows], np.int64))
        )
        out = out.mapInArrow(_nearest_in(shared), f"`{key}` {kind}, words array<string>, overlap double")
        if b + 1 < n_blocks and (b + 1) % at_once == 0:
            out = checkpointed(out)
    return out.select(key, "overlap")


def _nearest_in(shared):
    def one(index: dict, sizes: np.ndarray, words: list[str], best: float) -> float:
        n = len(words)
        lists = sorted((index[w] for w in words if w in index), key=len)
        read, looked = 0, 1
        while read < len(lists):
            # A text in none of the lists read holds at most the words that are left.
            if best >= (len(lists) - read) / n:
                break
            read = min(len(lists), read + looked)
            looked *= 2
            ids, held = np.unique(np.concatenate(lists[:read]), return_counts=True)
            best = max(best, float((held / (n + sizes[ids] - held)).max()))
        if 0 < read < len(lists):
            # Those that were met may hold words of the lists that weren't read.
            most = held + len(lists) - read
            open_ids = ids[most / np.maximum(n + sizes[ids] - most, 1) > best]
            if len(open_ids):
                all_held = sum((np.isin(open_ids, x, assume_unique=True) for x in lists), np.zeros(len(open_ids), np.int64))
                best = max(best, float((all_held / (n + sizes[open_ids] - all_held)).max()))
        return best

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sizes = shared.value
        for batch in batches:
            best = [one(index, sizes, w, x) if w else x for w, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.float64())], names=batch.schema.names)

    return run


def most_edits(longer: int, threshold: float) -> int:
    """Of two texts that are similar, by the length of the longer one."""
    return math.floor((1 - threshold) * longer + 1e-9)


#: Bits of the sketch of a text, and 64-bit words of it.
BITS = 4096
WORDS = BITS // 64


def _edits(n: np.ndarray, threshold: float) -> np.ndarray:
    return np.floor((1 - threshold) * n + 1e-9).astype(np.int64)


def _longest(n: np.ndarray, threshold: float) -> np.ndarray:
    """The length of the longest text that can be similar to one of n characters."""
    return np.floor(n / threshold + 1e-9).astype(np.int64)


def _bucket(n: np.ndarray, threshold: float) -> np.ndarray:
    """Numbers of buckets of lengths, whose ends grow by a factor; a text and a similar one are in the same or neighbouring ones, mostly."""
    return np.floor(np.log(n) / math.log(1 + 2 * (1 - threshold))).astype(np.int64) if threshold < 1 else n


def _width(bucket: int, threshold: float, spare: float) -> int:
    """The words of a sketch in a bucket of lengths: a power of two."""
    edits = most_edits(math.floor((1 + 2 * (1 - threshold)) ** (bucket + 1)), threshold)
    return min(WORDS, 2 ** max(0, round(math.log2(max(1.0, 10 * (1 + spare) * edits / 64)))))


def _sketches(texts: list[str]) -> np.ndarray:
    """Rows of WORDS words: each pair of neighbouring characters, with the number of equal pairs before it, flips one bit.

    Without that number, what a text says twice (a prompt and its correction, say) would cancel out.
    """
    out = np.zeros((len(texts), WORDS), np.uint64)
    for first in range(0, len(texts), 500):
        part = texts[first : first + 500]
        points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        row = np.repeat(np.arange(len(part)), [len(t) for t in part])
        inside = row[:-1] == row[1:]
        # A text, of which there are 500 at most, and two characters, of 21 bits each.
        pair = (row[:-1].astype(np.uint64) << np.uint64(42) | points[:-1] << np.uint64(21) | points[1:])[inside]
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        place = np.arange(len(pair))
        before = place - np.maximum.accumulate(np.where(np.r_[True, ranked[1:] != ranked[:-1]][: len(pair)], place, 0))
        two = ((ranked & np.uint64((1 << 42) - 1)) + before.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
        at = (ranked >> np.uint64(42)).astype(np.int64) * BITS + ((two ^ (two >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(part) * BITS) & 1).astype(np.uint8)
        out[first : first + len(part)] = np.packbits(odd).view(np.uint64).reshape(len(part), WORDS)
    return out


def _distances(sketches: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.bitwise_count(sketches ^ p).sum(axis=1, dtype=np.int32) for p in pivots], axis=1)


def _members(far: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the nearest pivot of each text, whether it is in the cell of each pivot).

    Of two texts whose sketches differ in ``most`` bits at most, with nearest pivots
    P < Q, the second is no more than twice as many bits farther from P than from Q
    (triangle inequality); so it is put into the cell of P too, and they meet there.
    """
    home = far.argmin(axis=1)
    own = np.arange(far.shape[1]) == home[:, None]
    near = far <= (far[np.arange(len(far)), home] + 2 * most)[:, None]
    return home, own | (near & (np.arange(far.shape[1]) < home[:, None]))


def _pivots(sketches: np.ndarray, most: np.ndarray, at_most: int = 128, copies: float = 3.0) -> np.ndarray:
    """Some of the sketches, far from each other, so many that comparing cells costs least. They decide on the cost alone, never on the pairs."""
    chosen, far = [0], _distances(sketches, sketches[:1])
    while len(chosen) < min(at_most, len(sketches)) and far.min(axis=1).max() > 0:
        chosen.append(int(far.min(axis=1).argmax()))
        far = np.concatenate([far, _distances(sketches, sketches[chosen[-1:]])], axis=1)
    best, least = 1, math.inf
    for n in range(1, len(chosen) + 1):
        home, member = _members(far[:, :n], most)
        own = np.bincount(home, minlength=n)
        cost = float((own * member.sum(axis=0)).sum())
        if cost < least and member.sum() <= copies * len(sketches):
            best, least = n, cost
    return sketches[chosen[:best]]


PLACED = "cell long, ix long, n int, far int, own boolean, short boolean, sketch binary"


def _placed(pivots: np.ndarray, threshold: float, spare: float):
    """The copies of each (ix, s) in cells: of its pivots, and of the buckets of all lengths that a similar text that isn't longer can have."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = np.array([len(t) for t in texts], np.int64)
            whole, most = _sketches(texts), 4 * _edits(_longest(n, threshold), threshold)
            far = _distances(whole, pivots)
            home, member = _members(far, most)
            member[most == 0] = False  # only equal texts are similar to these
            row, pivot = np.nonzero(member)
            low, high = _bucket(np.maximum(1, n - _edits(n, threshold)), threshold), _bucket(np.maximum(1, n), threshold)
            many = (high - low + 1)[row]
            bucket = np.repeat(low[row], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row, pivot = np.repeat(row, many), np.repeat(pivot, many)
            sketch: list[bytes] = [b""] * len(row)
            for b in np.unique(bucket).tolist():
                at, w = np.flatnonzero(bucket == b), min(WORDS, 2 * _width(b, threshold, spare))
                data = np.bitwise_xor.reduce(whole[row[at]].reshape(len(at), WORDS // w, w), axis=1).tobytes()
                for i, k in enumerate(at.tolist()):
                    sketch[k] = data[i * 8 * w : (i + 1) * 8 * w]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            columns = [
                pa.array(bucket * 1000 + pivot), pa.array(ids[row]), pa.array(n[row].astype(np.int32)), pa.array(far[row, pivot].astype(np.int32)),
                pa.array(home[row] == pivot), pa.array(bucket == high[row]), pa.array(sketch, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "ix", "n", "far", "own", "short", "sketch"])

    return run


def _bytes_of(column: pa.Array) -> np.ndarray:
    """The bytes of a column of binaries, one after another, without a Python object for each."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]


def _compared(threshold: float, tile: int = 32, wide: int = 1024):
    """Pairs (a, b) of a cell whose lengths and sketches allow similarity: a shorter text of the cell's bucket with one that isn't shorter.

    Of a large cell, pairs of its blocks ``low`` and ``high``.
    """

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_numpy() for c in ("ix", "n", "far", "own", "short", "block")}
        order = np.lexsort((columns["ix"], columns["n"]))
        ix, n, far, own, short, block = (columns[c][order] for c in ("ix", "n", "far", "own", "short", "block"))
        n, far = n.astype(np.int64), far.astype(np.int64)
        words = np.concatenate([_bytes_of(c) for c in table.column("sketch").chunks]).view(np.uint64).reshape(len(ix), -1)[order]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        sides = [(block == low, block == high)] if low == high else [(block == low, block == high), (block == high, block == low)]
        # All pairs are compared by sketches folded once, and by the whole ones what these allow.
        half = max(1, words.shape[1] // 2)
        by_word = np.ascontiguousarray((words[:, :half] ^ words[:, half:] if words.shape[1] > 1 else words).T)
        edits = _edits(n, threshold)
        longest = _longest(n, threshold)
        buffers = [np.zeros(tile * wide, kind) for kind in (np.uint64, np.uint8, np.uint8, np.uint16)]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        runs = [pair for mine, other in sides for pair in ((short & own & mine, other), (short & ~own & mine, own & other))]
        for shorts, among in (map(np.flatnonzero, pair) for pair in runs):
            for first in range(0, len(shorts), tile):
                a = shorts[first : first + tile]
                b = among[(among > a[0]) & (among < np.searchsorted(n, longest[a[-1]], "right"))]
                b = b[(far[b] <= far[a].max() + 4 * edits[b]) & (far[b] >= far[a].min() - 4 * edits[b])]
                for at in range(0, len(b), wide):
                    c = b[at : at + wide]
                    most = int(4 * edits[c[-1]])
                    # A sum that runs over is a false candidate; that of a similar pair doesn't, as it is ``most`` at most.
                    xor, ones, differ = (x[: len(a) * len(c)].reshape(len(a), len(c)) for x in (buffers[0], buffers[1], buffers[2 if most < 256 else 3]))
                    for k, w in enumerate(by_word):
                        np.bitwise_xor(w[a][:, None], w[c][None, :], out=xor)
                        if k:
                            np.add(differ, np.bitwise_count(xor, out=ones), out=differ)
                        else:
                            np.bitwise_count(xor, out=differ)
                    i, j = np.divmod(np.flatnonzero(differ <= differ.dtype.type(min(most, 65535))), len(c))
                    i, j = a[i], c[j]
                    apart = n[j] - n[i]
                    ok = (i < j) & (apart <= edits[j])
                    i, j, apart = i[ok], j[ok], apart[ok]
                    # An edit takes two pairs of characters away and adds two; one that changes the length one less.
                    ok = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64) <= 4 * edits[j] - apart
                    found.append((ix[i[ok]], ix[j[ok]]))
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ((), ())))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def similar_pairs(rows: DataFrame, threshold: float = 0.93, spare: float = 1.5, per_cell: int = 100_000) -> DataFrame:
    """Pairs (a, b), a < b, of (ix long unique, s string distinct) with normalised Levenshtein similarity of at least ``threshold``.

    The sketch of a text is the parity of its pairs of neighbouring characters by
    hash; an edit changes four bits at most, so sketches of similar texts differ in few.
    Texts are put into cells by length and by the nearest of some pivots, and into
    those of other pivots where the triangle inequality allows a similar text there
    (published idea: Das Sarma et al., "ClusterJoin", PVLDB 2014). In a cell, whole
    blocks of sketches are compared at once; what they allow is compared by the
    capped Levenshtein distance in double arithmetic. No pair is lost. A text moves in a
    few copies of its sketch, which has ``spare`` more bits than the least useful
    number; a cell of more than ``per_cell`` rows (fewer, if their sketches are long) is
    split into blocks of as many, and a task has two blocks at most. The empty text is
    similar to itself alone.
    """
    return _similar_pairs(stored(rows.select("ix", "s").where("length(s) > 0"), "texts"), threshold, spare, per_cell)


def _similar_pairs(rows: DataFrame, threshold: float, spare: float = 1.5, per_cell: int = 100_000) -> DataFrame:
    """The same of rows that are cheap to read again."""
    spark = rows.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    part = F.pmod(F.xxhash64("ix", F.lit("pivot")), F.lit(1_000_000)) / 1_000_000.0
    few = rows.where(part < 2_000 / max(1, rows.count())).mapInArrow(_sketched, "n int, sketch binary").collect()
    if few:
        n = np.array([r.n for r in few], np.int64)
        pivots = _pivots(np.frombuffer(b"".join(bytes(r.sketch) for r in few), np.uint64).reshape(len(few), WORDS), 4 * _edits(_longest(n, threshold), threshold))
    else:
        pivots = np.zeros((1, WORDS), np.uint64)
    placed = stored(rows.mapInArrow(_placed(pivots, threshold, spare), PLACED), "cells")
    cells = placed.groupBy("cell").agg(F.sum(F.greatest(F.lit(1.0), F.length("sketch") / 64.0)).alias("rows"))
    # There are as many cells at most as pivots and buckets of lengths, at any number of rows.
    parts = cells.where(F.col("rows") > per_cell).select("cell", F.ceil(F.col("rows") / per_cell).cast("int").alias("parts"))
    placed = placed.join(F.broadcast(parts), "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("ix", F.lit("block")), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("parts", "other")
    on = ["cell", "low", "high"]
    met = placed.repartition(8 * tasks, *on).groupBy(*on).applyInArrow(_compared(threshold), "a long, b long")
    pairs = spread(met, F.lit(1), 5_000)
    both = pairs.join(rows.select(F.col("ix").alias("a"), F.col("s").alias("sa")), "a").join(rows.select(F.col("ix").alias("b"), F.col("s").alias("sb")), "b")
    # A cap that depends on the row needs the SQL form.
    both = both.repartition(pairs.rdd.getNumPartitions()).withColumn("m", F.greatest(F.length("sa"), F.length("sb"))).withColumn("d", F.expr(f"levenshtein(sa, sb, CAST(ceil({1 - threshold!r}D * m) AS INT) + 1)"))
    return both.where((F.col("d") >= 0) & (1.0 - F.col("d") / F.col("m").cast("double") >= F.lit(threshold))).select("a", "b")


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        n = pa.array([len(t) for t in texts], pa.int32())
        yield pa.RecordBatch.from_arrays([n, pa.array([x.tobytes() for x in _sketches(texts)], pa.binary())], names=["n", "sketch"])


def _drops_of(links: Iterable[tuple[int, int]]) -> list[int]:
    """The ids that the sequential rule drops, over links (a, b) with a < b."""
    earlier: dict[int, list[int]] = {}
    for a, b in links:
        earlier.setdefault(b, []).append(a)
    dropped: set[int] = set()
    for b in sorted(earlier):
        if any(a not in dropped for a in earlier[b]):
            dropped.add(b)
    return sorted(dropped)


def first_kept(pairs: DataFrame, most_links: int = 200_000, most_rounds: int = 10_000) -> DataFrame:
    """Ids (ix) that the sequential rule drops: an id is dropped if an earlier kept one is similar to it.

    The rule is decided inside connected components. Components of at most
    ``most_links`` links are hashed into tasks of about as many links; larger ones are
    decided together in rounds, which stay distributed: a round decides every id whose
    earlier neighbours are decided, so they take as many rounds as the longest chain
    of similar ids. More rounds than ``most_rounds`` are an error, never a partial result.
    """
    pairs = checkpointed(pairs.where("a < b").select("a", "b").distinct())
    roots = components(pairs)
    sizes = pairs.join(roots.select(F.col("id").alias("a"), "root"), "a").groupBy("root").agg(F.count(F.lit(1)).alias("links"))
    rooted = checkpointed(pairs.join(roots.select(F.col("id").alias("a"), "root"), "a").join(sizes, "root"))
    small = rooted.where(F.col("links") <= most_links)
    tasks = -(-small.count() // most_links) or 1

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ix": _drops_of(zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True))}, dtype="int64")

    dropped = small.groupBy(F.pmod(F.xxhash64("root"), F.lit(tasks)).alias("t")).applyInPandas(decide, "ix long")
    edges = checkpointed(rooted.where(F.col("links") > most_links).select("a", "b"))
    rounds = 0
    while not edges.isEmpty():
        if rounds == most_rounds:
            raise RuntimeError(f"similar ids did not settle in {most_rounds} rounds")
        rounds += 1
        # An id without an undecided earlier neighbour is kept; its later neighbours are dropped, with their links.
        keep = edges.selectExpr("a AS ix").distinct().join(edges.selectExpr("b AS ix").distinct(), "ix", "left_anti")
        drop = checkpointed(edges.join(keep.selectExpr("ix AS a"), "a", "left_semi").selectExpr("b AS ix").distinct())
        dropped = dropped.unionByName(drop)
        edges = edges.join(drop.selectExpr("ix AS a"), "a", "left_anti")
        edges = checkpointed(edges.join(drop.selectExpr("ix AS b"), "b", "left_anti"))
    return dropped


def fuzzy_keep(rows: DataFrame, order: str, text: str, threshold: float = 0.93) -> DataFrame:
    """Rows without those that are similar to an earlier kept row, by the unique long column ``order``.

    Equal texts collapse first (an equal later row is always dropped). Null texts
    count as the empty text. Extra columns ride along.
    """
    ranked = rows.withColumn("_s", F.coalesce(text, F.lit("")))
    firsts = stored(ranked.groupBy("_s").agg(F.min(order).alias("ix")).select("ix", F.col("_s").alias("s")), "firsts")
    dropped = first_kept(_similar_pairs(firsts.where("length(s) > 0"), threshold))
    keep = firsts.select("ix").join(dropped, "ix", "left_anti").withColumnRenamed("ix", order)
    return rows.join(keep, order, "left_semi")
