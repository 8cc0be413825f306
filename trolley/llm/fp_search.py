"""Ranked lexical search over a document FP-tree, branch and bound per item.

Documents are read once: each text becomes a vector of the terms that occur in some item (term number, tf) beside its
number of terms, written as a table.  N, L and the document frequencies are counted over all of it.

A task holds its documents in blocks of ``BLOCK`` vectors.  Terms are put in order of falling frequency, the vectors
are sorted by their term sequences, and documents with a common opening share a path of the tree.  A path without a
branch is one edge, and below ``LEAF`` documents a subtree is a leaf that lists them.  Every node keeps, for each term
of its subtree, the highest tf, and the lowest m.  As a term's part of the score grows with tf and falls with m, the sum
over an item's terms of the part at (highest tf, lowest m) bounds every document below the node.

For an item the search goes down the child with the highest bound first and leaves out each subtree whose bound is
below the item's tenth score so far; an equal bound is searched, as a smaller doc_id may win the tie.  The tenth score
goes on from block to block of a task.  Documents with equal vectors and m are one entry with its ``k`` first doc_ids.
Each task returns its best ``k`` an item; a ranked window picks the best ``k`` of all tasks.

The items are cut into groups of about ``GROUP_TERMS`` (item, term) pairs, one run a group, so what is broadcast (8
bytes a term, 4 a pair) has a fixed bound however many items there are.  Terms are 64-bit hashes (the chance that a
term of V items' terms meets another of T document terms is V * T / 2 ** 64).

Results for odd rows: a null or empty text has no terms, counts nowhere and matches nothing; repeated rows are
documents of their own; a null doc_id ranks after all others of its score; rows of one item_id (null too) are one item
with the terms of all of them; an item without a match has no row; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.common import _POWERS, Scratch, mix, pick, pieces, utf8

BLOCK = 16_384
LEAF = 128
GROUP_TERMS = 2_000_000
LAST = np.iinfo(np.int64).max

# The separators of the contract's term pattern; every other byte belongs to a term.
_SEPARATOR = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _SEPARATOR[_low:_high + 1] = True
_BYTE = np.arange(256, dtype=np.uint64) + np.uint64(1)
_BYTE[65:91] += np.uint64(32)
_BYTE[_SEPARATOR] = 0


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms (A-Z lower-cased) and the offsets of each text's terms."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~_SEPARATOR[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    firsts = off[:-1][off[:-1] < off[1:]]
    start[firsts] = inside[firsts]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    powers, inverse = _POWERS.upto(len(data))
    return mix(np.add.reduceat(_BYTE[data] * powers[:len(data)], at) * inverse[at]), np.searchsorted(at, off)


# ------------------------------------------------------------------ vectors

def _hashes(items: DataFrame) -> DataFrame:
    """(item, hash): the distinct terms of each item."""
    schema = T.StructType([items.schema["item"].__class__("item", items.schema["item"].dataType), T.StructField("hash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(1))
            for i, j in pieces(off):
                h, at = terms(data[off[i]:off[j]], off[i:j + 1] - off[i])
                rows = pa.array(np.repeat(np.arange(i, j), np.diff(at)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(h.view(np.int64))], names=["item", "hash"])

    return items.mapInArrow(run, schema).distinct()


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc, n, term, tf): every document with a term: its number of terms, and its vocabulary terms' numbers
    (ascending) with their counts.  ``vocabulary`` holds the terms' hashes in ascending order."""
    schema = T.StructType([T.StructField("doc", docs.schema["doc"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, off = utf8(batch.column(1))
            for i, j in pieces(off):
                h, at = terms(data[off[i]:off[j]], off[i:j + 1] - off[i])
                n = np.diff(at)
                where = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = np.flatnonzero(known[where] == h) if len(known) else np.zeros(0, np.int64)
                pair, tf = np.unique(np.repeat(np.arange(j - i), n)[hit] * len(known) + where[hit], return_counts=True)
                row = pair // max(len(known), 1)
                keep = np.flatnonzero(n > 0)
                bounds = pa.array(np.searchsorted(row, np.append(keep, j - i)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(i + keep)), pa.array(n[keep]),
                     pa.ListArray.from_arrays(bounds, pa.array(pair % max(len(known), 1), pa.int32())),
                     pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int32()))], names=["doc", "n", "term", "tf"])

    return docs.mapInArrow(run, schema)


# ------------------------------------------------------------------ tree

def part(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Tree:
    """The FP-tree of a block.  Nodes are numbered so that a node's children follow each other; the entries (distinct
    vectors) come first.  ``child[x]`` is the first child and the end; ``ptr[x]`` bounds the node's terms and tf."""

    def __init__(self, term: np.ndarray, tf: np.ndarray, starts: np.ndarray, m: np.ndarray, docs: list[list[int]]):
        """term: numbers in the order of falling frequency, ascending within each vector."""
        size = np.diff(starts)
        keys = [term[a:b].astype(">i4").tobytes() for a, b in zip(starts[:-1], starts[1:])]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys = [keys[i] for i in order]
        self.docs = [docs[i] for i in order]
        order = np.array(order, np.int64)
        size = size[order]
        ends = np.cumsum(size)
        at = np.repeat(starts[:-1][order] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        shared = np.array([_common(a, b) for a, b in zip(keys[:-1], keys[1:])], np.int64)  # terms shared with the next entry
        n = len(order)
        # inner nodes are ranges of the sorted entries, found from the root down
        ranges, kids = [(0, n)], {}
        for x, (low, high) in enumerate(ranges):
            if high - low <= LEAF:
                continue
            gaps = shared[low:high - 1]
            cuts = low + 1 + np.flatnonzero(gaps == gaps.min())
            edges = [low, *cuts.tolist(), high]
            if gaps.min() == gaps.max():  # nothing shared further down: entries side by side, in runs of a leaf's size
                edges = [*range(low, high, max(LEAF, math.isqrt(high - low))), high]
            kids[x] = (len(ranges), len(ranges) + len(edges) - 1)
            ranges += zip(edges[:-1], edges[1:])
        self.root = n
        self.child = np.zeros((n + len(ranges), 2), np.int64)
        low_m = np.zeros(n + len(ranges), np.int64)
        low_m[:n] = m[order]
        tables: list = [None] * len(ranges)
        term, tf = term[at], tf[at]
        bounds = np.concatenate([[0], ends])
        for x in range(len(ranges) - 1, -1, -1):
            low, high = ranges[x]
            if x in kids:
                a, b = kids[x]
                self.child[n + x] = (n + a, n + b)
                t, f = np.concatenate([tables[y][0] for y in range(a, b)]), np.concatenate([tables[y][1] for y in range(a, b)])
                low_m[n + x] = low_m[n + a:n + b].min()
            else:
                self.child[n + x] = (low, high)
                t, f = term[bounds[low]:bounds[high]], tf[bounds[low]:bounds[high]]
                low_m[n + x] = low_m[low:high].min() if high > low else 1
            by = np.argsort(t, kind="stable")
            t, f = t[by], f[by]
            first = np.flatnonzero(np.diff(t, prepend=-1))
            tables[x] = (t[first], np.maximum.reduceat(f, first) if len(f) else f)
        self.m = low_m
        self.term = np.concatenate([term, *[t for t, _ in tables]])
        self.tf = np.concatenate([tf, *[f for _, f in tables]]).astype(np.int64)
        self.ptr = np.concatenate([bounds, bounds[-1] + np.cumsum([len(t) for t, _ in tables])]).astype(np.int64)

    def bounds(self, low: int, high: int, weight: np.ndarray) -> np.ndarray:
        """For the nodes low..high - 1: the highest score of a document below it, for an entry its own score."""
        a, b = self.ptr[low], self.ptr[high]
        w = weight[self.term[a:b]]
        hit = np.flatnonzero(w)
        node = np.searchsorted(self.ptr[low:high + 1], a + hit, "right") - 1
        sums = np.zeros(high - low, np.int64)
        np.add.at(sums, node, part(w[hit], self.tf[a + hit], self.m[low + node]))
        return sums

    def search(self, weight: np.ndarray, best: Best) -> None:
        """Puts the documents into ``best`` that belong there.  weight: by term, 0 for terms the item lacks."""
        stack = [(int(self.bounds(self.root, self.root + 1, weight)[0]), self.root)]
        while stack:
            bound, x = stack.pop()
            if bound <= 0 or bound < best.least:
                continue
            low, high = self.child[x].tolist()
            sums = self.bounds(low, high, weight)
            good = np.flatnonzero((sums > 0) & (sums >= best.least))
            good = good[np.argsort(sums[good], kind="stable")]
            if low < self.root:
                for i in good[::-1].tolist():
                    best.add(int(sums[i]), self.docs[low + i])
            else:
                stack += [(int(sums[i]), low + i) for i in good.tolist()]  # the highest bound is popped first


def _common(a: bytes, b: bytes) -> int:
    """Number of four-byte terms that two sequences share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // 4
    return int(np.argmax(np.frombuffer(a[:n], np.int32) != np.frombuffer(b[:n], np.int32)))


class Best:
    """The k highest (score, smallest doc) met so far; ``least``: a lower score can't get in any more."""

    def __init__(self, k: int):
        self.k, self.heap, self.least = k, [], 0

    def add(self, score: int, docs: list[int]) -> None:
        for d in docs:
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, (score, -d))
            elif (score, -d) > self.heap[0]:
                heapq.heapreplace(self.heap, (score, -d))
            else:
                break
        if len(self.heap) == self.k:
            self.least = self.heap[0][0]


@dataclass
class Items:
    """Terms of a group of items: numbers by falling frequency in the whole corpus, with their weights."""

    order: np.ndarray  # vocabulary number -> number by frequency
    weight: np.ndarray  # by number by frequency
    term: np.ndarray  # numbers by frequency, item after item
    starts: np.ndarray


def _block(rows: list[pa.RecordBatch], items: Items, docs: int, total: int, k: int) -> Tree:
    """The tree of one block; equal vectors with equal m are one entry with its first ``k`` documents."""
    ids = np.concatenate([b.column(0).fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64) for b in rows])
    n = np.concatenate([b.column(1).to_numpy() for b in rows])
    size = np.concatenate([b.column(2).value_lengths().to_numpy() for b in rows]).astype(np.int64)
    term = items.order[np.concatenate([b.column(2).flatten().to_numpy() for b in rows])]
    tf = np.concatenate([b.column(3).flatten().to_numpy() for b in rows]).astype(np.int64)
    m = 10 + np.array([90 * int(x) * docs // total for x in n], np.int64)
    row = np.repeat(np.arange(len(size)), size)
    by = np.lexsort((term, row))
    term, tf = term[by], tf[by]
    ends = np.cumsum(size)
    entries: dict[tuple, list[int]] = {}
    where = []
    for i, (a, b) in enumerate(zip((ends - size).tolist(), ends.tolist())):
        if a == b:
            continue  # no term of any item
        same = entries.get(key := (term[a:b].tobytes(), tf[a:b].tobytes(), int(m[i])))
        if same is None:
            entries[key] = [int(ids[i])]
            where.append(i)
        elif len(same) < k or ids[i] < same[-1]:
            same.append(int(ids[i]))
            same.sort()
            del same[k:]
    where = np.array(where, np.int64)
    size = size[where]
    stops = np.cumsum(size)
    at = np.repeat((ends[where] - size) - (stops - size), size) + np.arange(stops[-1] if len(stops) else 0)
    return Tree(term[at], tf[at], np.concatenate([[0], stops]), m[where], list(entries.values()))


def _searched(found: DataFrame, items: Items, docs: int, total: int, k: int, block: int) -> DataFrame:
    """(item, doc, score): each task's best ``k`` documents of every item."""
    shared = found.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        best = [Best(k) for _ in range(len(group.starts) - 1)]
        weight = np.zeros(len(group.weight), np.int64)

        def search(rows: list[pa.RecordBatch]) -> None:
            tree = _block(rows, group, docs, total, k)
            for i, b in enumerate(best):
                own = group.term[group.starts[i]:group.starts[i + 1]]
                weight[own] = group.weight[own]
                tree.search(weight, b)
                weight[own] = 0

        rows, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                piece = batch.slice(at, block)
                if held and held + piece.num_rows > block:
                    search(rows)
                    rows, held = [], 0
                rows.append(piece)
                held += piece.num_rows
        if held:
            search(rows)
        out = [(i, None if -d == LAST else -d, s) for i, b in enumerate(best) for s, d in b.heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc", "score"])

    return found.mapInArrow(run, "item int, doc bigint, score bigint")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK, group_terms: int = GROUP_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "fp-search")
    docs = pick(docs, doc=id_col, text=text_col)
    wanted = scratch.table(_hashes(pick(items, item=item_col, text=item_text_col)))
    groups = max(1, -(-wanted.count() // group_terms))
    out = None
    for g in range(groups):
        here = wanted.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g) if groups > 1 else wanted
        by_item = here.groupBy("item").agg(F.collect_list("hash").alias("hashes")).collect()  # bounded by group_terms
        by_item.sort(key=lambda r: (r.item is None, r.item))
        pairs = np.array([h for r in by_item for h in r.hashes], np.int64).view(np.uint64)
        vocabulary = np.unique(pairs)
        found = scratch.table(vectors(docs, vocabulary))
        n_docs, total = found.agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not len(pairs):
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in found.select(F.explode("term").alias("t")).groupBy("t").count().toLocalIterator():  # one row a term
            df[r["t"]] = r["count"]
        order = np.empty(len(df), np.int32)
        order[np.argsort(-df, kind="stable")] = np.arange(len(df))
        weight = np.zeros(len(df), np.int64)
        weight[order] = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df]
        sizes = [len(r.hashes) for r in by_item]
        group = Items(order, weight, order[np.searchsorted(vocabulary, pairs)], np.concatenate([[0], np.cumsum(sizes)]))
        names = spark.createDataFrame([(i, r.item) for i, r in enumerate(by_item)], T.StructType(
            [T.StructField("item", T.IntegerType()), T.StructField(item_col, items.schema[item_col].dataType)]))
        best = _searched(found, group, n_docs, total, k, block)
        top = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
        done = scratch.table(best.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).join(names, "item").select(
            item_col, "rank", F.col("doc").cast(docs.schema["doc"].dataType).alias(id_col), "score"))
        out = done if out is None else out.unionByName(done)
    if out is None:
        kinds = f"{item_col} {items.schema[item_col].dataType.simpleString()}, rank int, {id_col} {docs.schema['doc'].dataType.simpleString()}, score bigint"
        return spark.createDataFrame([], kinds)
    return out
