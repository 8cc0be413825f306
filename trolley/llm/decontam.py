"""Benchmark decontamination: a BM25 index of the test items, searched with block-max WAND.

Document frequencies, the mean length and the longest item are counted once over all test items, by Spark.  The
items are then dealt into index shards of at most ``SHARD_BYTES`` of text (a pass over the corpus for each shard;
one pass for any usual benchmark), so what a task holds is bounded and no score depends on the shards.
A shard is an inverted index: for each term the items that contain it, in blocks with the block's largest
impact.  Impacts are BM25 weights divided by the item's own total, so a score of 1 means that a passage holds
all of an item's words, and one threshold serves items of any length.

Passages are overlapping windows of a whole text, twice as long as the longest item, so an item that was
pasted into a text lies whole within one.  Every passage is a query of a block-max WAND search, which returns
all items at or above the threshold (``Index.retrieve``); items are in blocks of like length.  The passages of a
piece of text make their rounds together.  A retrieved item is confirmed if both its question (all but the
last sentence; of a single sentence the first two thirds) and its answer (the rest) have enough of their word
trigrams in the passage.

Defined results: words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased;
null, empty or wordless texts and items have no match; items of fewer than three words need all of them;
equal items are reported each; repeated rows report the same pairs again; null doc_ids and item_ids are
carried; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, mix, pick, pieces, utf8, words

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.6
BLOCK = 8
SHARD_BYTES = 16 << 20
SHORTEST_PASSAGE = 64

_PLAIN = np.zeros(256, bool)
_PLAIN[:128] = True
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, wo, _ = words(np.where(_PLAIN[data], np.uint8(32), data), off)
    return h, wo


def trigrams(h: np.ndarray) -> np.ndarray:
    """Hashes of the distinct trigrams; of fewer than three words, the words."""
    if len(h) < 3:
        return np.unique(h)
    return np.unique(mix(h[:-2] * np.uint64(3) + mix(h[1:-1] * np.uint64(5) + mix(h[2:]))))


def split_item(text: str) -> tuple[str, str]:
    """(question, answer)."""
    at = [m.end() for m in re.finditer(r"[.!?]\s+", text.rstrip())]
    if at:
        return text[:at[-1]], text[at[-1]:]
    w = text.split()
    cut = max(1, -(-2 * len(w) // 3))
    return " ".join(w[:cut]), " ".join(w[cut:])


class Statistics(NamedTuple):
    """Of all items together: their number (of those with words), words in all, words of the longest, and for a sorted
    array of terms (all that an index holds) the items with each."""

    items: int
    words: int
    longest: int
    terms: np.ndarray
    df: np.ndarray


class Index:
    """Inverted index of one shard of items; weights come from the statistics of all items (by default, of these)."""

    def __init__(self, items: list[tuple[object, str]], of_all: Statistics | None = None):
        self.ids, self.parts, bags = [], [], []
        for item_id, text in items:
            both = [np.frombuffer(x.encode("utf-8", "surrogatepass"), np.uint8) for x in (text, *split_item(text))]
            h, q, a = (tokens(x, np.array([0, len(x)]))[0] for x in both)
            if len(h):
                self.ids.append(item_id)
                self.parts.append((trigrams(q), trigrams(a)))
                bags.append(np.unique(h, return_counts=True))
        order = sorted(range(len(bags)), key=lambda i: int(bags[i][1].sum()))  # blocks of items of like length have tight maxima
        self.ids, self.parts, bags = ([x[i] for i in order] for x in (self.ids, self.parts, bags))
        n = len(bags)
        if of_all is None:
            terms, df = np.unique(np.concatenate([np.zeros(0, np.uint64), *[t for t, _ in bags]]), return_counts=True)
            lengths = [int(c.sum()) for _, c in bags]
            of_all = Statistics(n, sum(lengths), max(lengths, default=0), terms, df)
        self.longest = of_all.longest
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *[t for t, _ in bags]]))
        df = of_all.df[np.searchsorted(of_all.terms, self.terms)]
        idf = np.log1p((of_all.items - df + 0.5) / (df + 0.5))
        mean = of_all.words / max(1, of_all.items)
        post: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for i, (t, c) in enumerate(bags):
            at = np.searchsorted(self.terms, t)
            impact = idf[at] * c * (K1 + 1) / (c + K1 * (1 - B + B * c.sum() / mean))
            for x, w in zip(at.tolist(), (impact / impact.sum()).tolist()):
                post[x].append((i, w))
        self.lists = [(np.array([i for i, _ in p]), np.array([w for _, w in p])) for p in post]
        # the lists end to end, each posting with the largest weight from it to its list's end
        self.post_from = np.concatenate([[0], np.cumsum([len(i) for i, _ in self.lists])]).astype(np.int64)
        self.post_item = np.concatenate([np.zeros(0, np.int64), *[i for i, _ in self.lists]])
        self.post_weight = np.concatenate([np.zeros(0), *[w for _, w in self.lists]])
        self.post_rest = np.concatenate([np.zeros(0), *[np.maximum.accumulate(w[::-1])[::-1] for _, w in self.lists]])
        owner = np.repeat(np.arange(len(self.lists)), np.diff(self.post_from))
        self.items = max(1, n)
        self.post_key = owner * self.items + self.post_item
        # each term's largest weight in each block of items that holds it
        self.blocks = n // BLOCK + 1
        cell = owner * self.blocks + self.post_item // BLOCK
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else cell
        self.cell_key = cell[first]
        self.cell_max = np.maximum.reduceat(self.post_weight, first) if len(cell) else np.zeros(0)

    def block_bound(self, term: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The terms' maxima in the blocks; 0 where a block does not hold the term."""
        key = term * self.blocks + block
        at = np.minimum(np.searchsorted(self.cell_key, key), len(self.cell_key) - 1)
        return np.where(self.cell_key[at] == key, self.cell_max[at], 0.0)

    def retrieve(self, window: np.ndarray, term: np.ndarray, threshold: float | None = None) -> list[tuple[int, list[tuple[int, float]]]]:
        """(window, [(item, score)]) with all scores >= threshold, of distinct (window, term) pairs: block-max WAND.

        Every passage has a cursor in the list of each of its terms.  In a round, each passage's cursors are put in the
        order of their items; its pivot is the first item up to which the largest remaining weights of the lists add up
        to the threshold (no item before it can reach that).  If the maxima of the pivot's block add up too, the pivot
        is scored and passed; if not, the cursors jump to the block's end or the next list's item.  A passage without a
        pivot is done.  All passages make their round together, as array operations over the cursors."""
        least = (THRESHOLD if threshold is None else threshold) - 1e-9
        names, w = np.unique(window, return_inverse=True)
        t, cursor = term.astype(np.int64), self.post_from[term]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(w):
            item = self.post_item[cursor]
            order = np.argsort(w * self.items + item, kind="stable")  # nearly sorted after the first round
            w, t, cursor, item = w[order], t[order], cursor[order], item[order]
            start = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            size = np.diff(np.append(start, len(w)))
            total = np.concatenate([[0.0], np.cumsum(self.post_rest[cursor])])
            reach = total[1:] - np.repeat(total[start], size) >= least - 1e-9
            before = np.add.reduceat(~reach, start, dtype=np.int64)
            going = before < size
            if not going.any():
                break
            keep = np.repeat(going, size)
            w, t, cursor, item = w[keep], t[keep], cursor[keep], item[keep]
            pivot = item[(np.cumsum(np.where(going, size, 0)) - size + before)[going]]
            size = size[going]
            start = np.cumsum(size) - size
            passage = np.repeat(np.arange(len(size)), size)
            front = np.flatnonzero(item <= pivot[passage])
            of = passage[front]
            fronts = np.bincount(of, minlength=len(size))
            deep = np.bincount(of, self.block_bound(t[front], pivot[of] // BLOCK), len(size)) >= least
            behind = np.where(fronts < size, item[np.minimum(start + fronts, len(item) - 1)], self.items)
            to = np.where(deep, pivot, np.minimum((pivot // BLOCK + 1) * BLOCK, behind))
            end = self.post_from[t[front] + 1]
            at = np.minimum(np.searchsorted(self.post_key, t[front] * self.items + np.minimum(to[of], self.items - 1)), end)
            at = np.where(to[of] >= self.items, end, at)
            here = deep[of] & (at < end)
            here[here] = self.post_item[at[here]] == pivot[of[here]]
            score = np.bincount(of[here], self.post_weight[at[here]], len(size))
            hit = np.flatnonzero(deep & (score >= least))
            if len(hit):
                found.append((w[start[hit]], pivot[hit], np.minimum(score[hit], 1.0)))
            cursor[front] = at + here
            alive = cursor < self.post_from[t + 1]
            w, t, cursor = w[alive], t[alive], cursor[alive]
        out: dict[int, list[tuple[int, float]]] = {}
        for passages, items, scores in found:
            for p, i, x in zip(names[passages].tolist(), items.tolist(), scores.tolist()):
                out.setdefault(p, []).append((i, x))
        return sorted(out.items())

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (item, score) with score >= threshold for one query of distinct terms."""
        one = self.retrieve(np.zeros(len(terms), np.int64), np.array(terms, np.int64), threshold)
        return one[0][1] if one else []

    def matches(self, h: np.ndarray, off: np.ndarray) -> list[tuple[int, int, float, float, float, int]]:
        """(text, item, best score, question overlap, answer overlap, passages) of confirmed matches."""
        if not len(self.terms):
            return []
        half = max(SHORTEST_PASSAGE, self.longest)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == h)
        if not len(hit):
            return []
        text = np.searchsorted(off, hit, "right") - 1
        step = (hit - off[text]) // half
        steps = np.concatenate([[0], np.cumsum(-(-np.diff(off) // half) + 1)])  # a window starts at each step; one before the first
        window = steps[text] + step
        size = np.int64(len(self.terms))
        key = np.unique(np.concatenate([window * size + at[hit], (window + 1) * size + at[hit]]))  # window w covers steps w - 1 and w
        w = key // size
        term = key % size
        best: dict[tuple[int, int], list] = {}
        for k, found in self.retrieve(w, term):
            d = int(np.searchsorted(steps, k, "right") - 1)
            step = int(k - steps[d])
            passage = h[off[d] + max(0, step - 1) * half:min(off[d + 1], off[d] + (step + 1) * half)]
            have = np.union1d(trigrams(passage), passage)
            for item, score in found:
                q, a = (len(np.intersect1d(p, have, assume_unique=True)) / len(p) if len(p) else 1.0 for p in self.parts[item])
                if q >= OVERLAP and a >= OVERLAP:
                    b = best.setdefault((d, item), [0.0, 0.0, 0.0, 0])
                    b[:] = [max(b[0], score), max(b[1], q), max(b[2], a), b[3] + 1]
        return [(d, i, *b) for (d, i), b in sorted(best.items())]


def item_terms(items: DataFrame) -> DataFrame:
    """(term, length): a row for each distinct term of an item, and one without a term that holds the item's words."""
    def emit(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            h, wo = tokens(data, off)
            each = [np.unique(h[wo[i]:wo[i + 1]]) for i in range(len(off) - 1)]
            length = np.diff(wo)
            length = length[length > 0]
            term = np.concatenate([np.zeros(0, np.uint64), *each]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.nulls(len(term), pa.int64())], ["term", "length"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(length), pa.int64()), pa.array(length.astype(np.int64))], ["term", "length"])

    return items.select("text").mapInArrow(emit, "term long, length long")


def indexes(items: DataFrame) -> Iterator[Index]:
    """Index shards, one after the other; each holds at most SHARD_BYTES of item text (or one longer item)."""
    items = items.where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // SHARD_BYTES)
    if not shards:
        return
    counts = item_terms(items).groupBy("term").agg(F.count("*").alias("n"), F.sum("length").alias("words"), F.max("length").alias("longest"))
    counts = Scratch(items.sparkSession, "terms").table(counts)
    whole = counts.where("term is null").first()
    if whole is None:  # no item has a word
        return
    for s in range(shards):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == s).orderBy("item_id", "text")
        held = item_terms(part).select("term").distinct()
        df = sorted((r["term"] & (1 << 64) - 1, r["n"]) for r in counts.join(held, "term").select("term", "n").toLocalIterator())
        of_all = Statistics(whole["n"], whole["words"], whole["longest"], np.array([t for t, _ in df], np.uint64), np.array([n for _, n in df], np.int64))
        yield Index([(r["item_id"], r["text"]) for r in part.toLocalIterator()], of_all)


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for every confirmed pair: doc_id, item_id, score, question_overlap, answer_overlap, n_passages."""
    docs, items = pick(docs, doc_id=doc_id, text=text), pick(items, item_id=item_id, text=item_text)
    id_type, item_type = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, score double, question_overlap double, answer_overlap double, n_passages long"
    out = None
    for index in indexes(items):
        def search(batches, index=index):
            for batch in batches:
                data, off = utf8(batch.column("text"))
                rows, found = [], []
                for i, j in pieces(off):
                    h, wo = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                    for d, *rest in index.matches(h, wo):
                        rows.append(i + d)
                        found.append(rest)
                ids = pa.array([index.ids[x[0]] for x in found], batch_type(item_type))
                cols = [pa.array([x[c] for x in found], pa.float64()) for c in (1, 2, 3)] + [pa.array([x[4] for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), ids, *cols], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "n_passages"])

        part = docs.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def batch_type(t):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item.  One pass for each index shard."""
    place, schema, items = docs.columns.index("text"), docs.schema, pick(items, item_id="item_id", text="text")
    for index in indexes(items):
        def keep(batches, index=index):
            for batch in batches:
                data, off = utf8(batch.column(place))
                good = np.ones(len(off) - 1, bool)
                for i, j in pieces(off):
                    h, wo = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                    good[[i + m[0] for m in index.matches(h, wo)]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(keep, schema)
    return docs


__all__ = ["Index", "clean_documents", "contaminated"]
