"""Language-model scores by a hierarchical Pitman-Yor model of words.

Tokens are words (A-Z lower-cased) and one end mark for each text.  Every word that precedes a training token is a
context with a restaurant of its own; a token is a customer of its predecessor's restaurant (the first of a text: of
the end mark's), and every table of a restaurant is a customer of the parent restaurant, which all share.  A context
never seen in training has no customers, and its token is scored by the parent.  The parent's base is uniform over the V
known tokens and one unknown.  Discounts come from the counts of counts of each level, strengths are 1.

Seating is sampled by Gibbs sweeps: given the restaurants' table totals and the parent of the last sweep, all
customers of a dish are seated anew.  (From the 64th customer of a dish on, they come in groups of 2 %.)
Probabilities of ``SWEEPS`` seatings, after one that only starts the chain, are averaged before the logarithm.

Work: texts are tokenised once.  Each block of texts sends its (word, context) pairs with counts by text to the
slice of the word, where they are merged into one written row; a slice holds about ``SLICE_TOKENS`` tokens.  What a
sweep needs of a context, its customers and tables over all slices, is summed in context shards: every slice
sends its sums in the order of its sorted contexts, and gets the totals back in the same order.

*Hot* words have at least 1/``HOT_SHARE`` of the training tokens, counted over all tokens; there are fewer than
HOT_SHARE.  They only change where work is done, not the model: pairs of a hot word go by their context, pairs of two
hot words stay dealt out by block, and the joint counts of those (fewer than HOT_SHARE squared) and the totals of hot
words go to every task.  Slices are in order of word and context and draw their numbers by slice, so seatings don't
depend on how the input is partitioned.  Contexts are known by 48 bits of their hash, words by 64.

Defined results: a null or empty text has one token, the end; with no training text, every token has the
uniform probability 1 (V = 0); null ids are trained on like others and not held out; repeated rows are
counted and scored each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, pick, pieces, utf8, words
from trolley.llm.nn_descent import runs

HOT_SHARE = 1024
SLICE_TOKENS = 500_000
SLICES_A_SHARD = 4  # context shards and buckets: one for so many slices
BLOCK_BYTES = 8 << 20
BLOCK_TEXTS = 1 << 16
BUCKETS = 50_000
HELD_SUMS = 1_000_000  # sums by text that a task gathers before it sends them
SWEEPS = 2
STRENGTH = 1.0
END = np.uint64(0xE1D0_0000_0000_0001)


def release() -> None:
    """Free memory goes back to the system: Python workers live on, and would keep the most they ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, end marks included, and each token's text."""
    found = [words(data[off[i]:off[j]], off[i:j + 1] - off[i])[:2] for i, j in pieces(off)]  # hashing needs 32 bytes a byte
    h = np.concatenate([np.zeros(0, np.uint64), *[x[0] for x in found]])
    n = np.concatenate([np.zeros(0, np.int64), *[np.diff(x[1]) for x in found]]) + 1
    ends = np.cumsum(n) - 1
    w = np.empty(len(h) + len(n), np.uint64)
    w[ends] = END
    rest = np.ones(len(w), bool)
    rest[ends] = False
    w[rest] = h
    return w, np.repeat(np.arange(len(n)), n)


def blocks(off: np.ndarray):
    for i, j in pieces(off, BLOCK_BYTES):
        for a in range(i, j, BLOCK_TEXTS):
            yield a, min(a + BLOCK_TEXTS, j)


def frequent(scratch: Scratch, docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(sorted hashes of the hot words, their counts, all tokens).  Counted over all training tokens; fewer than
    HOT_SHARE words are collected."""
    def count(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for i, j in blocks(off):
                w, d = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                u, c = np.unique(w[train[i:j][d]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(u.view(np.int64), 0)), pa.array(np.append(c, 0)), pa.array(np.append(np.zeros(len(u), np.int64), len(w)))], ["w", "c", "tokens"])
        release()

    table = scratch.table(docs.mapInArrow(count, "w long, c long, tokens long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("tokens").alias("tokens")))
    train, total = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    rows = sorted((r["w"] % (1 << 64), r["c"]) for r in table.where((F.col("c") > 0) & (F.col("c") * HOT_SHARE >= train)).collect())
    scratch.drop(table)
    return np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64), total


def pack48(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.reshape(-1).view("<i8")


def place(w: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in the sorted ``among``, whether there)."""
    at = np.searchsorted(among, w)
    if not len(among):
        return at, np.zeros(len(w), bool)
    at = np.minimum(at, len(among) - 1)
    return at, among[at] == w


PART = ("words", "wpairs", "ctx", "pents", "doc", "cnt")
MERGED = ("words", "wpairs", "ctx", "count", "pents", "doc", "cnt", "texts")
KINDS = dict(words=np.uint64, wpairs=np.int32, count=np.int64, pents=np.int32, doc=np.uint32, cnt=np.uint32, texts=np.int64)


def _blob(**arrays) -> dict[str, bytes]:
    return {k: pack48(v) if k == "ctx" else np.ascontiguousarray(v, KINDS[k]).tobytes() for k, v in arrays.items()}


def _array(table, name: str, row: int) -> np.ndarray:
    raw = table.column(name)[row].as_buffer()
    return unpack48(np.frombuffer(raw, np.uint8)) if name == "ctx" else np.frombuffer(raw, KINDS[name])


def parts(docs: DataFrame, hot: np.ndarray, slices: int) -> DataFrame:
    """For each block and slice: words, contexts and texts with counts; and a row with the block's ids."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"slice int, uid long, ids array<{id_type}>, n array<long>, {', '.join(f'{p} binary' for p in PART)}"
    n_slices = np.uint64(slices)

    def split(batches):
        uid = TaskContext.get().partitionId() << 24
        for batch in batches:
            data, off = utf8(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in blocks(off):
                uid += 1
                w, d = tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                n = np.bincount(d, minlength=j - i)
                u = np.concatenate([[END], w[:-1]])  # the first word of a text follows an end mark
                uw, wi = np.unique(w, return_inverse=True)
                ui = wi[np.concatenate([[len(wi) - 1], np.arange(len(wi) - 1)])]  # a block ends with an end mark
                key = wi * len(uw) + ui
                del w, u, wi, ui
                order = np.argsort(key, kind="stable")
                key, d = key[order], d[order]
                first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (d[1:] != d[:-1])]))
                pair, doc, cnt = key[first], d[first] * 2 + train[i:j][d[first]], np.diff(np.append(first, len(key)))
                del key, d, order
                _, is_hot = place(uw, hot)
                pw, pu = pair // len(uw), pair % len(uw)
                at = ((uw >> np.uint64(8)) % n_slices).astype(np.int64)
                at = np.where(is_hot[pw], np.where(is_hot[pu], uid % slices, at[pu]), at[pw])
                order = np.argsort(at.astype(np.int16) if slices < 1 << 15 else at, kind="stable")
                cuts = np.flatnonzero(np.diff(at[order])) + 1
                rows = []
                for mine in np.split(order, cuts):
                    p = pair[mine]
                    f = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
                    fw = pw[mine][f]
                    ff = np.flatnonzero(np.concatenate([[True], fw[1:] != fw[:-1]]))
                    rows.append(dict(slice=int(at[mine[0]]), uid=uid, ids=None, n=None, **_blob(words=uw[fw[ff]], wpairs=np.diff(np.append(ff, len(fw))), ctx=uw[pu[mine][f]] >> np.uint64(16), pents=np.diff(np.append(f, len(p))), doc=doc[mine], cnt=cnt[mine])))
                ids = batch.column("doc_id").slice(i, j - i)
                rows.append(dict(slice=-1 - uid % slices, uid=uid, ids=ids.to_pylist(), n=n.tolist(), **dict.fromkeys(PART)))
                types = [pa.int32(), pa.int64(), pa.list_(ids.type), pa.list_(pa.int64()), *[pa.binary()] * len(PART)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(("slice", "uid", "ids", "n", *PART), types)], ["slice", "uid", "ids", "n", *PART])
                del rows, pair, doc, cnt, order, at, pw, pu, uw, first
                release()

    return docs.mapInArrow(split, schema)


def arranged(n: np.ndarray, order: np.ndarray, *entries: np.ndarray) -> tuple:
    """Entries of groups of ``n`` in the order of the groups, and each one's place in that order."""
    m = n[order].astype(np.int64)
    start, of = np.cumsum(n.astype(np.int64)) - n, np.repeat(np.arange(len(m)), m)
    at = np.arange(len(of)) + np.repeat(start[order] - (np.cumsum(m) - m), m)
    return *[e[at] for e in entries], of


def merge(table: DataFrame, buckets: int) -> DataFrame:
    """One row for each slice, its pairs in order of word and context; rows with ids pass."""
    def join(batches):
        for t in runs(batches, ["slice"], None):
            s = t.column("slice")[0].as_py()
            if s < 0:
                out = t.select(["slice", "uid", "ids", "n"])
                for m in MERGED:
                    out = out.append_column(m, pa.nulls(t.num_rows, pa.binary()))
                yield from out.to_batches()
                continue
            every = {p: [_array(t, p, r) for r in range(t.num_rows)] for p in PART}
            uids = t.column("uid").to_numpy()
            key = np.concatenate([(u << 17) + d for u, d in zip(uids, every.pop("doc"))])
            x = {p: np.concatenate(every.pop(p)) for p in list(every)}
            w, c = np.repeat(x["words"], x["wpairs"]), x["ctx"]
            key, cnt, of = arranged(x["pents"], order := np.lexsort((c, w)), key, x["cnt"])
            w, c = w[order], c[order]
            new_word = np.concatenate([[True], w[1:] != w[:-1]])
            new = new_word | np.concatenate([[True], c[1:] != c[:-1]])
            of = (np.cumsum(new) - 1)[of]
            n_pairs = int(new.sum())
            count = np.rint(np.bincount(of, cnt * (key & 1), n_pairs))
            texts, doc = np.unique(key, return_inverse=True)
            at = np.flatnonzero(new_word[new])
            blob = _blob(words=w[new_word], wpairs=np.diff(np.append(at, n_pairs)), ctx=c[new], count=count, pents=np.bincount(of, minlength=n_pairs), doc=doc, cnt=cnt, texts=texts)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([None], pa.int64()), pa.nulls(1, t.schema.field("ids").type), pa.nulls(1, pa.list_(pa.int64())), *[pa.array([blob[m]], pa.binary()) for m in MERGED]], ["slice", "uid", "ids", "n", *MERGED])
            del x, w, c, key, cnt, of, order, new, new_word, texts, doc, blob
        release()

    kind = table.schema["ids"].dataType.simpleString()
    schema = f"slice int, uid long, ids {kind}, n array<long>, {', '.join(f'{m} binary' for m in MERGED)}"
    return table.repartition(buckets, "slice").sortWithinPartitions("slice", "uid").mapInArrow(join, schema)


def bucketed(scratch: Scratch, df: DataFrame, buckets: int) -> DataFrame:
    """The table written by bucket of slice, so that joins by slice don't move it again."""
    name = f"hpylm_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "slice").sortBy("slice").option("path", f"{scratch.root}/merged").option("compression", "zstd").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


# ------------------------------------------------------------------ seating

def seat(rng, customers: np.ndarray, fresh: np.ndarray, discount: float) -> np.ndarray:
    """Tables of each dish after seating its customers; fresh: (strength + discount * tables) * base probability."""
    tables = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    seated = 1
    while len(live):
        group = 1 if seated < 64 else seated // 50
        n = np.minimum(group, customers[live] - seated)
        p = fresh[live] / (fresh[live] + seated - discount * tables[live])
        tables[live] += rng.binomial(n, p)
        seated += group
        live = live[customers[live] > seated]
    return tables


def new_dish(h: dict) -> float:
    return (STRENGTH + h["d1"] * h["S"]) / (h["V"] + 1)


def parent_probability(m: np.ndarray, s: np.ndarray, h: dict) -> np.ndarray:
    return (m - h["d1"] * s + new_dish(h)) / (STRENGTH + h["M"])


class Slice:
    """Pairs of one slice.  Pairs of two hot words are apart (``joint``): their seating is drawn once, by the driver."""

    def __init__(self, table, r: int, hot: np.ndarray):
        x = {m: _array(table, m, r) for m in ("words", "wpairs", "ctx", "count")}
        self.id = table.column("slice")[r].as_py()
        self.words, self.count = x["words"], x["count"]
        self.word = np.repeat(np.arange(len(self.words)), x["wpairs"])
        self.word_at, self.word_hot = place(self.words, hot)
        self.hot_at, self.hot = place(x["ctx"], (hot >> np.uint64(16)).astype(np.int64))  # of each pair's context
        self.joint = self.word_hot[self.word] & self.hot
        self.contexts, at = np.unique(x["ctx"][~self.hot], return_inverse=True)
        self.at = np.zeros(len(self.count), np.int64)
        self.at[~self.hot] = at

    def per_pair(self, cold: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Values of contexts brought to the pairs."""
        out = np.zeros(len(self.count))
        out[~self.hot] = cold[self.at[~self.hot]]
        out[self.hot] = hot[self.hot_at[self.hot]]
        return out

    def words_sum(self, tables: np.ndarray) -> np.ndarray:
        own = ~self.joint
        return np.bincount(self.word[own], tables[own], len(self.words)).astype(np.int64)

    def parent(self, m: np.ndarray, s: np.ndarray, h: dict) -> np.ndarray:
        p = parent_probability(m, s, h)
        p[self.word_hot] = parent_probability(h["m_hot"], h["s_hot"], h)[self.word_at[self.word_hot]]
        return p

    def states(self, history: list[dict], given: list[np.ndarray]) -> list[tuple]:
        """(tables by pair, customers and tables of the parent by word): state 0 has one table for each dish,
        state k is drawn from the totals ``history[k - 1]`` and ``given[k - 1]`` of state k - 1."""
        tables = ((self.count > 0) & ~self.joint).astype(np.int64)
        m = self.words_sum(tables)
        s = (m > 0).astype(np.int64)
        out = [(tables, m, s)]
        for k, (h, t) in enumerate(zip(history, given)):
            rng = np.random.default_rng([k, 1, self.id])
            fresh = (STRENGTH + h["d2"] * self.per_pair(t, h["T_hot"])) * self.parent(m, s, h)[self.word]
            own = np.flatnonzero(~self.joint & (self.count > 0))
            tables = np.zeros(len(self.count), np.int64)
            tables[own] = seat(rng, self.count[own], fresh[own], h["d2"])
            m = self.words_sum(tables)
            s = seat(rng, m, np.full(len(m), new_dish(h)), h["d1"])
            out.append((tables, m, s))
        return out


def received(row, k: int) -> list[list[np.ndarray]]:
    """Blobs of the answers by round, each in the order of the contexts: [[tables, customers], [tables], ...]."""
    got: dict[int, list] = {j: [] for j in range(k)}
    for a in row.as_py() or []:
        got[a["k"]].append((a["cshard"], a["t"], a["c"]))
    out = []
    for j in range(k):
        cols = sorted(got[j], key=lambda a: a[0])
        out.append([np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(a[c], np.int64) for a in cols]]) for c in ((1, 2) if j == 0 else (1,))])
    return out


def counts_of_counts(c: np.ndarray) -> list[float]:
    return [float((c == 1).sum()), float((c == 2).sum())]


def sweep(merged: DataFrame, answers: DataFrame | None, hot: np.ndarray, history: list[dict], shards: int) -> DataFrame:
    """The newest state's sums: rows (cshard, slice, us, t, c) for context shards, rows (i, a) for the driver."""
    size, k = len(hot), len(history)
    source = merged.where("slice >= 0").select("slice", "words", "wpairs", "ctx", "count")
    source = source.withColumn("answers", F.lit(None).cast("int")) if answers is None else source.join(answers.hint("merge"), "slice", "left")
    bounds = np.array([(s << 48) // shards for s in range(1, shards)], np.int64)  # shards are ranges of contexts

    def draw(batches):
        sums, both = np.zeros(3 * size + 8), np.zeros((size, size))
        for batch in batches:
            for r in range(batch.num_rows):
                x = Slice(batch, r, hot)
                if k == 0:
                    np.add.at(both, (x.word_at[x.word[x.joint]], x.hot_at[x.joint]), x.count[x.joint])
                given = received(batch.column("answers")[r], k)
                t, m, s = x.states(history, [g[0] for g in given])[-1]
                own, cold_word = ~x.joint, ~x.word_hot
                for i, v in enumerate((t, x.count)):
                    sums[i * size:(i + 1) * size] += np.bincount(x.hot_at[x.hot & own], v[x.hot & own], size)[:size] if size else 0
                sums[2 * size:3 * size] += np.bincount(x.word_at[x.word_hot], m[x.word_hot], size)[:size] if size else 0
                per_word = x.words_sum(x.count)[cold_word]
                sums[3 * size:] += [s[cold_word].sum(), m[cold_word].sum(), (per_word > 0).sum(), x.count[own].sum(), *counts_of_counts(x.count[own]), *counts_of_counts(m[cold_word])]
                cold = own & ~x.hot
                t, c = (np.bincount(x.at[cold], v[cold], len(x.contexts)).astype(np.int64) for v in (t, x.count))
                cuts = np.concatenate([[0], np.searchsorted(x.contexts, bounds), [len(x.contexts)]])
                for lo in range(0, shards, 1024):
                    some = [q for q in range(lo, min(lo + 1024, shards)) if cuts[q] < cuts[q + 1]]
                    cols = [[v[cuts[q]:cuts[q + 1]] for q in some] for v in (x.contexts, t, c)]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([x.id] * len(some), pa.int32()), pa.array([pack48(v) if k == 0 else None for v in cols[0]], pa.binary()), pa.array([v.tobytes() for v in cols[1]], pa.binary()),
                                                      pa.array([v.tobytes() if k == 0 else None for v in cols[2]], pa.binary()), pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.float64())], ["cshard", "slice", "us", "t", "c", "i", "a"])
        at = np.flatnonzero(both)
        i, sums = np.concatenate([np.arange(len(sums)), len(sums) + at]), np.concatenate([sums, both.ravel()[at]])
        n = len(sums)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32())] * 2 + [pa.nulls(n, pa.binary())] * 3 + [pa.array(i.astype(np.int32)), pa.array(sums)], ["cshard", "slice", "us", "t", "c", "i", "a"])

    return source.mapInArrow(draw, "cshard int, slice int, us binary, t binary, c binary, i int, a double")


def links_of(first: DataFrame) -> DataFrame:
    """(cshard, slice, idx, t, c): where a slice's contexts stand in their shard, and the totals of state 0."""
    def add(batches):
        for t in runs(batches, ["cshard"], None):
            us = [unpack48(np.frombuffer(v.as_buffer(), np.uint8)) for v in t.column("us")]
            _, idx = np.unique(np.concatenate(us), return_inverse=True)
            cuts = np.cumsum([len(u) for u in us])[:-1]
            total = [np.bincount(idx, np.concatenate([np.frombuffer(v.as_buffer(), np.int64) for v in t.column(c)])).astype(np.int64)[idx] for c in ("t", "c")]
            cols = [[v.tobytes() for v in np.split(a, cuts)] for a in (idx.astype(np.int32), *total)]
            yield from pa.table([t.column("cshard"), t.column("slice"), *[pa.array(c, pa.binary()) for c in cols]], ["cshard", "slice", "idx", "t", "c"]).to_batches(1024)

    rows = first.where("us is not null").select("cshard", "slice", "us", "t", "c")
    return rows.repartition("cshard").sortWithinPartitions("cshard", "slice").mapInArrow(add, "cshard int, slice int, idx binary, t binary, c binary")


def totals_of(stage: DataFrame, links: DataFrame) -> DataFrame:
    """(cshard, slice, t): the totals of a later state, for the contexts of each slice."""
    def add(batches):
        for t in runs(batches, ["cshard"], None):
            slices, idx, part = t.column("slice").to_pylist(), {}, {}
            for r, s in enumerate(slices):
                (idx if t.column("idx")[r].is_valid else part)[s] = r
            names = sorted(idx)
            at = [np.frombuffer(t.column("idx")[idx[s]].as_buffer(), np.int32) for s in names]
            every = np.concatenate(at)
            total = np.bincount(every, np.concatenate([np.frombuffer(t.column("t")[part[s]].as_buffer(), np.int64) for s in names])).astype(np.int64)
            shard = t.column("cshard")[0].as_py()
            yield from pa.table([pa.array([shard] * len(names), pa.int32()), pa.array(names, pa.int32()), pa.array([total[a].tobytes() for a in at], pa.binary())], ["cshard", "slice", "t"]).to_batches(1024)

    rows = stage.where("t is not null").select("cshard", "slice", F.lit(None).cast("binary").alias("idx"), "t")
    rows = rows.unionByName(links.select("cshard", "slice", "idx", F.lit(None).cast("binary").alias("t")))
    return rows.repartition("cshard").sortWithinPartitions("cshard", "slice").mapInArrow(add, "cshard int, slice int, t binary")


def by_slice(rounds: list[DataFrame]) -> DataFrame:
    """One row for each slice with all its answers: no more than one for each round and context shard it uses."""
    rows = None
    for k, a in enumerate(rounds):
        c = F.col("c") if k == 0 else F.lit(None).cast("binary").alias("c")
        a = a.select("slice", F.struct(F.lit(k).alias("k"), "cshard", "t", c.alias("c")).alias("a"))
        rows = a if rows is None else rows.unionByName(a)
    return rows.groupBy("slice").agg(F.collect_list("a").alias("answers"))


def sums_of(stage: DataFrame, size: int) -> tuple[np.ndarray, tuple]:
    """(sums of a sweep, (word, context, count) of the pairs of two hot words, of the first sweep only): fewer than
    HOT_SHARE squared rows are collected."""
    got = stage.where("i is not null").groupBy("i").agg(F.sum("a").alias("a")).toPandas().sort_values("i")
    i, a = got["i"].to_numpy(np.int64), got["a"].to_numpy(float)
    sums = np.zeros(3 * size + 8)
    few = i < len(sums)
    sums[i[few]] = a[few]
    pair = i[~few] - len(sums)
    return sums, (pair // max(1, size), pair % max(1, size), a[~few].astype(np.int64))


def next_totals(a: np.ndarray, joint: tuple, size: int, history: list[dict]) -> dict:
    """The driver's share of a sweep: totals by hot word and of the parent (fewer than 3 * HOT_SHARE + 8 numbers)."""
    w, u, c = joint
    T, C, m = (a[i * size:(i + 1) * size].astype(np.int64) for i in range(3))
    S, M, V, N, one2, two2, one1, two1 = a[3 * size:]
    h = history[-1] if history else None
    rng = np.random.default_rng([len(history), 2])
    if h is None:
        tables = np.ones(len(c), np.int64)
    else:
        tables = seat(rng, c, (STRENGTH + h["d2"] * h["T_hot"][u]) * parent_probability(h["m_hot"], h["s_hot"], h)[w], h["d2"])
    T, C, m = T + np.bincount(u, tables, size).astype(np.int64), C + np.bincount(u, c, size).astype(np.int64), m + np.bincount(w, tables, size).astype(np.int64)
    s = (m > 0).astype(np.int64) if h is None else seat(rng, m, np.full(size, new_dish(h)), h["d1"])
    V, N = (V + (m > 0).sum(), N + c.sum()) if h is None else (h["V"], h["N"])
    one2, two2, one1, two1 = (x + y for x, y in zip((one2, two2, one1, two1), counts_of_counts(c) + counts_of_counts(m)))
    # without dishes of one or two customers: the usual middle value
    discount = lambda one, two: min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5
    return dict(T_hot=T, C_hot=C, m_hot=m, s_hot=s, joint=tables, S=S + s.sum(), M=M + m.sum(), V=V, N=N, d1=discount(one1, two1), d2=discount(one2, two2))


def scores(merged: DataFrame, answers: DataFrame, hot: np.ndarray, often: np.ndarray, joint: tuple, history: list[dict]) -> DataFrame:
    """Sums by text of the model's and the base's logarithms and of known tokens, by block, a text once for each task or more."""
    size, h0, rounds = len(hot), history[0], len(history)
    joint_key, joint_count = joint[0] * size + joint[1], joint[2]

    def flush(key, sums):
        uid = key >> 17
        cuts = np.flatnonzero(np.diff(uid)) + 1
        names = uid[np.concatenate([[0], cuts])] if len(uid) else uid
        cols = [np.split(x, cuts) for x in (((key >> 1) & 0xFFFF).astype(np.uint16), sums[0], sums[1], sums[2].astype(np.uint32))]
        for lo in range(0, len(names), 256):
            yield pa.RecordBatch.from_arrays([pa.array(names[lo:lo + 256]), *[pa.array([v.tobytes() for v in c[lo:lo + 256]], pa.binary()) for c in cols]], ["uid", "docs", "model", "base", "known"])

    def predict(batches):
        key, sums = np.zeros(0, np.int64), [np.zeros(0)] * 3
        for batch in batches:
            for r in range(batch.num_rows):
                x = Slice(batch, r, hot)
                given = received(batch.column("answers")[r], rounds)
                states = x.states(history[:-1], [g[0] for g in given[:-1]])
                count, total = x.count.copy(), x.words_sum(x.count)
                total[x.word_hot] = often[x.word_at[x.word_hot]]
                at, there = place(x.word_at[x.word[x.joint]] * size + x.hot_at[x.joint], joint_key)
                count[x.joint] = np.where(there, joint_count[at], 0) if len(joint_key) else 0
                customers = x.per_pair(given[0][1], h0["C_hot"])
                p = np.zeros(len(x.word))
                for k in range(1, rounds):
                    h, (tables, m, s) = history[k], states[k]
                    tables = tables.copy()
                    tables[x.joint] = np.where(there, h["joint"][at], 0) if len(joint_key) else 0
                    T = x.per_pair(given[k][0], h["T_hot"])
                    p += (count - h["d2"] * tables + (STRENGTH + h["d2"] * T) * x.parent(m, s, h)[x.word]) / (STRENGTH + customers)
                model = np.log10(p / (rounds - 1))
                base = np.log10((total + 0.5) / (h0["N"] + 0.5 * (h0["V"] + 1)))
                y = {c: _array(batch, c, r) for c in ("pents", "doc", "cnt", "texts")}
                n = len(y["texts"])
                new = [np.bincount(y["doc"], y["cnt"] * np.repeat(v, y["pents"]), n) for v in (model, base[x.word], (total > 0)[x.word])]
                texts = y["texts"].copy()
                del states, x, y, p, customers, model
                key, inverse = np.unique(np.concatenate([key, texts]), return_inverse=True)
                sums = [np.bincount(inverse, np.concatenate([a, b]), len(key)) for a, b in zip(sums, new)]
                if len(key) > HELD_SUMS:
                    yield from flush(key, sums)
                    key, sums = np.zeros(0, np.int64), [np.zeros(0)] * 3
        yield from flush(key, sums)
        release()

    source = merged.where("slice >= 0").select("slice", "words", "wpairs", "ctx", "count", "pents", "doc", "cnt", "texts")
    return source.join(answers.hint("merge"), "slice", "left").mapInArrow(predict, "uid long, docs binary, model binary, base binary, known binary")


def model_scores(docs: DataFrame, parts_of: int = 5, held_out: int = 1) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = pick(docs, doc_id="doc_id", text="text")
    scratch = Scratch(docs.sparkSession, "hpylm")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts_of == held_out, F.lit(False))
    docs = docs.select("doc_id", "text", (~held).alias("train"))
    hot, often, total = frequent(scratch, docs)
    slices = max(1, -(-total // SLICE_TOKENS))
    shards = -(-slices // SLICES_A_SHARD)
    buckets = min(shards, BUCKETS)  # a task sums the texts of its slices before it sends them
    merged = bucketed(scratch, merge(parts(docs, hot, slices), buckets), buckets)
    scratch.drop()
    joint = None
    history: list[dict] = []
    rounds: list[DataFrame] = []
    answers = links = None
    for k in range(SWEEPS + 1):
        stage = scratch.table(sweep(merged, answers, hot, history, shards))
        sums, pairs = sums_of(stage, len(hot))
        joint = joint or pairs
        history.append(next_totals(sums, joint, len(hot), history))
        if k == 0:
            links = scratch.table(links_of(stage))
        rounds.append(links.select("slice", "cshard", "t", "c") if k == 0 else scratch.table(totals_of(stage, links)))
        scratch.drop(stage)
        answers = by_slice(rounds)
    found = scores(merged, answers, hot, often, joint, history)
    found = found.unionByName(merged.where("slice < 0").select("uid", "ids", "n"), allowMissingColumns=True)
    n_train = int(round(history[0]["N"]))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def collect(batches):
        for t in runs(batches, ["uid"], None):
            own = next(r for r in range(t.num_rows) if t.column("ids")[r].is_valid)
            ids, n = t.column("ids").combine_chunks()[own].values, np.array(t.column("n")[own].as_py(), np.int64)
            sums = np.zeros((3, len(n)))
            for r in range(t.num_rows):
                if r != own:
                    at = np.frombuffer(t.column("docs")[r].as_buffer(), np.uint16)
                    for i, (c, kind) in enumerate((("model", float), ("base", float), ("known", np.uint32))):
                        sums[i, at] += np.frombuffer(t.column(c)[r].as_buffer(), kind)  # a text is once in a row
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(np.rint(sums[2]).astype(np.int64)), pa.array(np.full(len(n), n_train)), pa.array(sums[1]), pa.array(sums[0])], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = found.repartition("uid").sortWithinPartitions("uid").mapInArrow(collect, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts_of == held_out, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
