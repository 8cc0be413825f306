"""N-gram Jaccard join with adaptive multi-match prefixes.

Two texts link when the Jaccard similarity of their sets of word shingles is at least a threshold t.  Order
every set by one global order, rare shingles first.  If two sets link, they share at least ``m`` shingles
within their *m-match prefixes*: all but the last ceil(t * size) - m entries, for every m.  A longer prefix
costs more index entries but asks for more common entries before a pair is verified.  Every document takes
the m of least estimated cost; a pair uses the smaller m of its two documents, and only entries that belong
to both prefixes of that m count.

Steps (no pass holds more than one text, one batch or one set pair in a Python worker):

1. A count sketch of shingle frequencies over all texts (fixed size, summed by Spark) gives the order and
   the cost estimates.  The order need not be exact: any order gives the same links.
2. Each text becomes (class, size, m, prefix); texts with equal sets form one class, so copies collapse.
3. Index entries are sorted by shingle; entries alone in their list go at once.
4. A first round verifies, in each list, every class with its neighbour by size and with the class that has
   the fewest entries of its own (the likely original): a linear number of pairs that joins large groups of
   near copies.  Links found make components.
5. The full join then pairs only classes of *different* components: an entry names a pair if it can be the
   first common one, the pair must have m common entries within its prefixes, and is verified exactly.
   No link between components is lost; links within a component can't change the result.

Defined results: null or white-space texts have an empty set (size 0) and link with nothing, also not with
each other; texts of fewer than k words are one shingle, their whole sequence; rows repeated with the same
doc_id stay separate rows with the same result; a null doc_id takes part and never names a component
(component_id is null if all of a component's ids are null, or the row's own id if its set is empty); extra
columns are ignored; an empty table gives an empty result.  Shingles and sets are identified by 64-bit
hashes: of n distinct sets two collide with odds of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, components, mix, pick, pieces, shingles, utf8, words

SKETCH_BITS = 18
FILTER_BITS = 19  # words of 64 bits in the filter of classes to verify: 4 MB whatever the input
MOST_MATCHES = 8
VERIFY_COST = 30.0
CHANCE = 0.5  # entries that a shingle without a visible frequency is expected to meet


def _sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for i, j in pieces(off):
        h, wo, _ = words(data[off[i]:off[j]], off[i:j + 1] - off[i])
        g, go = shingles(h, wo, k)
        for a, b in zip(go[:-1], go[1:]):
            yield np.unique(g[a:b])


def _bucket(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _class_id(s: np.ndarray) -> int:
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def shingle_frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """Number of documents of each bucket of shingles: 2^18 counters whatever the input's size."""
    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            data, off = utf8(batch.column("text"))
            for s in _sets(data, off, k):
                np.add.at(total, _bucket(s), 1)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.float64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def prefix_of(s: np.ndarray, freq: np.ndarray, mean: float, percent: int) -> tuple[np.ndarray, int, int]:
    """(prefix in global order, length of the 1-match prefix, m) of one set."""
    n = len(s)
    need = -(-percent * n // 100)
    first = n - need + 1
    f = freq[_bucket(s)]
    longest = min(n, first + MOST_MATCHES - 1)
    order = np.lexsort((s, f))[:longest]
    cost = np.cumsum(np.maximum(f[order] - mean, 0.0) + CHANCE)
    m = np.arange(1, longest - first + 2)
    m = m[m <= need]  # no more matches than links must share at all
    met = cost[first - 1:first - 1 + len(m)]  # entries met in the lists; a candidate takes m of them
    best = int(np.argmin(met * (1 + VERIFY_COST / m)))
    return s[order][:first + best], first, best + 1


def link_classes(docs: DataFrame, scratch: Scratch, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """From (doc_id, text): (doc_id, n, c) of every row, and (node, root) of the classes that have links.

    percent: the threshold times 100; compared in whole numbers."""
    freq = shingle_frequencies(docs, k)
    mean = float(np.median(freq))
    shared_freq = docs.sparkSession.sparkContext.broadcast(freq.astype(np.float32))  # 1 MB whatever the input

    def prefixes(batches):
        freq = shared_freq.value.astype(np.float64)
        for batch in batches:
            data, off = utf8(batch.column("text"))
            n, c, m, p, firsts = [], [], [], [], []
            for s in _sets(data, off, k):
                n.append(len(s))
                c.append(_class_id(s))
                x, first, best = prefix_of(s, freq, mean, percent) if len(s) else (s, 0, 0)
                p.append(x.view(np.int64))
                firsts.append(first)
                m.append(best)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in p])]).astype(np.int32), np.concatenate([np.zeros(0, np.int64), *p]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(m, pa.int32()), pa.array(firsts, pa.int32()), lists], ["doc_id", "n", "c", "m", "first", "prefix"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sets = scratch.table(docs.mapInArrow(prefixes, f"doc_id {id_type}, n long, c long, m int, first int, prefix array<long>"))
    shared_freq.destroy()
    classes = scratch.table(sets.where("n > 0").groupBy("c").agg(*[F.first(x).alias(x) for x in ("n", "m", "first", "prefix")]))
    # a class's prefix is kept once, in ``classes``; rows only need to know their class
    wide, sets = sets, scratch.table(sets.select("doc_id", "n", "c"))
    scratch.drop(wide)
    entries = classes.select(F.posexplode("prefix").alias("at", "tok"), "c").select("tok", "c", "at")

    def shared(batches):
        """Entries whose shingle has more than one; the input is sorted by shingle. Keeps one row between batches."""
        last, used = None, True
        for batch in batches:
            t = batch.column("tok").to_numpy()
            if not len(t):
                continue
            same = t[1:] == t[:-1]
            keep = np.zeros(len(t), bool)
            keep[1:] |= same
            keep[:-1] |= same
            if last is not None and last.column("tok")[0].as_py() == t[0]:
                keep[0] = True
                if not used:
                    yield last
            last, used = batch.slice(len(t) - 1, 1), bool(keep[-1])
            yield batch.filter(pa.array(keep))

    found = scratch.table(entries.repartition("tok").sortWithinPartitions("tok").mapInArrow(shared, entries.schema))
    scratch.drop()  # the entries' shuffle files go before the lists are shuffled
    # u: entries before the first that another class also has in its prefix.  The first common entry of a link
    # is in both prefixes, so those u are in no other linked set: at most n - u can be common.  own: all entries
    # without company; it only ranks
    with_company = found.groupBy("c").agg(F.min("at").cast("long").alias("u"), F.count("*").alias("company"))
    facts = classes.select("c", "n", "m", F.size("prefix").alias("len")).join(with_company, "c")
    lists = scratch.table(found.join(facts, "c").select("tok", "c", "n", "m", "at", "u", (F.col("len") - F.col("company")).alias("own")))
    scratch.drop(found)

    most = "least(n1 - u1, n2 - u2)"
    fits = f"100 * {most} >= {percent} * (n1 + n2 - {most})"
    first = Window.partitionBy("tok").orderBy("own", "n", "c")
    by_size = Window.partitionBy("tok").orderBy("n", "own", "c")
    cells = ("c", "n", "u", "m")

    def near(spot: DataFrame, *others) -> DataFrame:
        """Pairs of an entry's class with the classes that ``others`` name, as structs (c, n, u)."""
        pairs = spot.select(*[F.col(x).alias(f"{x}2") for x in cells], *[o.alias(f"o{i}") for i, o in enumerate(others)])
        pairs = pairs.select(*[f"{x}2" for x in cells], F.explode(F.array(*[f"o{i}" for i in range(len(others))])).alias("o"))
        pairs = pairs.select(*[F.col(f"o.{x}").alias(f"{x}1") for x in cells], *[f"{x}2" for x in cells]).where(f"c1 != c2 and {fits}")
        pairs = pairs.groupBy(F.least("c1", "c2").alias("c1"), F.greatest("c1", "c2").alias("c2")).agg(F.count("*").alias("met"), F.first(F.least("m1", "m2")).alias("m"))
        return pairs.where("2 * met >= m").select("c1", "c2")  # the others wait for the full join

    tried = scratch.table(near(lists, F.first(F.struct(*cells)).over(first), F.lag(F.struct(*cells)).over(by_size)))
    links = verify(docs, tried, scratch, k, percent)
    roots = components(scratch, links)
    spot = lists.join(roots, lists["c"] == roots["node"], "left").withColumn("root", F.coalesce("root", "c")).drop("node")
    open_lists = spot.groupBy("tok").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("tok")
    spot = scratch.table(spot.join(open_lists, "tok"))
    scratch.drop(lists)
    # a link's first common entry has nothing common before it on either side: its positions bound what can follow,
    # so only entries early in both sets can name a pair
    a, b = (spot.select("tok", *[F.col(x).alias(f"{x}{i}") for x in ("c", "n", "u", "at", "root")]) for i in (1, 2))
    rest = "least(n1 - at1, n2 - at2)"
    early = f"100 * {rest} >= {percent} * (n1 + n2 - {rest})"
    pairs = (a.join(b, (a["tok"] == b["tok"]) & F.expr(f"c1 < c2 and root1 != root2 and {early} and {fits}"))
             .select("c1", "c2").distinct().join(tried, ["c1", "c2"], "left_anti"))
    # the smaller m of the two: as many common entries within both prefixes of that m
    one, two = (classes.select(F.col("c").alias(f"c{i}"), F.col("m").alias(f"m{i}"), F.col("first").alias(f"f{i}"), F.col("prefix").alias(f"p{i}")) for i in (1, 2))
    m = F.least("m1", "m2")
    common = F.size(F.array_intersect(F.slice("p1", F.lit(1), F.col("f1") + m - 1), F.slice("p2", F.lit(1), F.col("f2") + m - 1)))
    pairs = pairs.join(one, "c1").join(two, "c2").where(common >= m).select("c1", "c2")
    links = links.unionByName(verify(docs, scratch.table(pairs), scratch, k, percent))
    return sets.select("doc_id", "n", "c"), scratch.table(components(scratch, links))


def verify(docs: DataFrame, pairs: DataFrame, scratch: Scratch, k: int, percent: int) -> DataFrame:
    """The pairs (c1, c2) whose sets really link, as (a, b): 100 * common >= percent * union."""
    need = pairs.select(F.col("c1").alias("c")).unionByName(pairs.select(F.col("c2").alias("c"))).distinct()
    bit = F.col("c").bitwiseAND((64 << FILTER_BITS) - 1)
    cells = need.groupBy(F.shiftright(bit, 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(c & 63 as int))")).alias("bits")).toArrow()
    maybe = np.zeros(1 << FILTER_BITS, np.uint64)
    maybe[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    shared_maybe = docs.sparkSession.sparkContext.broadcast(maybe)
    del cells, maybe

    # sets are built again, only where a candidate may need them: the texts themselves are never shuffled
    def whole(batches):
        done: set[int] = set()
        maybe = shared_maybe.value
        for batch in batches:
            data, off = utf8(batch.column("text"))
            c, p, size = [], [], 0
            for s in _sets(data, off, k):
                x = _class_id(s)
                low = x & ((64 << FILTER_BITS) - 1)
                if not int(maybe[low >> 6]) >> (low & 63) & 1 or x in done:
                    continue
                done.add(x)
                c.append(x)
                p.append(s.tobytes())
                size += len(p[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(p, pa.binary())], ["c", "toks"])
                    c, p, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(p, pa.binary())], ["c", "toks"])

    # written once: both sides of the pairs read it, and the texts are gone through once
    found = scratch.table(docs.select("text").mapInArrow(whole, "c long, toks binary"))
    shared_maybe.destroy()
    toks = found.dropDuplicates(["c"])
    both = (pairs.join(toks.select(F.col("c").alias("c1"), F.col("toks").alias("t1")), "c1")
            .join(toks.select(F.col("c").alias("c2"), F.col("toks").alias("t2")), "c2"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("t1"), batch.column("t2")):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            got = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([got.column("c1"), got.column("c2")], ["a", "b"])

    links = scratch.table(both.mapInArrow(check, "a long, b long"))
    scratch.drop(found)
    return links


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (the row's id names its component)."""
    docs = pick(docs, doc_id=doc_id, text=text)
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows, roots = link_classes(docs, scratch, k, percent)
    group = F.coalesce("root", "c")
    rows = rows.join(roots, rows["c"] == roots["node"], "left").select("doc_id", "n", group.alias("g"))
    first = rows.where("n > 0").groupBy(F.col("g").alias("g1")).agg(F.min("doc_id").alias("first_id"))
    out = rows.join(first, (rows["g"] == first["g1"]) & (rows["n"] > 0), "left")
    of = F.when(F.col("n") > 0, F.col("first_id")).otherwise(F.col("doc_id"))
    return scratch.table(out.select("doc_id", F.col("n").alias("n_shingles"), of.alias("component_id"), F.coalesce(of == F.col("doc_id"), F.lit(False)).alias("kept")))


def one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies, with all its columns: the one of the smallest doc_id (a null id comes
    last), then of the smallest hash of id and text.  Rows equal in id and text stay once, null ids included; rows that
    share an id but not their text are documents of their own.  Texts without words link with nothing and stay."""
    key = "_row_key"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    named = keyed.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col(key).alias("key")).alias("doc_id"), "text")
    keep = jaccard_groups(named, k=k, percent=percent).where("kept").select(F.col("doc_id.key").alias(key)).distinct()
    return keyed.dropDuplicates([key]).join(keep, key, "left_semi").drop(key)
