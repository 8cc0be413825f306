"""Near copies of embeddings by NN-descent.

Vectors of one label (and one length) are compared by cosine in double precision.

1. Equal vectors of a label collapse into one node, so a vector that many rows share is one node.
2. First neighbours: nodes are sorted by label and by the signs of random projections, several times; runs of
   ``RUN`` consecutive nodes are compared.  Runs have a fixed length, however many nodes are alike.
3. NN-descent: the neighbours of a node, and the nodes it is a neighbour of, are compared with each other;
   what beats a node's worst neighbour enters its list.  A list whose entries all reach the threshold is
   saturated and may double in each round.  Long reverse lists are dealt into cells of bounded size.
4. Links (cosine >= threshold) make first components.
5. Exact pass: all pairs of a label are compared, block against block.  Only the number of links of each node
   and the pairs of first components that a link joins leave a task, so neither a large group nor a link that
   the search has missed depends on lists, projections or samples.  Products are made in single precision;
   pairs within its rounding error of the threshold are decided in double precision.  The work of this pass
   grows with the square of a label's distinct vectors; a block has a bounded size.

Defined results: a null label, or a vector that is null, empty, zero or has null or non-finite components,
links with nothing (n_links 0, its own component, kept); repeated rows link with each other as equal vectors;
a null vec_id takes part, and names no component unless all ids of it are null; extra columns are ignored; an
empty table gives an empty result.  Nodes are identified by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, components, pick

K = 8
RUN = 128
TREES = 4
ROUNDS = 4
CELL = 48
CHUNK = 512
LARGEST_CHUNK = 16384
COPIES = 8  # of a vector in the exact pass, while blocks are between the two sizes
TILE = 512


def units(column, kind: str) -> np.ndarray:
    """Unit vectors in double precision from packed vectors of one length."""
    x = np.stack([np.frombuffer(v.as_buffer(), kind) for v in column]).astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def runs(batches, keys: list[str], longest: int | None):
    """Row groups with equal keys, of sorted input; cut at ``longest`` rows.  Holds one group between batches."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t
        change = np.zeros(t.num_rows - 1, bool)
        for k in keys:
            c = t.column(k).combine_chunks().dictionary_encode()
            c = c.indices.to_numpy() if isinstance(c, pa.DictionaryArray) else c.chunk(0).indices.to_numpy()
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, [*cuts[1:], t.num_rows]):
            while longest and b - a > longest:
                yield t.slice(a, longest)
                a += longest
            if b < t.num_rows:
                yield t.slice(a, b - a)
        rest = t.slice(a, b - a)
    if rest is not None:
        yield rest


def nearest(ids: np.ndarray, sim: np.ndarray, bound: np.ndarray | None = None, k: int = K) -> list[np.ndarray]:
    """(a, b, sim) of each row's best k others, above its bound."""
    np.fill_diagonal(sim, -2.0)
    n = len(ids)
    if n < 2:
        return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    top = np.argpartition(-sim, min(k, n - 1) - 1, axis=1)[:, :k] if n > k else np.argsort(-sim, axis=1)[:, :n - 1]
    rows = np.repeat(np.arange(n), top.shape[1])
    cols = top.ravel()
    good = sim[rows, cols] > (bound[rows] if bound is not None else -1.5)
    rows, cols = rows[good], cols[good]
    return [ids[rows], ids[cols], sim[rows, cols]]


def _edges(found):
    """Batches of (a, b, sim) from an iterator of triples."""
    have, size = [], 0
    for x in found:
        have.append(x)
        size += len(x[0])
        if size > 100_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[i] for h in have])) for i in range(3)], ["a", "b", "sim"])
            have, size = [], 0
    if have:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[i] for h in have])) for i in range(3)], ["a", "b", "sim"])


EDGE = "a long, b long, sim double"


def near_vectors(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    own = pick(vectors, vec_id=vec_id, embedding=embedding, label=label)
    kind = "float32" if own.schema["embedding"].dataType.elementType.simpleString() == "float" else "float64"
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    packed = F.col("embedding") if kind == "float32" else F.col("embedding").cast("array<double>")
    rows = own.select("vec_id", F.when(valid, F.concat_ws(":", F.col("label").cast("string"), F.size("embedding"))).alias("grp"), packed.alias("v"))
    rows = rows.select("vec_id", "grp", "v", F.when(F.col("grp").isNotNull(), F.xxhash64("grp", "v")).alias("id"))
    distinct = rows.where("grp is not null").groupBy("grp", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("rep"), F.min("id").alias("id"))

    def pack(batches):
        for b in batches:
            vec = pa.array([np.asarray(x.values, kind).tobytes() for x in b.column("v")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("grp"), b.column("n"), b.column("rep"), vec], ["id", "grp", "n", "rep", "vec"])

    id_type = own.schema["vec_id"].dataType.simpleString()
    nodes = scratch.table(distinct.select("id", "grp", "n", "rep", "v").mapInArrow(pack, f"id long, grp string, n long, rep {id_type}, vec binary"))
    total = nodes.count()
    lists = scratch.table(best(first_neighbours(nodes, kind), K, threshold, 0))
    for r in range(1, ROUNDS + 1):
        new = scratch.table(join_neighbours(nodes, lists, kind, K))
        entered = new.count()
        merged = scratch.table(best(lists.unionByName(new), K, threshold, r))
        scratch.drop(lists, new)
        lists = merged
        if entered <= 0.01 * K * total:
            break
    first = scratch.table(components(scratch, lists.where(F.col("sim") >= threshold).select("a", "b")))
    rooted = scratch.table(nodes.join(first, F.col("id") == F.col("node"), "left").select("id", "grp", "n", "vec", F.coalesce("root", "id").alias("root")))
    exact = scratch.table(all_pairs(rooted, kind, threshold))
    counts = exact.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    joined = components(scratch, exact.where("b is not null").select("a", "b"))
    roots = rooted.select(F.col("id").alias("member"), F.col("root").alias("r0")).join(joined, F.col("r0") == F.col("node"), "left")
    roots = roots.select(F.col("member").alias("node"), F.coalesce("root", "r0").alias("root"))
    facts = nodes.select("id", "n", "rep").join(roots, F.col("id") == F.col("node"), "left").join(counts, "id", "left")
    facts = facts.select("id", "n", "rep", F.coalesce("root", "id").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    names = facts.groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("component"))
    facts = facts.join(names, F.col("root") == F.col("r")).select(F.col("id").alias("node"), (F.col("links") + F.col("n") - 1).alias("links"), "component")
    out = rows.select("vec_id", "id").join(facts, F.col("id") == F.col("node"), "left")
    component = F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return scratch.table(out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))


def first_neighbours(nodes: DataFrame, kind: str) -> DataFrame:
    """Each node's best neighbours in runs along the signs of random projections."""
    def codes(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            ids, grp, vec = b.column("id").to_numpy(), b.column("grp"), b.column("vec")
            width = np.array([len(x.as_buffer()) for x in vec])
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                v = vec.take(pa.array(at))
                u = units(v, kind)
                if w not in planes:
                    planes[w] = np.random.default_rng([0, int(w)]).normal(size=(TREES, u.shape[1], 62))
                for t in range(TREES):
                    code = ((u @ planes[w][t] > 0) << np.arange(62)[::-1]).sum(1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), grp.take(pa.array(at)), pa.array(code), pa.array(ids[at]), v], ["t", "grp", "code", "id", "vec"])

    def compare(batches):
        def pairs():
            for t in runs(batches, ["t", "grp"], RUN):
                u = units(t.column("vec"), kind)
                yield nearest(t.column("id").to_numpy(), u @ u.T)
        yield from _edges(pairs())

    coded = nodes.select("id", "grp", "vec").mapInArrow(codes, "t int, grp string, code long, id long, vec binary")
    return coded.repartitionByRange("t", "grp", "code", "id").sortWithinPartitions("t", "grp", "code", "id").mapInArrow(compare, EDGE)


def best(edges: DataFrame, size: int, threshold: float, r: int) -> DataFrame:
    """The lists (a, b, sim): each node's ``size`` nearest; a saturated list has doubled in each round."""
    w = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    ranked = edges.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("rank", F.row_number().over(w))
    return ranked.where((F.col("rank") <= size) | (F.col("sim") >= threshold) & (F.col("rank") <= size << r)).drop("rank")


def join_neighbours(nodes: DataFrame, lists: DataFrame, kind: str, size: int) -> DataFrame:
    """Pairs of neighbours of one node that beat the worst entry of either's list."""
    worst = lists.groupBy("a").agg(F.min("sim").alias("bound"), F.count("*").alias("have"))
    member = nodes.select("id", "vec").join(worst, F.col("id") == F.col("a")).select("id", "vec", F.when(F.col("have") < size, F.lit(-1.5)).otherwise(F.col("bound")).alias("bound"))
    both = lists.select("a", "b").unionByName(lists.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    cells = both.groupBy("a").agg(F.ceil(F.count("*") / CELL).alias("cells"))
    # a node joins its own cells as a member too: lists are symmetric then
    dealt = both.join(cells, "a").select(F.col("a").alias("centre"), F.pmod(F.xxhash64("b"), "cells").alias("cell"), F.col("b").alias("id"))
    rows = dealt.join(member, "id").select("centre", "cell", "id", "bound", "vec")

    def compare(batches):
        def pairs():
            for t in runs(batches, ["centre", "cell"], None):
                if t.num_rows > 1:
                    u = units(t.column("vec"), kind)
                    yield nearest(t.column("id").to_numpy(), u @ u.T, t.column("bound").to_numpy())
        yield from _edges(pairs())

    found = rows.repartition("centre", "cell").sortWithinPartitions("centre", "cell", "id").mapInArrow(compare, EDGE)
    found = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")).groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return found.join(lists.select("a", "b"), ["a", "b"], "left_anti")


def all_pairs(rooted: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(a, b, links) of all pairs of a group: with b null, rows linked with node a in one other block, its own
    copies aside; else two first components with a link between them."""
    size = rooted.groupBy(F.col("grp").alias("g")).agg(F.count("*").alias("rows"))
    chunk = F.least(F.lit(LARGEST_CHUNK), F.greatest(F.lit(CHUNK), F.ceil(F.col("rows") / COPIES)))
    member = rooted.join(size.select("g", F.ceil(F.col("rows") / chunk).cast("int").alias("chunks")), F.col("grp") == F.col("g"))
    member = member.select("grp", "chunks", F.pmod(F.xxhash64("id", F.lit(2)), "chunks").cast("int").alias("chunk"), "id", "n", "root", "vec")
    fields = ("id", "n", "root")

    def pack(batches):
        for t in runs(batches, ["grp", "chunk"], 2 * LARGEST_CHUNK):
            cols = [pa.array([t.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()) for c in fields]
            vec = pa.array([b"".join(t.column("vec").to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([t.column(c).slice(0, 1).combine_chunks() for c in ("grp", "chunks", "chunk")] + [*cols, vec], ["grp", "chunks", "chunk", *fields, "vec"])

    packed = member.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk").mapInArrow(pack, "grp string, chunks int, chunk int, id binary, n binary, root binary, vec binary")
    other = packed.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o"))
    meet = other.select("grp", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"), "chunk", *fields, "vec")

    def unpacked(t, r: int) -> tuple:
        ids, n, root = (np.frombuffer(t.column(c)[r].as_buffer(), np.int64) for c in fields)
        x = np.frombuffer(t.column("vec")[r].as_buffer(), kind).reshape(len(ids), -1).astype(np.float64)
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        return ids, n.astype(np.float64), root, x, x.astype(np.float32)

    def compare(batches):
        for t in runs(batches, ["grp", "i", "j"], None):
            sides = [unpacked(t, r) for r in range(t.num_rows)]
            if t.column("i")[0].as_py() == t.column("j")[0].as_py():
                pairs = [(p, q) for p in range(len(sides)) for q in range(p, len(sides))]
            else:  # a block may be in several rows
                chunk = t.column("chunk").to_pylist()
                pairs = [(p, q) for p in range(len(sides)) for q in range(p) if chunk[p] != chunk[q]]
            for p, q in pairs:
                yield from block(sides[p], sides[q], p == q)

    def block(one, two, same: bool):
        (ids, n, root, x, x32), (ids2, n2, root2, y, y32) = one, two
        unsure = (x.shape[1] + 8) * 1.2e-7  # more than the error of a product in single precision
        links, links2, joins = np.zeros(len(ids)), np.zeros(len(ids2)), []
        for lo in range(0, len(x), TILE):
            sim = x32[lo:lo + TILE] @ y32.T
            link = sim >= threshold + unsure
            r, c = np.nonzero((sim >= threshold - unsure) ^ link)
            for at in range(0, len(r), 65536):
                i, j = r[at:at + 65536], c[at:at + 65536]
                link[i, j] = (x[lo + i] * y[j]).sum(1) >= threshold
            if same:
                d = np.arange(len(link))
                link[d, lo + d] = False
            hit = np.flatnonzero(link.any(1))
            if len(hit):
                part = link[hit]
                links[lo + hit] += part @ n2
                if not same:
                    links2 += n[lo + hit] @ part
                r, c = np.nonzero(part & (root[lo + hit][:, None] != root2[None, :]))
                if len(r):
                    joins.append(np.unique(np.stack([root[lo + hit[r]], root2[c]]), axis=1))
        a, k = (ids, links) if same else (np.concatenate([ids, ids2]), np.concatenate([links, links2]))
        some = k > 0
        yield pa.RecordBatch.from_arrays([pa.array(a[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(k[some].astype(np.int64))], ["a", "b", "links"])
        if joins:
            e = np.unique(np.concatenate(joins, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1]), pa.nulls(e.shape[1], pa.int64())], ["a", "b", "links"])

    return meet.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "chunk").mapInArrow(compare, "a long, b long, links long")
