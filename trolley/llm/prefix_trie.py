"""Conversation prefix trie: shared openings of conversations, rolled up in depth bands.

Turns get a 128-bit hash of (place, role, text); a prefix is the exclusive-or of its turns' hashes, so equal prefixes
of any two conversations carry equal ids and a conversation's prefixes come from one running fold.  (Two different
prefixes share an id with a chance of about n * n / 2 ** 129 for n prefixes.)  A node is a distinct prefix.

Sums over subtrees go in bands of ``height`` depths.  Within a band every node explodes to its ancestors of the same
band only (at most ``height`` rows a node) and the rows are added up by ancestor; the completed totals of the band's
topmost nodes then go to their parents, the bottom nodes of the band above.  With a longest conversation of D turns,
``height`` is max(16, sqrt(D)) rounded up, so there are at most sqrt(D) rounds and as many rows a node.

No step holds a whole conversation, a whole node or a whole list of members in one row or window:

* turns are numbered by (conversation, block of 64 turn numbers), offsets come from the counts of blocks;
* prefixes are folded by (conversation, band), earlier bands come from the bands' own folds;
* parents with over a thousandth of all nodes as children (fewer than 1,000) are broadcast, others joined by id;
* members that end at a node are joined in pieces of 4,096 consecutive ids, and a streaming SHA-256 reads the pieces
  in order, one at a time.

Results for odd rows: rows without conv_id belong to no conversation; a null role or text is empty; turns with equal
numbers (nulls first) are ordered by role, then text, and repeated rows are turns of their own; a conversation whose
rebuilt form has no turn is a member of the root alone; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, pick

TURN_BLOCK = 64
PIECE_IDS = 4096
HEAVY_SHARE = 1000
LEAST_HEIGHT = 16
DONATED = 5  # at most so many turns come from the first conversation of a hundred
ROOT = (0, 0)


def _hash(salt: int, *cols: Column | str) -> Column:
    return F.xxhash64(F.lit(salt), *cols)


def rebuilt_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, t1, t2, size) of the rebuilt conversations, pos from 1, and every conversation (conv, length).

    Conversation c starts with the first h original turns of conversation c - c % 100, then has its own after its
    first h; h is the unsigned crc32 of c's decimal digits modulo 6."""
    c = (pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv IS NOT NULL")
         .select(F.col("conv").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
         .withColumn("block", F.coalesce(F.floor(F.col("turn") / TURN_BLOCK), F.lit(-(1 << 62)))))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    hashed = [_hash(1, "role", "text").alias("t1"), _hash(2, "text", "role").alias("t2"), F.char_length("text").alias("size")]
    opening = (c.where("conv % 100 = 0").withColumn("rank", F.row_number().over(Window.partitionBy("conv").orderBy(*order)))
               .where(F.col("rank") <= DONATED).select("conv", "rank", *hashed)
               .groupBy(F.col("conv").alias("donor")).agg(F.array_sort(F.collect_list(F.struct("rank", "t1", "t2", "size"))).alias("opening")))
    by_block = Window.partitionBy("conv").orderBy("block")
    blocks = (c.groupBy("conv", "block").agg(F.count("*").alias("n"))
              .select("conv", "block", F.coalesce(F.sum("n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                      F.sum("n").over(Window.partitionBy("conv")).alias("turns"), F.row_number().over(by_block).alias("nth"),
                      (F.col("conv") - F.col("conv") % 100).alias("donor"),
                      (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).cast("int").alias("h"))
              .join(opening, "donor", "left")
              .select("conv", "block", "before", "turns", "nth", "h", F.slice(F.coalesce("opening", F.array()), 1, F.col("h")).alias("given")))
    blocks = blocks.withColumn("given_n", F.size("given"))
    one_each = blocks.where("nth = 1")
    given = one_each.select("conv", F.explode("given").alias("g")).select(
        "conv", F.col("g.rank").cast("long").alias("pos"), "g.t1", "g.t2", "g.size")
    rank = F.row_number().over(Window.partitionBy("conv", "block").orderBy(*order))
    own = (c.withColumn("rank", rank).select("conv", "block", "rank", *hashed)
           .join(blocks.select("conv", "block", "before", "h", "given_n"), ["conv", "block"])
           .withColumn("rank", F.col("rank") + F.col("before")).where("rank > h")
           .select("conv", (F.col("rank") - F.col("h") + F.col("given_n")).alias("pos"), "t1", "t2", "size"))
    lengths = one_each.select("conv", (F.col("given_n") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("length"))
    return given.unionByName(own), lengths


def band_paths(turns: DataFrame, height: int) -> DataFrame:
    """(conv, band, path, up, last): the node ids of each conversation's prefixes in a band of depths, in order, the
    id of the prefix before the band, and whether it is the conversation's last band."""
    band = Window.partitionBy("conv", "band").orderBy("pos")
    folded = (turns.withColumn("band", F.floor((F.col("pos") - 1) / height).cast("int"))
              .select("conv", "band", "pos", "size", F.bit_xor(_hash(3, "pos", "t1", "t2")).over(band).alias("x1"),
                      F.bit_xor(_hash(4, "t2", "pos", "t1")).over(band).alias("x2")))
    path = folded.groupBy("conv", "band").agg(F.array_sort(F.collect_list(F.struct("pos", "x1", "x2", "size"))).alias("path"))
    before = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    nul = F.lit(0).cast("long")
    whole = path.select(
        "conv", "band", "path", F.coalesce(F.bit_xor(F.element_at("path", -1)["x1"]).over(before), nul).alias("u1"),
        F.coalesce(F.bit_xor(F.element_at("path", -1)["x2"]).over(before), nul).alias("u2"),
        F.lead("band").over(Window.partitionBy("conv").orderBy("band")).isNull().alias("last"))
    return whole.select("conv", "band", F.struct("u1", "u2").alias("up"), "last", F.transform("path", lambda p: F.struct(
        p["x1"].bitwiseXOR(F.col("u1")).alias("u1"), p["x2"].bitwiseXOR(F.col("u2")).alias("u2"), p["size"].alias("size"))).alias("path"))


def _nodes(paths: DataFrame, height: int) -> DataFrame:
    """One row per node but the root: id, parent, conv (smallest member), members, depth, band, size of the last text."""
    ids = F.transform("path", lambda p: F.struct(p["u1"].alias("u1"), p["u2"].alias("u2")))
    steps = paths.select("conv", "band", F.posexplode(F.arrays_zip(
        ids.alias("id"), F.concat(F.array("up"), F.slice(ids, 1, F.size("path") - 1)).alias("up"), F.transform("path", lambda p: p["size"]).alias("size"))).alias("i", "s"))
    return (steps.groupBy(F.col("s.id").alias("id")).agg(
        F.min("conv").alias("conv"), F.count("*").alias("members"), F.max("s.up").alias("up"), F.max("s.size").alias("size"),
        F.max(F.col("band").cast("long") * height + F.col("i") + 1).alias("depth"), F.max("band").alias("band")))


def _rollup(scratch: Scratch, nodes: DataFrame, paths: DataFrame, bands: int, height: int) -> DataFrame:
    """(id, leaves, saved) of every node's subtree, written band by band from the deepest."""
    out, arriving = None, None
    for b in reversed(range(bands)):
        own = nodes.where(F.col("band") == b).select("id", "leaf", "saving")
        if arriving is not None:
            own = own.unionByName(arriving).groupBy("id").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
        place = nodes.where(F.col("band") == b).select("id", "conv", "depth")
        path = paths.where(F.col("band") == b).select("conv", F.transform("path", lambda p: F.struct(p["u1"].alias("u1"), p["u2"].alias("u2"))).alias("path"))
        # a node's ancestors stand on the path of its smallest member
        above = place.join(path, "conv").select("id", F.slice("path", 1, (F.col("depth") - b * height).cast("int")).alias("above"))
        done = scratch.table(own.join(above, "id").select(F.explode("above").alias("id"), "leaf", "saving")
                             .groupBy("id").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved")))
        out = done if out is None else out.unionByName(done)
        tops = nodes.where(F.col("depth") == b * height + 1).select("id", "up")
        arriving = (done.join(tops, "id").groupBy(F.col("up").alias("id"))
                    .agg(F.sum("leaves").alias("leaf"), F.sum("saved").alias("saving")))
    if arriving is not None:  # the root's own totals
        root = arriving.select("id", F.col("leaf").alias("leaves"), F.col("saving").alias("saved"))
        out = out.unionByName(scratch.table(root))
    return out


def ends_digests(ends: DataFrame) -> DataFrame:
    """(id, digest): SHA-256 of the members (conv) that end at a node, ascending and joined by commas."""
    piece = F.floor(F.col("conv") / PIECE_IDS)
    pieces = (ends.groupBy("id", piece.alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
              .select("id.u1", "id.u2", "piece", "ids").repartition("u1", "u2").sortWithinPartitions("u1", "u2", "piece"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for u1, u2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if now == (u1, u2):
                    state.update(b",")
                else:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (u1, u2), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield table(done)
                done = []
        if now is not None:
            yield table([(*now, state.hexdigest())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["u1", "u2", "digest"])

    return pieces.mapInArrow(digest, "u1 bigint, u2 bigint, digest string").select(F.struct("u1", "u2").alias("id"), "digest")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", least_height: int = LEAST_HEIGHT) -> DataFrame:
    """One row per node of the trie: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    turns, lengths = rebuilt_turns(conversations, conv_col, turn_col, role_col, text_col)
    lengths = scratch.table(lengths)
    convs, first, longest = lengths.agg(F.count("*"), F.min("conv"), F.max("length")).first()
    height = max(least_height, math.ceil(math.sqrt(longest or 0)))
    paths = scratch.table(band_paths(turns, height))
    root_id = F.struct(*[F.lit(x).cast("long").alias(n) for n, x in zip(("u1", "u2"), ROOT)])
    found = scratch.table(_nodes(paths, height))
    children = found.groupBy(F.col("up").alias("id")).agg(F.count("*").alias("children"))
    nodes = scratch.table(found.join(children, "id", "left").select(
        "id", "up", "conv", "members", "depth", "band", F.coalesce("children", F.lit(0)).alias("children"),
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaf"), ((F.col("members") - 1) * F.col("size")).alias("saving")))
    n_nodes = nodes.count()
    totals = _rollup(scratch, nodes, paths, math.ceil((longest or 0) / height), height)
    if not n_nodes:  # only conversations without turns, or none
        totals = conversations.sparkSession.range(1 if convs else 0).select(root_id.alias("id"), F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    ends = (paths.where("last").select(F.element_at("path", -1).alias("p"), "conv").select(F.struct("p.u1", "p.u2").alias("id"), "conv")
            .unionByName(lengths.where("length = 0").select(root_id.alias("id"), "conv")))
    root = nodes.where("depth = 1").agg(F.count("*").alias("children")).select(
        root_id.alias("id"), F.lit(first).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(convs).alias("members"), "children")
    # each node's values meet by id in one grouping
    values = ("conv", "depth", "members", "children", "leaves", "saved", "digest", "parent")

    def part(df: DataFrame) -> DataFrame:
        kinds = dict.fromkeys(values, "long") | {"digest": "string"}
        return df.select("id", *[F.col(v).cast(kinds[v]) if v in df.columns else F.lit(None).cast(kinds[v]).alias(v) for v in values])

    whole = nodes.select("id", "conv", "depth", "members", "children")
    if convs:
        whole = whole.unionByName(root)
    one = (part(whole).unionByName(part(totals)).unionByName(part(ends_digests(ends))).unionByName(part(_parents(nodes, n_nodes, root_id, first)))
           .groupBy("id").agg(*[F.max(v).alias(v) for v in values]))
    return one.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def _parents(nodes: DataFrame, n_nodes: int, root_id: Column, first: int | None) -> DataFrame:
    """(id, parent): the smallest member of each node's parent."""
    top = nodes.where("depth = 1").select("id", F.lit(first).cast("long").alias("parent"))
    many = F.col("children") * HEAVY_SHARE > n_nodes
    heavy = F.broadcast(nodes.where(many).select(F.col("id").alias("up"), F.col("conv").alias("parent")))  # fewer than HEAVY_SHARE rows
    below = nodes.where("depth > 1").select("id", "up").join(heavy, "up", "left")
    others = nodes.where(~many & (F.col("children") > 0)).select(F.col("id").alias("up"), F.col("conv").alias("parent"))
    light = below.where("parent IS NULL").select("id", "up").join(others, "up").select("id", "parent")
    return top.unionByName(below.where("parent IS NOT NULL").select("id", "parent")).unionByName(light)
