"""The pipeline, stage by stage, on documents with planted cases."""

from __future__ import annotations

import collections
import random

import corpus_pipeline
from tests.llm.test_operators import prose
from trolley.llm.mixing import mix
from trolley.llm.quality import quality_scores


def test_pipeline(spark, tmp_path):
    r = random.Random(1)
    good = prose(600, 11, 400)
    texts = [t if i % 3 else "BUY!! NOW!! " + " ".join(r.choice(["CLICK!!", "WIN!!", "FREE!!"]) for _ in range(60)) for i, t in enumerate(good)]
    item = " ".join(f"q{j}" for j in range(15)) + ". " + " ".join(f"a{j}" for j in range(4)) + "."
    texts[4] += " " + item
    texts += [texts[1] + " more", texts[2], texts[2].upper()]
    rows = [(i, t, "en", f"s{i % 2}" if i % 7 else None, len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    scored = quality_scores(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).where("predicted = 1").collect()
    accepted = {x.doc_id for x in scored}
    assert {1, 2, 4} <= accepted and len(accepted & {i for i in range(600) if i % 3}) > 380 and not accepted & set(range(0, 600, 3))
    unique = accepted - {600, 601, 602}  # near and exact copies of 1 and 2
    want = unique - {4}  # holds the test item
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage{k}")
        if k < 4:
            assert out.columns == docs.columns
        kept = spark.read.parquet(f"{tmp_path}/stage{k}")
        sizes.append(kept.count())
    assert sizes == [len(accepted), len(unique), len(want), len(want), len(want)]
    assert {x.doc_id for x in kept.collect()} == want
    assert {x.doc_id for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_slots_follow_the_mixed_order(spark, tmp_path):
    rows = [(i, t, "en", "a" if i % 10 else "b", len(t)) for i, t in enumerate(prose(400, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    position = {x.doc_id: x.position for x in mix(docs).collect()}
    clash = corpus_pipeline.mix_sources(spark, docs, "").selectExpr("*", "1 AS _file", "2 AS _row", "3 AS file", "4 AS row", "5 AS turn", "6 AS piece")
    clash.write.parquet(f"{tmp_path}/mixed")
    out = corpus_pipeline.assign_shards(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").collect()
    by_shard = collections.defaultdict(list)
    for x in sorted(out, key=lambda x: x.slot):
        by_shard[x.shard].append((x.slot, position[x.doc_id]))
    assert len(out) == 400 and len(by_shard) == corpus_pipeline.SHARDS
    for of in by_shard.values():
        assert [s for s, _ in of] == list(range(len(of))) and [p for _, p in of] == sorted(p for _, p in of)


def test_near_copies_keep_every_text(spark):
    """Rows that share an id keep their different texts; equal rows, without an id too, stay once."""
    from trolley.llm.jaccard_join import one_of_each_group

    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, 0), (1, b, 0), (2, b, 0), (None, c, 0), (None, c, 0), (None, c, 0), (3, a + " end", 0), (None, a, 0), (4, None, 0), (5, "", 0), (7, "x y", 0), (7, "x y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row_key int")
    got = sorted(((r.doc_id, r.text) for r in one_of_each_group(docs).collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (None, c), (4, None), (5, ""), (7, "x y")], key=repr)
    assert one_of_each_group(docs).columns == docs.columns
