"""The keyed table, its merges and replays, and the loads and incremental counts that stand on it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.frames import warehouse
from trolley.operators import affinity as af
from trolley.plans.warehouse import Warehouse
from trolley.session import work_dir
from trolley.sources import store
from trolley.sources.keyed import KeyedTable, width_for
from trolley.sources.schemas import RAW_KEYS, RAW_TABLES
from trolley.streaming import incremental as inc

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("j", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("seq", T.IntegerType())])


def _table(spark, name, width=10):
    import uuid

    return KeyedTable(spark, f"{work_dir(spark)}/tests/{name}-{uuid.uuid4().hex[:8]}", ["k", "j"], SCHEMA, width)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _parts(t):
    """Data files by range, of the versions that the manifest names."""
    m = t.manifest()
    return {r: [f for f in store.files(t.spark, f"{t.path}/data/v={v}/_range={r}") if f[0].endswith(".parquet")] for r, v in m.ranges.items()}


def test_merge_rewrites_only_touched_ranges(spark):
    t = _table(spark, "ranges")
    t.merge(_frame(spark, [(k, 0, "a", 1) for k in range(200)]))
    before = _parts(t)
    done = t.merge(_frame(spark, [(15, 0, "b", 2), (17, 3, "new", 1), (512, 0, "far", 1)]))
    after = _parts(t)
    assert done.touched == (1, 51) and done.kept == 19
    assert {r for r in after if after[r] != before.get(r)} == {1, 51}  # every other file is the very same file
    assert sum(len(store.files(spark, f"{t.path}/data/v=1/_range={r}")) > 0 for r in (1, 51)) == 2
    rows = {(r.k, r.j): r.v for r in t.read().collect()}
    assert len(rows) == 202 and rows[15, 0] == "b" and rows[17, 3] == "new" and rows[16, 0] == "a"
    plan = t.read([1])._jdf.queryExecution().executedPlan().toString()
    assert t.read([1]).count() == 11 and "PartitionFilters" in plan and "_range" in plan.split("PartitionFilters")[1]


def test_merges_equal_a_dictionary(spark):
    r = random.Random(2)
    t, want = _table(spark, "random", width=7), {}
    for b in range(4):
        rows = [(r.randrange(-40, 40), r.randrange(2), r.choice("abcd") if r.random() < 0.9 else None, r.randrange(5)) for _ in range(60)]
        t.merge(_frame(spark, rows), "feed", b, order_col="seq")
        best = {}
        for k, j, v, s in rows:  # nulls sort first
            best[k, j] = max(best.get((k, j), (-1,)), (s, v is not None, v or ""))
        for key, x in best.items():
            if key not in want or x[0] >= want[key][0]:
                want[key] = x
    got = {(x.k, x.j): (x.seq, x.v is not None, x.v or "") for x in t.read().collect()}
    assert got == want


def test_batch_without_order_wins_over_the_table(spark):
    t = _table(spark, "plain")
    t.merge(_frame(spark, [(1, 1, "z", 9)]))
    t.merge(_frame(spark, [(1, 1, "a", 0)]))
    assert [tuple(x) for x in t.read().collect()] == [(1, 1, "a", 0)]


def test_replayed_batch_and_unfinished_version_change_nothing(spark):
    t = _table(spark, "replay")
    t.merge(_frame(spark, [(1, 0, "a", 1)]), "f", 0)
    _frame(spark, [(1, 0, "torn", 1)]).withColumn("_range", F.lit(0)).write.partitionBy("_range").parquet(f"{t.path}/data/v=1")  # died before its manifest
    assert [x.v for x in t.read().collect()] == ["a"]
    again = t.merge(_frame(spark, [(1, 0, "other", 1)]), "f", 0)
    assert again.replayed and [x.v for x in t.read().collect()] == ["a"]
    t.merge(_frame(spark, [(1, 0, "b", 1)]), "f", 1)
    assert [x.v for x in t.read().collect()] == ["b"] and t.vacuum() == 1
    assert [x.v for x in t.read().collect()] == ["b"]
    other = KeyedTable(spark, t.path, ["k", "j"], SCHEMA, 999)
    assert other.width == 10  # a table keeps its ranges


def test_null_key_is_refused(spark):
    with pytest.raises(Exception, match="null in key k, j"):
        _table(spark, "null").merge(_frame(spark, [(1, None, "a", 1)]))


def test_empty_batch_and_width(spark):
    t = _table(spark, "empty")
    assert t.merge(_frame(spark, [])).touched == () and t.read().count() == 0
    assert width_for(1, 1600, 0) == 100 and width_for(5, 5, 10 ** 12) == 1


def test_stream_upsert_rewrites_few_ranges(spark):
    wh, merges = Warehouse(spark, "/root/testdata/sf0.001"), []
    got = inc.stream_upsert(wh, files_per_trigger=2, on_merge=merges.append)
    assert sorted(got.collect()) == sorted(wh.stg_orders.collect())
    ranges = len(inc.upserted_orders(wh).manifest().ranges)
    assert len(merges) >= 6 and ranges >= 12
    assert all(len(m.touched) <= ranges // 2 for m in merges)  # two of eight files, and their neighbours


def test_pair_batches_do_not_read_more_and_more(spark):
    wh, seen = Warehouse(spark, "/root/testdata/sf0.001"), []

    def note(batch_id, touched, earlier):
        files = sum(f[1] for r in touched for v in [inc.seen_items(wh, 50).manifest().ranges.get(r)] if v is not None
                    for f in store.files(spark, f"{inc.seen_items(wh, 50).path}/data/v={v}/_range={r}"))
        seen.append((len(touched), files))

    got = inc.stream_pair_counts(wh, files_per_trigger=1, on_batch=note)
    assert sorted(got.collect()) == sorted(af.product_pairs(wh).collect())
    whole = sum(f[1] for fs in _parts(inc.seen_items(wh, 50)).values() for f in fs)
    assert len(seen) >= 8
    assert max(b for _, b in seen[4:]) < whole / 2  # the last batches read a few ranges, not the history


def test_pair_batch_replayed_after_its_merge_counts_once(spark, monkeypatch):
    wh = warehouse(spark)
    real, calls = KeyedTable.merge, []

    def dies_after(self, *a, **b):
        done = real(self, *a, **b)
        calls.append(done)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return done

    monkeypatch.setattr(KeyedTable, "merge", dies_after)
    with pytest.raises(Exception, match="lost"):
        inc.stream_pair_counts(wh, files_per_trigger=1)
    monkeypatch.setattr(KeyedTable, "merge", real)
    assert sorted(inc.stream_pair_counts(wh, files_per_trigger=1).collect()) == sorted(af.product_pairs(wh).collect())


def _loaded(wh):
    return {t: sorted(inc.loaded_table(wh, t).read().drop("_seq").collect(), key=str) for t in RAW_TABLES}


def test_load_resumes_after_a_crash(spark, monkeypatch):
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    commits, real = [], KeyedTable._commit

    def dies(self, m):
        commits.append(self.path)
        if self.path.endswith("/orders") and m.version == 1:
            raise RuntimeError("lost before the manifest")
        real(self, m)

    monkeypatch.setattr(KeyedTable, "_commit", dies)
    with pytest.raises(Exception, match="lost before the manifest"):
        inc.load_tables(wh, files_per_trigger=2)
    monkeypatch.setattr(KeyedTable, "_commit", real)
    ledger = {(r.table_name, r.batch): r.status for r in inc.load_ledger(wh).read().collect()}
    assert ledger["orders", 0] == "merged" and ledger["orders", 1] == "loading"
    done = commits.count(inc.loaded_table(wh, "products").path)
    inc.load_tables(wh, files_per_trigger=2)
    assert commits.count(inc.loaded_table(wh, "products").path) == done  # finished loads do nothing again
    assert _loaded(wh) == {t: sorted(wh.raw(t).collect(), key=str) for t in RAW_TABLES}
    ledger = inc.load_ledger(wh).read().collect()
    assert {r.status for r in ledger} == {"merged"}
    assert all(sum(r.table_name == t for r in ledger) >= 3 for t in RAW_TABLES)
    for t in RAW_TABLES:
        twice = wh.raw(t).where(sum((F.col(k) for k in RAW_KEYS[t][1:]), F.col(RAW_KEYS[t][0])) % 2 == 0).count()
        assert sum(r.row_count for r in ledger if r.table_name == t) == wh.raw(t).count() + twice


def test_ranges_stay_small_enough_to_group_in_memory():
    """A range of keys holds 16 MB of input at 1 and at 6 GB, and 128 MB at most."""
    for total in (1 << 30, 6 << 30):
        assert width_for(0, total - 1, total) <= 16 << 20
    assert width_for(0, (100 << 40) - 1, 100 << 40) == 128 << 20


def test_change_feeds_are_put_in_order_once(spark, monkeypatch):
    """The three extracts of a table are written from one ordered copy (one shuffle), which is released afterwards."""
    from trolley.sources import files

    plans, real = [], files.write_csv

    def noted(df, *a, **b):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *a, **b)

    monkeypatch.setattr(files, "write_csv", noted)
    wh = warehouse(spark)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    base = inc.land_changes(wh)
    assert len(plans) == inc.EXTRACTS * len(RAW_TABLES) and all("InMemoryTableScan" in p for p in plans)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    feed = spark.read.options(**files.CSV_OPTIONS).csv(f"{base}/orders")
    early = wh.raw("orders").where("order_id % 2 = 0").count()
    assert feed.count() == wh.raw("orders").count() + early
    assert feed.where("_seq = 1 and user_id is not null").count() == 0


def test_feed_files_follow_the_bytes():
    """Batches of two files: a few dozen for each table at 6 GB, still bounded files at 100 TB."""
    assert inc.feed_files(0, 2) == 2 and inc.feed_files(512 << 20, 2) == 8
    assert 16 <= inc.feed_files(4800 << 20, 2) <= 20
    assert inc.feed_files(100 << 40, 2) == (100 << 40) // inc.FEED_BYTES
