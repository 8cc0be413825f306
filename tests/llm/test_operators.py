"""Each training-data operator against a brute-force version and on odd inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trolley.llm import decontam, hpylm, langid, licences, mixing, nn_descent, pii, quality, sharding
from trolley.llm.jaccard_join import jaccard_groups, one_of_each_group

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, root long, c long, size long, label int, quality string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UP, LOW)))


def docs(spark, texts, first=1):
    """Documents with columns that clash with the operators' working names; ids from ``first``, None stays None."""
    rows = [(i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1], "en" if i % 2 else "de", f"s{i % 3}" if i % 5 else None, None, 1, 2, 3, 4, 5, "x") for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(n, seed=0, vocabulary=3000):
    r = random.Random(seed)
    return [" ".join(f"w{r.randrange(vocabulary)}" for _ in range(r.randrange(20, 80))) for _ in range(n)]


ODD = [None, "", "   \n\t", "one", "One", "two words", "two words", (None, "no id here at all"), (7, "same id"), (7, "same id"), "x" * 50_000, "long " * 30_000]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, ["x"]).limit(0)


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


# ------------------------------------------------------------------ 1

def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    v = np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.1, base[:1] + rng.normal(size=(30, 16)) * 0.15, base[5:6], base[5:6]])
    label = [i % 3 if i < 60 else (i - 60) % 3 if i < 80 else 0 for i in range(len(v))]
    rows = [(i, [float(x) for x in r], label[i], 1) for i, r in enumerate(v)]
    odd = [(900, None, 0, 1), (901, [0.0] * 16, 0, 1), (902, [float("nan")] + [1.0] * 15, 0, 1), (903, [1.0] * 16, None, 1), (904, [1.0, None], 0, 1), (905, [], 0, 1), (None, [1.0, 2.0], 0, 1), (906, [2.0, 4.0], 0, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, id int").repartition(4)
    got = {r.vec_id: r for r in nn_descent.near_vectors(df).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(links, False)
    root = components(len(v), zip(*np.nonzero(links)))
    for i in range(len(v)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (int(links[i].sum()), root[i], root[i] == i)
    for i in (900, 901, 902, 903, 904, 905):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[906].n_links == 1 and got[906].component_id == 906 and got[None].component_id == 906 and not got[None].kept
    assert nn_descent.near_vectors(df.limit(0)).count() == 0


def against_all_pairs(spark, v):
    df = spark.createDataFrame([(i, [float(x) for x in r], 0) for i, r in enumerate(v)], "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_vectors(df).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = u @ u.T >= 0.93
    np.fill_diagonal(links, False)
    root = components(len(v), zip(*np.nonzero(links)))
    assert got == {i: (int(links[i].sum()), root[i]) for i in range(len(v))}


def test_vectors_isolated_pairs_beside_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "RUN", 8)
    monkeypatch.setattr(nn_descent, "CHUNK", 100)
    rng = np.random.default_rng(5)
    base, hot = rng.normal(size=(1500, 32)), rng.normal(size=(1, 32))
    pairs = base[:300] / np.linalg.norm(base[:300], axis=1, keepdims=True) + rng.normal(size=(300, 32)) * 0.055
    against_all_pairs(spark, np.concatenate([base, pairs, hot + rng.normal(size=(400, 32)) * 0.05]))


def test_vectors_dense_groups_that_only_meet_across(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "ROUNDS", 2)
    rng = np.random.default_rng(8)
    q, _ = np.linalg.qr(rng.normal(size=(64, 3)))
    centres = np.stack([q[:, 0], 0.96 * q[:, 0] + 0.28 * q[:, 1]])
    noise = lambda n: rng.normal(size=(n, 64)) * np.sqrt(0.02 / 64)
    two = np.concatenate([c + noise(60) for c in centres])  # 0.98 within a group, 0.94 across
    u = two / np.linalg.norm(two, axis=1, keepdims=True)
    links = u @ u.T >= 0.93
    assert links[:60, 60:].mean() > 0.9
    hot = np.repeat(q[:, 2] + noise(100), 40, axis=0)
    rows = [(i, [float(x) for x in r], 0) for i, r in enumerate(np.concatenate([two, hot]))]
    got = {r.vec_id: r for r in nn_descent.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert [(got[i].n_links, got[i].component_id) for i in range(120)] == [(int(k) - 1, 0) for k in links.sum(1)]
    assert {got[i].component_id for i in range(120, len(rows))} == {120}


# ------------------------------------------------------------------ 2

def shingle_set(text, k):
    w = words(text)
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_against_all_pairs(spark, k, percent):
    r, texts = random.Random(k), prose(60, 1)
    for t in texts[:25]:
        for _ in range(3):
            w = t.split()
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"z{r.randrange(50)}"
            texts.append(" ".join(w))
    texts += [texts[0], texts[0].upper(), "a b", "a B", None, "", " ", None]
    ids = list(range(10, 10 + len(texts)))
    got = {x.doc_id: x for x in jaccard_groups(docs(spark, texts, 10), k=k, percent=percent).collect()}
    sets = [shingle_set(t, k) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = components(len(sets), links)
    assert links and {i: (x.n_shingles, x.component_id) for i, x in got.items()} == {ids[i]: (len(sets[i]), ids[root[i]]) for i in range(len(sets))}


def test_jaccard_keeps_prefixes_once(spark, monkeypatch):
    """The prefixes of all rows, and the index that the full join has read, are deleted before the result is there."""
    import glob

    from trolley.llm import jaccard_join

    made, real = [], jaccard_join.Scratch
    monkeypatch.setattr(jaccard_join, "Scratch", lambda *a: made.append(real(*a)) or made[-1])
    jaccard_groups(docs(spark, [prose(40, i % 5) for i in range(20)]), k=3, percent=90).count()
    left = [spark.read.parquet(p).columns for p in glob.glob(f"{made[0].root.removeprefix('file:')}/t*")]
    assert sum("prefix" in c for c in left) == 1 and not any("own" in c and "root" not in c for c in left)


def test_jaccard_odd_inputs(odd, empty):
    got = jaccard_groups(odd).collect()
    assert len(got) == len(ODD)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert by[(1, 0)] == 1 and by[(2, 0)] == 2 and by[(4, 1)] == 4 and by[(5, 1)] == 4 and by[(7, 1)] in (6, 7)
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 1 and kept.where("doc_id = 5").count() == 0
    assert jaccard_groups(empty).count() == 0 and one_of_each_group(empty).count() == 0


# ------------------------------------------------------------------ 3

def test_shards(spark, odd, empty):
    texts = prose(300, 5) + prose(20, 5) + [None, "", "y" * 9000]
    rows = sharding.shard(docs(spark, texts), shards=7).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"bytes"}
    by = collections.defaultdict(list)
    for r in rows:
        t = texts[r.doc_id - 1] or ""
        assert (r.size, r.text_crc32, r.grown_shard) == (len(t.encode()) + 16, zlib.crc32(t.encode()), None)
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    where = collections.defaultdict(set)
    for r in rows:
        where[texts[r.doc_id - 1]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    # no shard is above the mean by more than its last group
    loads = [sum(r.size for r in by[s]) for s in range(7)]
    assert max(loads) <= max(9016, sum(loads) / 7 + 1000)
    assert len(sharding.shard(odd, shards=3).collect()) == len(ODD) and sharding.shard(empty).count() == 0


def test_schedule_equals_plain_longest_processing_time():
    r = random.Random(4)
    sizes = sorted([r.randrange(1, 60) for _ in range(400)], reverse=True)
    plain = [0] * 9
    for s in sizes:
        plain[plain.index(min(plain))] += s
    count = collections.Counter(sizes)
    loads = [0] * 9
    for size, ends, where in sharding.schedule([(s, n, s * n) for s, n in count.items()], 9):
        for a, b, s in zip([0, *ends], ends, where):
            loads[s] += (b - a) * size
    assert sorted(loads) == sorted(plain)


# ------------------------------------------------------------------ 4

def test_mix_is_pfair(spark, odd, empty):
    texts = [f"t{i}" for i in range(400)]
    df = docs(spark, texts).withColumn("source", F.when(F.col("doc_id") % 10 < 6, "a").when(F.col("doc_id") % 10 < 9, "b"))
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.3), (None, 0.2)], "source string, weight double")
    rows = mixing.mix(df, weights, block_rows=2, period=20).collect()
    assert sorted(r.position for r in rows) == list(range(400))
    blocks = {(r.source, r.block): r for r in rows}
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert len({r.slot for r in blocks.values()}) == len(blocks)
    share = {s: n / 20 for s, n in ((r["source"], r["blocks"]) for r in mixing.period_shares(weights, 20).collect())}
    last = min(max(r.slot for r in rows if r.source == s) for s in share)
    for t in range(last + 1):
        for s, w in share.items():
            assert abs(sum(r.source == s and r.slot < t for r in blocks.values()) - w * t) < 1
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == len(ODD)


def test_mixed_order_needs_no_join_to_the_texts(spark):
    """The rows come in the order of their positions, and after the written table only the ranges are shuffled."""
    df = docs(spark, [prose(5, i) for i in range(200)]).withColumn("source", F.when(F.col("doc_id") % 7 == 0, "a").otherwise("b"))
    mixed = mixing.mixed_documents(df)
    assert "Join" not in mixed._jdf.queryExecution().executedPlan().toString()
    want = [r.doc_id for r in sorted(mixing.mix(df).collect(), key=lambda r: r.position)]
    assert [r.doc_id for r in mixed.collect()] == want


@pytest.mark.parametrize("weights", [{"a": 0.9, "b": 0.1}, {"a": 0.99, "b": 0.01}, {"a": 0.91} | {f"s{i}": 0.01 for i in range(9)},
                                     {"a": 3.0, "b": 7.0, None: 1.5}, {"a": 1 / 3, "b": 2 / 3}, {f"s{i}": i + 1.0 for i in range(10)}])
def test_mix_keeps_the_given_weights(spark, weights):
    """Over at least ten periods every source is less than one block away from its given share, at any slot."""
    period, total = 100, sum(weights.values())
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    shares = mixing.period_shares(given, period, mixing.LONGEST).collect()
    length = shares[0].period
    assert sum(r.blocks for r in shares) == length
    share = {r.source: r.blocks / r.period for r in shares}
    slots = 10 * length if length < 2000 else length
    assert all(abs(share[s] - w / total) * slots < 0.5 for s, w in weights.items())
    taken = mixing.period_slots(mixing.period_shares(given, period, mixing.LONGEST)).orderBy("slot").collect()
    assert [r.slot for r in taken] == list(range(length)) and all(r.release <= r.slot < r.deadline for r in taken)
    if length < 2000:
        done = dict.fromkeys(weights, 0)
        for t in range(slots):
            done[taken[t % length].source] += 1
            assert all(abs(done[s] - w / total * (t + 1)) < 1 for s, w in weights.items())


def test_mixed_rows_keep_the_given_weights(spark):
    """The rows themselves, in order: 0.9 and 0.1 over more than ten periods, and odd weights."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") < 5400, "a").otherwise("b").alias("source"))
    given = spark.createDataFrame([("a", 0.9), ("b", 0.1), ("gone", 5.0), ("zero", 0.0), ("odd", float("nan"))], "source string, weight double")
    rows = sorted(mixing.mix(df, given, block_rows=2, period=20).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(6000)) and all(r.release <= r.slot < r.deadline for r in rows)
    assert sorted({r.slot for r in rows}) == list(range(3000))  # 150 periods without an empty slot
    seen = 0
    for k, r in enumerate(rows):
        seen += r.source == "b"
        assert abs(seen - 0.1 * (k + 1)) < 2 * 1 + 1e-6  # less than one block of two rows


# ------------------------------------------------------------------ 5

def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_personal_data_against_the_patterns(spark, odd, empty):
    r = random.Random(9)
    texts = ["".join(r.choice("ab1279.@-+ ()%é\n") for _ in range(r.randrange(120))) for _ in range(400)]
    texts += ["mail a@b.co, +44 20 7946 0958, 4111 1111 1111 1111, 10.0.0.255, 1.2.3.4.5.6.7.8", "IBAN: DE89 3704 0044 0532 0130 00 account no. 12345678 ssn 123-45-6789",
              "https://joe:secret@example.com/x joe (at) example (dot) com", "1" * 20_000, "é@b.c a@b@c.d..e"]
    got = {x.doc_id: x for x in pii.personal_data(docs(spark, texts, 0)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t) if len(t) < 10_000 else []
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{a}:{b}:{c}" for a, b, c in want).encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(w[0] == k for w in want) for k in pii.BASE]
        assert all(f"{a}:{b}:{c}" in got[i].spans for a, b, c in want)
    kinds = [{s.split(":")[0] for s in got[i].spans.split(",")} for i in (401, 402)]
    assert {"iban", "account", "ssn"} <= kinds[0] and {"login", "mailbox"} <= kinds[1]
    assert pii.personal_data(odd).count() == len(ODD) and pii.personal_data(empty).count() == 0


# ------------------------------------------------------------------ 6

def test_decontamination_finds_pasted_items(spark, odd, empty):
    items = [" ".join(f"q{i}x{j}" for j in range(12 + i % 5)) + ". " + " ".join(f"a{i}x{j}" for j in range(4)) + "." for i in range(30)] + ["Short.", None, ""]
    texts = prose(40, 2)
    for i in range(20):
        w = texts[i].split()
        texts[i] = " ".join(w[:9] + [items[i].upper() if i % 2 else items[i]] + w[9:])
    texts[25] += " " + items[3].split(". ")[0]  # the question alone
    texts.append(" ".join(prose(60, 8)) + " " + items[7] + " " + " ".join(prose(30, 9)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string").withColumn("doc_id", F.lit(1))
    df = docs(spark, texts, 0)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert got == {(i, i) for i in range(20)} | {(40, 7)}
    assert {r.doc_id for r in decontam.clean_documents(df, bench).collect()} == set(range(20, 40))
    assert decontam.contaminated(odd, bench).count() == 0 and decontam.clean_documents(odd, bench).count() == len(ODD)
    assert decontam.contaminated(empty, bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_search_equals_scoring_every_item(monkeypatch):
    r = random.Random(1)
    items = [(i, " ".join(f"t{r.randrange(60)}" for _ in range(r.randrange(3, 12)))) for i in range(400)]
    index = decontam.Index(items)
    full = np.zeros((len(index.terms), len(items)))
    for t, (ids, w) in enumerate(index.lists):
        full[t, ids] = w
    for _ in range(60):
        query = r.sample(range(len(index.terms)), min(len(index.terms), r.randrange(1, 40)))
        want = full[query].sum(0)
        monkeypatch.setattr(decontam, "THRESHOLD", 0.5)
        many = index.retrieve(np.full(len(query), 5), np.sort(query))
        assert sorted(i for _, x in many for i, _ in x) == np.flatnonzero(want >= 0.5 - 1e-9).tolist()
        found = index.search(query, 0.5)
        assert sorted(i for i, _ in found) == np.flatnonzero(want >= 0.5 - 1e-9).tolist()
        assert all(abs(min(1, want[i]) - s) < 1e-9 for i, s in found)


def test_search_of_many_passages_equals_scoring_every_item():
    """Passages of one call don't disturb each other; thresholds, ties between items and passages without a hit."""
    r = random.Random(8)
    items = [(i, " ".join(f"t{r.randrange(40)}" for _ in range(r.choice([1, 2, 5, 30])))) for i in range(300)] + [(300, "t1 t2 t3"), (301, "t1 t2 t3"), (302, "")]
    index = decontam.Index(items)
    full = np.zeros((len(index.terms), len(index.ids)))
    for t, (ids, w) in enumerate(index.lists):
        full[t, ids] = w
    queries = {k * 3: sorted(r.sample(range(len(index.terms)), r.choice([1, 3, 10, len(index.terms)]))) for k in range(80)}
    window, term = (np.array([x[c] for k, q in queries.items() for x in [(k, t) for t in q]]) for c in (0, 1))
    for threshold in (0.2, 0.6, 1.0):
        got = {k: dict(x) for k, x in index.retrieve(window, term, threshold)}
        for k, q in queries.items():
            score = full[q].sum(0)
            assert sorted(got.get(k, {})) == np.flatnonzero(score >= threshold - 1e-9).tolist()
            assert all(abs(min(1, score[i]) - x) < 1e-9 for i, x in got.get(k, {}).items())


def test_decontamination_does_not_depend_on_shards(spark, monkeypatch):
    """Scores, passages and matches are the same from one index and from many; an item far longer than a shard too."""
    r = random.Random(3)
    items = [" ".join(r.choice(["the", "of", f"q{i}x{j}"]) for j in range(r.randrange(8, 40))) + ". " + " ".join(f"a{i}x{j}" for j in range(4)) + "." for i in range(40)]
    items.append(" ".join(f"z{j}" for j in range(3000)) + ". yes it is.")
    texts = prose(30, 2)
    for i in range(25):
        texts[i] += " " + items[i] + " of the " + items[(i * 7) % 40]
    texts.append("start " + items[40] + " end")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    one = sorted(decontam.contaminated(docs(spark, texts, 0), bench).collect())
    monkeypatch.setattr(decontam, "SHARD_BYTES", 4000)
    many = sorted(decontam.contaminated(docs(spark, texts, 0), bench).collect())
    assert [x[:2] for x in one] == [x[:2] for x in many] and {(i, i) for i in range(25)} | {(30, 40)} <= {tuple(x[:2]) for x in one}
    assert all(a[2:] == pytest.approx(b[2:], abs=1e-12) for a, b in zip(one, many))
    assert sum(1 for _ in decontam.indexes(bench)) > 5


# ------------------------------------------------------------------ 7

def follows(n, seed=3):
    """Texts in which every second word follows from the one before."""
    r = random.Random(seed)
    return [" ".join(f"{a} b{ord(a[0])}" for a in (r.choice("uvwxyz") * r.randrange(1, 3) for _ in range(r.randrange(10, 60)))) for _ in range(n)] + [None, "", "A a"]


def test_language_model(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(hpylm, "SLICE_TOKENS", 3000)
    texts = follows(200)
    got = {x.doc_id: x for x in hpylm.model_scores(docs(spark, texts, 0)).collect()}
    tokens = [words(t) + [None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    c = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    N, V = sum(c.values()), len(c)
    for i, t in enumerate(tokens):
        want = sum(math.log10((c[w] + 0.5) / (N + 0.5 * (V + 1))) for w in t)
        x = got[i]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), N)
        assert x.base_score == pytest.approx(want, rel=1e-9) and x.score < 0
    out = [i for i in range(200) if held[i]]
    assert sum(got[i].score for i in out) > 0.8 * sum(got[i].base_score for i in out)
    assert hpylm.model_scores(odd).count() == len(ODD) and hpylm.model_scores(empty).count() == 0


@pytest.mark.parametrize("share", [1, 8, 1024])  # no word, some words and most words are hot
def test_language_model_does_not_depend_on_partitions(spark, monkeypatch, share):
    monkeypatch.setattr(hpylm, "SLICE_TOKENS", 1500)
    monkeypatch.setattr(hpylm, "HOT_SHARE", share)
    df = docs(spark, follows(60) + prose(40, vocabulary=300), 0)
    one, many = ({x.doc_id: (x.score, x.base_score) for x in hpylm.model_scores(df.repartition(n)).collect()} for n in (1, 7))
    assert one.keys() == many.keys()
    assert all(one[i] == pytest.approx(many[i], abs=1e-9) for i in one)


def test_language_model_against_dictionaries(spark, monkeypatch):
    """Every context word has a restaurant; the same draws over plain dictionaries give the same scores."""
    monkeypatch.setattr(hpylm, "HOT_SHARE", 1)
    texts = follows(40) + prose(60, vocabulary=300)
    got = {x.doc_id: x.score for x in hpylm.model_scores(docs(spark, texts, 0)).collect()}

    def hashed(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return hpylm.tokens(data, np.array([0, len(data)]))[0].tolist()
    pairs = [list(zip(h, [int(hpylm.END)] + h[:-1])) for h in map(hashed, texts)]
    train = [zlib.crc32(str(i).encode()) % 5 != 1 for i in range(len(texts))]
    c = collections.Counter(p for t, use in zip(pairs, train) if use for p in t)
    keys = sorted(c, key=lambda p: (p[0], p[1] >> 16))
    every = sorted({w for t in pairs for w, _ in t})
    V = len({w for w, _ in keys})

    def discount(values):
        one, two = sum(v == 1 for v in values), sum(v == 2 for v in values)
        return min(0.95, max(0.05, one / (one + 2 * two)))

    def sums(tables, by):
        out = collections.Counter()
        for k in keys:
            out[k[by]] += tables[k]
        return out
    tables = dict.fromkeys(keys, 1)
    m = sums(tables, 0)
    s = {w: int(m[w] > 0) for w in every}
    d2, total, prob = discount(c.values()), {}, collections.Counter()
    for t in keys:
        total[t[1]] = total.get(t[1], 0) + c[t]
    for k in range(hpylm.SWEEPS + 1):
        T, d1 = sums(tables, 1), discount([m[w] for w in every])
        new = (1 + d1 * sum(s.values())) / (V + 1)
        parent = {w: (m[w] - d1 * s[w] + new) / (1 + sum(m.values())) for w in every}
        if k:
            for t in {p for x in pairs for p in x}:
                prob[t] += (c[t] - d2 * tables.get(t, 0) + (1 + d2 * T[t[1]]) * parent[t[0]]) / (1 + total.get(t[1], 0))
        rng = np.random.default_rng([k, 1, 0])
        drawn = hpylm.seat(rng, np.array([c[t] for t in keys]), np.array([(1 + d2 * T[t[1]]) * parent[t[0]] for t in keys]), d2)
        tables = dict(zip(keys, drawn.tolist()))
        m = sums(tables, 0)
        s = dict(zip(every, hpylm.seat(rng, np.array([m[w] for w in every]), np.full(len(every), new), d1).tolist()))
    for i, t in enumerate(pairs):
        assert got[i] == pytest.approx(sum(math.log10(prob[p] / hpylm.SWEEPS) for p in t), abs=1e-8)
    for u in list(total)[:5]:  # over all words and the unknown one, a context's probabilities add up to one
        inner = sum((c[w, u] - d2 * tables.get((w, u), 0)) for w in every)
        assert inner + d2 * sums(tables, 1)[u] == pytest.approx(total[u])


def test_seating_bounds():
    rng = np.random.default_rng(0)
    count = np.array([5, 200, 3, 40, 1, 0, 100_000])
    t = hpylm.seat(rng, count, np.full(len(count), 0.3), 0.7)
    assert (t <= count).all() and (t[count > 0] >= 1).all() and t[5] == 0


# ------------------------------------------------------------------ 8

def test_licences(spark, odd, empty):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    texts = ["Text.\n" + mit + "More text.", "Released under the MIT License.\nA. B. C. D.\nLicensed under CC BY-NC 4.0.", "SPDX-License-Identifier: Apache-2.0", "a licence of my own", None,
             "This work is licensed under the GNU General Public License, version 3. Released under the MIT License. Released under the MIT License."]
    got = {r.doc_id: r for r in licences.licences(docs(spark, texts, 0)).collect()}
    assert [got[i].licences for i in range(6)] == ["MIT", "MIT,CC-BY-NC-4.0", "Apache-2.0", "", "", "MIT,GPL-3.0"]
    assert got[0].sentence_ids == "mit-permission mit-notice" and got[1].sentence_ids == "name:MIT # name:CC-BY-NC-4.0"
    assert licences.licences(odd).count() == len(ODD) and licences.licences(empty).count() == 0


def test_licences_wrapped_and_commented(spark):
    by_id, wrap = dict(licences.SENTENCES), lambda t, mark, width=72: "\n".join(mark + x for x in textwrap.wrap(t, width))
    mit = "\n#\n".join(wrap(by_id[f"mit-{i}"].capitalize() + ".", "# ") for i in ("permission", "notice", "as-is", "liability"))
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the\nLicense at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
              "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License")
    gpl = ("This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n *\n"
           " * This program is distributed in the hope that it will be useful,\n * but WITHOUT ANY WARRANTY; without even the implied warranty of\n * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n * GNU General Public License for more details.\n *\n"
           " * You should have received a copy of the GNU General Public License\n * along with this program.  If not, see <https://www.gnu.org/licenses/>.")
    bsd = "\n\n".join(wrap(f"{b}{by_id[i].capitalize()}.", "// ", 76) for b, i in (("", "bsd-permission"), ("(1) ", "bsd-source"), ("(2) ", "bsd-binary"), ("", "bsd-as-is")))
    texts = [mit, apache, "/*\n * " + gpl + "\n */", bsd, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", "Released under the MIT License, see LICENSE.", "It is published under the\nMIT License", "A book published under the MIT imprint.", "Other than that, it is distributed under"]
    got = {r.doc_id: r for r in licences.licences(docs(spark, texts, 0)).collect()}
    assert [got[i].licences for i in range(len(texts))] == ["MIT", "Apache-2.0", "GPL-3.0-or-later", "BSD-2-Clause", "MPL-2.0", "MIT", "MIT", "", ""]
    assert got[0].sentence_ids == "mit-permission mit-notice mit-as-is mit-liability" and got[2].sentence_ids == "gpl-free gpl-hope gpl-copy" and got[1].sentence_ids == "apache-header apache-comply apache-basis"


# ------------------------------------------------------------------ 9

def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in langid.start(3).items()}
    x, y = rng.integers(0, 256, (5, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grad = langid.step(p, x, y)
    for key, at in (("Uf", (1, 2)), ("Ub", (0, 17)), ("W", (3, 1)), ("Ef", (int(x[2, 1]), 20)), ("Eb", (int(x[1, 0]), 3))):
        p[key][at] += 1e-3
        up = langid.step(p, x, y)[0]
        p[key][at] -= 2e-3
        down = langid.step(p, x, y)[0]
        p[key][at] += 1e-3
        assert grad[key][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_languages(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(langid, "ROUNDS", 60)
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcde" if i % 2 else "vwxyz") for _ in range(5)) for _ in range(r.randrange(3, 60))) for i in range(200)] + [None, "", "123 !?", "abcde " * 5000]
    got = {x.doc_id: x for x in langid.languages(docs(spark, texts, 0)).collect()}
    assert sum(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(200)) >= 196
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (200, 201, 202)) and got[203].lang_pred == "en"
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= x.score <= 1 for i, x in got.items())
    assert langid.languages(odd).count() == len(ODD) and langid.languages(empty).count() == 0


def test_languages_sample_against_sorting_all_rows(spark, monkeypatch):
    """Every language is learned, also the 70th; a bound that equal ids make too small is raised."""
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 6)
    rows = [(i, f"text{i:06d}", f"l{i % 70:02d}" if i % 2 else "big") for i in range(4000)] + [(7, f"again{i}", "same") for i in range(300)] + [(None, "x", "big"), (3, None, "big"), (5, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, texts, labels = langid.training_sample(df, 4, 2)
    want = collections.defaultdict(list)
    for i, text, lang in rows:
        if None not in (i, text, lang) and zlib.crc32(str(i).encode()) % 4 != 2:
            want[lang].append((hashlib.md5(str(i).encode()).hexdigest(), i, text.encode()[:6]))
    assert langs == sorted(want)
    each = 400 // len(langs)
    assert [(langs[k], t) for k, t in zip(labels, texts)] == [(x, r[2]) for x in langs for r in sorted(want[x])[:each]]


def test_training_reaches_every_language(monkeypatch):
    """More languages than rows of a batch."""
    monkeypatch.setattr(langid, "ROWS", 8)
    r = random.Random(4)
    texts = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwx"[2 * c:2 * c + 2]) for _ in range(6)) for _ in range(12)).encode() for c in range(12) for _ in range(10)]
    labels = [c for c in range(12) for _ in range(10)]
    p = langid.train(texts, labels, 12, rounds=400)
    off = np.cumsum([0, *map(len, texts)])
    q = langid.probabilities(p, np.frombuffer(b"".join(texts), np.uint8), off)
    assert (q.argmax(1) == labels).mean() > 0.95 and np.allclose(q.sum(1), 1)


# ------------------------------------------------------------------ 10

def test_quality(spark, odd, empty):
    good, r = prose(160, 1, 400), random.Random(5)
    texts = [t if i % 2 else "BUY!! NOW!! " + " ".join(r.choice(["CLICK!!", "WIN!!", "FREE!!"]) for _ in range(40)) for i, t in enumerate(good)] + [None, ""]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(160)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    df = docs(spark, texts, 0)
    got = {x.doc_id: x for x in quality.quality_scores(df, labels).collect()}
    held = [i for i in range(160) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) and 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.3) for i in got)
    assert sum(got[i].predicted == i % 2 for i in held) >= 0.95 * len(held)
    kept = quality.accepted(df, labels)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {i for i in got if got[i].predicted}
    assert {x.score for x in quality.quality_scores(df, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(odd, labels).count() == len(ODD) and quality.quality_scores(empty, labels).count() == 0
