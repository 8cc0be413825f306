"""Document FP-tree, prefix trie and merge rounds against plain restatements, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trolley.llm import bpe, fp_search, prefix_trie

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# ------------------------------------------------------------------ ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_ranks(docs, items, k=10):
    rows = [(d, Counter(t), len(t)) for d, t in ((d, terms(x)) for d, x in docs) if t]
    n_docs, total = len(rows), sum(n for _, _, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    wanted = defaultdict(set)
    for i, x in items:
        wanted[i].update(terms(x))
    out = []
    for i, ts in wanted.items():
        scored = []
        for d, c, n in rows:
            m = 10 + 90 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def ranks(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def search_rows():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "日本", "x1"]
    say = lambda n: " ".join(r.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))
    docs = [(i, say(r.randrange(1, 80))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # copies: ties by doc_id
    docs += [(2000, None), (2001, ""), (2002, " \t.,"), (2003, say(20_000)), (2004, "W1 w1 W1"), (2004, "W1 w1 W1"), (None, docs[3][1]), (None, say(5)), (-7, docs[3][1])]
    items = [(i, say(r.randrange(1, 25))) for i in range(30)] + [(100, docs[3][1]), (101, None), (102, "nowhere"), (103, "w1"), (103, "w59 w2"), (None, "w5 w7")]
    return docs, items


@pytest.mark.parametrize("block, group", [(16_384, 2_000_000), (37, 90)])
def test_fp_search_equals_brute_force(spark, search_rows, block, group):
    docs, items = search_rows
    d = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, n int, item long").repartition(3)
    i = spark.createDataFrame([(a, b, 0.5) for a, b in items], "item_id long, text string, score double")
    got = fp_search.ranked(d, i, block=block, group_terms=group)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranks(got) == brute_ranks(docs, items)


def test_fp_search_leaf_size_changes_nothing(spark, search_rows, monkeypatch):
    docs, items = search_rows
    monkeypatch.setattr(fp_search, "LEAF", 4)
    vectors = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t) and d is not None]
    names = {t: i for i, (t, _) in enumerate(Counter(t for _, c, _ in vectors for t in c).most_common())}
    rows = [sorted((names[t], f) for t, f in c.items()) for _, c, _ in vectors]
    starts = np.cumsum([0] + [len(r) for r in rows])
    flat = np.array([x for r in rows for x in r], np.int64)
    m = np.array([10 + n for _, _, n in vectors], np.int64)
    tree = fp_search.Tree(flat[:, 0].astype(np.int32), flat[:, 1], starts, m, [[d] for d, _, _ in vectors])
    weight = np.zeros(len(names), np.int64)
    for t in ("w3", "w9", "w40", "x1"):
        weight[names[t]] = 5 + names[t]
    exact = [int(fp_search.part(weight[flat[a:b, 0]], flat[a:b, 1], np.full(b - a, m[i])).sum()) for i, (a, b) in enumerate(zip(starts, starts[1:]))]
    best = fp_search.Best(10)
    tree.search(weight, best)
    assert sorted(best.heap, reverse=True) == sorted(((s, -vectors[i][0]) for i, s in enumerate(exact) if s > 0), reverse=True)[:10]
    # a node's bound is never below that of anything under it
    for x in range(tree.root, len(tree.m)):
        low, high = tree.child[x]
        assert tree.bounds(x, x + 1, weight)[0] >= tree.bounds(low, high, weight).max()


def test_fp_search_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert fp_search.ranked(none, items).collect() == []
    assert fp_search.ranked(docs, items.where("false")).collect() == []
    assert fp_search.ranked(docs, items).dtypes == fp_search.ranked(none, items).dtypes


# ------------------------------------------------------------------ prefix trie

def brute_trie(rows):
    """Rows (conv, turn, role, text) -> the contract's rows, from whole sequences."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    original = {c: [x[2:] for x in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = original.get(c - c % 100 if c >= 0 else c + (-c) % 100, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), sum(not children[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE_SCHEMA = "conv_id long, turn int, role string, text string, id long, band int, path string"


def trie(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], TRIE_SCHEMA)
    got = prefix_trie.prefix_trie(frame, **more)
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in got.collect()), key=repr)


@pytest.fixture(scope="module")
def trie_rows():
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "bot"]), r.choice(["hi", "hello", "héllo 🙂", ""])) for c in range(0, 330, 3) for t in range(r.randrange(0, 9))]
    rows += [(c, t, "user", "same") for c in range(5000, 5040) for t in range(12)]  # copies that end at one node
    rows += [(700, t, "user", f"turn {t % 7}") for t in range(200)]  # far longer than the others
    rows += [(900, None, None, None), (900, None, "b", None), (900, 1, None, "x"), (900, 1, None, "x"), (901, 0, None, "only"), (-3, 0, "a", "b"), (None, 0, "a", "b")]
    r.shuffle(rows)
    return rows


def test_prefix_trie_equals_brute_force(spark, trie_rows):
    assert trie(spark, trie_rows) == brute_trie(trie_rows)


def test_prefix_trie_bands_and_pieces_change_nothing(spark, trie_rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    monkeypatch.setattr(prefix_trie, "TURN_BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "HEAVY_SHARE", 4)
    small = [x for x in trie_rows if x[0] != 700]
    assert trie(spark, small, least_height=4) == brute_trie(small)


def test_prefix_trie_without_turns(spark):
    assert trie(spark, []) == []
    # h of 1 is 5: nothing is left of its turn, and there is no conversation 0
    lone = [(1, 0, "a", "b")]
    assert zlib.crc32(b"1") % 6 > 0 and trie(spark, lone) == brute_trie(lone) and len(brute_trie(lone)) == 1


# ------------------------------------------------------------------ byte-pair encoding

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(1)
    letters = "aaabcdefgß é İΣσς'ſt'll 12٣ \t\n\x85日本語🙂é-_<|"
    odd = ["", " \n\t", "<|endoftext|>", "a<|startoftext|>b<|ENDOFTEXT|><|endoftext|><|endoftext|>", "aaaa" * 700, "the" * 900, "ΟΔΟΣ", "it's we'll 'S", "a" * 300 + " b"]
    return odd + ["".join(r.choice(letters) for _ in range(r.randrange(80))) for _ in range(800)]


def test_encoder_equals_the_library(library, texts):
    encoder = bpe.Encoder(bpe.Vocabulary.load(WORD_BPE))
    ids, starts = encoder.encode(texts)
    decoded = encoder.decode(ids, starts).to_pylist()
    for i, (text, want) in enumerate(zip(texts, library.encode_batch(texts, add_special_tokens=False))):
        assert ids[starts[i]:starts[i + 1]].tolist() == want.ids, text
        assert decoded[i] == library.decode(want.ids, skip_special_tokens=False)


def test_encoder_forgets_without_effect(texts, monkeypatch):
    whole = bpe.Encoder(bpe.Vocabulary.load(WORD_BPE)).encode(texts)[0].tolist()
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    encoder = bpe.Encoder(bpe.Vocabulary.load(WORD_BPE))
    assert sum((encoder.encode(texts[i:i + 50])[0].tolist() for i in range(0, len(texts), 50)), []) == whole


def test_encode_query(spark, library, texts):
    rows = [(i if i % 50 else None, t or None, 1) for i, t in enumerate([*texts, texts[9], texts[9]])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(5)
    got = sorted((r.asDict() for r in bpe.encoded_digests(frame, WORD_BPE).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append({"doc_id": i, "n_tokens": len(e), "ids_sha256": hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(),
                     "decoded_sha256": hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()})
    assert got == sorted(want, key=repr)
    assert bpe.encoded_digests(frame.where("false"), WORD_BPE).collect() == []


def test_encode_query_on_the_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, WORD_BPE).select("doc_id", "ids").collect()}
    rows = docs.select("doc_id", "text").collect()
    assert {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in rows} == got
