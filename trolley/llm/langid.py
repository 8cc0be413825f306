"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the UTF-8 bytes of a text, one from each side; their states together label
every byte position with a probability for each language, and a document's probabilities are the mean over
all its positions.  The network is written and trained in numpy by backpropagation through time (Adam,
cross-entropy at every position).

A text is read in windows of ``STEP`` bytes, each with ``WARM`` bytes of context on either side that only
warm up the states, so whole texts of any length are read, many windows at a time.

Fitted on a bounded sample: of each language, at most ``SAMPLE`` rows of the admitted folds (those with the
smallest md5 of doc_id), of each at most ``SAMPLE_BYTES``.  All languages are learned, however rare and many; beyond
``SAMPLE_ROWS / SAMPLE`` of them each gives fewer rows, at least one.  Training takes more rounds for more languages.
Every row is predicted over its whole text.  Only the text is an input of a prediction.

Defined results: null texts and texts without a letter give ``und`` with a score of 0; with no learned
language all rows do; ties go to the language that sorts first; repeated rows and null ids give a row each
(a null id is not learned from); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import pick, utf8

HIDDEN = 8
STEP, WARM = 112, 8
BATCH = 1024
SAMPLE, SAMPLE_BYTES = 250, 1500
SAMPLE_ROWS = 16_000
ROUNDS, ROWS, LENGTH = 260, 96, 40
CLASSES = 16  # languages that ROUNDS are meant for


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def start(classes: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for side in "fb":
        p["E" + side] = rng.normal(0, 0.3, (256, 3 * HIDDEN))  # input weights: a byte picks its row
        p["U" + side] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
    p["W"] = rng.normal(0, 0.3, (2 * HIDDEN, classes))
    p["b"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in p.items()}


def read(p: dict, side: str, x: np.ndarray, keep: bool = False):
    """States after each byte of x (time, row); keep: also what backpropagation needs. Gates: z, r, candidate."""
    E, U, n = p["E" + side], p["U" + side], HIDDEN
    h = np.zeros((x.shape[1], n), np.float32)
    states = np.empty((x.shape[0], x.shape[1], n), np.float32)
    trace = []
    Ug, Uc = np.ascontiguousarray(U[:, :2 * n]), np.ascontiguousarray(U[:, 2 * n:])
    order = range(x.shape[0]) if side == "f" else range(x.shape[0] - 1, -1, -1)
    for t in order:
        e = E[x[t]]
        g = h @ Ug
        g += e[:, :2 * n]
        g *= 0.5
        np.tanh(g, out=g)
        g *= 0.5
        g += 0.5
        z, r = g[:, :n], g[:, n:]
        c = (r * h) @ Uc
        c += e[:, 2 * n:]
        np.tanh(c, out=c)
        new = h + z * (c - h)
        if keep:
            trace.append((t, h, z, r, c))
        states[t] = h = new
    return (states, trace) if keep else states


def back(p: dict, side: str, x: np.ndarray, trace: list, dstates: np.ndarray, grad: dict) -> None:
    U, n = p["U" + side], HIDDEN
    dE, dU, dh = np.zeros_like(p["E" + side]), np.zeros_like(U), np.zeros((x.shape[1], n), np.float32)
    for t, h, z, r, c in reversed(trace):
        dh = dh + dstates[t]
        dc = dh * z * (1 - c * c)
        drh = dc @ U[:, 2 * n:].T
        dz, dr = dh * (c - h) * z * (1 - z), drh * h * r * (1 - r)
        dg = np.concatenate([dz, dr], 1)
        dU[:, 2 * n:] += (r * h).T @ dc
        dU[:, :2 * n] += h.T @ dg
        np.add.at(dE, x[t], np.concatenate([dg, dc], 1))
        dh = dh * (1 - z) + drh * r + dg @ U[:, :2 * n].T
    grad["E" + side], grad["U" + side] = dE, dU


def step(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients; x (time, row) bytes, y (row) labels: every position of a row has its label."""
    (f, tf), (b, tb) = read(p, "f", x, True), read(p, "b", x, True)
    both = np.concatenate([f, b], 2)
    o = both @ p["W"] + p["b"]
    o -= o.max(2, keepdims=True)
    q = np.exp(o)
    q /= q.sum(2, keepdims=True)
    n = x.size
    loss = -float(np.log(q[:, np.arange(len(y)), y] + 1e-9).sum() / n)
    q[:, np.arange(len(y)), y] -= 1
    q /= n
    grad = {"W": np.einsum("tbi,tbj->ij", both, q), "b": q.sum((0, 1))}
    d = q @ p["W"].T
    back(p, "f", x, tf, d[:, :, :HIDDEN], grad)
    back(p, "b", x, tb, d[:, :, HIDDEN:], grad)
    return loss, grad


def train(texts: list[bytes], labels: list[int], classes: int, rounds: int | None = None, seed: int = 7) -> dict[str, np.ndarray]:
    p, rng, rounds = start(classes, seed), np.random.default_rng(seed), rounds or ROUNDS
    by = [[i for i, y in enumerate(labels) if y == c and texts[i]] for c in range(classes)]
    by = [x for x in by if x]
    rounds *= -(-len(by) // CLASSES)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for k in range(1, rounds + 1):
        x, y = np.full((LENGTH, ROWS), 32, np.uint8), np.zeros(ROWS, np.int64)
        for row in range(ROWS):  # every language equally often
            own = by[((k - 1) * ROWS + row) % len(by)]
            i = own[rng.integers(len(own))]
            t = texts[i]
            a = int(rng.integers(max(1, len(t) - LENGTH)))
            s = np.frombuffer(t[a:a + LENGTH], np.uint8)
            x[:len(s), row], y[row] = s, labels[i]
        _, grad = step(p, x, y)
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = 0.02 * min(1.0, 3 * (1 - (k - 1) / rounds))
        for key, g in grad.items():
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m[key] = 0.9 * m[key] + 0.1 * g
            v[key] = 0.99 * v[key] + 0.01 * g * g
            p[key] = (p[key] - rate * (m[key] / (1 - 0.9 ** k)) / (np.sqrt(v[key] / (1 - 0.99 ** k)) + 1e-8)).astype(np.float32)
    return p


def labelled(p: dict, side: str, x: np.ndarray) -> np.ndarray:
    """This side's part of the label scores, (time, language, row), without the warm-up positions.

    The same recurrence as ``read``, with one feature per row of memory and nothing kept."""
    n, rows = HIDDEN, x.shape[1]
    E = np.ascontiguousarray(p["E" + side].T)
    Ug, Uc = np.ascontiguousarray(p["U" + side][:, :2 * n].T), np.ascontiguousarray(p["U" + side][:, 2 * n:].T)
    W = np.ascontiguousarray((p["W"][:n] if side == "f" else p["W"][n:]).T)
    E[:2 * n] *= 0.5
    Ug *= 0.5
    h, e = np.zeros((n, rows), np.float32), np.empty((3 * n, rows), np.float32)
    g, c, rh = np.empty((2 * n, rows), np.float32), np.empty((n, rows), np.float32), np.empty((n, rows), np.float32)
    out = np.empty((len(x) - 2 * WARM, len(W), rows), np.float32)
    for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
        np.take(E, x[t], axis=1, out=e, mode="clip")
        np.matmul(Ug, h, out=g)
        g += e[:2 * n]
        np.tanh(g, out=g)
        g += 1  # twice the gates
        np.multiply(g[n:], h, out=rh)
        rh *= 0.5
        np.matmul(Uc, rh, out=c)
        c += e[2 * n:]
        np.tanh(c, out=c)
        c -= h
        c *= g[:n]
        c *= 0.5
        h += c
        if WARM <= t < len(x) - WARM:
            np.matmul(W, h, out=out[t - WARM])
    return out


def window_scores(p: dict, data: np.ndarray, begin: np.ndarray, end: np.ndarray, off: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Sums of the position probabilities of the windows data[begin:end], each within its text's bytes."""
    steps = np.arange(-WARM, STEP + WARM)[:, None]
    at = begin[None, :] + steps
    inside = (at >= off[text][None, :]) & (at < off[text + 1][None, :])
    x = np.where(inside, data[np.clip(at, 0, len(data) - 1)], np.uint8(32))
    o = labelled(p, "f", x)
    o += labelled(p, "b", x)
    o += p["b"][:, None]
    o -= o.max(1, keepdims=True)
    np.exp(o, out=o)
    o *= ((at[WARM:-WARM] < end[None, :]) / o.sum(1)).astype(np.float32)[:, None, :]
    return o.sum(0, dtype=np.float64).T


def probabilities(p: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, languages): mean over all byte positions; an empty text has zeros."""
    size = np.diff(off)
    count = -(-size // STEP)
    text = np.repeat(np.arange(len(size)), count)
    first = np.concatenate([[0], np.cumsum(count)])
    begin = off[text] + (np.arange(len(text)) - first[text]) * STEP
    end = np.minimum(begin + STEP, off[text + 1])
    out = np.zeros((len(size), len(p["b"])))
    batch = max(16, BATCH * 64 // max(64, len(p["b"])))  # the label scores of a batch have a bounded size
    for a in range(0, len(text), batch):
        s = slice(a, a + batch)
        np.add.at(out, text[s], window_scores(p, data, begin[s], end[s], off, text[s]))
    return out / np.maximum(size, 1)[:, None]


def training_sample(docs: DataFrame, parts: int, held_out: int) -> tuple[list[str], list[bytes], list[int]]:
    """All languages in order, and the texts of the sample with each one's language.

    A count by language gives the hash below which about twice the rows wanted lie; one more pass ranks only those and
    the first ones come to the driver.  Should equal ids leave too few, the pass is repeated with a higher bound."""
    rows = docs.where("doc_id is not null and lang is not null and text is not null")
    rows = rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != held_out)
    count = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().toLocalIterator()}
    langs = sorted(count)
    if not langs:
        return [], [], []
    each = max(1, min(SAMPLE, SAMPLE_ROWS // len(langs)))
    share = {x: (2 * each + 40) / n for x, n in count.items()}
    rows = rows.select("lang", "doc_id", F.md5(F.col("doc_id").cast("string").cast("binary")).alias("turn"), F.substring(F.col("text").cast("binary"), 1, SAMPLE_BYTES).alias("x"))
    first = Window.partitionBy("lang").orderBy("turn", "doc_id", "x")
    found: dict[str, list[bytes]] = {}
    while len(found) < len(langs):
        ask = [(x, "g" if share[x] >= 1 else f"{int(share[x] * 2 ** 64):016x}") for x in langs if x not in found]  # g: above all digits
        bounds = docs.sparkSession.createDataFrame(ask, "of string, bound string")
        near = rows.join(F.broadcast(bounds), F.col("lang") == F.col("of")).where("turn < bound")
        got: dict[str, list[bytes]] = {}
        for r in near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= each).orderBy("lang", "k").select("lang", "x").toLocalIterator():
            got.setdefault(r["lang"], []).append(bytes(r["x"]))
        for x, _ in ask:
            if len(got.get(x, [])) >= min(each, count[x]) or share[x] >= 1:
                found[x] = got.get(x, [])
            share[x] *= 16
    return langs, [t for x in langs for t in found[x]], [k for k, x in enumerate(langs) for _ in found[x]]


def languages(docs: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """One row per row: doc_id, held_out, lang_pred, score."""
    docs = pick(docs, doc_id="doc_id", text="text", lang="lang")
    langs, texts, labels = training_sample(docs, parts, held_out)
    model = train(texts, labels, len(langs)) if any(texts) else None
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches):
        for batch in batches:
            data, off = utf8(batch.column("text"))
            q = probabilities(model, data, off) if model else np.zeros((len(off) - 1, 1))
            best = q.argmax(1)
            blank = batch.column("blank").to_numpy(zero_copy_only=False) | (q.max(1) <= 0)
            names = [None if blank[i] else langs[b] for i, b in enumerate(best)]
            score = np.where(blank, 0.0, np.clip(q.max(1), 0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    blank = ~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out = docs.select("doc_id", "text", blank.alias("blank")).mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held_out, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), "score")
