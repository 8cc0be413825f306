"""Quality by compression: one zstandard dictionary is built from good labelled text, one from bad.

A text is cut into pieces of 2 KB (all of it); each piece is compressed with either dictionary.  The
difference of the two compressed sizes over their sum, and the ratio of the larger one to the text's size,
are clipped to the range of the texts that calibrate (a text that is in a dictionary lies far beyond it) and
go through a logistic regression fitted on labelled texts that the dictionaries haven't seen.

Fitted on a bounded sample: at most ``SAMPLE`` labelled rows of each label (those with the smallest md5 of
doc_id, from the rows the fold admits) and at most ``SAMPLE_BYTES`` of each text; half of them build the
dictionaries, half calibrate.  A label's dictionary is trained by zstandard from the pieces of its half; a half of
under 20 times the dictionary's size, of under 51 pieces, or without repeated content cannot train one, and its last
``DICTIONARY_BYTES`` are the dictionary as they are.  Pieces of 7 bytes or less, below what a dictionary can match,
don't build one.  Every row is scored over its whole text.

Defined results: a null or empty text scores the calibrated value of a difference of zero at ratio one, so a
number from 0 to 1 as any other; with no labelled rows of one label every score is 0.5; of several labels of
a doc_id the largest quality counts; repeated rows give one row each; null doc_ids are scored and never
learned from; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import pick, utf8

SAMPLE = 3000
SAMPLE_BYTES = 8000
PIECE_BYTES = 2048
DICTIONARY_BYTES = 64 << 10
THRESHOLD = 0.3
RIDGE = 1.0


def fold(doc_id: str, parts: int):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def training_sample(docs: DataFrame, labels: DataFrame, parts: int, held_out: int, size: int = SAMPLE) -> list[tuple[bytes, int]]:
    """(text, label) of at most ``size`` rows of each label, smallest md5 of doc_id first."""
    own = pick(labels, doc_id="doc_id", quality="quality").where("doc_id is not null and quality in (0, 1)")
    own = own.where(fold("doc_id", parts) != held_out).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    own = own.withColumn("turn", F.md5(F.col("doc_id").cast("string").cast("binary")))
    picked = None
    for q in (0, 1):
        one = own.where(F.col("quality") == q).orderBy("turn", "doc_id").limit(size)
        picked = one if picked is None else picked.unionByName(one)
    rows = docs.join(F.broadcast(picked), "doc_id").select("turn", "doc_id", "quality", F.substring(F.col("text").cast("binary"), 1, SAMPLE_BYTES).alias("x"))
    rows = rows.where("x is not null").groupBy("turn", "doc_id", "quality").agg(F.min("x").alias("x"))
    return [(bytes(r["x"]), r["quality"]) for r in rows.orderBy("turn", "doc_id").toLocalIterator()]


def features(data: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[float, float]:
    """(normalised difference of compressed sizes, larger size over the text's size)."""
    g = b = 0
    for i in range(0, len(data), PIECE_BYTES):
        piece = data[i:i + PIECE_BYTES]
        g += len(good.compress(piece))
        b += len(bad.compress(piece))
    return ((b - g) / (b + g), max(b, g) / len(data)) if data else (0.0, 1.0)


def compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    out = []
    for d in (good, bad):
        z = zstandard.ZstdCompressionDict(d)
        z.precompute_compress(level=3)
        out.append(zstandard.ZstdCompressor(dict_data=z, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i:i + PIECE_BYTES] for t in texts for i in range(0, len(t), PIECE_BYTES) if len(t) > 7]
    if sum(map(len, pieces)) > 20 * DICTIONARY_BYTES and len(pieces) > 50:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
        except zstandard.ZstdError:
            pass  # too little variety to train on: the texts themselves are the dictionary
    return b"".join(pieces)[-DICTIONARY_BYTES:] or b"\x00" * 8


def design(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x[:, 0] * 20, (x[:, 1] - 0.5) * 4, (x[:, 0] * 20) ** 2, ((x[:, 1] - 0.5) * 4) ** 2])


def fit(sample: list[tuple[bytes, int]]) -> dict | None:
    """Dictionaries and weights; None unless both labels occur."""
    by = [[t for t, q in sample if q == label and t] for label in (0, 1)]
    if min(map(len, by)) < 2:
        return None
    good, bad = dictionary(by[1][::2]), dictionary(by[0][::2])
    tools = compressors(good, bad)
    calibrate = [(t, q) for q in (0, 1) for t in by[q][1::2]]
    x = np.array([features(t, *tools) for t, _ in calibrate])
    y = np.array([q for _, q in calibrate], float)
    low, high = np.percentile(x, [0.5, 99.5], axis=0)
    X, w = design(np.clip(x, low, high)), np.zeros(5)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)  # both labels count alike
    def loss(w: np.ndarray) -> float:
        z = X @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * RIDGE * (w @ w))

    for _ in range(60):  # Newton's method; a step is halved until it lowers the loss
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        grad = X.T @ (weight * (y - p)) - RIDGE * w
        step = np.linalg.solve((X * (weight * p * (1 - p))[:, None]).T @ X + RIDGE * np.eye(X.shape[1]), grad)
        now, size = loss(w), 1.0
        while size > 1e-6 and not loss(w + size * step) < now:
            size /= 2
        if size <= 1e-6:
            break
        w = w + size * step
    return {"good": good, "bad": bad, "w": w, "low": low, "high": high}


def score_texts(model: dict | None, texts: list[bytes], tools=None) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    tools = tools or compressors(model["good"], model["bad"])
    x = np.array([features(t, *tools) for t in texts]).reshape(-1, 2)
    return 1 / (1 + np.exp(-np.clip(design(np.clip(x, model["low"], model["high"])) @ model["w"], -30, 30)))


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0) -> DataFrame:
    """One row per row: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.3)."""
    docs = pick(docs, doc_id="doc_id", text="text")
    model = fit(training_sample(docs, labels, parts, held_out))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        tools = compressors(model["good"], model["bad"]) if model else None
        for batch in batches:
            data, off = utf8(batch.column("text"))
            out = score_texts(model, [data[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], tools)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    out = docs.mapInArrow(score, f"doc_id {kind}, score double")
    return out.select("doc_id", F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    own = pick(docs, doc_id="doc_id", text="text")
    model = fit(training_sample(own, labels, 5, 0))
    schema = docs.schema
    place = docs.columns.index("text")

    def keep(batches):
        tools = compressors(model["good"], model["bad"]) if model else None
        for batch in batches:
            data, off = utf8(batch.column(place))
            out = score_texts(model, [data[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], tools)
            yield batch.filter(pa.array(out >= THRESHOLD))

    return docs.mapInArrow(keep, schema)
