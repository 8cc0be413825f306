"""Byte-pair encoding and decoding in batched numpy merge rounds.

A word's symbols start as its bytes, the last one with the vocabulary's word end.  The symbols of many words lie
in one flat array.  A round finds the lowest-ranked pair of each word (pair keys ``left << 32 | right`` are looked
up by binary search over the sorted keys of the merge list), merges every place where it stands, left to right and
without overlap, and looks up only the pairs beside a merge again.  Words without a pair in the list leave the array.
Equal words of a task are encoded once; the table of known words is emptied beyond ``KNOWN_WORDS`` entries and after
a word of over ``LONG_WORD`` bytes, so a task's memory doesn't grow with its input.

Normalisation is that of the vocabulary file it is made for: canonical composition, lower case code point by code
point, white space only separates.  Special tokens are found in the raw text.  Words follow the file's pattern.
Code points assigned after Unicode 15.1 (Python's own tables) may be cased or classed otherwise by other libraries.

Results for odd rows: a null or empty text, or white space alone, has no tokens and decodes to the empty text; each
repeated row gets its own result; null ids are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.common import pick, pieces, utf8

KNOWN_WORDS = 200_000
LONG_WORD = 256
BATCH = 4 << 20  # bytes of text that are encoded at once; a longer text stands alone
NEVER = np.int64(1 << 40)


@dataclass
class Vocabulary:
    """Tables of a word-end BPE file: ids of the 256 bytes inside and at the end of a word, sorted pair keys with
    the rank and the result of each merge, the text of each token, the special tokens and the word pattern."""

    inner: np.ndarray
    final: np.ndarray
    keys: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    tokens: list[str]
    special: dict[str, int]
    pattern: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        chars = byte_characters()
        pairs = np.array([[ids[a], ids[b], ids[a + b]] for a, b in spec["model"]["merges"]], np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (1 + max([*ids.values(), *special.values()]))
        for text, i in [*ids.items(), *special.items()]:
            tokens[i] = text
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        return cls(np.array([ids[c] for c in chars], np.int64), np.array([ids[c + end] for c in chars], np.int64),
                   keys[order], order.astype(np.int64), pairs[order, 2], tokens, special, split)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; ``NEVER`` for a pair outside the merge list."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.rank[at], NEVER), self.merged[at]


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable and no space,
    else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and where each word starts in it (with the end as last entry)."""
    size = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    word = np.repeat(np.arange(len(words)), size)
    sym = vocabulary.inner[raw]
    last = np.cumsum(size)[size > 0] - 1
    sym[last] = vocabulary.final[raw[last]]
    rank, result = np.full(len(sym), NEVER), np.zeros(len(sym), np.int64)

    def look_up(at: np.ndarray) -> None:
        inside = at[:-1] if len(at) and at[-1] == len(sym) - 1 else at
        inside = inside[word[inside] == word[inside + 1]]
        rank[at] = NEVER
        rank[inside], result[inside] = vocabulary.look_up(sym[inside], sym[inside + 1])

    done_word, done_sym = [], []
    look_up(np.arange(len(sym)))
    while len(sym):
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lengths = np.diff(np.append(starts, len(sym)))
        least = np.minimum.reduceat(rank, starts)
        goes_on = least < NEVER
        if not goes_on.all():
            stay = np.repeat(goes_on, lengths)
            done_word.append(word[~stay])
            done_sym.append(sym[~stay])
            word, sym, rank, result = word[stay], sym[stay], rank[stay], result[stay]
            least, lengths = least[goes_on], lengths[goes_on]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == np.repeat(least, lengths))
        # a run of hits side by side is one symbol repeated: every second pair of it merges
        first = np.concatenate([[True], np.diff(hit) > 1])
        in_run = np.arange(len(hit)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        hit = hit[in_run % 2 == 0]
        sym[hit] = result[hit]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        word, sym, rank, result = word[keep], sym[keep], rank[keep], result[keep]
        now = hit - np.arange(len(hit))  # each merge before a place takes one symbol away
        beside = np.zeros(len(sym), bool)
        beside[now] = beside[now[now > 0] - 1] = True
        look_up(np.flatnonzero(beside))
    if not done_word:
        return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
    word, sym = np.concatenate(done_word), np.concatenate(done_sym)
    order = np.argsort(word, kind="stable")
    return sym[order].astype(np.int32), np.searchsorted(word[order], np.arange(len(words) + 1))


def lower(text: str) -> str:
    """Lower case code point by code point: a final sigma isn't told from others."""
    out = text.lower()
    return "".join(map(str.lower, text)) if "Σ" in text else out


class Numbers(dict):
    """Word -> number, in the order of first use; ``new`` lists the words numbered since it was emptied."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Encodes batches of texts; knows the words that it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.texts = pa.array(vocabulary.tokens, pa.large_string())
        self._forget()

    def _forget(self) -> None:
        special = self.vocabulary.special
        self.known = Numbers({s: i for i, s in enumerate(special)})
        self.ids = np.array(list(special.values()), np.int32)
        self.starts = np.arange(len(special) + 1, dtype=np.int64)

    def split(self, text: str) -> list[str]:
        if self.special is not None and "<" in text:
            parts = self.special.split(text)
            if len(parts) > 1:
                return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._split(p))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return self.words.findall(lower(text))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and each text's start in it (with the end)."""
        split = [self.split(t) for t in texts]
        counts = np.array([len(ws) for ws in split], np.int64)
        words = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        new = [w.encode() for w in self.known.new]
        self.known.new.clear()
        ids, starts = merge_words(self.vocabulary, new)
        self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        size = self.starts[words + 1] - self.starts[words]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.repeat(self.starts[words] - ends[:-1], size) + np.arange(ends[-1])]
        if len(self.known) > KNOWN_WORDS or any(len(w) > LONG_WORD for w in new):
            self._forget()
        return flat, ends[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The texts of ids: tokens' texts joined by a space, as a file without a decoder has it."""
        pieces_ = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), self.texts.take(pa.array(ids)))
        return pc.binary_join(pieces_, pa.scalar(" ", pa.large_string()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for every row of ``docs``.  ``path`` names the vocabulary file on the
    driver; its tables (under 10 MB, whatever the input's size) are broadcast once."""
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(Vocabulary.load(path))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        for batch in batches:
            data, off = utf8(batch.column(1))
            raw = data.tobytes()
            for i, j in pieces(off, BATCH):
                ids, starts = encoder.encode([raw[off[k]:off[k + 1]].decode() for k in range(i, j)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids)),
                     encoder.decode(ids, starts).cast(pa.string())], names=[id_col, "ids", "decoded"])

    return pick(docs, **{"id": id_col, "text": text_col}).mapInArrow(run, schema)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, one space between) and of the decoded text."""
    return encode(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
