"""Byte-level BPE encoding and decoding with a public vocabulary.

A text is cut at the vocabulary's added tokens, then into words; a word's bytes
are merged pair by pair, the pair of lowest rank first, the leftmost of equal
ones.

Contiguous rank array. A short word is a list of part boundaries and, beside
it, the rank of each pair of neighbouring parts. The least rank is found by
scanning the list; its boundary is deleted and the ranks of the two pairs that
changed are looked up again. That is quadratic in the parts, which for a word
of some letters is the cheapest form there is. A word of over ``SHORT`` bytes
(no prose has one, a text without spaces may) keeps its pairs in a heap with
links to the neighbours instead, with the same merges in the same order.

The vocabulary file is read by the driver and broadcast: its size is checked
against ``MOST_VOCABULARY``. A worker keeps the words that it has merged in two
generations of ``REMEMBERED`` bytes; when the younger is full, the older goes,
except for words met again. Rows are encoded where they lie: no shuffle.

Defined results. A null text counts as empty and has no ids. Texts are encoded
whole. Ids that the vocabulary does not have decode to nothing, and bytes that
are no UTF-8 decode to U+FFFD. All columns given are handed on as ``doc``, so
their names cannot clash.
"""

from __future__ import annotations

import heapq
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Words of the byte-level vocabularies (a fixed value of their format).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
MOST_VOCABULARY = 64 << 20
SHORT = 256
REMEMBERED = 64 << 20
_NONE = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the other bytes in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Vocabulary:
    """Ids of byte strings, ranks of merges and added tokens of a byte-level
    BPE file."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]:
            raise ValueError("the file is not a plain byte-level BPE vocabulary")
        letter = byte_letters()
        as_bytes = lambda token: bytes(letter[c] for c in token)
        ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: as_bytes(t) for t, i in ids.items() if t not in self.added}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.of_byte = [ids[c] for c, _ in sorted(letter.items(), key=lambda x: x[1])]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[a], ids[b]] = rank
            self.made.append(ids[a + b])


def merge_short(word: bytes, v: Vocabulary) -> list[int]:
    """Merge by scanning one contiguous list of ranks."""
    of_byte, rank_of, made = v.of_byte, v.ranks.get, v.made
    parts = [of_byte[b] for b in word]
    ranks = [rank_of(pair, _NONE) for pair in zip(parts, parts[1:])]
    while ranks and (least := min(ranks)) != _NONE:
        i = ranks.index(least)
        parts[i] = made[least]
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = rank_of((parts[i], parts[i + 1]), _NONE)
        if i:
            ranks[i - 1] = rank_of((parts[i - 1], parts[i]), _NONE)
    return parts


def merge_long(word: bytes, v: Vocabulary) -> list[int]:
    """The same merges by a heap of (rank, place) and links between parts."""
    parts = [v.of_byte[b] for b in word]
    rank_of, n = v.ranks.get, len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if (rank := rank_of(pair)) is not None]
    heapq.heapify(heap)

    def propose(i: int) -> None:
        if i >= 0 and after[i] < n and (rank := rank_of(pair := (parts[i], parts[after[i]]))) is not None:
            heapq.heappush(heap, (rank, i, pair))

    while heap:
        rank, i, pair = heapq.heappop(heap)
        j = after[i]
        if parts[i] < 0 or j >= n or (parts[i], parts[j]) != pair:
            continue        # a part of the pair has been merged since
        parts[i] = v.made[rank]
        parts[j] = -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        propose(i)
        propose(before[i])
    return [p for p in parts if p >= 0]


class MergedWords(dict):
    """Words to their ids (as bytes of 32-bit numbers), merged when first asked for."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v, self.older, self.held = v, {}, 0

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            data = word.encode()
            if len(data) > SHORT:
                return np.array(merge_long(data, self.v), dtype=np.int32).tobytes()
            found = array("i", merge_short(data, self.v)).tobytes()
        if self.held > REMEMBERED:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += 2 * len(word) + len(found) + 200
        self[word] = found
        return found


class Encoder:
    """Cuts texts into added tokens and words, and merges these."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, MergedWords(v)
        self.words = regex.compile(WORD)
        names = sorted(v.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")")

    def ids(self, text: str) -> np.ndarray:
        out = []
        plain = not any(name in text for name in self.v.added)
        for k, piece in enumerate([text] if plain else self.cut.split(text)):
            if k % 2:
                out.append(np.int32(self.v.added[piece]).tobytes())
            elif len(piece) > 1 << 20:
                out += (self.known[m.group()] for m in self.words.finditer(piece))
            else:
                out += map(self.known.__getitem__, self.words.findall(piece))
        return np.frombuffer(b"".join(out), dtype=np.int32)


class Decoder:
    """Joins the bytes of ids; unknown ids have none."""

    def __init__(self, v: Vocabulary):
        self.table = [v.bytes_of.get(i, b"") for i in range(max(v.bytes_of) + 1)]

    def text(self, ids: np.ndarray) -> str:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.table)):
            ids = ids[(ids >= 0) & (ids < len(self.table))]
        return b"".join(map(self.table.__getitem__, ids.tolist())).decode("utf-8", "replace")


_WORKERS: dict[type, tuple] = {}


def _worker(kind: type, vocabulary: Broadcast):
    """This Python worker's encoder or decoder, kept from task to task."""
    v = vocabulary.value
    held = _WORKERS.get(kind)
    if held is None or held[0] is not v:
        held = _WORKERS[kind] = (v, kind(v))
    return held[1]


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary of a tokenizer's JSON file, broadcast; ``path`` is the driver's."""
    if (size := os.path.getsize(path)) > MOST_VOCABULARY:
        raise ValueError(f"a vocabulary of {size} bytes is over the {MOST_VOCABULARY} that are broadcast")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(Vocabulary(json.load(f)))


def _mapped(df: DataFrame, column: str, name: str, kind: str, make) -> DataFrame:
    """``df`` with ``name`` computed from ``column`` by ``make()`` batch for batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for k in range(0, batch.num_rows, 100):
                part = batch.slice(k, 100)
                yield pa.RecordBatch.from_arrays([*part.columns, work(part.column(at))],
                                                 names=[*part.schema.names, name])
    schema = F.lit(None).cast(kind).alias(name)
    return df.mapInArrow(run, df.select("*", schema).schema)


def encode(docs: DataFrame, text: str, vocabulary: Broadcast) -> DataFrame:
    """``doc`` (all columns) and ``ids``, the token ids of ``text``."""
    def make():
        encoder = _worker(Encoder, vocabulary)

        def work(texts: pa.Array) -> pa.Array:
            found = [encoder.ids(t or "") for t in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        return work
    held = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"))
    return _mapped(held, "text", "ids", "array<int>", make).drop("text")


def decode(encoded: DataFrame, ids: str, vocabulary: Broadcast) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``."""
    def make():
        decoder = _worker(Decoder, vocabulary)

        def work(lists: pa.Array) -> pa.Array:
            none = np.zeros(0, dtype=np.int64)
            return pa.array([decoder.text(none if row.values is None else row.values.to_numpy(zero_copy_only=False))
                             for row in lists], pa.string())
        return work
    return _mapped(encoded, ids, "decoded", "string", make)
