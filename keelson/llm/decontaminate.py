"""Benchmark decontamination (operator 2).

The windows of all benchmark items go into hash sets that are broadcast in
blocks of at most about ``block_pairs`` (window, item) pairs, so no broadcast
grows with the benchmark: a larger one takes more blocks, each scanned over
the documents in turn. A document's windows are hashed with numpy; a hash that
falls into the set's bit table is verified word by word before it counts.

Defined cases: null or empty text has no words, is never contaminated and
keeps its row; a null item text has no windows; a null item id still marks
words as hit but names no item; repeated documents and items are judged like
any others; an empty benchmark hits nothing; all columns of the documents pass
through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keelson.llm import text as W
from keelson.session import scratch_dir

WINDOW = 13
#: (window, item) pairs in one broadcast, about 150 bytes each.
BLOCK_PAIRS = 200_000
#: Slots of a block's hash table for each of its windows, and the fewest it has (2^20).
_ROOM, _BITS = 64, 20
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_FOUND = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """Distinct (item, size, gram): each item's windows of ``window`` words,
    space-joined; an item of fewer words gives one window of all it has."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(F.coalesce(lower, F.lit("")),
                                 F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    return (benchmark.select(F.col(id_col).cast("string").alias("item"), words.alias("words"))
            .where(F.size("words") > 0)
            .withColumn("size", F.least(F.size("words"), F.lit(window)))
            .select("item", "size", "words", F.explode(F.expr("sequence(1, size(words) - size + 1)")).alias("at"))
            .select("item", "size", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("gram"))
            .distinct())


class Grams:
    """One block's windows: exact lookup, and by length a bit table of hashes."""

    def __init__(self, pairs: list[tuple[str | None, int, str]]):
        self.items: dict[bytes, set[str]] = {}
        sizes: dict[int, list[bytes]] = {}
        for item, size, gram in pairs:
            key = gram.encode()
            if key not in self.items:
                self.items[key] = set()
                sizes.setdefault(size, []).append(key)
            if item is not None:
                self.items[key].add(item)
        self.tables: dict[int, np.ndarray] = {}
        for size, grams in sizes.items():
            words = W.find_words(grams, W.PLAIN)
            # few windows a slot: a word of a text that is in no window is hardly ever looked at
            bits = max(_BITS, (_ROOM * len(grams)).bit_length())
            table = np.zeros(1 << bits, dtype=bool)
            table[_slot(W.window_hashes(words.hashes(), size)[words.first[:-1]], bits)] = True
            self.tables[size] = table

    def hits(self, words: W.Words) -> Iterator[tuple[int, int, bytes]]:
        """(first word, size, window) of every verified hit."""
        h = words.hashes()
        for size, table in self.tables.items():
            if len(h) < size:
                continue
            maybe = table[_slot(W.window_hashes(h, size), len(table).bit_length() - 1)] & W.inside(words, size)
            for i in np.flatnonzero(maybe).tolist():
                gram = words.joined(i, i + size)
                if gram in self.items:
                    yield i, size, gram


def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> W.U64(64 - bits)).astype(np.int64)


def _scanner(block, text_at: int):
    """Adds one block's hits to (n_words, spans, items), the last three columns."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(block.value)
        for batch in batches:
            texts = W.text_bytes(batch.column(text_at))
            spans, items = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            n_words: list[int] = []
            for a, b in W.pieces(texts):
                words = W.find_words([x.lower() for x in texts[a:b]], W.PLAIN)
                n_words += np.diff(words.first).tolist()
                found: dict[int, list[tuple[int, int, bytes]]] = {}
                for i, size, gram in grams.hits(words):
                    row = int(np.searchsorted(words.first, i, "right")) - 1
                    found.setdefault(row, []).append((i - int(words.first[row]), size, gram))
                for row, hits in found.items():
                    step = np.zeros(n_words[a + row] + 1, dtype=np.int64)
                    for s, e in [(x["start"], x["end"]) for x in spans[a + row]] + [(i, i + size) for i, size, _ in hits]:
                        step[s] += 1
                        step[e] -= 1
                    spans[a + row] = [{"start": s, "end": e} for s, e in W.runs(np.cumsum(step[:-1]) > 0)]
                    items[a + row] = sorted(set(items[a + row]).union(*(grams.items[g] for _, _, g in hits)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(n_words, pa.int64()), pa.array(spans, _SPANS),
                 pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)
    return scan


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with ``n_words``, ``spans``
    (maximal runs of hit words, end exclusive) and ``items`` (ids of the items
    with a window in the text, sorted as strings)."""
    spark = docs.sparkSession
    grams = item_windows(benchmark, item_col, item_text, window)
    pairs = grams.count()
    blocks = max(1, -(-pairs // block_pairs))
    if blocks > 1:
        grams.write.parquet(path := scratch_dir(spark, "grams"))
        grams = spark.read.parquet(path)
    # Arrow columns are positional: any column names may stand in docs
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = docs.toDF(*names).selectExpr(
        *names, "cast(0 as bigint) n_words", "cast(array() as array<struct<start:int,end:int>>) spans",
        "cast(array() as array<string>) items")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.toDF(*names).schema.fields)
    for b in range(blocks):
        part = grams.where(F.pmod(F.xxhash64("gram", "item"), F.lit(blocks)) == b) if blocks > 1 else grams
        block = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        out = out.mapInArrow(_scanner(block, docs.columns.index(text_col)), f"{schema}, {_FOUND}")
        if b < blocks - 1:
            out.write.parquet(path := scratch_dir(spark, "hits"))
            out = spark.read.parquet(path)
    doc = F.struct(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
    return out.select(doc.alias("doc"), "n_words", "spans", "items")


def n_hit():
    """Words in a document's spans."""
    return F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")


def contaminated(percent: int = 5):
    """At least ``percent`` of a document's words are hit, and at least one."""
    return (n_hit() > 0) & (n_hit() * 100 >= F.col("n_words") * percent)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text",
                  percent: int = 5, **options) -> DataFrame:
    """``docs`` without its contaminated documents (``remove="documents"``), or
    with every document but without the hit words (``remove="spans"``, from a
    span's first byte to its last)."""
    found = benchmark_hits(docs, benchmark, text_col, **options)
    if remove == "documents":
        return found.where(~contaminated(percent)).select("doc.*")
    if remove != "spans":
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    at = docs.columns.index(text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    flat = found.select(*(F.col("doc").getField(c).alias(n) for n, c in zip(names, docs.columns)), "spans")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields[:-1])
    return flat.mapInArrow(_cutter(at), schema).toDF(*docs.columns)


def _cutter(text_at: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if spans:
                    texts[i] = _without(texts[i].encode(), [(x["start"], x["end"]) for x in spans]).decode()
            columns = list(batch.columns[:-1])
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
    return cut


def _without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    words = W.find_words([raw.lower()], W.PLAIN)
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:int(words.starts[s] - words.offsets[0])])
        at = int(words.ends[e - 1] - words.offsets[0])
    return b"".join([*kept, raw[at:]])
