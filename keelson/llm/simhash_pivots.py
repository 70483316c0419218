"""SimHash near-duplicates by pivot distance tables (operator 4).

Each text gets a 64-bit SimHash over its word shingles. All distinct
fingerprints get a row of Hamming distances to ``PIVOTS`` reference
fingerprints: a base reference, and references that differ from it within one
of five blocks of the bits. By the triangle inequality two fingerprints at
distance ``d`` differ by at most ``d`` in every coordinate.

Candidates meet without comparing all: two linked fingerprints differ in at
most two bits, so in at least three of the five blocks they agree, and there
all their distances differ from the base's by equal amounts. Those differences
are an equality key (a cell) for each of the ten triples of blocks; the
references are drawn so that the differences tell all values of a block apart,
so fingerprints of one cell agree in 38 or 39 bits, and cells stay sparse up
to some 10^11 fingerprints. Pairs within a cell are discarded by the largest
coordinate difference over the whole table, and the survivors verified by
their exact distance.

More than ``CELL`` fingerprints that are equal in a triple's bits are not
paired up: there each is listed under all values one bit away from it outside
those blocks, at most 65 over all its triples; two of them are linked exactly
if they share a value. A value has at most 65 fingerprints, however many are
equal in those bits.

Linked fingerprints form components (alternating stars, each round written to
the shared folder); documents of equal text meet in one fingerprint first, so
copies are never paired.

Defined cases: null and empty texts have the fingerprint zero, linked like any
other; a text of fewer words than a shingle is one shingle; a component's id is
its smallest id that is not null (null if all are); repeated ids are separate
documents; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from keelson.llm import text as W
from keelson.llm.components import connected
from keelson.session import scratch_dir

SHINGLE = 3
SEED = 42
MOST_BITS = 2
CELL = 16
_BLOCKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
_TRIPLES = tuple(combinations(range(len(_BLOCKS)), 3))
_MASKS = 10


def _tells_apart(masks: list[int], bits: int) -> bool:
    """Whether the counts of ones under the masks differ for all values of so many bits."""
    values = np.arange(1 << bits, dtype=np.int64)
    counts = np.zeros_like(values)
    for m in masks:
        counts = counts * (bits + 1) + np.bitwise_count(values & m)
    return len(np.unique(counts)) == len(values)


def _references(seed: int = 7) -> list[list[int]]:
    """The base reference, alone, then for each block the references that differ from it there."""
    draw = random.Random(seed)
    base = draw.getrandbits(64)
    found = [[base]]
    for lo, hi in _BLOCKS:
        masks: list[int] = []
        while not (masks and _tells_apart(masks, hi - lo)):
            masks = [draw.getrandbits(hi - lo) for _ in range(_MASKS)]
        found.append([base ^ (m << lo) for m in masks])
    return found


REFERENCES = _references()
PIVOTS = sum(map(len, REFERENCES))


def fingerprint(raw: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text's word shingles, unsigned."""
    words = raw.lower().split()  # bytes: A-Z, and the white space \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) > size:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate([[0], ends[:-size]]).tolist()
        grams = [joined[s:e] for s, e in zip(starts, (ends[size - 1:] - 1).tolist())]
    else:
        grams = [joined]
    h = np.array([xxhash.xxh64_intdigest(g, seed) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, size) for x in W.text_bytes(batch.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                                             names=["id", "digest", "fp"])
    return of_batches


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, digest, fp) of every row: its id, a 64-bit digest of its text, its fingerprint."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text")
                       ).mapInArrow(_fingerprints(size), f"id {kind}, digest bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance_table(fps: DataFrame) -> DataFrame:
    """``fps`` with ``dist``: the distances to all references, as bytes."""
    refs = [r for group in REFERENCES for r in group]
    return fps.withColumn("dist", F.array(*(
        F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(r)))).cast("tinyint") for r in refs)))


def _cells(table: DataFrame) -> DataFrame:
    """Ten rows for each fingerprint: its cell in each triple of blocks, and the bits outside it."""
    at, blocks = 1, {}
    for k, group in enumerate(REFERENCES[1:]):
        blocks[f"block{k}"] = F.xxhash64(*(F.col("dist")[at + j] - F.col("dist")[0] for j in range(len(group))))
        at += len(group)
    keys = []
    for t, triple in enumerate(_TRIPLES):
        free = sum((1 << hi) - (1 << lo) for k, (lo, hi) in enumerate(_BLOCKS) if k not in triple)
        keys.append(F.struct(F.xxhash64(F.lit(t), *(F.col(f"block{k}") for k in triple)).alias("cell"),
                             F.lit(_signed(free)).alias("free")))
    return table.withColumns(blocks).select("fp", "dist", F.explode(F.array(*keys)).alias("k")).select(
        "fp", "dist", "k.cell", "k.free")


def _near(a: Column, b: Column) -> Column:
    """No coordinate of the tables differs by more than the distance allowed."""
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(x.cast("int") - y)), lambda d: d <= MOST_BITS)


def links(fps: DataFrame, cell: int = CELL) -> DataFrame:
    """Edges (a, b), a > b, that connect exactly the distinct fingerprints
    ``fps`` at ``MOST_BITS`` or fewer differing bits: all pairs of sparse cells,
    and in crowded ones a star for each shared value."""
    cells = _cells(distance_table(fps))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = cells.join(sizes, "cell")
    small = held.where(F.col("n") <= cell).select("cell", "fp", "dist")
    pairs = (small.alias("x").join(small.alias("y"), "cell").where("x.fp > y.fp")
             .where(_near(F.col("x.dist"), F.col("y.dist")))
             .where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= MOST_BITS)
             .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))
    flips = F.array(*(F.lit(_signed(1 << b)) for b in range(64)))
    crowded = held.where(F.col("n") > cell).groupBy("fp").agg(F.bit_or("free").alias("free"))
    masks = F.concat(F.array(F.lit(0).cast("bigint")), F.filter(flips, lambda m: m.bitwiseAND(F.col("free")) != 0))
    shared = (crowded.select("fp", F.explode(masks).alias("mask"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("value"))
              .groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
              .select(F.array_min("fps").alias("b"), F.explode("fps").alias("a")).where("a > b"))
    return pairs.unionByName(shared.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    cell: int = CELL) -> DataFrame:
    """(id, digest, fp, component_id, first) of every row of ``docs``;
    ``first`` is (id, digest) of the one document that stands for its component."""
    spark = docs.sparkSession
    fingerprints(docs, id_col, text_col, size).write.parquet(path := scratch_dir(spark, "fingerprints"))
    found = spark.read.parquet(path)
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "digest")
    nodes = found.groupBy("fp").agg(F.min(order).alias("first"))
    roots = connected(links(nodes.select("fp"), cell))
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    firsts = labelled.groupBy("root").agg(F.min("first").alias("first"))
    of_fp = labelled.select("fp", "root").join(firsts, "root").select("fp", "first")
    return found.join(of_fp, "fp").select("id", "digest", "fp", F.col("first.id").alias("component_id"),
                                          F.struct("first.id", "first.digest").alias("first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component: that of smallest id (of rows alike in id and text, one)."""
    first = near_duplicates(docs, id_col, text_col, **options).select("first").distinct()
    first = first.select(F.coalesce("first.id", F.lit(0)).alias("key id"), F.col("first.id").isNull().alias("key null"),
                         F.col("first.digest").alias("key digest"))
    keyed = docs.withColumns({"key id": F.coalesce(F.col(id_col), F.lit(0)), "key null": F.col(id_col).isNull(),
                              "key digest": F.xxhash64(text_col)})
    keys = ["key id", "key null", "key digest"]
    return keyed.join(first, keys, "left_semi").dropDuplicates(keys).drop(*keys)
