"""Ranked lexical search of all documents for given items, scoring each bag once.

Bag deduplication. A document is restricted to the items' vocabulary: what a
score depends on is its counts of those terms (``tf``) and one number of its
length (``m``). Documents equal in both form a class, found by a hash and
verified by the vectors themselves. Each class is scored once, whatever number
of copies, reposts and near copies share it, and the classes that an item
ranks are expanded again into members by ascending id.

Plan, per block of items (``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` distinct
terms at most, an item of more terms being a block of its own):

1. The vocabulary is broadcast; one pass counts every document's terms and
   writes the bags. N and L (and with them ``m``) are sums over that table.
2. Classes are grouped from the bags, copies combined before the shuffle. Terms'
   document counts are summed over classes by their sizes; at most one number a
   vocabulary term reaches the driver, which broadcasts the weights back.
3. Tasks score classes against the whole block, term by term on numpy arrays,
   and keep the ``k`` best classes an item. A class that is not among an item's
   ``k`` best by (score, smallest member) has no member among the ``k`` best
   documents, so nothing is lost.
4. The chosen classes, at most ``k`` an item, meet their bags; of each the ``k``
   smallest ids are kept before the shuffle, and documents are ranked.

Defined results. A null text has no terms; a null id ranks after all others of
its score; rows of one id rank apart, each for itself. Texts are counted whole,
in slices. Items without a term that any document holds have no rows, as has
an empty table. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keelson.session import scratch_dir

#: ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes with A-Z lower-cased
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
SLICE = 4 << 20
BLOCK_ITEMS = 512
BLOCK_TERMS = 500_000
#: Classes scored at a time in a task.
CHUNK = 1024
_LAST = (1 << 63) - 1


def count_terms(text: str | None) -> Counter:
    """Occurrences of each term, in slices that end between terms."""
    data = (text or "").encode().lower()       # bytes lower-case A-Z alone
    if len(data) <= SLICE:
        return Counter(TERM.findall(data))
    found, at = Counter(), 0
    while at < len(data):
        gap = _GAP.search(data, at + SLICE)
        end = gap.start() if gap else len(data)
        found.update(TERM.findall(data[at:end]))
        at = end
    return found


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, Counter]]]:
    """Items with their terms, streamed to the driver and cut into blocks."""
    block, terms = [], set()
    for row in items.select(item, text).orderBy(item, text).toLocalIterator():
        found = count_terms(row[1])
        if block and (len(block) == BLOCK_ITEMS or len(terms | found.keys()) > BLOCK_TERMS):
            yield block
            block, terms = [], set()
        block.append((row[0], found))
        terms |= found.keys()
    if block:
        yield block


def _bags(docs: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """(id, n, terms, tfs) of every document: term numbers ascend."""
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = numbers.value
        for batch in batches:
            ns, terms, tfs, ends = [], [], [], [0]
            for x in batch.column(1):
                found = count_terms(x.as_py())
                held = sorted((place[t], c) for t, c in found.items() if t in place)
                ns.append(found.total())
                terms += [t for t, _ in held]
                tfs += [c for _, c in held]
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), *lists],
                                             names=["id", "n", "terms", "tfs"])
    out = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "id long, n long, terms array<int>, tfs array<int>")
    out.write.parquet(path := scratch_dir(spark, "bags"))
    return spark.read.parquet(path)


def _classes(bags: DataFrame) -> DataFrame:
    """Bags grouped by hash and vector: members, smallest id (nulls last), and a number."""
    spark = bags.sparkSession
    found = bags.filter(F.size("terms") > 0).groupBy("hash", "m", "terms", "tfs").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.coalesce("id", F.lit(_LAST))).alias("first"))
    found.withColumn("class", F.monotonically_increasing_id()).write.parquet(path := scratch_dir(spark, "bag-classes"))
    return spark.read.parquet(path)


def term_weights(classes: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """Weight of each vocabulary term, 0 for those that no document holds."""
    held = (classes.select("members", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.sum("members").alias("df")))
    out = np.zeros(size, dtype=np.int64)
    for term, df in held.toLocalIterator():
        out[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return out


class Postings:
    """Items of each vocabulary term, and how often each holds it."""

    def __init__(self, block: list[tuple[int, Counter]], place: dict[bytes, int]):
        rows = sorted((place[t], i, c) for i, (_, found) in enumerate(block) for t, c in found.items())
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        self.items, self.times = table[:, 1], table[:, 2]
        self.first = np.searchsorted(table[:, 0], np.arange(len(place) + 1))
        self.n_items = len(block)


def score_chunk(terms: list, tfs: list, m: np.ndarray, weights: np.ndarray, postings: Postings) -> np.ndarray:
    """Scores of each class (rows) for each item (columns)."""
    sizes = np.fromiter(map(len, terms), dtype=np.int64, count=len(terms))
    owner = np.repeat(np.arange(len(terms)), sizes)
    term, tf = np.concatenate(terms).astype(np.int64), np.concatenate(tfs).astype(np.int64)
    value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
    order = np.argsort(term, kind="stable")
    term, owner, value = term[order], owner[order], value[order]
    out = np.zeros((postings.n_items, len(terms)), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(term)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(term)]):
        t = term[a]
        for p in range(postings.first[t], postings.first[t + 1]):
            out[postings.items[p], owner[a:b]] += postings.times[p] * value[a:b]
    return out


def _best(score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores above 0, the smallest ``first`` first among equals."""
    least = max(1, np.partition(score, -k)[-k]) if len(score) > k else 1
    held = np.flatnonzero(score >= least)
    return held[np.lexsort((first[held], -score[held]))][:k]


def _best_classes(classes: DataFrame, weights: np.ndarray, block: list[tuple[int, Counter]],
                  vocabulary: list[bytes], k: int) -> DataFrame:
    """(item, score, first, class): each item's ``k`` best classes."""
    sc = classes.sparkSession.sparkContext
    shared = sc.broadcast((weights, Postings(block, {t: i for i, t in enumerate(vocabulary)})))
    names = ["item", "score", "first", "class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, postings = shared.value
        best = [np.zeros((0, 3), dtype=np.int64) for _ in range(postings.n_items)]     # score, first, class
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                numbers = np.stack([part.column(c).to_numpy() for c in ("first", "class")], axis=1)
                terms, tfs = ([x.values.to_numpy() for x in part.column(c)] for c in ("terms", "tfs"))
                scores = score_chunk(terms, tfs, part.column("m").to_numpy(), weights, postings)
                for i, row in enumerate(scores):
                    new = _best(row, numbers[:, 0], k)
                    if len(new):
                        both = np.concatenate([best[i], np.column_stack([row[new], numbers[new]])])
                        best[i] = both[_best(both[:, 0], both[:, 1], k)]
        table = np.concatenate([np.column_stack([np.full(len(b), i), b]) for i, b in enumerate(best)])
        yield pa.RecordBatch.from_arrays([pa.array(table[:, c].astype(np.int64)) for c in range(4)], names=names)

    found = classes.select("first", "class", "m", "terms", "tfs").mapInArrow(
        run, ", ".join(f"{c} long" for c in names))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "class")
    return found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")


def _expand(chosen: DataFrame, classes: DataFrame, bags: DataFrame, k: int) -> DataFrame:
    """(item, rank, id, score): members of the chosen classes, ``k`` an item."""
    vector = ["hash", "m", "terms", "tfs"]
    wanted = classes.join(chosen.select("class").distinct(), "class").select("class", *vector)
    # at most ``k`` keys of two numbers for each item of a block
    near = bags.join(F.broadcast(wanted.select("hash", "m").distinct()), ["hash", "m"], "left_semi")
    by_id = Window.partitionBy(*vector).orderBy(F.asc_nulls_last("id"))
    first = near.withColumn("_nth", F.row_number().over(by_id)).filter(F.col("_nth") <= k)
    members = first.join(wanted, vector).select("class", "id")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (chosen.join(members, "class").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("item", "rank", "id", "score"))


def _named(found: DataFrame, names: list, item: str, key: str, kinds: tuple) -> DataFrame:
    """Item numbers back to their ids."""
    spark = found.sparkSession
    ids = spark.createDataFrame([(i, x) for i, x in enumerate(names)], f"item long, _name {kinds[0]}")
    return found.join(F.broadcast(ids), "item").select(
        F.col("_name").alias(item), "rank", F.col("id").alias(key), "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
           k: int = 10) -> DataFrame:
    """(item, rank, key, score): each item's ``k`` highest-scoring documents
    with a score above 0, equal scores by ascending key."""
    spark: SparkSession = docs.sparkSession
    kinds = (items.schema[item].dataType.simpleString(), "bigint")
    out = None
    for block in item_blocks(items, item, text):
        vocabulary = sorted(set().union(*(found.keys() for _, found in block)))
        if not vocabulary:
            continue
        bags = _bags(docs, key, text, vocabulary)
        n_docs, length = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_docs:
            break
        m = F.expr(f"25 + (75 * n * {n_docs}L) div {length}L")
        bags = bags.withColumn("m", m).withColumn("hash", F.xxhash64("terms", "tfs"))
        classes = _classes(bags)
        weights = term_weights(classes, n_docs, len(vocabulary))
        chosen = _best_classes(classes, weights, block, vocabulary, k)
        chosen.write.parquet(path := scratch_dir(spark, "bag-best"))
        ranked = _named(_expand(spark.read.parquet(path), classes, bags, k), [i for i, _ in block], item, key, kinds)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], f"{item} {kinds[0]}, rank int, {key} bigint, score bigint")
    return out
