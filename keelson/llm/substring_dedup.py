"""Substring dedup by suffix automata of reference shards (operator 6).

A window is ``window`` consecutive words of one text. A word goes if a window
over it also starts earlier: in a document of smaller id, or earlier in the
same one. The reference of a corpus is the corpus itself, which no broadcast
can hold, so its repeated parts are found first and dealt into shards:

0. Of equal texts the earliest document stands for all; the words of the others
   go, if they fill a window.
1. Every window names an anchor, the run of ``GRAM`` words in it with the
   smallest hash; equal windows name equal anchors. A window whose anchor occurs
   in one text only, and there once, has no twin.
2. Around each repeated anchor a text yields a context: the words of all its
   windows that name this anchor. Equal contexts are merged, keeping the
   earliest; all words of the later ones go.
3. Different contexts of one anchor go to one shard. Each shard's task builds a
   suffix automaton of its contexts, earliest first, and streams them through
   it: where the match reaches a whole window that an earlier context holds,
   the window goes. A window's contexts all share its anchor, so no other
   shard can hold its twin.
4. An anchor with over ``MOST_CONTEXTS`` different contexts (a common phrase at
   the border of many texts) is not put in one shard: its windows are grouped
   by their words, and all but the earliest go.

``remove_reference`` applies the automata to a given reference instead, whose
shards of ``shard_words`` words are broadcast one after another.

Defined cases: null and empty texts have no words and none removed; rows of
equal id are ordered by their texts' digests, and rows equal in both are one
document, treated alike; a null id comes after all others; texts of fewer
words than a window keep them all; an empty table gives an empty result;
columns beside the text pass through in struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keelson.llm import text as W
from keelson.llm.automaton import SuffixAutomaton
from keelson.session import scratch_dir

WINDOW = 20
GRAM = 6
MOST_CONTEXTS = 3000
#: Words of one automaton (it has at most two states a word).
SHARD_WORDS = 60_000
_LAST = (1 << 63) - 1
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: End of a span over a whole text.
_WHOLE = (1 << 31) - 1


def _anchors(words: W.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor: its hash, its text, and the first and last window that name it."""
    grams = W.window_hashes(words.hashes(), gram)
    ok = W.inside(words, window)
    none = np.zeros(0, dtype=np.int64)
    if not ok.any():
        return none.astype(W.U64), none, none, none
    n, width = len(ok), window - gram + 1
    least = grams[:n].copy()
    for j in range(1, width):
        np.minimum(least, grams[j:n + j], out=least)
    at = np.zeros(n, dtype=np.int64)
    for j in range(width - 1, -1, -1):  # the leftmost of equal ones stays
        at[grams[j:n + j] == least] = j
    starts = np.flatnonzero(ok)
    at = at[starts] + starts
    owner = words.of_text()[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(starts)]]) - 1
    return grams[at[begin]], owner[begin], starts[begin], starts[end]


def _anchor_rows(window: int, gram: int):
    """(digest, text) rows to (anchor, digest, n): how often a text holds an anchor."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column(0).to_numpy()
            texts = W.text_bytes(batch.column(1))
            for a, b in W.pieces(texts):
                hashes, owner, _, _ = _anchors(W.find_words(texts[a:b], W.SPACED), window, gram)
                order = np.lexsort((hashes, owner))
                h, o = hashes[order], owner[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]) if len(h) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(digests[a:b][o[at]]),
                     pa.array(np.diff(np.concatenate([at, [len(h)]])).astype(np.int32))], names=["anchor", "digest", "n"])
    return rows


def _context_rows(window: int, gram: int):
    """(ord, digest, text, anchors) rows to the contexts of the listed anchors."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, digests = (batch.column(k).to_numpy() for k in (0, 1))
            texts = W.text_bytes(batch.column(2))
            listed = batch.column(3)
            for a, b in W.pieces(texts):
                words = W.find_words(texts[a:b], W.SPACED)
                hashes, owner, lo, hi = _anchors(words, window, gram)
                bounds = np.searchsorted(owner, np.arange(b - a + 1))
                chosen, contexts = [], []
                for i in range(b - a):
                    own = hashes[bounds[i]:bounds[i + 1]].view(np.int64)
                    at = np.flatnonzero(np.isin(own, listed[a + i].values.to_numpy())) + bounds[i]
                    first, last = words.first[i], words.first[i + 1]
                    # the text with one space between its words, and where each word begins in it
                    joined = b" ".join(texts[a + i].split())
                    begin = np.concatenate([[0], np.cumsum(words.ends[first:last] - words.starts[first:last] + 1)])
                    contexts += [joined[s:e] for s, e in zip(begin[lo[at] - first].tolist(),
                                                             (begin[hi[at] + window - first] - 1).tolist())]
                    chosen.append(at)
                at = np.concatenate([*chosen, np.zeros(0, dtype=np.int64)]).astype(np.int64)
                text = owner[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at].view(np.int64)), pa.array(ords[a:b][text]), pa.array(digests[a:b][text]),
                     pa.array((lo[at] - words.first[text]).astype(np.int32)), pa.array((hi[at] + window - lo[at]).astype(np.int32)),
                     pa.array(contexts, pa.binary())],
                    names=["anchor", "ord", "digest", "start", "size", "context"])
    return rows


_CONTEXT = "anchor bigint, ord bigint, digest bigint, start int, size int, context binary"


def _shard_spans(window: int, shard_words: int):
    """Contexts sorted by anchor and age to the windows that an earlier one holds."""
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        rivals: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rivals and row[0] != rivals[0][0]:  # an anchor's contexts stay together
                    if len(rivals) > 1:  # one alone has no twin
                        shard += rivals
                        size += sum(c[4].count(b" ") + 1 for c in rivals)
                    rivals = []
                    if size >= shard_words:
                        yield _searched(shard, window)
                        shard, size = [], 0
                rivals.append(row)
        yield _searched(shard + (rivals if len(rivals) > 1 else []), window)
    return spans


def _searched(contexts: list[tuple], window: int) -> pa.RecordBatch:
    automaton = SuffixAutomaton()
    texts = [c[4].split(b" ") for c in contexts]
    for words in texts:
        automaton.add(words)
    out = []
    for number, (c, words) in enumerate(zip(contexts, texts)):
        held = [k for k, (length, first) in enumerate(automaton.matches(words, window)) if length == window and first < number]
        if held:
            starts = np.array(held, dtype=np.int64) - window + 1
            out += [(c[1], c[2], c[3] + s, c[3] + e) for s, e in W.runs(W.covered(len(words), starts, window))]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
        names=["ord", "digest", "start", "end"])


_SPAN = "ord bigint, digest bigint, start int, end int"


def repeated_spans(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, most_contexts: int = MOST_CONTEXTS,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """Word spans (ord, digest, start, end) that go; ``rows`` has (ord, digest, text)."""
    keyed = rows.select("ord", "digest", F.xxhash64(F.lit(1), "text").alias("digest2"), "text")
    firsts = keyed.groupBy("digest", "digest2").agg(F.min("ord").alias("first"))
    copies = (keyed.select("ord", "digest", "digest2").join(firsts, ["digest", "digest2"]).where("ord <> first")
              .select("ord", "digest", F.lit(0).alias("start"), F.lit(_WHOLE).alias("end")))
    # equal texts have one digest, so copies alone do not make an anchor repeated
    anchors = keyed.select("digest", "text").mapInArrow(_anchor_rows(window, gram), "anchor bigint, digest bigint, n int")
    often = (anchors.groupBy("anchor").agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.max("n").alias("n"))
             .where("a <> b or n > 1").select("anchor"))
    listed = (anchors.select("anchor", "digest").join(often, "anchor", "left_semi")
              .groupBy("digest").agg(F.collect_set("anchor").alias("anchors")))
    listed = firsts.join(listed, "digest").withColumnRenamed("first", "ord")
    texts = keyed.join(listed, ["ord", "digest", "digest2"])
    contexts = (texts.select("ord", "digest", "text", "anchors").mapInArrow(_context_rows(window, gram), _CONTEXT))
    # equal contexts have equal anchors, so 128 bits of the words are the key
    key = [F.xxhash64("context").alias("h1"), F.xxhash64(F.lit(1), "context").alias("h2")]
    contexts = _written(contexts.select("*", *key), "contexts")

    first = F.min(F.struct("ord", "digest", "start")).alias("first")
    distinct = _written(contexts.groupBy("anchor", "h1", "h2", "context").agg(first, F.count(F.lit(1)).alias("copies"))
                        .select("anchor", "h1", "h2", "context", "copies", "first.*"), "distinct-contexts")
    earliest = distinct.where("copies > 1").select("h1", "h2", *(F.col(c).alias(f"first_{c}") for c in ("ord", "digest", "start")))
    later = (contexts.select("h1", "h2", "ord", "digest", "start", "size").join(earliest, ["h1", "h2"])
             .where("ord <> first_ord or digest <> first_digest or start <> first_start")
             .select("ord", "digest", "start", (F.col("start") + F.col("size")).alias("end")))

    # the few anchors with too many contexts for a shard; all others go there by their anchor
    crowded = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_contexts).select("anchor")
    shards = (distinct.join(crowded, "anchor", "left_anti")
              .select("anchor", "ord", "digest", "start", "context")
              .repartition("anchor").sortWithinPartitions("anchor", "ord", "digest", "start")
              .mapInArrow(_shard_spans(window, shard_words), _SPAN))

    words = F.split(F.col("context").cast("string"), " ")
    place = F.struct("ord", "digest", "start")
    common = (distinct.join(crowded, "anchor", "left_semi").select("ord", "digest", "start", words.alias("words"))
              .select("ord", "digest", "start", "words", F.explode(F.expr(f"sequence(0, size(words) - {window})")).alias("k"))
              .select("ord", "digest", (F.col("start") + F.col("k")).alias("start"),
                      F.array_join(F.slice("words", F.col("k") + 1, window), " ").alias("w"))
              .select(F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"), place.alias("own")))
    earliest = common.groupBy("h1", "h2").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    common = (common.join(earliest, ["h1", "h2"]).where("own <> first")
              .select("own.ord", "own.digest", "own.start", (F.col("own.start") + window).alias("end")))
    return _written(copies.unionByName(later).unionByName(shards).unionByName(common), "spans")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder. The shuffle files it was made
    from are dropped when it is written, so they do not pile up step by step."""
    spark = df.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path := scratch_dir(spark, name))
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.parquet(path)


def _removed(text_at: int, window: int):
    """Rows with (spans) last to (n_words, spans merged, kept words)."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            n_words, merged, kept = [], [], []
            for raw, spans in zip(W.text_bytes(batch.column(text_at)), batch.column(batch.num_columns - 1).to_pylist()):
                words = raw.split()  # bytes: the white space \x20 \x09-\x0D
                runs = []
                if spans and len(words) >= window:  # a copy of fewer words has no window
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(step, [x["start"] for x in spans], 1)
                    np.add.at(step, [min(x["end"], len(words)) for x in spans], -1)
                    runs = W.runs(np.cumsum(step[:-1]) > 0)
                n_words.append(len(words))
                merged.append([{"start": s, "end": e} for s, e in runs])
                for s, e in reversed(runs):
                    del words[s:e]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(merged, kind), pa.array(kept, pa.string())],
                names=[*batch.schema.names[:-1], "n_words", "spans", "kept"])
    return remove


def _with_spans(docs: DataFrame, spanned: DataFrame, names: list[str], text_at: int, window: int) -> DataFrame:
    """``spanned`` (columns ``names``, then spans) to struct ``doc`` and what is removed and kept."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spanned.schema.fields[:-1])
    doc = F.struct(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
    return spanned.mapInArrow(
        _removed(text_at, window), f"{schema}, n_words bigint, spans array<struct<start:int,end:int>>, kept string").select(
        doc.alias("doc"), "n_words", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        "spans", "kept")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with ``n_words``, ``n_removed``,
    ``spans`` (maximal removed runs of words, end exclusive) and ``kept`` (the
    other words, joined by one space)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    rows = docs.toDF(*names).withColumns({"ord": F.coalesce(F.col(names[id_at]).cast("long"), F.lit(_LAST)),
                                          "digest": F.xxhash64(names[text_at])})
    spans = repeated_spans(rows.select("ord", "digest", F.col(names[text_at]).alias("text")), **options)
    spans = spans.groupBy("ord", "digest").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return _with_spans(docs, rows.join(spans, ["ord", "digest"], "left").select(*names, "spans"), names, text_at,
                       options.get("window", WINDOW))


def _reference_spans(shard, text_at: int, window: int):
    """Adds the windows that the broadcast automaton holds to the last column."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        automaton = SuffixAutomaton()
        for text in shard.value:
            automaton.add(text.encode().split())
        for batch in batches:
            spans = batch.column(batch.num_columns - 1).to_pylist()
            for i, raw in enumerate(W.text_bytes(batch.column(text_at))):
                words = raw.split()
                held = [k for k, (n, _) in enumerate(automaton.matches(words, window)) if n == window]
                if held:
                    cover = W.covered(len(words), np.array(held) - window + 1, window)
                    spans[i] = spans[i] + [{"start": s, "end": e} for s, e in W.runs(cover)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, kind)], names=batch.schema.names)
    return search


def remove_reference(docs: DataFrame, reference: DataFrame, text_col: str = "text", reference_text: str = "text",
                     window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Like ``dedup_substrings``, for windows that occur in ``reference``: its
    texts are dealt into shards of about ``shard_words`` words, and each
    shard's texts are broadcast in turn, a scan of the documents each. A text
    longer than a shard is cut into parts that overlap by a window less a word."""
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.coalesce(reference_text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    parts = (reference.select(words.alias("w")).where(F.size("w") >= window)
             .select("w", F.explode(F.expr(f"sequence(1, size(w) - {window - 1}, {shard_words})")).alias("k"))
             .select(F.array_join(F.expr(f"slice(w, k, {shard_words + window - 1})"), " ").alias("part")).distinct())
    parts.write.parquet(path := scratch_dir(spark, "reference"))
    parts = spark.read.parquet(path)
    total = parts.agg(F.coalesce(F.sum(F.size(F.split("part", " "))), F.lit(0))).first()[0]
    shards = -(-total // shard_words)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text_at = docs.columns.index(text_col)
    kind = "array<struct<start:int,end:int>>"
    out = docs.toDF(*names).withColumn("spans", F.expr(f"cast(array() as {kind})"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    for k in range(shards):
        texts = [r["part"] for r in parts.where(F.pmod(F.xxhash64("part"), F.lit(shards)) == k).sort("part").collect()]
        out = out.mapInArrow(_reference_spans(spark.sparkContext.broadcast(texts), text_at, window), schema)
        if k < shards - 1:  # one automaton at a time in a task
            out.write.parquet(path := scratch_dir(spark, "spans"))
            out = spark.read.parquet(path)
    return _with_spans(docs, out, names, text_at, window)
