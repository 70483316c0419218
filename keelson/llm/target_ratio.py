"""Quality rules (operator 10).

Words and word pairs are hashed into ``BUCKETS`` cells. Two multinomials are
estimated over the cells: the raw corpus (every document) and the trusted
target (the documents labelled good, all of them), the latter smoothed towards
the former. A document's score is the mean log-likelihood
ratio of its n-grams, target against raw, so length does not enter. The target
is fitted on one half of the trusted documents, and the threshold lies below
nearly all scores of the other half, which the fit has not seen; every document
is then compared with it, and the plain counting rules are applied besides.

Defined cases: a null or empty text has no words and fails the base rules;
without a trusted document the ratio is zero everywhere and only the base
rules decide; repeated rows and ids are judged each by its text; columns
beside the text pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keelson.llm import text as W

BUCKETS = 1 << 16
#: Up to so many trusted ids are broadcast to the documents; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Up to so many scores are looked at one by one for a quantile; more are counted in finer bins first.
FEW_SCORES = 10_000
#: Share of the unseen trusted documents below the quantile that the threshold starts from,
#: and how much further down it lies, as a share of the way from their median to the quantile.
BELOW = 0.002
SLACK = 0.25
#: Weight of the raw corpus in the target, in n-grams.
PRIOR = BUCKETS
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_REPEAT = 8
_SEEN = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, ratio double"


def _cells(h: np.ndarray, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Cell and text of every word and of every pair of neighbours."""
    owner = words.of_text()
    same = W.inside(words, 2)
    cells = np.concatenate([h, W.window_hashes(h, 2)[same]]) >> W.U64(48)
    return cells.astype(np.int64), np.concatenate([owner, owner[:len(same)][same]])


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(trusted, text) rows to one (cell, raw, target) row for each cell seen."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        trusted = np.array(batch.column(0).to_pylist(), dtype=bool)
        texts = W.text_bytes(batch.column(1))
        for a, b in W.pieces(texts):
            words = W.find_words(texts[a:b], W.SPACED)
            cells, owner = _cells(words.hashes(), words)
            raw += np.bincount(cells, minlength=BUCKETS)
            target += np.bincount(cells[trusted[a:b][owner]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])],
                                     names=["cell", "raw", "target"])


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", good: str = "quality = 1",
                rows: int | None = None) -> DataFrame:
    """All ids labelled good, each once. Only a caller who names a number of
    ``rows`` gets fewer: those with the smallest hash, so the choice does not
    depend on order or partitions."""
    ids = labels.where(good).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    return ids if rows is None else ids.orderBy(F.xxhash64("id"), "id").limit(rows)


def _to_join(ids: DataFrame) -> DataFrame:
    """``ids`` as the small side of a join with the documents: few enough are broadcast."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """log(target / raw) of each cell: raw counts smoothed by one a cell, target
    counts by ``PRIOR`` n-grams of the raw corpus."""
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        _to_join(trusted.select("id", F.lit(True).alias("trusted"))), "id", "left").select(
        F.coalesce("trusted", F.lit(False)).alias("trusted"), "text")
    counts = (marked.mapInArrow(_histogram, "cell bigint, raw bigint, target bigint")
              .groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    cells = counts["cell"].to_numpy()
    raw[cells], target[cells] = counts["raw"].to_numpy(), counts["target"].to_numpy()
    if target.sum() == 0:
        return np.zeros(BUCKETS)
    raw = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((target + PRIOR * raw) / (target.sum() + PRIOR)) - np.log(raw)


def _judge(table, text_at: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = table.value
        for batch in batches:
            texts = W.text_bytes(batch.column(text_at))
            out: list[list] = [[] for _ in range(6)]
            for a, b in W.pieces(texts):
                words = W.find_words(texts[a:b], W.SPACED)
                h = words.hashes()
                n = np.diff(words.first)
                cells, owner = _cells(h, words)
                total = np.bincount(owner, weights=ratios[cells], minlength=b - a)
                grams = np.bincount(owner, minlength=b - a)
                buf = np.frombuffer(words.data, dtype=np.uint8)
                # a code point begins at every byte but 10xxxxxx
                points = _counted((buf & 0xC0 != 0x80) & W.SPACED[buf], words.offsets)
                symbols = _counted(_SYMBOLS[buf], words.offsets)
                again = _repeated(words, h)
                for column, x in zip(out, (n, points, symbols, None, again, total / np.maximum(grams, 1))):
                    column += [_dup_lines(t) for t in texts[a:b]] if x is None else x.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in out[:5]), pa.array(out[5], pa.float64())],
                names=[*batch.schema.names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"])
    return judge


def _counted(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:] - 1] - total[offsets[:-1]]


def _dup_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def _repeated(words: W.Words, h: np.ndarray) -> np.ndarray:
    """For each text, its words in windows that occur twice or more in it."""
    out = np.zeros(len(words.first) - 1, dtype=np.int64)
    grams = W.window_hashes(h, _REPEAT)
    if not len(grams):
        return out
    owner = words.of_text()
    at = np.flatnonzero(W.inside(words, _REPEAT))
    keys = W.mixed(grams[at] ^ (owner[at].astype(W.U64) * W.U64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys, kind="stable")
    twin = keys[order][1:] == keys[order][:-1]
    maybe = np.zeros(len(at), dtype=bool)
    maybe[order[1:][twin]] = True
    maybe[order[:-1][twin]] = True
    seen: dict[tuple[int, bytes], list[int]] = {}
    for i in at[maybe].tolist():  # equal hashes only propose: the words decide
        seen.setdefault((int(owner[i]), words.joined(i, i + _REPEAT)), []).append(i)
    starts = np.array(sorted(i for x in seen.values() if len(x) > 1 for i in x), dtype=np.int64)
    if len(starts):
        out += np.bincount(owner[W.covered(len(h), starts, _REPEAT)], minlength=len(out))
    return out


def base_failed():
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    good: str = "quality = 1", trusted_rows: int | None = None, below: float = BELOW) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with its counts, ``ratio`` (mean
    log-likelihood ratio), ``base_failed`` and ``kept``.

    ``good`` is a condition on the labels. ``labels`` may repeat ids or lack
    them; ids that no document has are ignored. All trusted documents count,
    one half for the target and the other for the threshold, unless
    ``trusted_rows`` bounds them."""
    spark = docs.sparkSession
    # labels of other documents would use up a caller's choice
    trusted = trusted_ids(labels.join(docs.select(F.col(id_col)), id_col, "left_semi"), id_col, good, trusted_rows).persist()
    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2))
    table = spark.sparkContext.broadcast(log_ratios(docs, trusted.where(half == 0), id_col, text_col))
    at = docs.columns.index(text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    least = _threshold(plain.join(_to_join(trusted.where(half == 1)), F.col(names[docs.columns.index(id_col)]) == F.col("id"), "left_semi")
                       .mapInArrow(_judge(table, at), f"{schema}, {_SEEN}"), below)
    trusted.unpersist()
    doc = F.struct(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
    return (plain.mapInArrow(_judge(table, at), f"{schema}, {_SEEN}")
            .select(doc.alias("doc"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    F.round("ratio", 6).alias("ratio"))
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= F.lit(least))))


def _threshold(trusted: DataFrame, below: float) -> float:
    """From the ratios of the trusted documents that pass the base rules."""
    scores = trusted.where(~base_failed()).select("ratio").persist()
    found = quantiles(scores, "ratio", [below, 0.5])
    scores.unpersist()
    if found is None:
        return -1e9
    low, middle = found
    return round(low - SLACK * (middle - low), 6) - 1e-6


def quantiles(rows: DataFrame, col: str, shares: list[float]) -> list[float] | None:
    """The exact quantiles of ``col``, as SQL's ``percentile`` interpolates them;
    None without rows. ``rows`` is read a few times: persist it."""
    n = rows.where(F.col(col).isNotNull()).count()
    if not n:
        return None
    at = [share * (n - 1) for share in shares]
    value = {k: _at_rank(rows, col, k) for k in sorted({int(f(x)) for x in at for f in (np.floor, np.ceil)})}
    low, high = ([value[int(f(x))] for x in at] for f in (np.floor, np.ceil))
    return [a if x == int(x) else (np.ceil(x) - x) * a + (x - np.floor(x)) * b for x, a, b in zip(at, low, high)]


def _at_rank(rows: DataFrame, col: str, rank: int) -> float:
    """The value of rank ``rank`` (from 0). Values are counted in a thousand bins
    between the least and the greatest, then those of the bin that holds the rank
    likewise, until few are left to sort or all are equal; nothing is gathered but
    counts and these few."""
    rows = rows.where(F.col(col).isNotNull())
    while True:
        n, least, most = rows.agg(F.count(col), F.min(col), F.max(col)).first()
        if least == most:
            return least
        if n <= FEW_SCORES:
            return sorted(r[0] for r in rows.select(col).collect())[rank]
        # the same bins however the rows lie; the last one is closed
        bin_of = F.least(F.floor((F.col(col) - F.lit(least)) / F.lit(most - least) * 1000), F.lit(999))
        for k, held in sorted(tuple(r) for r in rows.groupBy(bin_of.alias("bin")).count().collect()):
            if rank < held:
                break
            rank -= held
        rows = rows.where(bin_of == k)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass."""
    return score_documents(docs, labels, **options).where("kept").select("doc.*")
