"""Toxicity scores by a counterfactual-regularised classifier (operator 5).

A text's features are the hashed words it holds and their beginnings, each
present or absent. A logistic model is fitted on labelled rows (a bounded
choice, ``TRAIN_ROWS``); of all hashed cells the ``FEATURES`` that tell the
labels apart best are used, besides those of the identity terms. For every
labelled sentence that names a group, the term is swapped for each other term
of its list, and the squared change of score is penalised; sentences without a
mention are given one ("... and <term> people"), so that a mention alone
cannot move a score either. Neutral mentions of groups therefore weigh nearly
nothing, while abusive words beside them keep their weight.

Defined cases: null and empty texts get the score of no features; without
labelled rows of both kinds every score is 0.5 less a little; a row labelled
twice is toxic if any label says so; a null id is held out (it has no label);
repeated rows are scored alike; columns beside the text pass through in struct
``doc``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keelson.llm import text as W

#: Bound on the labelled rows that the model is fitted on (smallest hash of the id first).
TRAIN_ROWS = 20_000
FEATURES = 4096
FOLDS = 5
RIDGE = 2e-4
#: A toxic row's weight in the loss; the others weigh 1.
TOXIC_WEIGHT = 3.0
COUNTERFACTUAL = 1.0
#: Bound on the swaps that one labelled row gives (its first ones).
SWAPS = 256
STEPS = 400
_BITS = 18
_CUTS = (4, 5, 6, 7, 8)
#: Group names that may stand for one another in a sentence.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("women", "men", "female", "male"),
    ("immigrant", "refugee", "citizen", "native"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("frauen", "männer", "muslime", "christen", "juden"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos"),
)
_TERMS = {t.encode(): [o.encode() for o in group if o != t] for group in IDENTITY for t in group}
_SENTENCE = re.compile(rb"[^.!?\n]+")
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def held_out(id_col: Column, folds: int = FOLDS) -> Column:
    """True for the rows that are never learned from: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")), F.lit(0)) % folds == 0


def _cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, cell) of every word and word beginning, repeats included."""
    words = W.find_words([x.lower() for x in texts], W.LETTERS)
    owner = words.of_text()
    h = words.prefix_hashes(_CUTS)
    cells = np.concatenate([x + W.U64(k << 40) for k, x in enumerate(h)])  # a word and a beginning differ
    return np.tile(owner, len(h)), (W.mixed(cells) >> W.U64(64 - _BITS)).astype(np.int64)


def _present(owner: np.ndarray, cells: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(owner * width + cells)
    return pairs // width, pairs % width


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) rows to one (cell, texts, toxic texts) row for each cell seen."""
    n, bad = np.zeros(1 << _BITS, dtype=np.int64), np.zeros(1 << _BITS, dtype=np.int64)
    for batch in batches:
        toxic = np.array(batch.column(0).to_pylist(), dtype=np.int64)
        texts = W.text_bytes(batch.column(1))
        for a, b in W.pieces(texts):
            owner, cells = _present(*_cells(texts[a:b]), 1 << _BITS)
            n += np.bincount(cells, minlength=1 << _BITS)
            bad += np.bincount(cells[toxic[a:b][owner] == 1], minlength=1 << _BITS)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(bad[at])], names=["cell", "n", "bad"])


def swapped(text: bytes) -> list[tuple[bytes, bytes]]:
    """(sentence, sentence with one term swapped) for every mention in a text;
    for a text without one, (first sentence, the same with a mention)."""
    out = []
    for m in _SENTENCE.finditer(text.lower()):
        for w in _WORD.finditer(m[0]):
            for other in _TERMS.get(w[0], ()):
                out.append((m[0], m[0][:w.start()] + other + m[0][w.end():]))
    first = _SENTENCE.search(text.lower())
    if first and not out:
        terms = sorted(_TERMS)
        out.append((first[0], first[0] + b" and " + terms[len(text) % len(terms)] + b" people"))
    return out


def swap_changes(text: bytes, known: Callable[[bytes], list[int]], most: int = SWAPS) -> tuple[list, list]:
    """Features that each swap of :func:`swapped` adds and takes away, for the
    first ``most`` swaps. ``known`` gives a text's features, repeats included; the two
    sides differ in one word, so a sentence is looked up once whatever it mentions."""
    gained, lost = [], []
    for m in _SENTENCE.finditer(low := text.lower()):
        held = None
        for w in _WORD.finditer(m[0]):
            if w[0] in _TERMS:
                held = Counter(known(m[0])) if held is None else held
                own = Counter(known(w[0]))
            for other in _TERMS.get(w[0], ()):
                if len(gained) == most:
                    return gained, lost
                new = set(known(other))
                gained.append(sorted(new - held.keys()))
                lost.append(sorted(c for c, n in own.items() if held[c] == n and c not in new))
    first = _SENTENCE.search(low)
    if first and not gained:
        terms = sorted(_TERMS)
        more = known(b"and " + terms[len(text) % len(terms)] + b" people")
        gained.append(sorted(set(more) - set(known(first[0]))))
        lost.append([])
    return gained, lost


def _rows(chosen, most: int):
    """(toxic, text) rows to their chosen features, and those that swaps add and take away."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = chosen.value
        width = int(number.max()) + 2

        def features(texts: list[bytes]) -> list[np.ndarray]:
            owner, cells = _cells(texts)
            known = number[cells] >= 0
            owner, at = _present(owner[known], number[cells[known]], width)
            return np.split(at, np.searchsorted(owner, np.arange(1, len(texts))))

        def look_up(text: bytes) -> list[int]:
            at = number[_cells([text])[1]]
            return at[at >= 0].tolist()

        of_term = {t: look_up(t) for t in _TERMS}
        known = lambda text: of_term[text] if text in of_term else look_up(text)
        for batch in batches:
            texts = W.text_bytes(batch.column(1))
            found, gained, lost = [], [], []
            for a, b in W.pieces(texts):
                found += [x.tolist() for x in features(texts[a:b])]
                for text in texts[a:b]:
                    more, less = swap_changes(text, known, most)
                    gained.append(more)
                    lost.append(less)
            kind = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), pa.array(gained, kind), pa.array(lost, kind)],
                names=["toxic", "features", "gained", "lost"])
    return rows


@dataclass
class Model:
    number: np.ndarray
    weights: np.ndarray
    start: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        owner, cells = _cells(texts)
        at = self.number[cells]
        owner, at = _present(owner[at >= 0], at[at >= 0], len(self.weights) + 1)
        logit = self.start + np.bincount(owner, weights=self.weights[at], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    values = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists if len(x)] or [np.zeros(0, np.int64)])
    return np.repeat(np.arange(len(lists)), sizes), values


def fit_weights(toxic: np.ndarray, features: list, gained: list, lost: list, width: int, ridge: float = RIDGE,
                counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Minimise log loss + ridge + mean squared score change over the swaps (Adam, all rows each step)."""
    row, at = _flat(features)
    up, up_at = _flat(gained)
    down, down_at = _flat(lost)
    pairs = max(len(gained), 1)
    share = np.clip(toxic.mean(), 1e-3, 1 - 1e-3)
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, weights=w[at], minlength=len(toxic)), -30, 30)))
        miss = (p - toxic) * np.where(toxic > 0, TOXIC_WEIGHT, 1.0) / len(toxic)
        g = np.bincount(at, weights=miss[row], minlength=width) + 2 * ridge * w
        change = (np.bincount(up, weights=w[up_at], minlength=pairs) - np.bincount(down, weights=w[down_at], minlength=pairs)) / pairs
        g += 2 * counterfactual * (np.bincount(up_at, weights=change[up], minlength=width)
                                   - np.bincount(down_at, weights=change[down], minlength=width))
        g = np.append(g, miss.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-10)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _gain(n: np.ndarray, bad: np.ndarray, rows: int, toxic: int) -> np.ndarray:
    """Likelihood-ratio statistic of a cell's presence against the label."""
    def term(seen, a, b):
        expected = a * b / max(rows, 1)
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0)
    return (term(bad, n, toxic) + term(n - bad, n, rows - toxic)
            + term(toxic - bad, rows - n, toxic) + term(rows - n - toxic + bad, rows - n, rows - toxic))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train_rows: int = TRAIN_ROWS, swaps: int = SWAPS, **options) -> Model:
    """A model of the labelled rows that are not held out, ``train_rows`` of them with ``swaps`` swaps each at most."""
    spark = docs.sparkSession
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).where("id is not null and toxic is not null")
            .where(~held_out(F.col("id"))).join(docs.select(F.col(id_col).alias("id")), "id", "left_semi").groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("id"), "id").limit(train_rows))
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(rows), "id").select("toxic", "text")
    counts = (chosen.mapInArrow(_counts, "cell bigint, n bigint, bad bigint")
              .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).toPandas())
    total = chosen.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    n, bad = counts["n"].to_numpy(), counts["bad"].to_numpy()
    gain = np.where(n >= 3, _gain(n, bad, total["n"], total["bad"]), -1)
    order = np.lexsort((counts["cell"].to_numpy(), -gain))
    best = counts["cell"].to_numpy()[order[:FEATURES]][gain[order[:FEATURES]] > 0]
    terms = np.unique(_cells(sorted(_TERMS))[1])
    cells = np.union1d(best, terms).astype(np.int64)
    number = np.full(1 << _BITS, -1, dtype=np.int64)
    number[cells] = np.arange(len(cells))
    sample = chosen.mapInArrow(_rows(spark.sparkContext.broadcast(number), swaps),
                               "toxic int, features array<int>, gained array<array<int>>, lost array<array<int>>").collect()
    if not sample:
        return Model(number, np.zeros(len(cells)), -0.1)
    sample.sort(key=lambda r: (r["toxic"], r["features"]))
    weights, start = fit_weights(np.array([r["toxic"] for r in sample], dtype=float), [r["features"] for r in sample],
                                 [x for r in sample for x in r["gained"]], [x for r in sample for x in r["lost"]],
                                 len(cells), **options)
    return Model(number, weights, start)


def _scorer(model, text_at: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.text_bytes(batch.column(text_at))
            found = [model.value.scores(texts[a:b]) for a, b in W.pieces(texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate([*found, np.zeros(0)]), pa.float64())],
                names=[*batch.schema.names, "score"])
    return score


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None,
          **options) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with ``held_out``, ``score`` and ``predicted``."""
    model = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels, id_col, text_col, **options))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    doc = F.struct(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
    return plain.mapInArrow(_scorer(model, docs.columns.index(text_col)), f"{schema}, score double").select(
        doc.alias("doc"), held_out(F.col(names[docs.columns.index(id_col)])).alias("held_out"),
        F.round("score", 6).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
