"""Secret scans by grammar inference (operator 3).

Three listed patterns find credentials of known kinds (the base). Their
matches label strings by kind; from a bounded choice of them, one probabilistic
automaton per kind is inferred over character classes (``grammar``). Every
candidate of every text is then scored by its mean log-likelihood under a
kind's automaton, and added as kind ``grammar`` where it is as likely as nearly
all labelled credentials of that kind and likelier than by the plain class
frequencies of candidates that no pattern finds, those with a digit and those
without apart. (Those may hold unlabelled credentials, so their structure is
not learned, only their mix of characters.)

A candidate is what an assignment may label: a run of 6 or more credential
characters, dots among them, with or without a digit. A run that is not
accepted whole is tried without the signs at its ends (a full stop), then by
its pieces between dots.

Base spans are never changed; a candidate that overlaps one is not added.
Spans count code points, end exclusive, and cover a pattern's whole match.

Defined cases: a null or empty text has no spans; without labelled strings
nothing is added; equal credentials count once for the model; repeated rows are
scanned each; columns beside the text pass through in struct ``doc``.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keelson.llm.grammar import UNSEEN, Automaton, infer

KINDS = ("assign", "access", "hex")
ADDED = "grammar"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24}")
#: Least characters of an assigned value, hence of a candidate.
LEAST = 6
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
_SIGNS = "+/_.=-"
_DIGIT = re.compile(r"[0-9]")
#: Distinct strings of each kind, and ordinary ones, that the automata are inferred from (smallest hash first).
PER_KIND = 1500
#: Characters of each kind that inference takes at most: strings of any length, until these are reached.
SYMBOLS = 128 * PER_KIND
#: Distinct strings whose verdict a task remembers, and the longest of them.
REMEMBERED, REMEMBERED_SIZE = 1 << 16, 64
#: Share of a kind's labelled strings that may score below its threshold.
BELOW = 0.02
MARGIN = 0.25
#: Character classes: digits, lower case a-f and beyond, upper case A-F and beyond; signs stand for themselves.
_CLASSES = str.maketrans({c: k for k, cs in {"0": "0123456789", "a": "abcdef", "g": "ghijklmnopqrstuvwxyz",
                                             "A": "ABCDEF", "G": "GHIJKLMNOPQRSTUVWXYZ"}.items() for c in cs})
_ALPHABET = "0agAG+/_.=-"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place, end, credential) of the listed patterns, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    at = _LONG_HEX.search(text)
    while at:  # a run of 24 or more is a whole match: matches are maximal runs
        m = _HEX.match(text, at.start())
        found.append((m.start(), 2, m.end(), m[0]))
        at = _LONG_HEX.search(text, m.end())
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, string) of the runs that no base span touches; ``taken``
    ascends by start, so both lists are walked once."""
    touched: list[list[int]] = []
    for start, _, end, _ in taken:
        if touched and start < touched[-1][1]:
            touched[-1][1] = max(touched[-1][1], end)
        else:
            touched.append([start, end])
    k = 0
    for m in _CANDIDATE.finditer(text):
        while k < len(touched) and touched[k][1] <= m.start():
            k += 1
        if k == len(touched) or m.end() <= touched[k][0]:
            yield m.start(), m.end(), m[0]


def accepted(start: int, string: str, accepts: Callable[[str], bool]) -> Iterator[tuple[int, int]]:
    """(start, end) of the candidate that begins at ``start``, or of what of it is accepted."""
    if accepts(string):
        yield start, start + len(string)
        return
    bare = string.strip(_SIGNS)
    start += string.find(bare)
    if len(bare) < LEAST:
        return
    if bare != string and accepts(bare):
        yield start, start + len(bare)
    elif "." in bare:
        for piece in bare.split("."):
            if len(piece) >= LEAST and accepts(piece):
                yield start, start + len(piece)
            start += len(piece) + 1


def _ordinary(string: str) -> str:
    return "digit" if _DIGIT.search(string) else "plain"


def _place(string: str) -> int:
    """Seedless hash that the choice of strings goes by."""
    return int.from_bytes(hashlib.blake2b(string.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1


def _first(strings: set[tuple[int, str]], per_kind: int, symbols: int) -> set[tuple[int, str]]:
    """Those of smallest hash: ``per_kind`` at most, and no more once they hold ``symbols``
    characters. What is left out of a part's choice would be left out of the whole one's too."""
    out, held = set(), 0
    for place, x in heapq.nsmallest(per_kind, strings):
        if held >= symbols:
            break
        out.add((place, x))
        held += len(x)
    return out


_CHOSEN_SQL = "kind string, place bigint, string string"


def _chosen(found: dict[str, set[tuple[int, str]]]) -> pa.RecordBatch:
    rows = [(kind, place, x) for kind in sorted(found) for place, x in sorted(found[kind])]
    kinds, places, strings = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(places, pa.int64()),
                                       pa.array(strings, pa.string())], names=["kind", "place", "string"])


def _labelled(per_kind: int, symbols: int):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, set[tuple[int, str]]] = {}
        for batch in batches:
            rows: set[tuple[str, str]] = set()
            for text in batch.column(0).to_pylist():
                if text:
                    base = base_spans(text)
                    rows.update((KINDS[k], x[:symbols]) for _, k, _, x in base)
                    rows.update(("", x) for _, _, x in candidates(text, base))
            for kind, x in rows:
                found.setdefault(kind or _ordinary(x), set()).add((_place(x), x[:symbols]))
            found = {k: _first(v, per_kind, symbols) for k, v in found.items()}
        yield _chosen(found)
    return label


def _merged(per_kind: int, symbols: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, set[tuple[int, str]]] = {}
        for batch in batches:
            for kind, place, x in zip(*(c.to_pylist() for c in batch.columns)):
                found.setdefault(kind, set()).add((place, x))
            found = {k: _first(v, per_kind, symbols) for k, v in found.items()}
        yield _chosen(found)
    return merge


class Formats:
    """The automata, and for each kind the least likelihood that is accepted."""

    def __init__(self, strings: list[tuple[str, str]], below: float = BELOW):
        by_kind: dict[str, list[str]] = {}
        for kind, x in strings:
            by_kind.setdefault(kind, []).append(x.translate(_CLASSES))
        self.ordinary: dict[str, dict[str, float]] = {}
        for sort in ("digit", "plain"):
            mix = Counter("".join(by_kind.get(sort, ())))
            total = sum(mix.values()) + len(_ALPHABET)
            self.ordinary[sort] = {c: math.log((mix[c] + 1) / total) for c in _ALPHABET}
        self.kinds: list[tuple[Automaton, float]] = []
        for kind in KINDS:
            if kind in by_kind:
                automaton = infer((x, 1) for x in by_kind[kind])
                scores = sorted(automaton.likelihood(x) for x in by_kind[kind])
                self.kinds.append((automaton, scores[int(below * len(scores))]))

    def accepts(self, string: str) -> bool:
        symbols = string.translate(_CLASSES)
        mix = self.ordinary[_ordinary(string)]
        usual = sum(mix.get(c, UNSEEN) for c in symbols) / (len(symbols) + 1)
        return any(p >= least and p >= usual + MARGIN
                   for p, least in ((a.likelihood(symbols), least) for a, least in self.kinds))


def fit_formats(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND, below: float = BELOW,
                symbols: int = SYMBOLS) -> Formats:
    """Formats of the credentials in ``docs``: all texts are searched, and of each
    kind's distinct strings those of smallest hash are used, ``per_kind`` at most
    and none after ``symbols`` characters (of a longer one, its first ``symbols``)."""
    parts = docs.select(F.col(f"`{text_col}`")).mapInArrow(_labelled(per_kind, symbols), _CHOSEN_SQL)
    rows = parts.repartition("kind").mapInArrow(_merged(per_kind, symbols), _CHOSEN_SQL).collect()
    return Formats([(r["kind"], r["string"]) for r in sorted(rows)], below)


def _scanner(formats, text_at: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slow = formats.value.accepts
        quick = lru_cache(REMEMBERED)(slow)
        accepts = lambda x: quick(x) if len(x) <= REMEMBERED_SIZE else slow(x)
        for batch in batches:
            out = []
            for text in batch.column(text_at).to_pylist():
                base = base_spans(text) if text else []
                more = [(a, len(KINDS), b) for s, _, x in candidates(text, base)
                        for a, b in accepted(s, x, accepts)] if text else []
                out.append([{"kind": (*KINDS, ADDED)[k], "start": s, "end": e}
                            for s, k, e in sorted([x[:3] for x in base] + more)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, _SPANS)], names=[*batch.schema.names, "spans"])
    return scan


def find_secrets(docs: DataFrame, text_col: str = "text", formats: Formats | None = None, **options) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` with its ``spans``, ordered by
    start and then kind (assign, access, hex, grammar)."""
    formats = formats or fit_formats(docs, text_col, **options)
    model = docs.sparkSession.sparkContext.broadcast(formats)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    doc = F.struct(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
    return plain.mapInArrow(_scanner(model, docs.columns.index(text_col)), f"{schema}, spans {_SPANS_SQL}").select(
        doc.alias("doc"), "spans")
