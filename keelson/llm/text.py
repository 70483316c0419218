"""Word arrays over whole Arrow batches.

A batch's texts are joined into one byte buffer (a newline between them, which
no word class contains), and words are found and hashed with numpy, so Python
runs per batch instead of per word. Word classes are byte tables: on UTF-8 the
classes used here keep or drop every byte from 0x80 up together, so they match
their code-point forms.

A hash only proposes; callers that report a match compare the words as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 2**64))
_CHUNK = 1 << 20


def class_table(dropped: list[tuple[int, int]]) -> np.ndarray:
    """Byte table that is true for every byte outside the ranges given."""
    table = np.ones(256, dtype=bool)
    for lo, hi in dropped:
        table[lo:hi + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``
SPACED = class_table([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text
PLAIN = class_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: letters of lower-cased text
LETTERS = class_table([(0x00, 0x60), (0x7B, 0x7F)])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows (and so the memory) of an Arrow batch sent to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each row; a null row is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (one long row stands alone)."""
    at, held = 0, 0
    for i, x in enumerate(texts):
        if i > at and held + len(x) > most:
            yield at, i
            at, held = i, 0
        held += len(x) + 1
    if at < len(texts):
        yield at, len(texts)


@dataclass
class Words:
    """Words of some texts: byte spans in ``data`` and, for text ``i``, which
    begins at byte ``offsets[i]``, the words ``first[i]`` to ``first[i + 1]``."""

    data: bytes
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def at(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]]

    def joined(self, i: int, j: int) -> bytes:
        return b" ".join(self.data[a:b] for a, b in zip(self.starts[i:j].tolist(), self.ends[i:j].tolist()))

    def of_text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return self.prefix_hashes(())[0]

    def prefix_hashes(self, cuts: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of each word, and of its first ``c`` bytes for each ``c`` of ``cuts``."""
        out = [np.zeros(len(self.starts), dtype=U64) for _ in range(len(cuts) + 1)]
        buf = np.frombuffer(self.data, dtype=np.uint8)
        a, n = 0, len(self.starts)
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + _CHUNK, "right")))
            lo = int(self.starts[a])
            part = buf[lo:int(self.ends[b - 1])]
            power, inverse = _powers(len(part))
            total = np.zeros(len(part) + 1, dtype=U64)
            np.cumsum((part.astype(U64) + U64(1)) * power[:len(part)], out=total[1:])
            s, e = self.starts[a:b] - lo, self.ends[a:b] - lo
            for h, cut in zip(out, (None, *cuts)):
                h[a:b] = (total[e if cut is None else np.minimum(e, s + cut)] - total[s]) * inverse[s]
            a = b
        return [mixed(h) for h in out]


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n + 1:
        size = max(n + 1, _CHUNK + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            t = np.full(size, base, dtype=U64)
            t[0] = U64(1)
            tables.append(np.cumprod(t, dtype=U64))
        if n > _CHUNK:
            return tables[0], tables[1]
        _POWERS[:] = tables
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a hash: every bit of the result depends on every bit given."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def find_words(texts: list[bytes], table: np.ndarray) -> Words:
    data = b"\n".join([b"", *texts, b""])
    member = table[np.frombuffer(data, dtype=np.uint8)]
    edges = np.flatnonzero(member[1:] != member[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[1], 1 + np.cumsum(sizes)])
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for j in range(size):
        out *= _BASE
        out += h[j:n + j]
    return mixed(out)


def inside(words: Words, size: int) -> np.ndarray:
    """True where a window of ``size`` words lies in one text."""
    n = len(words.starts) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    owner = words.of_text()
    return owner[:n] == owner[size - 1:]


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """True for each of ``n`` words inside a window of ``size`` that begins at one of ``starts``."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + size, n), -1)
    return np.cumsum(step[:-1]) > 0


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal true runs as (start, end) pairs, end exclusive."""
    padded = np.concatenate([[False], flags, [False]])
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist()))
