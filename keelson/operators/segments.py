"""Tables that grow by batches and stay few: segments merged in size classes.

Each batch adds a segment; when ``fan`` segments of one size class are there,
they become one of the next class, as digits carry in a counter. Which segments
are live after batch ``n`` follows from ``n`` alone (the digits of ``n + 1``
with base ``fan``), so at most ``(fan - 1) * log(n)`` segments are read, and a
row is rewritten once a class.

Replay. A batch writes its segments with overwrite, then a marker of its
number. Segments that a merge replaced are deleted when the *next* batch
begins, by which time the stream has recorded the one before: so a batch that
broke off and runs again finds all that it read the first time, and a reader
who saw a marker finds its segments until the batch after next. A batch that
has its marker is complete and is left out when it comes again. One stream
(one checkpoint) feeds a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

Range = tuple[int, int]


def live(last: int, fan: int) -> list[Range]:
    """The (first, last) batches of each segment once batch ``last`` is taken."""
    out, at, size = [], 0, 1
    while size * fan <= last + 1:
        size *= fan
    while size:
        while at + size <= last + 1:
            out.append((at, at + size - 1))
            at += size
        size //= fan
    return out


def merges(batch: int, fan: int) -> list[tuple[Range, list[Range]]]:
    """The segments that batch ``batch`` completes, smallest first, each with its parts."""
    out, size = [], 1
    while (batch + 1) % (size * fan) == 0:
        first = batch + 1 - size * fan
        out.append(((first, batch), [(first + k * size, first + (k + 1) * size - 1) for k in range(fan)]))
        size *= fan
    return out


class Segments:
    """A segmented table at ``path``.

    ``write(rows, path)`` stores a segment with overwrite; ``merge(rows)`` makes
    one segment's rows of several segments' (the rows themselves by default);
    ``schema`` is that of a stored segment, needed where one may have no file.
    Batches are numbered 0, 1, 2, ... as ``foreachBatch`` does."""

    def __init__(self, spark: SparkSession, path: str, fan: int = 4,
                 write: Callable[[DataFrame, str], None] | None = None,
                 merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, schema: str | None = None):
        if fan < 2:
            raise ValueError("a merge takes two segments or more")
        self.spark, self.path, self.fan, self.merge, self.schema = spark, path, fan, merge, schema
        self.write = write or (lambda rows, to: rows.write.mode("overwrite").parquet(to))

    def _files(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _names(self) -> list[str]:
        files, folder = self._files()
        return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []

    def _place(self, part: Range) -> str:
        return f"{self.path}/segment={part[0]}-{part[1]}"

    def last(self) -> int:
        """The newest batch taken, -1 before the first."""
        return max((int(n[6:]) for n in self._names() if n.startswith("taken=")), default=-1)

    def paths(self, last: int | None = None) -> list[str]:
        """Folders of the live segments."""
        return [self._place(p) for p in live(self.last() if last is None else last, self.fan)]

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """All rows of the given folders, by default of the live segments."""
        places = list(self.paths() if parts is None else parts)
        if not places:
            raise ValueError("the table has no batch yet")
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        # one by one: each segment may have partition folders of its own
        return reduce(DataFrame.unionByName, [reader.parquet(p) for p in places])

    def add(self, rows: DataFrame, batch: int) -> None:
        """Take one batch (a ``foreachBatch`` body); harmless when repeated."""
        last = self.last()
        if batch <= last:
            return
        if batch > last + 1:
            raise ValueError(f"batch {batch} after {last}: batches are numbered without gaps")
        self._drop({self._place(p) for p in live(batch - 1, self.fan)}, batch - 1)
        self.write(rows, self._place((batch, batch)))
        for whole, parts in merges(batch, self.fan):
            self.write(self.merge(self.read([self._place(p) for p in parts])), self._place(whole))
        files, _ = self._files()
        files.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/taken={batch}"))

    def _drop(self, kept: set[str], taken: int) -> None:
        """Delete what was replaced up to batch ``taken``."""
        files, _ = self._files()
        for name in self._names():
            old = name.startswith("segment=") and f"{self.path}/{name}" not in kept
            if old or name.startswith("taken=") and int(name[6:]) < taken:
                files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)
