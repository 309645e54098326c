"""Words of pages, delivered once, in blocks that fit a task.

The pages of a corpus are cut into chunks of lines of one block, and long lines
into parts.  Chunks, not pages, are spread over the tasks, so a page of any
length, even one that is a single line, is many small groups, and the partial
results of its chunks are merged afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_LINES = 32
#: Words of a line kept together.
PART_WORDS = 512


def edge(geometry: Column, axis: int, far: bool) -> Column:
    """Least or greatest x (axis 0) or y (axis 1) of four or eight numbers; null otherwise."""
    pick = lambda *i: (F.greatest if far else F.least)(*(geometry[k] for k in i))
    return F.when(F.size(geometry) == 4, pick(axis, axis + 2)).when(F.size(geometry) == 8, pick(axis, axis + 2, axis + 4, axis + 6)).cast("float")


def chunk_words(words: DataFrame, ahead: bool = False, **columns: Column) -> DataFrame:
    """``page_id, block_idx, chunk, part`` and ``words``: keys and columns of each word, once.

    Equal deliveries are combined before the shuffle, and a chunk has at most
    CHUNK_LINES lines of PART_WORDS words (word_idx tells the part).  Rows without a page, block, line or id are left out.
    With ``ahead`` a chunk also has the first line of the next one.
    """
    kept = words.filter("page_id is not null and block_idx is not null and line_idx is not null and word_id is not null")
    chunk = F.floor(F.col("line_idx") / CHUNK_LINES).cast("int")
    if ahead:
        chunk = F.explode(F.when((F.col("line_idx") > 0) & (F.col("line_idx") % CHUNK_LINES == 0), F.array(chunk, chunk - 1)).otherwise(F.array(chunk)))
        kept = kept.select("page_id", "block_idx", "line_idx", "word_idx", "word_id", *(c.alias(n) for n, c in columns.items()), chunk.alias("chunk"))
        columns = {n: F.col(n) for n in columns}
        chunk = F.col("chunk")
    chunk = chunk.alias("chunk")
    word = F.struct("line_idx", "word_idx", "word_id", *(c.alias(n) for n, c in columns.items()))
    part = F.floor(F.coalesce("word_idx", F.lit(0)) / PART_WORDS).cast("int").alias("part")
    return kept.groupBy("page_id", "block_idx", chunk, part).agg(F.collect_set(word).alias("words"))


def word_tables(batches: Iterator[pa.RecordBatch], rows: int = 1500) -> Iterator[pa.Table]:
    """Words of whole chunks in reading order, one row a word."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            part = b.slice(s, rows)
            lists = part.column(4)
            ends = lists.offsets.to_numpy()
            of = np.repeat(np.arange(part.num_rows), np.diff(ends))
            flat = lists.flatten()
            fields = dict(zip((f.name for f in flat.type), flat.flatten()))
            line, at, ids = (fields[c].to_numpy(zero_copy_only=False) for c in ("line_idx", "word_idx", "word_id"))
            order = np.lexsort((ids, at, line, of))
            fresh = starts(of[order], line[order], ids[order])
            order = order[fresh]
            take = pa.array(order)
            keys = {c: part.column(i).take(pa.array(of[order])) for i, c in enumerate(("page_id", "block_idx", "chunk", "part"))}
            yield pa.table(keys | {c: v.take(take) for c, v in fields.items()})


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of the columns change; the first row counts."""
    n = len(columns[0])
    change = np.ones(n, bool)
    if n:
        change[1:] = False
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
    return change


class Lookup:
    """A function of strings, computed once for each distinct one a task meets, and spread over columns."""

    MOST = 400_000

    def __init__(self, function: Callable[[list[str]], np.ndarray]):
        self.function = function
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.made: np.ndarray | None = None

    def __call__(self, column: pa.ChunkedArray) -> np.ndarray:
        """Rows of the function's result; a null string is ''."""
        e = column.combine_chunks()
        e = (e.chunk(0) if isinstance(e, pa.ChunkedArray) else e).fill_null("").dictionary_encode()
        names = e.dictionary.to_pylist()
        if len(self.place) > self.MOST:
            self.forget()
        if new := [n for n in names if n not in self.place]:
            made = self.function(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.made = made if self.made is None else np.concatenate([self.made, made])
        if self.made is None:
            return self.function([])
        return self.made[np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))[e.indices.to_numpy()]]
