"""Bounded-space online packing of token sequences.

Each partition is one pass: a document is tokenised, cut into full windows and a tail, and the tail goes to the
open window that it fills best. At most ``open_windows`` windows are open; when none fits and all are in use the
fullest is emitted. Memory per task is ``open_windows`` windows. The first pass is written once to the shared
folder; the windows that were still open at the ends of partitions are then merged, as whole units, in groups of a
bounded number of partitions. No step sees more than a few thousand windows, and only leftovers are shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import tokens
from ledgerlight.llm.shared import ship, stored

LENGTH = 1024
OPEN_WINDOWS = 64
#: Partitions whose leftovers are merged in one group: at most this many times ``open_windows`` windows.
MERGED_PARTITIONS = 32
END_ID = 0

_SCHEMA = "key {key}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, open boolean"


class Windows:
    """Open windows ordered by free room; pieces are ``(size, item)``. Closed windows are yielded as lists of items."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.free: list[tuple[int, int]] = []          # (room, window), ascending
        self.items: dict[int, list] = {}
        self.count = 0

    def place(self, size: int, item) -> list | None:
        """Put a piece into the window that it fills best; returns a window that had to be closed."""
        closed = None
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            room, w = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                closed = self.items.pop(self.free.pop(0)[1])     # the fullest
            room, w = self.length, self.count
            self.count += 1
            self.items[w] = []
        self.items[w].append(item)
        if room == size:
            return self._both(closed, self.items.pop(w))
        insort(self.free, (room - size, w))
        return closed and [closed]

    @staticmethod
    def _both(a: list | None, b: list) -> list:
        return [x for x in (a, b) if x is not None]

    def rest(self) -> list:
        return [self.items[w] for _, w in self.free]


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, open_windows: int = OPEN_WINDOWS,
         vocabulary_folder: str | None = None) -> DataFrame:
    """One row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. A document is its ids and the
    end id 0; a null or empty text is the end id alone. Documents longer than a window are cut into full windows
    and a tail. Repeated rows and repeated keys are packed like any others; an empty table gives no rows. Only
    ``key`` and ``text`` are read, so other columns may have any name.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = read.schema["key"].dataType
    schema = _SCHEMA.format(key=kind.simpleString())

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        windows, done, out = Windows(length, open_windows), 0, []
        arrow = _arrow_schema

        def emit(pieces: list, is_open: bool) -> None:
            nonlocal done
            at = 0
            for k, start, ids, total in pieces:
                out.append((k, start, len(ids) // 4, ids, total, part << 32 | done, at, is_open))
                at += len(ids) // 4
            done += 1

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = tokens.encode(t.as_py() or "", vocabulary_folder)
                own.append(END_ID)
                raw = np.asarray(own, dtype="<u4").tobytes()
                for start in range(0, len(own), length):
                    ids = raw[4 * start:4 * (start + length)]
                    if len(ids) == 4 * length:
                        emit([(k, start, ids, len(own))], False)
                    else:
                        for closed in windows.place(len(ids) // 4, (k, start, ids, len(own))) or ():
                            emit(closed, False)
                if len(out) >= 4096:
                    yield _batch(out, arrow)
                    out.clear()
        for left in windows.rest():
            emit(left, True)
        if out:
            yield _batch(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    _arrow_schema = to_arrow_schema(_parse_datatype_string(schema))
    first = stored(read.mapInArrow(first_pass, schema), "packed")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sequence_id", "offset"], kind="stable")
        units = [(g["length"].sum(), w, g) for w, g in rows.groupby("sequence_id", sort=True)]
        units.sort(key=lambda u: (-u[0], u[1]))                 # the fullest first
        windows, done, out = Windows(length, len(units) + 1), [], []
        for size, _, g in units:
            done += windows.place(int(size), g) or []
        group = int(rows["sequence_id"].iloc[0] >> 32) // MERGED_PARTITIONS
        for n, parts in enumerate(done + windows.rest()):
            at = 0
            for g in parts:
                out.append(g.assign(sequence_id=(1 << 62) | group << 32 | n, offset=at + g["length"].cumsum() - g["length"]))
                at += int(g["length"].sum())
        return pd.concat(out)

    # keys pass pandas as texts: a null among them would turn 64-bit numbers into floating point
    named = first.where("open").withColumn("key", F.col("key").cast("string"))
    cols = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    left = (named.groupBy((F.shiftright("sequence_id", 32) / MERGED_PARTITIONS).cast("long").alias("_group"))
            .applyInPandas(merge, _SCHEMA.format(key="string")).withColumn("key", F.col("key").cast(kind)).select(*cols))
    return first.where("not open").select(*cols).union(left)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def op8_pack_documents(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens: one row per piece, with its ids' CRC."""
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select(F.col("key").cast("long").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
