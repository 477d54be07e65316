"""Line dedup by winnowing over line hashes.

The lines of a text that hold a word are its sequence; a line's hash has 128 bits. Over every window of ``window``
hashes of ``gram`` consecutive lines the minimum is selected, so every run of ``window + gram - 1`` lines contains a
selected fingerprint: what two texts share at that length, they share a fingerprint of. A long line is a run of its
own and always selected. Only fingerprints that occur twice go on. Their positions are extended both ways to
all runs around them, and equal runs are joined with their own first occurrence (the first occurrence of the
fingerprint alone may have other neighbours). Adjoining repeated runs unite to maximal ones; all lines of later runs go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.shared import fold_grams, free_name, ship, stored, text_chunks, word_spans

#: A repeated run has at least WINDOW + GRAM - 1 lines,
WINDOW, GRAM = 2, 1
#: or is one line of so many words, or of so many bytes (text without blanks).
LONG_WORDS, LONG_BYTES = 20, 400
_FIRST_DOC = -(1 << 63)
_LISTS = ("prints", "at", "print", "low", "high")


def worded_lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and numbers of words of all lines of a buffer that ends in a line feed."""
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    words, _ = word_spans(data)
    return starts, ends, np.searchsorted(words, ends) - np.searchsorted(words, starts)


def line_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit hashes of lines, as two columns of 64 bits."""
    digests = b"".join(xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist()))
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 2)


def winnow(hashes: np.ndarray, long: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """For a sequence of line hashes: selected fingerprints, and for each run its place (twice the first line's number,
    one more for a long line by itself), the fingerprint inside it and the two halves of its hash."""
    low, high = np.ascontiguousarray(hashes[:, 0]), np.ascontiguousarray(hashes[:, 1])
    run = window + gram - 1
    grams = fold_grams(low, gram)
    if len(grams) >= window:
        seen = np.lib.stride_tricks.sliding_window_view(grams, window)
        at = np.arange(len(seen)) + window - 1 - seen[:, ::-1].argmin(axis=1)        # the last minimum of each window
    else:
        at = np.zeros(0, dtype=np.int64)
    alone = np.flatnonzero(long) if run > 1 else at[:0]
    singles = fold_grams(low, 1)[alone]
    # a long line's own fingerprint is that of a gram of one line: selected once, be it a minimum too or not
    selected = grams[np.union1d(at, alone)] if gram == 1 else np.concatenate([grams[np.unique(at)], singles])
    runs = np.concatenate([2 * np.arange(len(at)), 2 * alone + 1])
    print_ = np.concatenate([grams[at], singles])
    return (selected, runs.astype(np.uint64), print_, np.concatenate([fold_grams(low, run), singles]),
            np.concatenate([fold_grams(high, run), fold_grams(high, 1)[alone]]))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
               long_words: int = LONG_WORDS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """``docs`` with shortened ``text`` and the columns ``n_lines, n_removed`` (suffixed by ``_`` if taken).

    A run of ``window + gram - 1`` lines is repeated if an equal run occurs earlier: in a row with a smaller key
    (null first), at a smaller position of the same text, or, for equal keys, in the text with the smaller hash.
    A line of ``long_words`` words or ``long_bytes`` bytes is repeated if an equal line occurs earlier in that sense.
    Lines without a word are no part of runs and stay. Rows equal in key and text are treated alike: none counts as
    the earlier one. Null texts stay null with 0 lines; texts with fewer lines than a run and no long line stay whole; a text all of
    whose lines go becomes empty or keeps its blank lines. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    run = window + gram - 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _LISTS]
            for _, raw in text_chunks([t or "" for t in batch.column(2).to_pylist()]):
                data = b"\n".join(raw) + b"\n"
                starts, ends, words = worded_lines(np.frombuffer(data, dtype=np.uint8))
                starts, ends, words = starts[words > 0], ends[words > 0], words[words > 0]
                hashes = line_hashes(data, starts, ends)
                long = (words >= long_words) | (ends - starts >= long_bytes)
                edge = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])])
                cut = np.searchsorted(starts, edge)
                for a, b in zip(cut[:-1], cut[1:]):
                    for column, x in zip(out, winnow(hashes[a:b], long[a:b], window, gram)):
                        column.append(x.view(np.int64))
            arrays = [pa.array(c, type=pa.list_(pa.int64())) for c in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["d", "h", *_LISTS])

    d, h = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_FIRST_DOC)), F.xxhash64(F.col(f"`{text}`"))
    scanned = (docs.select(d.alias("d"), h.alias("h"), F.col(f"`{text}`").alias("t")).where("t is not null")
               .mapInArrow(scan, "d long, h long, " + ", ".join(f"{c} array<long>" for c in _LISTS)))
    scanned = stored(scanned.where(F.size("at") > 0), "lines")

    prints = scanned.select(F.explode("prints").alias("print")).groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    runs = (scanned.select("d", "h", F.explode(F.arrays_zip("at", "print", "low", "high")).alias("r"))
            .select("d", "h", "r.at", "r.print", F.struct("r.low", "r.high").alias("run")))
    met = runs.join(prints, "print", "left_semi").select("d", "h", "at", "run")
    first = met.groupBy("run").agg(F.min(F.struct("d", "h", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").select("run", "first")
    later = met.join(first, "run").where(F.struct("d", "h", "at") > F.col("first"))
    gone = later.groupBy("d", "h").agg(F.array_sort(F.collect_set("at")).alias("gone"))

    names = {c: free_name(docs, c) for c in ("n_lines", "n_removed")}
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), d.alias("d"), h.alias("h"))
    joined = whole.join(gone, ["d", "h"], "left").select("row", F.coalesce(f"row.`{text}`", F.lit("")).alias("t"), "gone")
    cut = joined.where("gone is not null").mapInArrow(_cutter(run), _cut_schema(joined))
    kept = joined.where("gone is null").select("row", F.col("t").alias("text"), F.size(F.split("t", "\n", -1)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    both = cut.select("row", "text", "n_lines", "n_removed").union(kept)
    columns = [F.when(F.col(f"row.`{c}`").isNotNull(), F.col("text")).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    lines = F.when(F.col(f"row.`{text}`").isNull(), 0).otherwise(F.col("n_lines"))
    return both.select(*columns, lines.alias(names["n_lines"]), F.col("n_removed").alias(names["n_removed"]))


def _cut_schema(joined: DataFrame):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    return StructType([joined.schema["row"], StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_removed", LongType())])


def _cutter(run: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, removed = [], [], []
            for t, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = t.split("\n")
                _, _, words = worded_lines(np.frombuffer(t.encode() + b"\n", dtype=np.uint8))
                sequence = np.flatnonzero(words)
                drop = {int(sequence[(g >> 1) + j]) for g in gone for j in range(1 if g & 1 else run)}
                texts.append("\n".join(x for i, x in enumerate(own) if i not in drop))
                total.append(len(own))
                removed.append(len(drop))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts), pa.array(total), pa.array(removed)], ["row", "text", "n_lines", "n_removed"])
    return cut


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without its later repeated runs of lines."""
    found = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("n_lines").cast("long").alias("n_lines"), "n_removed")


#: The same by comparing every run of two worded lines and every long line as text.
SQL = """
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 20 OR strlen(line) >= 400 AS long, row_number() OVER w AS j, lead(line) OVER w AS next_line, lead(i) OVER w AS next_i
  FROM split WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), runs AS (
  SELECT doc_id, i, next_i, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, j) AS nth FROM worded WHERE next_line IS NOT NULL
), alone AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, j) AS nth FROM worded WHERE long
), gone AS (
  SELECT doc_id, i FROM runs WHERE nth > 1 UNION SELECT doc_id, next_i FROM runs WHERE nth > 1 UNION SELECT doc_id, i FROM alone WHERE nth > 1
), cut AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) FILTER (WHERE g.i IS NULL) AS text, count(*) AS n_lines, count(g.i) AS n_removed
  FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(c.text, '') END AS text, coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN cut c ON d.doc_id = c.doc_id
"""
