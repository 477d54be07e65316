"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of the last 16 bytes decides where a text is cut: at white space where the hash falls below a
threshold. Boundaries depend on nearby bytes only, so equal passages have equal chunks inside whatever stands
before them. Chunks are deduplicated by digest: the first occurrence in key order stays. What is removed are runs
of adjoining repeated chunks of at least ``min_words`` words, or of as much text without blanks (``CHARS_A_WORD`` code
points for a word), so short common phrases are left alone.

Digests that occur once leave after one count; first occurrences are found, and joined back, for the rest only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.shared import free_name, mix64, ship, span_hashes, stored, text_chunks, word_spans

#: One in so many word ends is a cut; cuts closer than GAP bytes to the one before are dropped.
CUT_SHARE, GAP = 6, 12
#: Bytes that the hash looks back, so the first possible cut of a text.
WARM = 16
#: Texts without white space for so many bytes are cut at any character, one in 32; longer chunks are cut every MOST bytes.
BLANKLESS, MOST = 64, 512
#: Words of a run of repeated chunks that is removed.
MIN_WORDS = 20
#: Code points that stand for a word in text without blanks: words of over BLANKLESS bytes, and scripts that use none.
CHARS_A_WORD = 5
_FIRST_DOC = -(1 << 63)
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(40)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the sum of ``G[byte] << age`` over the last 16 bytes, modulo 2**16."""
    h = _GEAR[data]
    for shift in (1, 2, 4, 8):                  # doubling: a window of 2k is two windows of k
        older = np.zeros_like(h)
        older[shift:] = h[:-shift]
        h = h + (older << np.uint16(shift))
    return h


def chunk_ends(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ends of all chunks of a buffer of texts that begin at ``first``; each text ends with a separator byte."""
    h = gear(data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    at = np.arange(len(data))
    since = at - np.maximum.accumulate(np.where(blank, at, 0))
    lead = (data & 0xC0) != 0x80
    cut = blank & (h < (1 << 16) // CUT_SHARE) | (since > BLANKLESS) & lead & (h >> 11 == 0)
    ends = np.flatnonzero(cut) + 1
    ends = np.where(blank[ends - 1], ends, ends - 1)        # after white space, before another character
    ends = ends[ends - first[np.searchsorted(first, ends, side="right") - 1] >= WARM]      # the hash saw this text only
    # distance to the candidate before it; a text's own start counts as one
    edges = np.concatenate([first, [len(data)]])
    marks = np.union1d(ends, edges)
    gaps = np.diff(marks, prepend=-GAP)
    marks = marks[(gaps >= GAP) | np.isin(marks, edges)]
    long = np.flatnonzero(np.diff(marks) > MOST)
    if len(long):                               # e.g. one word over and over: equal pieces, so they are found equal
        after_blank, leads, extra = np.flatnonzero(blank) + 1, np.flatnonzero(lead), []
        for i in long:
            pos, end = int(marks[i]), int(marks[i + 1])
            while end - pos > MOST:
                pos += MOST
                near = after_blank[np.searchsorted(after_blank, pos):][:1]
                pos = int(near[0]) if len(near) and near[0] < pos + MOST else int(leads[np.searchsorted(leads, pos)])
                extra.append(min(pos, end))
        marks = np.union1d(marks, extra).astype(np.int64)
    return marks[1:]


def _buffer(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])[:-1]]).astype(np.int64)
    ends = chunk_ends(data, first)
    starts = np.concatenate([[0], ends[:-1]])
    doc = np.searchsorted(first, starts, side="right") - 1
    return data, first, starts, ends, doc


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digest of every chunk without the white space at its end, so that a passage may end a text or not."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    stop = np.maximum.accumulate(np.where(blank, 0, np.arange(1, len(data) + 1)))[ends - 1]
    return span_hashes(data, starts, np.maximum(stop, starts))


def blankless_chars(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of every code point of text without blanks."""
    word, stop = word_spans(data)
    long = stop - word > BLANKLESS
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[word[long]], edge[stop[long]] = 1, -1
    second = np.append(data[1:], np.uint8(0))
    scripts = ((data >= 0xE3) & (data <= 0xE9) | (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)       # Kana, Han; Thai, Lao
               | (data == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F))   # Myanmar; Khmer
               | (data == 0xEF) & ((second >= 0xA4) & (second <= 0xAB) | (second >= 0xBC)) | (data == 0xF0) & (second >= 0xA0))
    return scripts | (np.cumsum(edge[:-1]) > 0) & ((data & 0xC0) != 0x80)


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with shortened ``text`` and ``n_chunks, n_repeated, removed`` (names suffixed by ``_`` if taken).

    ``removed`` lists the spans cut from the old text as (start, end, words) in code points. A chunk is repeated if an
    equal chunk occurs in a row with a smaller key (null first), earlier in the same text, or, for equal keys, in
    the text with the smaller hash; rows equal in key and text are treated alike. Null texts stay null without
    chunks; a text whose chunks are all repeated becomes empty. Long texts are chunked whole. An empty table gives
    no rows.
    """
    ship(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, raw in text_chunks([t or "" for t in batch.column(2).to_pylist()]):
                data, first, starts, ends, doc = _buffer(raw)
                digests = _digests(data, starts, ends).view(np.int64)
                out += np.split(digests, np.searchsorted(doc, np.arange(1, len(raw))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, type=pa.list_(pa.int64()))], ["d", "h", "digests"])

    d, h = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_FIRST_DOC)), F.xxhash64(F.col(f"`{text}`"))
    scanned = docs.select(d.alias("d"), h.alias("h"), F.col(f"`{text}`").alias("t")).where("t is not null")
    scanned = stored(scanned.mapInArrow(scan, "d long, h long, digests array<long>"), "chunks")

    twice = scanned.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    met = stored(scanned.select("d", "h", F.posexplode("digests").alias("at", "digest")).join(twice, "digest", "left_semi"), "met")
    first = met.groupBy("digest").agg(F.min(F.struct("d", "h", "at")).alias("first"))
    later = met.join(first, "digest").where(F.struct("d", "h", "at") > F.col("first"))
    again = later.groupBy("d", "h").agg(F.array_sort(F.collect_set("at")).alias("again"))

    span = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "end", "words")])
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), d.alias("d"), h.alias("h"))
    joined = whole.join(again, ["d", "h"], "left").select("row", F.coalesce(f"row.`{text}`", F.lit("")).alias("t"), F.coalesce("again", F.array().cast("array<int>")).alias("again"))
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chunks", T.LongType()),
                           T.StructField("n_repeated", T.LongType()), T.StructField("removed", T.ArrayType(span))])
    arrow_span = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "end", "words")]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, repeated = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out, count, removed = [], [], []
            for some, raw in text_chunks(texts):
                data, first, starts, ends, doc = _buffer(raw)
                words = np.diff(np.searchsorted(word_spans(data)[0], np.concatenate([starts, [len(data)]])))
                chars_before = np.concatenate([[0], np.cumsum(blankless_chars(data))])
                blankless = chars_before[ends] - chars_before[starts]
                edge = np.searchsorted(doc, np.arange(len(raw) + 1))
                for k, i in enumerate(some):
                    a, b, base = edge[k], edge[k + 1], first[k]
                    counted = zip(runs(repeated[i], words[a:b]), runs(repeated[i], blankless[a:b]))
                    spans = [(starts[a + x] - base, min(ends[a + y] - base, len(raw[k])), n) for (x, y, n), (*_, c) in counted
                             if n >= min_words or c >= CHARS_A_WORD * min_words]
                    kept, at, found, chars = [], 0, [], 0
                    for s, e, n in spans:
                        before, gone = raw[k][at:s].decode(), raw[k][s:e].decode()
                        kept.append(before)
                        found.append({"start": chars + len(before), "end": chars + len(before) + len(gone), "words": int(n)})
                        chars, at = chars + len(before) + len(gone), e
                    out.append("".join(kept) + raw[k][at:].decode() if spans else texts[i])
                    count.append(int(b - a))
                    removed.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.string()), pa.array(count, type=pa.int64()),
                                              pa.array([len(r) for r in repeated], type=pa.int64()), pa.array(removed, type=arrow_span)],
                                             ["row", "text", "n_chunks", "n_repeated", "removed"])

    result = joined.mapInArrow(cut, schema)
    known = F.col(f"row.`{text}`").isNotNull()
    columns = [F.when(known, F.col("text")).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return result.select(*columns, F.when(known, F.col("n_chunks")).otherwise(0).alias(free_name(docs, "n_chunks")),
                         F.col("n_repeated").alias(free_name(docs, "n_repeated")), F.col("removed").alias(free_name(docs, "removed")))


def runs(repeated: list[int], words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(first chunk, last chunk, words)`` of each run of adjoining repeated chunks."""
    out: list[tuple[int, int, int]] = []
    for at in repeated:
        n = int(words[at])
        if out and out[-1][1] == at - 1:
            out[-1] = (out[-1][0], at, out[-1][2] + n)
        else:
            out.append((at, at, n))
    return out


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without its later repeated passages."""
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_chunks", "n_repeated",
                        F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("removed_words"),
                        F.concat_ws(",", F.transform("removed", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))).alias("removed_spans"))
