"""Quality rules: base counts of a text, and bands on tokeniser fertility per language or script.

One pass measures every document with public vocabularies: characters per token and entropy of the token
distribution (``byte_bpe_50k``), and the share of bytes that ``piece_bpe_32k`` can only spell as bytes. The measures are written once. Over all
documents, the medians of each language (script where the language is null) set the bands, for the entropy by octave
of the token count; small groups take the band of the next wider one; copies count once, and values are rounded first, so an exact median needs only a few thousand
counters whatever the group's size.
Widths are fixed multiples of the sampling error at the document's length, so long texts are held to narrower bands.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm import tokens
from ledgerlight.llm.shared import fold_grams, mix64, scratch_root, ship, span_hashes, stored, text_chunks, word_spans

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: Texts with fewer tokens are not judged by the bands.
MIN_TOKENS = 16
#: Groups with fewer different texts are judged by the band of the next wider group.
MIN_GROUP = 30
#: How much wider than in a language the spread between clean documents is across a script's languages, and across scripts.
WIDER = {"lang": 1.0, "script": 5.0, "all": 10.0}
#: The same for the entropy, which falls with the octave up to that of 512 tokens: own octave, all octaves from there on,
#: one and two octaves to either side, all octaves of the language, of the script, of all rows.
ENTROPY_WIDER = {"octave": 1.0, "near0": 1.0, "near1": 2.0, "near2": 4.0, "lang": 7.0, "script": 8.0, "all": 10.0}
FULL_OCTAVE = 9
#: The table of bands is broadcast up to this many rows.
BROADCAST_BANDS = 100_000
#: Half-widths in standard errors: characters per token (both sides), token entropy (below).
FERTILITY_WIDTH, ENTROPY_WIDTH = 5.5, 2.2
#: Relative spread between clean documents, and variances per token of the two measures.
SPREAD, FERTILITY_VARIANCE, ENTROPY_VARIANCE = 0.02, 2.0, 0.4
#: Byte-fallback share above the group's median: a margin and a multiple of its standard error.
FALLBACK_MARGIN, FALLBACK_WIDTH = 0.10, 4.0

#: Scripts by first code point of their main blocks (fixed values from the Unicode block list).
SCRIPTS = [(0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
           (0x0600, "Arabic"), (0x0900, "Indic"), (0x0E00, "Southeast Asian"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
           (0x1E00, "Latin"), (0x1F00, "Greek"), (0x3040, "Kana"), (0x3400, "Han"), (0xAC00, "Hangul"), (0xF900, "Han")]

_MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars long, "
             "n_bytes long, n_fallback long, n_tokens long, entropy double, script string")


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The base counts of each text: all texts of a chunk are worked on as one buffer of bytes."""
    n = len(texts)
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    of = lambda at: np.searchsorted(first, at, side="right") - 1  # noqa: E731  the document of a byte
    starts, ends = word_spans(data)
    doc = of(starts)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    out = {"n_words": np.bincount(doc, minlength=n),
           "word_chars": np.bincount(doc, weights=lead[ends] - lead[starts], minlength=n).astype(np.int64)}
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    out["n_symbols"] = np.bincount(of(np.flatnonzero(symbol[data])), minlength=n)

    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    worded = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_doc = of(line_starts)
    keyed = mix64(span_hashes(data, line_starts, line_ends) + line_doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, firsts = np.unique(keyed, return_index=True)
    out["n_dup_lines"] = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[firsts], minlength=n)

    grams = fold_grams(span_hashes(data, starts, ends), REPEAT_WINDOW)
    own = doc[:len(grams)]
    whole = np.flatnonzero(own == doc[REPEAT_WINDOW - 1:]) if len(grams) else np.zeros(0, dtype=np.int64)
    keyed = mix64(grams[whole] + own[whole].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, which, count = np.unique(keyed, return_inverse=True, return_counts=True)
    again = whole[count[which] > 1] if len(whole) else whole
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


@functools.lru_cache(maxsize=2)
def _letter_scripts() -> np.ndarray:
    """Script number of each code point below 0x10000 that is a letter, else -1."""
    table = np.searchsorted([c for c, _ in SCRIPTS], np.arange(0x10000), side="right") - 1
    table[[i for i in range(0x10000) if not chr(i).isalpha()]] = -1
    return table


def script_of(text: str) -> str | None:
    """The script of most letters (None without letters); higher planes count as Han."""
    if text.isascii():
        return "Latin" if any(map(str.isalpha, text)) else None
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _letter_scripts()[points[points < 0x10000]]
    counts: dict[str, int] = {"Han": int((points >= 0x20000).sum())}
    for k, c in enumerate(np.bincount(letters[letters >= 0], minlength=len(SCRIPTS))):
        counts[SCRIPTS[k][1]] = counts.get(SCRIPTS[k][1], 0) + int(c)
    best = max(sorted(counts), key=counts.get)
    return best if counts[best] else None


@functools.lru_cache(maxsize=2)
def _fallback_bytes(folder: str | None) -> np.ndarray:
    """For each code point, the bytes that the piece vocabulary spells it with: 0 if a piece holds the character.

    Pieces are merged from characters, so a character falls back to its bytes exactly if it is in no piece."""
    sp = tokens.piece_bpe(folder)
    known = np.zeros(0x110000, dtype=bool)
    known[0x20] = True
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if len(piece) == 1 and not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            known[ord(piece)] = True
    size = np.full(0x110000, 4, dtype=np.uint8)
    size[:0x10000], size[:0x800], size[:0x80] = 3, 2, 1
    return np.where(known, np.uint8(0), size)


def fertility(text: str, folder: str | None = None) -> tuple[int, int, int, float]:
    """(UTF-8 bytes, bytes that the piece vocabulary falls back to, byte-BPE tokens, entropy of these tokens in bits)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    fallback = int(_fallback_bytes(folder)[points].sum())
    ids = np.asarray(tokens.encode(text, folder), dtype=np.int64)
    size = len(text.encode("utf-8", "surrogatepass"))
    if not len(ids):
        return size, fallback, 0, 0.0
    count = np.unique(ids, return_counts=True)[1]
    share = count / len(ids)
    return size, fallback, len(ids), float(-(share * np.log2(share)).sum())


def measure(rows: DataFrame, vocabulary_folder: str | None = None) -> DataFrame:
    """Adds the measures to ``rows`` of ``text`` and other columns, which are carried along."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ship(rows.sparkSession)
    carried = [f for f in rows.schema.fields if f.name != "text"]
    extra = rows.sparkSession.createDataFrame([], _MEASURES).schema.fields
    schema = StructType([*carried, *extra])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            found: dict[str, list] = {f.name: [] for f in extra}
            for some, raw in text_chunks(texts):
                for k, v in base_counts(raw).items():
                    found[k].extend(v.tolist())
                for i in some:
                    size, fallback, n, entropy = fertility(texts[i], vocabulary_folder)
                    for k, v in (("n_chars", len(texts[i])), ("n_bytes", size), ("n_fallback", fallback), ("n_tokens", n),
                                 ("entropy", entropy), ("script", script_of(texts[i]))):
                        found[k].append(v)
            own = [batch.column(batch.schema.get_field_index(f.name)).cast(arrow.field(f.name).type) for f in carried]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(found[f.name], type=arrow.field(f.name).type) for f in extra]], schema=arrow)

    return rows.mapInArrow(run, schema)


_BAND = ["group", "script", "octave"]


def _bands(found: DataFrame) -> DataFrame:
    """``_group, _script, _octave, m_c, m_f, wider, m_e, wider_e`` for all that occur: the medians of the narrowest group that
    has ``MIN_GROUP`` different texts, of all rows if none has, and how much wider than a language's own the band is."""
    # copies count once; rounded values keep the counters of an exact median few
    values = stored(found.where(F.col("n_tokens") >= MIN_TOKENS)
                    .select(*_BAND, "n_tokens", F.round("chars_per_token", 2).alias("c"), F.round("entropy_ratio", 3).alias("e"),
                            F.round("fallback_share", 3).alias("f")).distinct(), "bands")
    bands = found.select(*[F.col(c).alias(f"_{c}") for c in _BAND]).distinct()

    def attached(rows: DataFrame, values: DataFrame, by: list[str], of: str, name: str, least: int = MIN_GROUP) -> DataFrame:
        medians = (values.where(reduce(and_, [F.col(c).isNotNull() for c in by], F.lit(True))).groupBy(*[F.col(c).alias(f"{name}_{c}") for c in by])
                   .agg(F.count("*").alias("_n"), *[F.expr(f"percentile({x}, 0.5)").alias(f"{name}_{x}") for x in of])
                   .where(F.col("_n") >= least).drop("_n"))
        return rows.join(medians, reduce(and_, [F.col(f"_{c}") == F.col(f"{name}_{c}") for c in by], F.lit(True)), "left")

    bands = attached(bands, values, ["group", "octave"], "e", "octave")
    length = F.least(F.col("octave"), F.lit(FULL_OCTAVE))
    bands = bands.withColumn("_length", F.least(F.col("_octave"), F.lit(FULL_OCTAVE)))
    for r in (0, 1, 2):
        spread = values.withColumn("length", F.explode(F.sequence(length - r, length + r)))
        bands = attached(bands, spread, ["group", "length"], "e", f"near{r}")
    bands = attached(bands, values, ["group"], "cef", "lang")
    bands = attached(bands, values, ["script"], "cef", "script")
    bands = attached(bands, values, [], "cef", "all", least=1)

    def narrowest(x: str, widths: dict[str, float]) -> tuple[Column, Column]:
        found_at = [F.when(F.col(f"{name}_{x}").isNotNull(), F.lit(wider)) for name, wider in widths.items()]
        return F.coalesce(*[F.col(f"{name}_{x}") for name in widths]), F.coalesce(*found_at)

    (c, wider), (f, _), (e, wider_e) = narrowest("c", WIDER), narrowest("f", WIDER), narrowest("e", ENTROPY_WIDER)
    return bands.select(*[f"_{x}" for x in _BAND], c.alias("m_c"), f.alias("m_f"), wider.alias("wider"), e.alias("m_e"), wider_e.alias("wider_e"))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", carry: bool = False,
                  vocabulary_folder: str | None = None) -> DataFrame:
    """Every row with its measures, ``base_failed`` and ``kept``; with ``carry``, ``row`` holds the whole input row.

    ``base_failed``: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT_PERCENT`` % of the words in 5-word
    windows that occur twice. ``kept`` is false for these, and for texts whose characters per token, entropy or
    byte-fallback share leave the bands of their group. A null text counts as empty (base_failed); a null
    language is judged by the script, a group with fewer than ``MIN_GROUP`` different texts by the next wider one (entropy:
    neighbour octaves, language, script, all rows; the others: language, script, all rows), with wider bands across languages and
    scripts, so every text of ``MIN_TOKENS`` tokens is judged. Repeated rows get equal results, an empty table none. Input columns
    are kept inside ``row``, so their names cannot clash.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    scratch_root(docs.sparkSession)
    found = stored(measure(rows, vocabulary_folder), "quality")
    n = F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")
    found = (found
             .withColumn("group", F.coalesce("lang", F.concat(F.lit("script "), "script")))
             .withColumn("octave", F.when(F.col("n_tokens") > 0, F.floor(F.log2("n_tokens"))).cast("int"))
             .withColumn("chars_per_token", F.when(F.col("n_tokens") > 0, F.col("n_chars") / F.col("n_tokens")))
             .withColumn("fallback_share", F.when(F.col("n_bytes") > 0, F.col("n_fallback") / F.col("n_bytes")))
             .withColumn("entropy_ratio", F.when(F.col("n_tokens") > 1, F.col("entropy") / F.log2(F.least(n, F.lit(512.0))))))

    bands = _bands(found).checkpoint()
    # the bands are broadcast only if there are few of them, else rows go to them by a shuffle
    small = F.broadcast(bands) if bands.count() <= BROADCAST_BANDS else bands
    judged = found.join(small, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _BAND]), "left")
    middle = {x: F.col(f"m_{x}") for x in "cef"}
    off_c = (F.col("chars_per_token") - middle["c"]) / F.sqrt(F.pow(middle["c"] * SPREAD * F.col("wider"), 2) + FERTILITY_VARIANCE / n)
    off_e = (F.col("entropy_ratio") - middle["e"]) / F.sqrt(F.pow(SPREAD * F.col("wider_e"), 2) + ENTROPY_VARIANCE / n)
    most_f = middle["f"] + FALLBACK_MARGIN * F.col("wider") + FALLBACK_WIDTH * F.sqrt(middle["f"] * (1 - middle["f"]) / n)
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    outside = [F.coalesce(x, F.lit(False)) for x in (F.abs(off_c) > FERTILITY_WIDTH, off_e < -ENTROPY_WIDTH, F.col("fallback_share") > most_f)]
    judge = (F.col("n_tokens") >= MIN_TOKENS) & (outside[0] | outside[1] | outside[2])
    return judged.select("key", *(["row"] if carry else []), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed.alias("base_failed"), (~base_failed & ~judge).alias("kept"), "chars_per_token", "fallback_share",
                         "entropy", off_c.alias("fertility_offset"), off_e.alias("entropy_offset"), "script")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document with its base counts, fertility measures and verdict."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("doc_id", F.col("key").cast("long")).drop("key")
