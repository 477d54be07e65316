"""Personal data by anchor expansion.

An Aho-Corasick automaton passes over the text once and reports anchors: at-signs, URL schemes and identifier
cues. Local parsers expand every anchor to the boundaries of an email address, a URL, an account number or a secret, and
validate it. Numbers without a cue (IP addresses, cards, phones) anchor themselves by their pattern.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.shared import ship

#: Kinds in the order of the output; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE_KINDS = KINDS[:4]

#: Tried once per run of digits (a match never starts inside one), so long numbers cost their length.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
URL_REST = re.compile(r"[A-Za-z0-9\[][^\x00-\x20\"'<>`{}|\\^\x7f]*")
#: What may stand between a cue and its value, and the values.
BETWEEN = re.compile(r"(?:[\x20\t]*(?:no\.?|nr\.?|number|num|id|n°|#))?[\x20\t]*[:=#]?[\x20\t]*[\"']?", re.IGNORECASE)
ACCOUNT = re.compile(r"[A-Z]{0,3}[0-9](?:[\x20-]?[A-Z0-9]){5,33}")
SECRET = re.compile(r"[A-Za-z0-9_\-/+=.]{16,}")

SCHEMES = ["http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "mailto:"]
ACCOUNT_CUES = ["account", "acct", "iban", "konto", "cuenta", "compte", "ssn", "passport", "social security", "tax id", "routing", "swift"]
SECRET_CUES = ["token", "api_key", "apikey", "api key", "secret", "password", "passwd", "access_key", "private_key"]
_BOUNDARY = re.compile(r"[A-Za-z0-9]")


def luhn(digits: str) -> bool:
    """The check digit rule of payment cards."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(text: str) -> bool:
    """The check digits of an international account number: moved to the end, letters as numbers, 1 modulo 97."""
    plain = re.sub("[ -]", "", text).upper()
    if not 15 <= len(plain) <= 34 or not plain[:2].isalpha() or not plain[2:4].isdigit():
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


_IBAN_HEAD = re.compile(r"[A-Z]{2}[0-9]{2}")
_LOWER = {c: c + 32 for c in range(65, 91)}


@functools.lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for kind, cues in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.add_word("@", ("email", 1))
    a.make_automaton()
    return a


def find(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of every span in code points, by kind as listed, then start; none overlap within a kind."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    over = dict.fromkeys(KINDS, 0)          # end of the kind's last span
    for last, (kind, size) in automaton().iter(text.translate(_LOWER)):      # cues in any spelling
        at, end = last + 1 - size, last + 1
        if at < over[kind]:
            continue
        if kind == "email":
            span = _email(text, at, over[kind])
        elif kind == "url":
            span = _url(text, at, end)
        else:
            span = _cued(text, at, end, ACCOUNT if kind == "account" else SECRET, kind)
        if span and span[0] >= over[kind]:
            spans[kind].append(span)
            over[kind] = span[1]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans["ip"].append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[ -]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                spans["phone"].append(m.span())
    return [(k, a, b) for k in KINDS for a, b in spans[k]]


def _email(text: str, at: int, over: int) -> tuple[int, int] | None:
    domain = DOMAIN.match(text, at + 1)
    start = at
    while domain and start > over and (text[start - 1] in "._%+-" or text[start - 1].isascii() and text[start - 1].isalnum()):
        start -= 1
    return (start, domain.end()) if domain and start < at else None


def _url(text: str, at: int, end: int) -> tuple[int, int] | None:
    if at and _BOUNDARY.match(text[at - 1]):
        return None
    rest = URL_REST.match(text, end)
    if not rest:
        return None
    stop = rest.end()
    while stop > end and text[stop - 1] in ".,;:!?)]*":         # closing punctuation belongs to the sentence
        stop -= 1
    return (at, stop) if stop > end else None


def _cued(text: str, at: int, end: int, value: re.Pattern, kind: str) -> tuple[int, int] | None:
    if at and _BOUNDARY.match(text[at - 1]) or _BOUNDARY.match(text[end:end + 1]):
        return None
    m = value.match(text, BETWEEN.match(text, end).end())
    if not m:
        return None
    digits = sum("0" <= c <= "9" for c in m[0])
    if kind == "account" and _IBAN_HEAD.match(m[0]) and len(re.sub("[ -]", "", m[0])) >= 15 and not iban(m[0]):
        return None                                              # written like one, but its check digits are wrong
    if kind == "account" and digits < 6 or kind == "secret" and (digits < 4 or not any(c.isalpha() for c in m[0])):
        return None
    return m.span()


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` for every row: ``spans`` is an array of ``(kind, start, end)``, end exclusive, in code points.

    A null text counts as empty: no spans. Whole texts are searched, in one task each; repeated rows get equal
    results, an empty table none. Only ``key`` and ``text`` are read, so other columns may have any name.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, type=pa.list_(item))], ["key", "spans"])

    return rows.mapInArrow(run, f"key {kind}, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``; overlapping spans of different kinds are replaced by the first."""
    spans = found.groupBy("key").agg(F.first("spans").alias("_spans"))
    joined = docs.join(spans, docs[key].eqNullSafe(spans["key"]), "left").drop(spans["key"])
    order = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    cut = F.aggregate(order, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
                      lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
                          F.concat(a["out"], F.substring(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                                   F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"), (-s["end"]).alias("at"))),
                      lambda a: F.concat(a["out"], F.substring(F.col(text), (a["at"] + 1).cast("int"), F.length(text))))
    return joined.withColumn(text, F.when(F.size("_spans") > 0, cut).otherwise(F.col(text))).drop("_spans")


def op6_personal_data(spark, sf_dir: str) -> DataFrame:
    """Every document with its numbers of base spans, their digest and all spans."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    show = lambda s: F.concat_ws(",", F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("key").cast("long").alias("doc_id"), *[count(k) for k in BASE_KINDS],
                        F.sha2(show(F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
                        show(F.col("spans")).alias("spans"), *[count(k) for k in KINDS[4:]])
