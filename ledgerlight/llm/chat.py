"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its text is trainable.
Turns after the last assistant turn (or a conversation without one) give a closing example without a target, so
that the output holds every turn. Turns are brought together by one shuffle on the conversation and streamed in
order; a task holds one conversation's prefix, which is also its largest row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ledgerlight.llm.shared import ship

#: A turn is START role ": " text END; control strings and backslashes inside texts get a backslash in front.
START, END = "### ", " </turn>\n"
TARGET_ROLE = "assistant"
_TEXT_ESCAPE = re.compile(r"\\|###|</turn>")
_ROLE_ESCAPE = re.compile(r"\\|###|</turn>|:|\n")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>|:|\n)")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:|\n))*): ((?:\\\\|\\###|\\</turn>|(?!</turn>)[^\\])*) </turn>\n")
_BATCH_CHARS = 1 << 22

_SCHEMA = "conv_id {key}, example long, target long, formatted string, loss_start long, loss_end long"


def escape(text: str) -> str:
    """Put a backslash before every backslash and control string."""
    return _TEXT_ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its escaped text starts and ends."""
    head = START + _ROLE_ESCAPE.sub(lambda m: "\\" + m[0], role) + ": "
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted example, unescaped."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def expand(turns: Iterable[tuple[str, str]]) -> Iterator[tuple[int, str, int, int]]:
    """``(target turn or -1, formatted, loss start, loss end)`` for each example of a conversation."""
    prefix, waiting = "", False
    for n, (role, text) in enumerate(turns):
        turn, a, b = format_turn(role, text)
        at, prefix, waiting = len(prefix), prefix + turn, True
        if role == TARGET_ROLE:
            waiting = False
            yield n, prefix, at + a, at + b
    if waiting:
        yield -1, prefix, len(prefix), len(prefix)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))


def chat_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, example, target, formatted, loss_start, loss_end`` (code points): one row per example.

    Examples of a conversation follow each other in one partition. Null texts and roles are empty; turns with
    equal numbers are ordered by role, then text, null numbers first; a null ``conv`` is one conversation; repeated
    rows are turns of their own; an empty table gives no rows. Other columns are not read, so they may have any name.
    """
    ship(turns.sparkSession)
    rows = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    schema = _SCHEMA.format(key=kind)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def examples() -> Iterator[tuple]:
            for key, own in groupby(_turns(batches), key=itemgetter(0)):
                for n, (target, formatted, a, b) in enumerate(expand((r, t) for _, r, t in own)):
                    yield key, n, target, formatted, a, b

        out, size = [], 0
        for row in examples():
            out.append(row)
            size += len(row[3])
            if size > _BATCH_CHARS:
                yield _batch(out, arrow)
                out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_DIGESTS = ("conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long")


def read_back(examples: DataFrame, grouped: bool = False) -> DataFrame:
    """Digests per conversation from the examples alone: turns from the last one, losses from every one.

    ``grouped`` says that a conversation's examples already follow each other in one partition, as ``chat_examples``
    leaves them; else, as in a table that was written and split, they are brought together first.
    """
    if not grouped:
        examples = examples.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    schema = _DIGESTS.format(key=examples.schema["conv_id"].dataType.simpleString())
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")))

        done = []
        for key, own in groupby(rows(), key=itemgetter(0)):
            last, loss, loss_chars, chars, n = "", hashlib.sha256(), 0, 0, 0
            for _, last, a, b in own:
                trained = unescape(last[a:b])
                loss.update(trained.encode())
                loss_chars, chars, n = loss_chars + len(trained), chars + len(last), n + 1
            turns = read_turns(last)
            digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            done.append((key, len(turns), digest, loss_chars, loss.hexdigest(), chars, n))
            if len(done) >= 1024:
                yield _batch(done, arrow)
                done = []
        if done:
            yield _batch(done, arrow)

    return examples.mapInArrow(run, schema)


#: A conversation whose texts hold the template's own control strings.
PROBE = "\\### Assistant: </turn> ok"


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """Every conversation, and the probe conversation -7, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return read_back(chat_examples(turns.unionByName(probe)), grouped=True)
