"""Chat formatting: every assistant turn as an example of its own."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubagem.llm.common import width

BEGIN, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"

EXAMPLES = "conv_id bigint, example int, target_turn int, formatted string, loss_begin int, loss_end int"
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_examples bigint"
)

_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    """Put one more backslash into each ``<|``, ``<\\|``, ..., so that no control string is left."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{BEGIN}{escape_role(role)}\n{escape(text)}{END}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_examples(turns: DataFrame) -> DataFrame:
    """Examples of conversations given as rows (conv_id, turn, role, text).

    Each assistant turn becomes an example: all turns before it, then the turn itself; code points
    ``loss_begin`` to ``loss_end`` are the trainable reply, without its end mark. Turns after the last
    reply, or of a conversation without one, make one more example with nothing to train
    (``target_turn`` null), so that the examples hold every turn. The last example of a
    conversation holds all of it.

    Rows are ordered by turn (null first), then role and text; repeated rows are turns of their
    own. Null roles and texts count as empty, a null conv_id is a conversation. An empty table
    gives no examples. Other columns are ignored. A task goes through sorted rows and keeps no
    more than the conversation so far.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = rows.repartition(width(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_examples, EXAMPLES)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(EXAMPLES_ARROW)
    current, context, n, example, pending = object(), "", 0, 0, False
    for batch in batches:
        for conv_id, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if conv_id != current:
                if pending:
                    yield from out.add(current, example, None, context, None, None)
                current, context, n, example = conv_id, "", 0, 0
            turn = format_turn(role, text)
            context, pending = context + turn, True
            if role == TARGET_ROLE:
                end = len(context) - len(END) - 1
                yield from out.add(conv_id, example, n, context, end - len(escape(text)), end)
                example, pending = example + 1, False
            n += 1
    if pending:
        yield from out.add(current, example, None, context, None, None)
    yield from out.rest()


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of conversations, read from the formatted text and loss spans of their examples.

    The examples come as ``format_examples`` makes them: those of a conversation one after the other.
    """
    return examples.select("conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(_digests, READ)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(READ_ARROW)
    current, last, loss, chars, formatted_chars, n = object(), None, None, 0, 0, 0

    def digest():
        turns = read_turns(last)
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        sha = hashlib.sha256(whole.encode()).hexdigest()
        return current, len(turns), sha, chars, loss.hexdigest(), formatted_chars, n

    for batch in batches:
        for conv_id, formatted, begin, end in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if conv_id != current or last is None:
                if last is not None:
                    yield from out.add(*digest())
                current, loss, chars, formatted_chars, n = conv_id, hashlib.sha256(), 0, 0, 0
            if begin is not None:
                reply = unescape(formatted[begin:end])
                loss.update(reply.encode())
                chars += len(reply)
            last, formatted_chars, n = formatted, formatted_chars + len(formatted), n + 1
    if last is not None:
        yield from out.add(*digest())
    yield from out.rest()


class _Rows:
    """Output rows, handed on in batches of bounded size."""

    def __init__(self, schema: pa.Schema, most_chars: int = 4 << 20):
        self.schema, self.most, self.rows, self.chars = schema, most_chars, [], 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += sum(len(x) if isinstance(x, str) else 8 for x in row)
        if self.chars >= self.most:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = list(zip(*self.rows, strict=True))
            self.rows, self.chars = [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema
            )


EXAMPLES_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("example", pa.int32()), ("target_turn", pa.int32()), ("formatted", pa.string()),
     ("loss_begin", pa.int32()), ("loss_end", pa.int32())]
)
READ_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64())]
)
