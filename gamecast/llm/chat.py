"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only its reply is
trainable. The expansion gives every turn a row with its rendered text, and an assistant turn's row its example: the
full `text` of all turns up to this one, with `loss_start` and `loss_end` in it. The examples' size is quadratic in a
conversation's turns, by what the method asks for. They stream out of the sorted turns, so only turns are shuffled, and
a task holds one conversation's text and batches of about `BATCH_CHARS`.

A turn renders as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts ``<``, any backslashes and ``|`` get one
backslash more, so that no text can hold a control string; `unescape` takes it away again. Roles also have
backslashes and line breaks escaped.

Defined cases: a null text or role is empty; rows with a null conv_id form one conversation; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows have one order and all stay; a conversation without an
assistant turn has rows but no example; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import shipped, text_or_empty

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
BATCH_CHARS = 4 << 20       # characters of examples after which a batch is handed on
SEGMENT = "conv_id long, turn_index long, role string, segment string, start long, segment_chars long"
EXAMPLE = SEGMENT + ", example_id long, example_chars long, loss_start long, loss_end long, text string"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _ordered(rows: DataFrame, *order: str) -> DataFrame:
    """A conversation's rows in one task, in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rendered turns with their offsets; carries (conversation, turns, examples, characters) across batches."""
    now, turn, example, at = object(), 0, 0, 0
    for batch in batches:
        out = {k: [] for k in ("conv_id", "turn_index", "role", "segment", "start", "segment_chars", "example_id",
                               "example_chars", "loss_start", "loss_end")}
        for conv, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
            if conv != now:
                now, turn, example, at = conv, 0, 0, 0
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            segment = head + body + END
            trained = role == ASSISTANT
            loss = (at + len(head), at + len(head) + len(body)) if trained else (None, None)
            row = (conv, turn, role, segment, at, len(segment), example if trained else None,
                   at + len(segment) if trained else None, *loss)
            for k, v in zip(out, row):
                out[k].append(v)
            turn, example, at = turn + 1, example + trained, at + len(segment)
        types = [pa.string() if k in ("role", "segment") else pa.int64() for k in out]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rendered turns, and with every assistant turn the full text of its example."""
    now, prefix, after = object(), "", []          # the last example's text, and the segments since
    for batch in _render(batches):
        texts, at, size = [], 0, 0
        for conv, segment, example in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "segment", "example_id"))):
            if conv != now:
                now, prefix, after = conv, "", []
            after.append(segment)
            if example is not None:
                prefix, after = prefix + "".join(after), []
                size += len(prefix)
            texts.append(prefix if example is not None else None)
            if size >= BATCH_CHARS:
                yield _with_texts(batch.slice(at, len(texts)), texts)
                texts, at, size = [], at + len(texts), 0
        if texts:
            yield _with_texts(batch.slice(at), texts)


def _with_texts(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
    return pa.record_batch([*batch.columns, pa.array(texts, pa.large_string())], names=[*batch.schema.names, "text"])


def expand_prefix_targets(conversations: DataFrame) -> DataFrame:
    """One row per turn, `EXAMPLE` columns; rows with an `example_id` are the examples.

    Example e of a conversation has as `text` the segments of all rows up to and including its own (`example_chars`
    characters), and `loss_start:loss_end` of that text is its only trainable part. A task's rows are in order of
    conversation and turn.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    return _ordered(rows, "turn", "role", "text").mapInArrow(_expand, EXAMPLE)


def materialize_examples(expanded: DataFrame) -> DataFrame:
    """The examples alone."""
    return expanded.where(F.col("example_id").isNotNull()).select("conv_id", "example_id", "text", "loss_start", "loss_end")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse the examples and digest each conversation: an example is read on from where the one before it ended, and
    the turns behind the last one are read as they were rendered."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples",
             "example_chars"]
    types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    state, read, after = None, "", []              # digests so far, the last example's text, the segments since

    def parse(text: str) -> None:
        for turn in text.split(END)[:-1]:
            role, _, said = turn[len(START):].partition("\n")
            state[2].update(f"{unescape_role(role)}\n{unescape(said)}\n".encode())
            state[1] += 1
        state[5] += len(text)

    for batch in batches:
        done = []
        cols = (batch.column(k).to_pylist() for k in ("conv_id", "segment", "text", "loss_start", "loss_end"))
        for conv, segment, text, loss_start, loss_end in zip(*cols):
            if state is None or state[0] != conv:
                if state:
                    parse("".join(after))
                    done.append(state)
                state, read, after = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0], "", []
            if text is None:
                after.append(segment)
                continue
            if not text.startswith(read):
                raise ValueError(f"example {state[6]} of conversation {conv} does not begin with the one before it")
            parse(text[len(read):])
            target = unescape(text[loss_start:loss_end])
            state[3] += len(target)
            state[4].update(target.encode())
            state[6] += 1
            state[7] += len(text)
            read, after = text, []
        if done:
            yield _digests(done, names, types)
    if state:
        parse("".join(after))
        yield _digests([state], names, types)


def _digests(done: list, names: list, types: list) -> pa.RecordBatch:
    rows = [[v.hexdigest() if hasattr(v, "hexdigest") else v for v in s] for s in done]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_back(expanded: DataFrame, in_order: bool = False) -> DataFrame:
    """Digests of each conversation parsed from its examples: what was formatted, and what is trainable.

    `in_order`: `expanded` comes right from `expand_prefix_targets`, so its rows need no shuffle.
    """
    rows = expanded.select("conv_id", "turn_index", "segment", "text", "loss_start", "loss_end")
    return (rows if in_order else _ordered(rows, "turn_index")).mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long, n_examples long, example_chars long")


shipped(__name__)
