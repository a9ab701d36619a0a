"""Chat formatting by assembly of token ids.

Each turn is encoded where it is read: role and text on their own, so no token ever spans a
boundary.  Control marks are ids above the vocabulary, spliced between the segments; a text can't
produce them.  In the rendered form the marks are strings, and what looks like one inside a text
is escaped by one more backslash, which reading back takes away.

A shuffle brings the turns of a conversation together in order.  Conversations are then streamed:
places of segments are running sums of their lengths, and the loss mask is the running sum over the
ids of a batch of a step up where a learnt segment begins and a step down where it ends.  A
conversation of any length needs memory for one batch at a time.  Each row is one turn of the
output, with its place in the conversation's sequence.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_text, ship

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
MARKS = (TURN, BODY, END)

# Control strings of this template and of others in wide use.
CONTROL = r"\||/?s>|/?INST\]|</?SYS>>"
ESCAPE = re.compile(rf"([<\[])(\\*)({CONTROL})")
UNESCAPE = re.compile(rf"([<\[])\\(\\*)({CONTROL})")


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


class Codec:
    """Byte-level BPE from a file of ranks; the marks take the ids after the vocabulary."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 1
        self.turn, self.body, self.end = range(first, first + len(MARKS))

    def segments(self, role: str, text: str) -> tuple[list[int], int]:
        """Ids of a turn, and where its text begins in them."""
        head = [self.turn, *self.bpe.encode_ordinary(escape(role)), self.body]
        return [*head, *self.bpe.encode_ordinary(escape(text)), self.end], len(head)

    def render(self, ids: list[int]) -> str:
        """The formatted string of whole turns."""
        marks = {self.turn: TURN, self.body: BODY, self.end: END}
        parts, plain = [], []
        for i in [*ids, None]:
            if i is None or i in marks:
                parts += [self.bpe.decode(plain), marks.get(i, "")]
                plain = []
            else:
                plain.append(i)
        return "".join(parts)


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            roles, texts = (batch.column(c).to_pylist() for c in ("role", "text"))
            turns = [codec.segments(role or "", text or "") for role, text in zip(roles, texts)]
            yield pa.RecordBatch.from_pydict(
                {"conv_id": batch.column("conv_id"), "turn": batch.column("turn"),
                 "learnt": pa.array([role == "assistant" for role in roles], pa.bool_()),
                 "head": pa.array([head for _, head in turns], pa.int32()),
                 "ids": pa.array([ids for ids, _ in turns], pa.list_(pa.int32()))}
            )

    return run


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places within the conversation and the loss mask by prefix sums; rows come in order."""
    last, place, number = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        heads = batch.column("head").to_numpy(zero_copy_only=False)
        learnt = batch.column("learnt").to_numpy(zero_copy_only=False).astype(bool)
        ends = np.cumsum(sizes)
        starts = ends - sizes

        steps = np.zeros(ends[-1], np.int8)
        np.add.at(steps, (starts + heads)[learnt], 1)
        np.add.at(steps, (ends - 1)[learnt], -1)  # the mark that ends a turn is not learnt
        mask = np.cumsum(steps, dtype=np.int8) > 0

        ids = batch.column("conv_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        keys = ids.fill_null(0).to_numpy(zero_copy_only=False)
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (known[1:] != known[:-1])
        new[0] = (keys[0], known[0]) != last
        row = np.arange(len(keys))
        first = np.maximum.accumulate(np.where(new, row, -1))
        goes_on = first < 0  # turns of the conversation that the batch before ended with
        places = np.where(goes_on, place + starts, starts - starts[first])
        numbers = np.where(goes_on, number + row, row - first)
        last, place, number = (keys[-1], known[-1]), places[-1] + sizes[-1], numbers[-1] + 1
        bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
        yield pa.RecordBatch.from_pydict(
            {"conv_id": ids, "turn_no": pa.array(numbers, pa.int64()),
             "offset": pa.array(places, pa.int64()), "ids": batch.column("ids"),
             "loss_mask": pa.ListArray.from_arrays(bounds, pa.array(mask))}
        )


def format_chats(conversations: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per turn: ``conv_id, turn_no, offset, ids, loss_mask``, in order by conversation.

    ``offset`` is the place of the turn's first id in the conversation, so the ids in order of
    ``turn_no`` are its sequence.  The loss mask covers the texts of assistant turns and no mark.
    Turns are ordered by ``turn`` (null last), ties by their ids.  Null roles and texts count as
    empty, a null ``conv_id`` is a conversation of its own, repeated rows are repeated turns, an
    empty table gives no rows, other columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", plain_text().alias("text"),
    )
    encoded = rows.mapInArrow(
        _encode(path, pattern),
        "conv_id long, turn long, learnt boolean, head int, ids array<int>",
    )
    order = ["conv_id", F.col("turn").isNull(), "turn", "ids", "learnt"]
    together = encoded.repartition("conv_id").sortWithinPartitions(*order)
    return together.mapInArrow(
        _assemble, "conv_id long, turn_no long, offset long, ids array<int>, loss_mask array<boolean>"
    )


def _read(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        done: list[tuple] = []
        now = None

        def close():
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        def rows():
            found = list(zip(*done)) or [()] * 6
            done.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(found, kinds)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            values = (batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss_mask"))
            for conv_id, ids, mask in zip(*values):
                if now is None or conv_id != now[0]:
                    if now is not None:
                        close()
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                # Everything below is read from ids and mask alone.
                body = ids.index(codec.body)
                role = unescape(codec.bpe.decode(ids[1:body]))
                text = unescape(codec.bpe.decode(ids[body + 1 : ids.index(codec.end)]))
                learnt = unescape(codec.bpe.decode([i for i, m in zip(ids, mask) if m]))
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(learnt)
                now[4].update(learnt.encode())
                now[5] += len(codec.render(ids))
            yield rows()
        if now is not None:
            close()
        yield rows()

    return run


def read_back(formatted: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of what the output of :func:`format_chats` says, one row per conversation.

    Reads rows as they are dealt and ordered there.
    """
    return formatted.mapInArrow(
        _read(path, pattern),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


ship(__name__)
