"""Chat formatting with a grammar round trip.

Every turn is rendered on its own, so a conversation is the concatenation of
its turns' pieces in order::

    system     [SYS] text [/SYS]
    user       [INST] text [/INST]
    assistant  [OUT] text</s>
    any other  [ROLE] role<newline>text [/ROLE]

After rendering, the piece goes through a deterministic parser.  Where the
recovered turn differs from the source (a text that holds a control string, or
something that reads like an escaped one), the text is escaped and the piece is
parsed again, until both are identical.  Escaping puts one more backslash after
the opening character of a control string (``</s>`` -> ``<\\/s>``); reading
takes one away, so it is reversible for every text.

Defined cases: null role or text is empty; rows of a conversation go by
(turn, role, text), null turns first; repeated rows are repeated turns; rows
without conv_id form one conversation with null id; extra columns are ignored;
an empty table gives an empty table (the query adds conversation -1).

A conversation is read as a sorted stream, so memory follows its longest turn.
Its digests are SHA-256 over all turns in order, which one task has to follow:
a conversation with a third of all rows takes that task's time, not its memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>")}
OTHER = ("[ROLE] ", " [/ROLE]")
LOSS_ROLE = "assistant"
_CONTROL = r"(<|\[)(\\*)(/?s>|/?(?:SYS|INST|OUT|ROLE)\])"
ANY_CONTROL = re.compile(_CONTROL)
RAW_CONTROL = re.compile(_CONTROL.replace(r"(\\*)", "()"))


def escape(text: str) -> str:
    return ANY_CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ANY_CONTROL.sub(lambda m: m[1] + m[2][1:] + m[3], text)


class NotAChat(ValueError):
    """The text doesn't follow the grammar."""


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the raw text) of every turn; deterministic, left to right."""
    at = 0
    openers = {opener: role for role, (opener, _) in MARKS.items()} | {OTHER[0]: None}
    while at < len(text):
        opener = next((o for o in openers if text.startswith(o, at)), None)
        if opener is None:
            raise NotAChat(f"no turn starts at {at}")
        role, begin = openers[opener], at + len(opener)
        closer = MARKS[role][1] if role else OTHER[1]
        mark = RAW_CONTROL.search(text, begin)
        end = mark.end() - len(closer) if mark else -1
        if end < begin or not text.startswith(closer, end):
            raise NotAChat(f"the turn at {at} is not closed")
        at = mark.end()
        if role is None:
            cut = text.find("\n", begin, end)
            if cut < 0:
                raise NotAChat("a role has no end")
            role, begin = unescape(text[begin:cut]).replace("\\n", "\n").replace("\\-", "\\"), cut + 1
        yield role, unescape(text[begin:end]), begin, end


def render(role: str, text: str) -> str:
    """The turn's piece, escaped as far as its round trip asks for."""
    opener, closer = MARKS.get(role, OTHER)
    name = "" if role in MARKS else escape(role.replace("\\", "\\-").replace("\n", "\\n")) + "\n"
    for body in (text, escape(text)):
        piece = f"{opener}{name}{body}{closer}"
        try:
            if [x[:2] for x in parse(piece)] == [(role, text)]:
                return piece
        except NotAChat:
            pass
    raise NotAChat(f"no form of the turn survives its round trip: {text[:80]!r}")


def ordered(conversations: DataFrame) -> DataFrame:
    """Each conversation's turns together and in order."""
    empty = F.lit("")
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                 F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position (from 0), piece, loss_start, loss_end.

    A conversation's formatted text is its pieces put together by position.
    The loss bounds are the raw assistant text within the piece, else null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = object(), 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                n = n + 1 if conv == last else 0
                last, piece = conv, render(role, text)
                begin, end = next(parse(piece))[2:] if role == LOSS_ROLE else (None, None)
                out.append((conv, n, piece, begin, end))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)],
                                             names=["conv_id", "position", "piece", "loss_start", "loss_end"])

    return ordered(conversations).mapInArrow(run, "conv_id long, position long, piece string, loss_start long, loss_end long")


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long")


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted pieces by the parser.

    ``pieces`` must come as ``format_turns`` leaves them: a conversation's rows together and in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        state, done = None, []
        close = lambda s: (s["id"], s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["size"])
        for batch in batches:
            for conv, position, piece, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if position == 0:
                    if state:
                        done.append(close(state))
                    state = {"id": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0}
                state["size"] += len(piece)
                for role, text, _, _ in parse(piece):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                if begin is not None:
                    masked = unescape(piece[begin:end])
                    state["chars"] += len(masked)
                    state["loss"].update(masked.encode())
            if done:
                yield batch_of(done)
                done = []
        if state:
            yield batch_of([close(state)])

    return pieces.mapInArrow(run, DIGEST_SCHEMA)


def with_probe(conversations: DataFrame) -> DataFrame:
    """Adds conversation -1, both of whose texts are made of control strings."""
    probe = conversations.sparkSession.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
