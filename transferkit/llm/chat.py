"""Conversations as training text: chosen branches of reply trees under one template, with a mask for the loss.

The template marks every turn by control strings; where such a string, or the escape itself, stands in a text, a
backslash goes before it, so that the text can be read back.  Turns arrive sorted and are written as they come: a
conversation of any length is a sequence of parts of bounded size, and no task holds more than one part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferkit.llm.batches import map_batches
from transferkit.llm.tables import sized
from transferkit.llm.trees import message_keys, reply_links, reply_paths, thread_links
from transferkit.llm.words import text_of

# The strings that mark turns.
CONTROLS = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")
ROLES = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>> ", " <</SYS>>"), "assistant": (" ", " </s>")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
LEARNED = "assistant"

_ANY = "|".join(re.escape(c) for c in CONTROLS)
_TO_ESCAPE = re.compile(rf"\\|{_ANY}")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MARK = re.compile(rf"\\.|({_ANY})", re.DOTALL)
# Code points of a part after which it ends; a longer turn is a part of its own.
PART_CHARS = 1 << 20
# Code points sent on at once.
BATCH_CHARS = 4 << 20

PARTS = (
    "path long, rank int, part int, n_turns int, formatted string, loss_starts array<long>, loss_lengths array<long>"
)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn under the template, and start and length of its text in it."""
    inner = escape(text)
    if role in ROLES:
        head, tail = ROLES[role]
    else:
        head, tail = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    return head + inner + tail, len(head), len(inner)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of formatted text."""

    def until(mark: str, at: int) -> int:
        for m in _MARK.finditer(formatted, at):
            if m.group(1):
                if m.group(1) != mark:
                    raise ValueError(f"{m.group(1)} where {mark} should stand")
                return m.start()
        raise ValueError(f"no {mark} after {at}")

    at = 0
    while at < len(formatted):
        role = next((r for r, (head, _) in ROLES.items() if formatted.startswith(head, at)), None)
        if role is None:
            at += len(OTHER[0])
            end = until(OTHER[1].strip(), at) - 1
            role, at = unescape(formatted[at:end]), end + len(OTHER[1])
            tail = OTHER[2]
        else:
            head, tail = ROLES[role]
            at += len(head)
        end = until(tail.strip(), at) - 1
        yield role, unescape(formatted[at:end])
        at = end + len(tail)


def _write(tree_type: pa.DataType, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        waiting = 0
        now = None  # path, tree, rank
        number = 0
        texts: list[str] = []
        starts: list[int] = []
        lengths: list[int] = []
        chars = 0

        def close() -> None:
            nonlocal texts, starts, lengths, chars, number, waiting
            out.append((now[1], now[0], now[2], number, len(texts), "".join(texts), starts, lengths))
            waiting += chars
            number += 1
            texts, starts, lengths, chars = [], [], [], 0

        def batch() -> pa.RecordBatch:
            kinds = [tree_type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["tree", "path", "rank", "part", "n_turns", "formatted", "loss_starts", "loss_lengths"]
            return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)

        for rows in batches:
            columns = [rows.column(c) for c in ("path", "tree", "rank", "role", "text")]
            for path, tree, rank, role, text in zip(*(iter(c.to_pylist()) for c in columns)):
                if now is None or path != now[0]:
                    if now is not None:
                        close()
                    now, number = (path, tree, rank), 0
                elif chars >= part_chars:
                    close()
                piece, start, length = render(role, text)
                if role == LEARNED:
                    starts.append(chars + start)
                    lengths.append(length)
                texts.append(piece)
                chars += len(piece)
                if waiting > BATCH_CHARS:
                    yield batch()
                    out.clear()
                    waiting = 0
        if now is not None:
            close()
        if out:
            yield batch()

    return run


def _formatted(texts: DataFrame, links: DataFrame, top: int | None, part_chars: int) -> DataFrame:
    """Parts of the chosen paths, from rows ``k1, k2, role, text``.

    The places of messages on paths are broadcast while they are few and small, else both sides are shuffled by
    the message.  After that the text is shuffled once, by path.
    """
    paths = reply_paths(links, top)
    names = links.select(F.col("no").alias("root"), "tree")
    places = paths.join(links.select("no", "k1", "k2"), "no").join(names, "root")
    places = sized(places.select("k1", "k2", "tree", "path", "rank", "position"), "places")
    rows = texts.join(places, ["k1", "k2"]).select("path", "position", "tree", "rank", "role", "text")
    rows = rows.repartition("path").sortWithinPartitions("path", "position")
    tree = places.schema["tree"].dataType
    kind = places.sparkSession.createDataFrame([], places.schema).select("tree").toArrow().schema.field(0).type
    return map_batches(rows, _write(kind, part_chars), f"tree {tree.simpleString()}, {PARTS}")


def format_threads(
    rows: DataFrame,
    thread_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Threads of turns under the template, as parts ``tree, path, rank, part, n_turns, formatted, loss_starts, loss_lengths``.

    A conversation is its parts' ``formatted`` in the order of ``part``; the loss mask covers, in code points of the
    part, the texts of the assistant.  Parts of a path follow each other in one partition.

    Each turn answers the one before, so every thread is a tree with one branch.  Null turns come first; rows of one
    turn stand in an order of their content; a repeated row is a repeated turn.  Null ids make one thread with a null
    id; null roles and texts are empty, and roles of other names are written out.  An empty table gives no parts; other
    columns are not read.
    """
    d = rows.select(
        F.col(thread_col).alias("tree"), F.col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")
    )
    d = d.select("*", *message_keys(*[F.col(c) for c in ("tree", "turn", "role", "text")], F.col("tree").isNull(), F.col("turn").isNull()))
    links = thread_links(d, ["turn"])
    return _formatted(d.select("k1", "k2", "role", "text"), links, 1, part_chars)


def format_replies(
    messages: DataFrame,
    id_col: str = "message_id",
    parent_col: str = "parent_id",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = "score",
    top: int | None = 1,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """The ``top`` branches of every reply tree as conversations, or all; parts as of ``format_threads``, ``tree`` being
    the root's id.

    See ``reply_paths`` for ranks, ties and circles and ``reply_links`` for shared and unknown ids.  A null score is 0; a
    message without an id has no answers; a repeated row is a repeated turn.
    """
    score = F.col(score_col).cast("double") if score_col else F.lit(None).cast("double")
    d = messages.select(
        F.col(id_col).alias("id"), F.col(parent_col).alias("parent_id"), score.alias("score"),
        text_of(role_col).alias("role"), text_of(text_col).alias("text"),
    )
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in ("id", "parent_id", "score")])
    d = d.select("*", *message_keys(*[F.col(c) for c in ("id", "parent_id", "score", "role", "text")], nulls))
    return _formatted(d.select("k1", "k2", "role", "text"), reply_links(d), top, part_chars)


def read_back(parts: DataFrame, ordered: bool = False) -> DataFrame:
    """What formatted parts hold, parsed from them: one row for each path.

    ``n_turns``, the digest of role, line end, text and line end of every turn, number and digest of the code points
    under the loss mask, and the length of the formatted text.  ``ordered`` says the parts of a path follow each other
    in one partition, as the formatting leaves them; else they are brought together.
    """
    if not ordered:
        parts = parts.repartition("path").sortWithinPartitions("path", "part")
    tree = parts.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def close() -> None:
            done.append((now["tree"], now["path"], now["n"], now["turns"].hexdigest(), now["loss"], now["learned"].hexdigest(), now["chars"]))

        def batch(kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["tree", "path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names=names)

        kind = None
        for rows in batches:
            kind = rows.schema.field("tree").type
            for r in rows.to_pylist():
                if now is None or now["path"] != r["path"]:
                    if now is not None:
                        close()
                    now = {"tree": r["tree"], "path": r["path"], "n": 0, "loss": 0, "chars": 0}
                    now |= {"turns": hashlib.sha256(), "learned": hashlib.sha256()}
                formatted = r["formatted"]
                for role, text in turns(formatted):
                    now["turns"].update(f"{role}\n{text}\n".encode())
                    now["n"] += 1
                for start, length in zip(r["loss_starts"], r["loss_lengths"]):
                    text = unescape(formatted[start : start + length])
                    now["loss"] += len(text)
                    now["learned"].update(text.encode())
                now["chars"] += len(formatted)
            if done:
                yield batch(kind)
                done = []
        if now is not None:
            close()
            yield batch(kind)

    schema = f"tree {tree}, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(parts, run, schema)
