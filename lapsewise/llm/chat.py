"""Operator 4: chat formatting by incremental black-box rendering.

A template is any function from turns to one string.  Successive prefixes of a
conversation are rendered; what a prefix adds to the one before is its last
turn's span, and a prefix that changes earlier output shows that the template
rewrites history.  Where a turn's text lies inside its span is found with a
probe in place of the text, so nothing is assumed about the markers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

Turn = tuple[str, str]

# Strings that control the template or common chat models; escaped inside texts.
CONTROL = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])|<(?=\|)|<(?=</?SYS>>)")
_ESCAPE = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<s>(.*?)\n(.*?)</s>\n", re.DOTALL)
_ROLE_ESCAPE = re.compile(r"\\(\\|n)?")

FORMATTED = ("conv_id long, formatted string, rewritten_at int, "
             "spans array<struct<role:string,start:int,stop:int,text_start:int,text_stop:int,loss:boolean>>")


def escape(text: str) -> str:
    """Break every control string with a backslash; a backslash itself is doubled."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    """As ``escape``; a role ends at its line's end, so a line feed becomes a backslash and n, which ``escape`` never makes."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1] or "", role)


def probe_for(output: str) -> str:
    """A text of one character that ``output`` doesn't hold: from the private-use planes, so no marker holds it either."""
    return next(c for c in map(chr, chain(range(0xE000, 0xF900), range(0xF0000, 0x10FFFE))) if c not in output)


def template(turns: list[Turn]) -> str:
    """``<s>role``, the escaped text, ``</s>``: one marked block a turn."""
    return "".join(f"<s>{escape_role(role)}\n{escape(text)}</s>\n" for role, text in turns)


def parse(formatted: str) -> list[Turn]:
    """The turns that ``template`` rendered."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def locate(turns: list[Turn], render: Callable[[list[Turn]], str], loss_roles: tuple[str, ...] = ("assistant",)) -> tuple[str, int | None, list[dict]]:
    """The rendered conversation, the first turn that rewrote earlier output (or None), and each turn's spans.

    Spans are code-point ranges of the whole output: the turn, and its text.
    After a rewrite the earlier ranges no longer hold, so no spans are given.
    """
    before, spans = "", []
    for k, (role, _) in enumerate(turns):
        now = render(turns[: k + 1])
        if not now.startswith(before):
            return render(turns), k, []
        probe = probe_for(now)
        probed = render([*turns[:k], (role, probe)])
        start = probed.find(probe, len(before))
        tail = len(probed) - start - 1
        shown = start >= 0 and len(now) - tail >= start and now[:start] == probed[:start]
        spans.append({"role": role, "start": len(before), "stop": len(now), "text_start": start if shown else len(now),
                      "text_stop": len(now) - tail if shown else len(now), "loss": role in loss_roles})
        before = now
    return before, None, spans


def format_conversations(rows: DataFrame, render: Callable[[list[Turn]], str] = template,
                         loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a conversation: ``(conv_id, formatted, rewritten_at, spans)``.

    Takes ``(conv_id, turn, role, text)``.  Turns go by ``turn``, then role,
    then text (nulls first); a repeated row is one more turn; a null text or
    role is empty; rows of null conv_id form one conversation; no rows give no
    rows.  A conversation is one row, so its turns are gathered in one task.
    """
    prepare(rows.sparkSession, rows=500)
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    span = pa.struct([("role", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("text_start", pa.int32()),
                      ("text_stop", pa.int32()), ("loss", pa.bool_())])

    def render_all(tables):
        for b in tables:
            out = [locate([(t["role"], t["text"]) for t in turns], render, loss_roles) for turns in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.list_(span))],
                                             names=["conv_id", "formatted", "rewritten_at", "spans"])

    return turns.mapInArrow(render_all, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text and its loss mask say, for ``template``'s format; a row per conversation, any role and
    text given back as it was, no rows for none."""
    def digest(tables):
        for b in tables:
            rows = []
            for conv, text, spans in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s["text_start"]: s["text_stop"]]) for s in spans if s["loss"])
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
