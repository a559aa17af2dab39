"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string.  Nothing is known of it: the turns
are rendered prefix by prefix, and what each adds to the output is that turn's span.  Where the
text stands inside the span is found by rendering the same prefix with two probes as the text:
the outputs differ just there, else the turn is marked as not placed.  A template whose output for a prefix is not the beginning of the
next output rewrites history; such conversations are marked, for them no span is sure.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import ship_package

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

#: Two texts that no template escapes or strips.
PROBES = ("\ue000", "\ue001")
LOSS_ROLES = ("assistant",)

#: The control strings of the tagged template.
CONTROL = re.compile(r"<(?=/?s>)|\[(?=/?(?:INST|SYS|OUT|TURN)[\] ])|\\")
TAGS = {"user": "INST", "system": "SYS", "assistant": "OUT"}
READ = re.compile(r"(?s)<s>\[(?:(INST|SYS|OUT)|TURN ([^\]]*))\] (.*?) \[/(?:INST|SYS|OUT|TURN)\](?:</s>)?")


def escape(text: str) -> str:
    """A backslash after the first character of each control string, and after each backslash."""
    return CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"(?s)(.)\\", r"\1", text)


def tagged(turns: Sequence[Turn]) -> str:
    """The default template: each turn between a pair of tags, other roles named in the tag."""
    out = []
    for role, text in turns:
        tag = TAGS.get(role)
        name = tag or "TURN " + quote(role, safe="")
        out.append(f"<s>[{name}] {escape(text)} [/{tag or 'TURN'}]" + ("</s>" if role == "assistant" else ""))
    return "".join(out)


def read_tagged(formatted: str) -> list[Turn]:
    """The turns of an output of ``tagged``."""
    roles = {tag: role for role, tag in TAGS.items()}
    turns, at = [], 0
    while at < len(formatted):
        m = READ.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((roles[m.group(1)] if m.group(1) else unquote(m.group(2)), unescape(m.group(3))))
        at = m.end()
    return turns


def common(one: str, two: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(one), len(two))
    while low < high:
        middle = (low + high + 1) // 2
        if one[low:middle] == two[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


Place = tuple[int, int, int | None, int | None]


def text_place(output: str, one: str, two: str) -> tuple[int | None, int | None]:
    """Where the text stands in ``output``, from the outputs with each probe as the text.

    They must differ in one place, by the probes themselves, and the true output must have the same beginning and
    end around it; a template that drops or repeats a text, or writes other things for other texts, has no place.
    """
    head = common(one, two)
    tail = one[head + 1:]
    if one[head:head + 1] != PROBES[0] or two[head:head + 1] != PROBES[1] or tail != two[head + 1:]:
        return None, None
    if len(output) < head + len(tail) or not output.startswith(one[:head]) or not output.endswith(tail):
        return None, None
    return head, len(output) - len(tail)


def locate(turns: Sequence[Turn], template: Template) -> tuple[str, list[Place], bool]:
    """The output, per turn (start, end, text start, text end), and whether history is rewritten.

    The text's place is None where it cannot be told, or where it lies outside the turn's own span.
    """
    before, spans, rewrites = template([]), [], False
    for n, (role, _) in enumerate(turns, 1):
        output = template(turns[:n])
        start = len(before) if output.startswith(before) else common(before, output)
        rewrites |= start < len(before)
        begin, end = text_place(output, *(template([*turns[:n - 1], (role, probe)]) for probe in PROBES))
        spans.append((start, len(output), begin, end) if begin is not None and begin >= start else (start, len(output), None, None))
        before = output
    return before, spans, rewrites


def format_chats(rows: DataFrame, template: Template = tagged, loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): conv_id, formatted, spans, rewrites, unplaced.

    spans has a struct per turn: role, start, end, text_start, text_end in code points of
    ``formatted``, and loss, true for the turns to be learnt.  Where the template drops, repeats or moves a turn's
    text, text_start and text_end are null, loss is false, and unplaced counts the turn.  Turns go by number, null first, and
    equal numbers by role and text; repeated rows are turns of their own.  A null role or text is
    empty, a null conv_id is a conversation like any other, an empty table gives an empty result.
    Further columns are not read.

    Rows are dealt by conversation and sorted, so that a task holds one conversation at a time;
    rendering all prefixes takes time in the square of its turns, which is the price of not
    knowing the template.
    """
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.select(
        "conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("_role"),
        F.coalesce("text", F.lit("")).alias("_text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "_turn", "_role", "_text")
    span = pa.struct([("role", pa.string()), *[(name, pa.int32()) for name in ("start", "end", "text_start", "text_end")], ("loss", pa.bool_())])

    def made(conv: object, turns: list[Turn], kind: pa.DataType) -> pa.RecordBatch:
        output, places, rewrites = locate(turns, template)
        spans = [dict(zip(("role", "start", "end", "text_start", "text_end", "loss"), (role, *place, role in loss_roles and place[2] is not None)))
                 for (role, _), place in zip(turns, places)]
        unplaced = sum(place[2] is None for place in places)
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([output]), pa.array([spans], pa.list_(span)), pa.array([rewrites]), pa.array([unplaced], pa.int32())],
            ["conv_id", "formatted", "spans", "rewrites", "unplaced"])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns, kind = None, [], None
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if turns and conv != current:
                    yield made(current, turns, kind)
                    turns = []
                current = conv
                turns.append((role, text))
        if turns:
            yield made(current, turns, kind)

    return dealt.mapInArrow(
        render, f"conv_id {kind}, formatted string, spans array<struct<role:string,start:int,end:int,"
                "text_start:int,text_end:int,loss:boolean>>, rewrites boolean, unplaced int")
