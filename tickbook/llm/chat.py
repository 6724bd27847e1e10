"""Chat formatting with spans found by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string; the
operator knows nothing else about it.  It renders successive prefixes of a
conversation and compares consecutive outputs: what the new output adds is the
new turn's span, and rendering the same prefix with a probe in place of the
turn's text shows where in the span the text lies.  If an output does not begin with the
one before, the template rewrites history; such a conversation is flagged, and
its spans are not guessed.

The library's own template marks turns as ``### role: ...</turn>`` and escapes
control strings inside texts, so it can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

Turns = list[tuple[str, str]]
_PROBE = "\ue000\ue001"  # private-use characters
FULL_TURNS = 128        # prefixes up to this length are rendered even if the template declares itself additive

_ESCAPE = re.compile(r"\\|###|</turn>")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>|:)")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text) if "\\" in text else text


def render(turns: Turns) -> str:
    """The library's template."""
    return "".join(f"### {_escape_role(role)}: {escape(text)}</turn>\n" for role, text in turns)


render.additive = True


def _escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def _unescaped(formatted: str, mark: str, at: int) -> int:
    """Place of the next ``mark`` from ``at`` on that no backslash escapes."""
    while (found := formatted.find(mark, at)) >= 0:
        back = found
        while back > at and formatted[back - 1] == "\\":
            back -= 1
        if (found - back) % 2 == 0:
            return found
        at = found + 1
    raise ValueError(f"no {mark!r} from {at} on")


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a string that ``render`` wrote, one at a time; the memory needed is that of a turn."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith("### ", at):
            raise ValueError(f"no turn at {at}")
        colon = _unescaped(formatted, ":", at + 4)
        if not formatted.startswith(": ", colon):
            raise ValueError(f"no text at {colon}")
        end = _unescaped(formatted, "</turn>", colon + 2)
        if not formatted.startswith("</turn>\n", end):
            raise ValueError(f"no end of a turn at {end}")
        yield unescape(formatted[at + 4:colon]), unescape(formatted[colon + 2:end])
        at = end + 8


def read_back(formatted: str) -> Turns:
    """The turns of a string that ``render`` wrote."""
    return list(turns_of(formatted))


def _update(digest, text: str, block: int = 1 << 20) -> None:
    """Add the UTF-8 bytes of a text, block by block."""
    for i in range(0, len(text), block):
        digest.update(text[i:i + block].encode())


def _text_place(added: str, render_with: Callable[[str], str]) -> tuple[int, int]:
    """Characters of ``added`` before and after the turn's text; ``render_with`` renders the
    turn with another text.  Of a text that the template changes by place, all is text."""
    probe = _PROBE
    while probe in added:
        probe += _PROBE
    bare = render_with(probe)
    if bare.count(probe) != 1:
        return 0, 0
    head = bare.index(probe)
    tail = len(bare) - head - len(probe)
    if len(added) < head + tail or added[:head] != bare[:head] or added[len(added) - tail:] != bare[len(bare) - tail:]:
        return 0, 0
    return head, tail


def _by_prefixes(turns: Turns, template: Callable[[Turns], str]):
    """``locate`` from the outputs of all successive prefixes."""
    spans, before = [], template([])
    for i, (role, _text) in enumerate(turns):
        now = template(turns[:i + 1])
        if not now.startswith(before):
            return template(turns), [], True
        at = len(before)
        head, tail = _text_place(now[at:], lambda probe: template([*turns[:i], (role, probe)])[at:])  # noqa: B023
        spans.append((at, len(now), at + head, len(now) - tail))
        before = now
    return before, spans, False


def locate(turns: Turns, template: Callable[[Turns], str]):
    """(formatted, spans, rewrites): per turn (start, stop, text start, text stop)
    in the formatted string, or no spans if the template rewrites history.

    All successive prefixes are rendered, whatever the number of turns, so the
    work grows with its square.  A template may declare by a true attribute
    ``additive`` that it joins what it makes of each turn alone (template(a + b)
    == template(a) + template(b)); then the prefixes of more than ``FULL_TURNS``
    turns are joined from single turns.  If that does not give template(turns),
    the declaration is wrong, and all prefixes are rendered after all."""
    if not getattr(template, "additive", False) or len(turns) <= FULL_TURNS:
        return _by_prefixes(turns, template)
    first, spans, rewrites = _by_prefixes(turns[:FULL_TURNS], template)
    if not rewrites:
        parts, at = [first], len(first)
        for role, text in turns[FULL_TURNS:]:
            added = template([(role, text)])
            head, tail = _text_place(added, lambda probe: template([(role, probe)]))  # noqa: B023
            spans.append((at, at + len(added), at + head, at + len(added) - tail))
            parts.append(added)
            at += len(added)
        formatted = "".join(parts)
        if formatted == template(turns):
            return formatted, spans, False
    return _by_prefixes(turns, template)


FORMATTED = ("conv_id bigint, formatted string, roles array<string>, rewrites boolean, "
             "spans array<struct<start:bigint,stop:bigint,text_start:bigint,text_stop:bigint,loss:boolean>>")
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("text_start", pa.int64()), ("text_stop", pa.int64()),
                   ("loss", pa.bool_())])


def _conversations(batches):
    """(conv_id, turns) from batches sorted by conversation; one may go on in the next batch."""
    current, turns = None, None
    for b in batches:
        for conv, role, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if turns is None or conv != current:
                if turns is not None:
                    yield current, turns
                current, turns = conv, []
            turns.append((role or "", text or ""))
    if turns is not None:
        yield current, turns


def format_conversations(rows: DataFrame, template: Callable[[Turns], str] = render,
                         loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conv_id: formatted, roles, rewrites, spans (``FORMATTED``).

    Rows are ordered by turn (NULL first), then role and text, so repeated
    rows are repeated turns in a defined order.  NULL roles and texts count as
    empty; NULL conv_ids are one conversation; an empty table gives no rows.
    Texts of any length are formatted whole; other columns are not read.
    A conversation is one output row, so it is gathered in one task; its rows
    stream in sorted order.  The work is proportional to the conversation for a
    template that declares itself ``additive``, as the library's own does, and
    to the square of its turns for any other (see ``locate``)."""
    T.prepare(rows.sparkSession)

    def run(batches):
        out: list[list] = [[], [], [], [], []]
        size = 0

        def batch():
            types = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.bool_(), pa.list_(_SPAN))
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)],
                                              names=["conv_id", "formatted", "roles", "rewrites", "spans"])
            for c in out:
                c.clear()
            return done

        for conv, turns in _conversations(batches):
            formatted, spans, rewrites = locate(turns, template)
            marks = [dict(zip(("start", "stop", "text_start", "text_stop", "loss"), (*s, r in loss_roles), strict=True))
                     for s, (r, _) in zip(spans, turns, strict=False)]
            for c, v in zip(out, (conv, formatted, [r for r, _ in turns], rewrites, marks), strict=True):
                c.append(v)
            size += len(formatted)
            if size > 1 << 22:
                yield batch()
                size = 0
        if out[0]:
            yield batch()

    sort = ["conv_id", "turn", "role", "text"]
    return (rows.select(F.col("conv_id").cast("bigint"), "turn", F.col("role").cast("string"), F.col("text").cast("string"))
                .repartition("conv_id").sortWithinPartitions(*sort).select("conv_id", "role", "text")
                .mapInArrow(run, FORMATTED))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read
    back from the formatted string of the library's template and its loss spans."""

    def run(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                all_turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                turns = 0
                for role, said in turns_of(text):
                    turns += 1
                    for part in (role, "\n", said, "\n"):
                        _update(all_turns, part)
                for s in spans:
                    if s["loss"]:
                        said = unescape(text[s["text_start"]:s["text_stop"]])
                        _update(loss, said)
                        chars += len(said)
                for c, v in zip(cols, (turns, all_turns.hexdigest(), chars, loss.hexdigest(), len(text)), strict=True):
                    c.append(v)
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                                    "formatted_chars"])

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
