"""Chat formatting by incremental black-box rendering.

A template is a function from a list of turns to a string, and nothing else is
known of it. Rendering the prefixes of a conversation, one turn more each time,
and comparing consecutive outputs gives the span of every turn: what the last
turn added. If an output doesn't begin with the one before it, the template
rewrites history (as templates do that drop earlier reasoning), and spans are
then located in the whole output. Two probes in place of a turn's text show
where in its span the text stands, and so the characters that carry loss.

Rows of turns are shuffled once by conversation and sorted by Spark; a task
streams through them and holds one conversation at a time, which is what one
row of the result holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
_PROBES = ("\ue000", "\ue001")


@dataclass(frozen=True)
class Template:
    """render: turns to output; unescape: a text as it stands in the output to the text;
    parse: an output to its turns."""

    render: Callable[[list[Turn]], str]
    unescape: Callable[[str], str] = lambda s: s
    parse: Callable[[str], list[Turn]] | None = None


_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_IN_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:\\.|[^\\])*?): ((?:\\.|[^\\])*?) </turn>\n", re.S)


def _unescape(s: str) -> str:
    return _ESCAPED.sub(r"\1", s)


def _render(turns: list[Turn]) -> str:
    return "".join(f"### {_IN_ROLE.sub(lambda m: chr(92) + m[0], r)}: {_CONTROL.sub(lambda m: chr(92) + m[0], t)} </turn>\n" for r, t in turns)


def _parse(output: str) -> list[Turn]:
    turns, at = [], 0
    while at < len(output):
        m = _TURN.match(output, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((_unescape(m[1]), _unescape(m[2])))
        at = m.end()
    return turns


#: ``### role: text </turn>``; a backslash stands before every backslash, every # that two more
#: follow and every < of a ``</turn>`` in a text, so that control strings occur as such only.
PLAIN = Template(_render, _unescape, _parse)


@dataclass
class Rendered:
    output: str
    turns: list[tuple[int, int]]        # span of each turn; with rewritten history, up to where its text ends
    texts: list[tuple[int, int]]        # span of each turn's text within it
    rewrites_history: bool


def _alike(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _text_span(render, turns: list[Turn], i: int, output: str) -> tuple[int, int]:
    """Where the text of turn i stands in the output, by two probes in its place."""
    a, b = (render([*turns[:i], (turns[i][0], p), *turns[i + 1:]]) for p in _PROBES)
    lo = _alike(a, b)
    tail = a[lo + 1:]
    hi = len(output) - len(tail)
    if output[:lo] == a[:lo] and hi >= lo and output[hi:] == tail:
        return lo, hi
    return lo, max(lo, len(output) - _alike(a[::-1], output[::-1]))


def _frame(render, roles: tuple) -> tuple[str, str] | None:
    """What stands before and after the text of a conversation's last turn within that turn's span,
    seen on a conversation of the last two roles alone; None if the first turn's output changes."""
    before = [(r, "") for r in roles[:-1]]
    start = render(before)
    a, b = (render([*before, (roles[-1], p)]) for p in _PROBES)
    if not a.startswith(start):
        return None
    lo = _alike(a, b)
    return a[len(start):lo], a[lo + 1:]


def render_incrementally(turns: list[Turn], render: Callable[[list[Turn]], str], frames: dict | None = None) -> Rendered:
    """Render every prefix once and compare it with the one before. Where a turn's text stands in its
    span is looked up by its role and the one before (``frames`` keeps these between calls); a span
    that doesn't begin and end as the lookup says is probed in its own place."""
    frames = {} if frames is None else frames
    before, spans, texts = render([]), [], []
    for i in range(len(turns)):
        now = render(turns[:i + 1])
        if not now.startswith(before):
            break
        lo, hi = len(before), len(now)
        roles = tuple(r for r, _ in turns[max(0, i - 1):i + 1])
        if roles not in frames:
            frames[roles] = _frame(render, roles)
        frame = frames[roles]
        if frame and hi - lo >= len(frame[0]) + len(frame[1]) and now.startswith(frame[0], lo) and now.endswith(frame[1]):
            texts.append((lo + len(frame[0]), hi - len(frame[1])))
        else:
            texts.append(_text_span(render, turns[:i + 1], i, now))
        spans.append((lo, hi))
        before = now
    else:
        return Rendered(before, spans, texts, False)
    output = render(turns)
    texts = [_text_span(render, turns, i, output) for i in range(len(turns))]
    ends = [*[hi for _, hi in texts[:-1]], len(output)]
    return Rendered(output, list(zip([0, *ends[:-1]], ends)), texts, True)


_SPAN = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def format_chats(rows: DataFrame, template: Template = PLAIN, *, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, turn_spans, loss_spans (the texts of ``trained``
    roles, in code points of ``formatted``), rewrites_history.

    Turns are ordered by (turn, role, text), nulls first; a null text or role counts as empty; a null
    conv_id is a conversation; repeated rows are turns of their own; other columns are ignored.
    An empty table gives no rows.
    """
    rows = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def one(key, turns: list[Turn], frames: dict) -> tuple:
        r = render_incrementally(turns, template.render, frames)
        loss = [r.texts[i] for i in range(len(turns)) if turns[i][0] in trained]
        return key, r.output, [dict(lo=a, hi=b) for a, b in r.turns], [dict(lo=a, hi=b) for a, b in loss], r.rewrites_history

    def batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        cols = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), pa.array(cols[1], pa.string()), pa.array(cols[2], _SPAN), pa.array(cols[3], _SPAN),
             pa.array(cols[4], pa.bool_())], ["conv_id", "formatted", "turn_spans", "loss_spans", "rewrites_history"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, done, held, kind, frames = None, [], [], 0, pa.int64(), {}
        for b in batches:
            kind = b.schema.field(0).type
            for k, r, t in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and k != key:
                    done.append(one(key, turns, frames))
                    held += len(done[-1][1])
                    turns = []
                    if held > 1 << 22:
                        yield batch(done, kind)
                        done, held = [], 0
                key = k
                turns.append((r, t))
        if turns:
            done.append(one(key, turns, frames))
        if done:
            yield batch(done, kind)

    spans = "array<struct<lo:bigint,hi:bigint>>"
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, f"conv_id {id_type}, formatted string, turn_spans {spans}, loss_spans {spans}, rewrites_history boolean"))


def read_back(formatted: DataFrame, template: Template = PLAIN) -> DataFrame:
    """The contract's digests of formatted conversations, from the output and its spans alone."""
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha, loss_n, loss_sha, chars = [], [], [], [], []
            for output, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist()):
                turns = template.parse(output)
                loss = "".join(template.unescape(output[s["lo"]:s["hi"]]) for s in spans)
                n.append(len(turns))
                sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                loss_n.append(len(loss))
                loss_sha.append(hashlib.sha256(loss.encode()).hexdigest())
                chars.append(len(output))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(loss_n, pa.int64()),
                 pa.array(loss_sha, pa.string()), pa.array(chars, pa.int64()), b.column("rewrites_history")],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"])

    return formatted.select("conv_id", "formatted", "loss_spans", "rewrites_history").mapInArrow(
        digest, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites_history boolean")
