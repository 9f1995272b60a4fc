"""Conversation structure repair by weighted interval parsing (CYK).

Legal conversations are, by the initials of their roles, ``(s?(ua)+)?``. The
repair grammar is in Chomsky normal form: with the states 0 (start), 1 (after a
system turn), 2 (after a user turn) and 3 (after an assistant turn), the symbol
[p q] stands for all that leads from p to q, and

    [p q] -> [p r] [r q]        a span cut in two
    [p p] -> row                the row is deleted
    [p q] -> row                the row is kept or gets another role
    [p q] -> nothing            turns are inserted (the insertion closure)

A cell of the chart is the least (cost, audit) of one symbol over one span of
rows. Two audits of one cell and cost never are a prefix one of the other (the
longer would have insertions on top, which cost), so the least audit of a span is
made of least audits of its parts. Charts are filled bottom-up by span length.

Rows are ranked once over the whole table by (conversation, turn, role, text).
Every block of 16 places of that order is parsed for itself, in any task; the
top cells of a conversation's blocks are combined in pairs, spans of doubling
length, so that no task holds a conversation's rows. What meets in one place is
one audit per symbol, a character per row, as long as the row of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import Scratch, fingerprint, ranked

BLOCK = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

_MOVES = ((0, "s", 1), (0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3))
_ACCEPT = (0, 3)
_FAULTS = ("none", "blank", "duplicate", "truncated")
_INITIALS = "sua"                       # any other initial is the fourth kind
_SPACES = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}

Cell = tuple[int, str]
Chart = dict[tuple[int, int], Cell]


def _closure() -> Chart:
    """[p q] -> nothing: the fewest insertions that lead from p to q."""
    cells: Chart = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        for p, letter, q in _MOVES:
            for o in range(4):
                if (o, p) in cells and letter != "s":
                    cost, audit = cells[o, p]
                    cells[o, q] = min(cells.get((o, q), (1 << 60, "")), (cost + INSERT, audit + "I"))
    return cells


def join(left: Chart, right: Chart) -> Chart:
    """The cells of two neighbouring spans as those of their union, cut there."""
    out: Chart = {}
    for (p, r), (a, x) in left.items():
        for q in range(4):
            found = right.get((r, q))
            if found is not None:
                cell = (a + found[0], x + found[1])
                if (p, q) not in out or cell < out[p, q]:
                    out[p, q] = cell
    return out


NOTHING = _closure()


@lru_cache(maxsize=64)
def _row(code: str) -> Chart:
    """Cells of a span of one row, with insertions on both sides."""
    kind, fault = divmod(ord(code) - 97, 4)
    cells: Chart = {(p, p): (DELETE, "D") for p in range(4)}
    if _FAULTS[fault] in ("none", "truncated"):
        more = TRUNCATED if _FAULTS[fault] == "truncated" else 0
        initial = (_INITIALS + "-")[kind]
        for p, letter, q in _MOVES:
            if letter == initial:
                cells[p, q] = (KEEP + more, "K")
            elif letter != "s":
                cells[p, q] = (REROLE + more, "R")
    return join(join(NOTHING, cells), NOTHING)


@lru_cache(maxsize=1 << 14)
def chart(codes: str) -> Chart:
    """Cells of a whole span, one code per row, from those of all shorter spans and all cuts."""
    n = len(codes)
    if not n:
        return NOTHING
    spans = {(i, i + 1): _row(c) for i, c in enumerate(codes)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best: Chart = {}
            for cut in range(i + 1, i + length):
                for key, cell in join(spans[i, cut], spans[cut, i + length]).items():
                    if key not in best or cell < best[key]:
                        best[key] = cell
            spans[i, i + length] = best
    return spans[0, n]


def combine(charts: list[Chart]) -> Chart:
    """The cells of neighbouring spans as those of their union: pairs of spans, again and again."""
    while len(charts) > 1:
        charts = [join(charts[i], charts[i + 1]) if i + 1 < len(charts) else charts[i] for i in range(0, len(charts), 2)]
    return charts[0] if charts else NOTHING


def verdict(cells: Chart) -> Cell:
    return min(cells[0, q] for q in _ACCEPT if (0, q) in cells)


_FACES = ("blank", "duplicate", "truncated", "illegal")


def _counts(codes: str) -> tuple[int, int, int, int]:
    kinds = [divmod(ord(c) - 97, 4) for c in codes]
    initials = [(_INITIALS + "-")[k] for k, _ in kinds]
    bad = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    faults = [f for _, f in kinds]
    return faults.count(1), faults.count(2), faults.count(3), bad


_KEYS = sorted(set(_row("a")) | set(_row("e")) | set(_row("i")) | set(_row("m")) | set(NOTHING))


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, first, codes) with the top cells of the block, in the order of _KEYS, null where there is none."""
    for b in batches:
        charts = [chart(c) for c in b.column("codes").to_pylist()]
        costs = [[c[k][0] if k in c else None for k in _KEYS] for c in charts]
        audits = [[c[k][1] if k in c else None for k in _KEYS] for c in charts]
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("first"), b.column("codes"),
                                          pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                                         ["conv", "first", "codes", "costs", "audits"])


def _conclude(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation: its blocks, in order, as counts, cost and audit."""
    for b in batches:
        out: dict[str, list] = {k: [] for k in ("first", *_FACES, "cost", "audit")}
        for pieces in b.column("pieces").to_pylist():
            charts = [{k: (c, a) for k, c, a in zip(_KEYS, p["costs"], p["audits"]) if c is not None} for p in pieces]
            found = [_counts(p["codes"]) for p in pieces]
            counts = [sum(x) for x in zip(*found)] if found else [0, 0, 0, 0]
            for x, y in zip(pieces, pieces[1:]):
                counts[3] += _counts(x["codes"][-1] + y["codes"][0])[3]
            cost, audit = verdict(combine(charts))
            for k, v in zip(out, (pieces[0]["first"] if pieces else None, *counts, cost, audit)):
                out[k].append(v)
        kinds = [pa.int64()] * 6 + [pa.string()]
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("gaps"), *(pa.array(v, t) for v, t in zip(out.values(), kinds))],
                                         ["conv", "gaps", *out])


_EDITS = pa.schema([("conv", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("row", pa.int64()), ("new_role", pa.string())])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns of repaired conversations: place, edit, rank of the row it came from (none: inserted)
    and the role it gets (none: its own)."""
    for b in batches:
        for conv, first, audit in zip(b.column("conv"), b.column("first"), b.column("audit")):
            letters = np.frombuffer(audit.as_py().encode(), np.uint8)
            kept = np.flatnonzero(letters != ord("D"))
            row = np.cumsum(letters != ord("I")) - 1 + (first.as_py() or 0)
            place = np.arange(len(kept))
            # an odd number of turns begins with the system's; then users and assistants take turns
            role = np.where((place + len(kept)) % 2 == 0, "user", "assistant")
            for lo in range(0, len(kept), 1 << 16):
                at = kept[lo:lo + (1 << 16)]
                edit, new = letters[at], letters[at] == ord("I")
                yield pa.RecordBatch.from_arrays([
                    pa.array([conv.as_py()] * len(at), pa.int64()), pa.array(place[lo:lo + len(at)]),
                    pa.array([chr(x) for x in edit], pa.string()), pa.array(row[at], mask=new),
                    pa.array(role[lo:lo + len(at)], mask=edit == ord("K"), type=pa.string())], schema=_EDITS)


@dataclass
class Repair:
    """conversations: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row each.
    turns: (conv_id, place, role, text, edit) of the repaired conversations, edit K, R or I."""

    conversations: DataFrame
    turns: DataFrame


def _without_trailing_spaces(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(_SPACES))


def repair(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           conversations: DataFrame | None = None) -> Repair:
    """The cheapest repair of every conversation, whose turns come in the order of (turn, role, text),
    null turns first.

    A row's first fault counts: blank, duplicate (role and text seen earlier in the conversation), or
    truncated (its last character that is no space is none of ``.!?``). Keep costs 0, another role
    (user, assistant) 1, delete 2 (a must for blank rows and duplicates), insert an empty user or
    assistant turn 5; truncated rows that stay cost 5 more. Among repairs of equal cost the one with
    the least audit is taken.

    A null role or text is one space, a null conv_id a conversation of its own; an empty role, like any
    other than s.., u.., a.., can only be replaced or deleted. Equal rows are duplicates. Texts of any
    length count in full and are never parsed, only ranked and carried. ``conversations`` (with the
    column conv_id) names conversations that have a result even without rows: zeros and an empty
    audit. An empty table gives empty results. Other columns are ignored, whatever their names; conv_id
    and turn must fit 64 bits.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "structure")
    base = rows.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                       F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    names = base if conversations is None else conversations.select(F.col(f"`{conv_id}`").cast("long").alias("conv"))
    order = ["conv", "turn", "role", "text"]
    placed = ranked(base, order, scratch, "turns").select(F.col("_rank").alias("rank"), *order)

    bare = _without_trailing_spaces("text")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    # joined by rank, not by text: no row of a text that many rows have goes where the others go
    firsts = placed.groupBy("conv", "role", fingerprint().alias("key")).agg(F.min("rank").alias("rank")).select("rank", F.lit(True).alias("one"))
    coded = (placed.select("rank", "conv", kind.alias("kind"), bare.alias("bare")).select(
        "rank", "conv", "kind", (F.col("bare") == "").alias("blank"), F.right("bare", F.lit(1)).isin(".", "!", "?").alias("ended"))
        .join(firsts, "rank", "left"))
    fault = F.when(F.col("blank"), 1).when(F.col("one").isNull(), 2).when(~F.col("ended"), 3).otherwise(0)
    blocks = (coded.select("rank", "conv", F.char(97 + 4 * F.col("kind") + fault).alias("code"))
              .groupBy("conv", F.floor(F.col("rank") / BLOCK).alias("block"))
              .agg(F.min("rank").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "code"))), lambda x: x.code), "").alias("codes"))
              .select("conv", "first", "codes")
              .mapInArrow(_parse_blocks, "conv long, first long, codes string, costs array<long>, audits array<string>"))

    per_turn = placed.groupBy("conv", "turn").agg(F.lit(1).alias("_")).groupBy("conv").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n"))
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("n"), F.lit(0))
    facts = (blocks.select("conv", F.struct("first", "codes", "costs", "audits").alias("piece"))
             .unionByName(per_turn, allowMissingColumns=True).unionByName(names.distinct(), allowMissingColumns=True))
    verdicts = scratch.save(
        facts.groupBy("conv").agg(F.array_sort(F.collect_list("piece")).alias("pieces"), gaps.cast("long").alias("gaps"))
        .mapInArrow(_conclude, "conv long, gaps long, first long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"), "verdicts")

    edits = verdicts.where(F.col("audit") != "").select("conv", "first", "audit").mapInArrow(
        _edits, "conv long, place long, edit string, row long, new_role string")
    # ranks differ from row to row, so a long conversation's texts are dealt over all tasks
    own = edits.where("row IS NOT NULL").join(placed.select(F.col("rank").alias("row"), "role", "text"), "row")
    turns = own.select("conv", "place", F.coalesce("new_role", "role").alias("role"), "text", "edit").unionByName(
        edits.where("row IS NULL").select("conv", "place", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit"))
    return Repair(verdicts.drop("first").withColumnRenamed("conv", "conv_id"), turns.withColumnRenamed("conv", "conv_id"))


def digest(done: Repair) -> DataFrame:
    """The conversations with ``repaired_sha256`` of their repaired ``role:text``, newline-joined; an
    empty conversation's is that of an empty text. The texts of one conversation meet in one row."""
    names = [c for c in done.conversations.columns if c != "conv_id"]
    lines = done.turns.select("conv_id", F.struct("place", F.concat_ws(":", "role", "text").alias("line")).alias("line"))
    both = done.conversations.select("conv_id", F.struct(*names).alias("facts")).unionByName(lines, allowMissingColumns=True)
    text = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x.line), "\n")
    return (both.groupBy("conv_id").agg(F.first("facts", ignorenulls=True).alias("facts"), F.sha2(text, 256).alias("repaired_sha256"))
            .select("conv_id", "facts.*", "repaired_sha256"))


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults of the contract, by crc32(``conv_id:turn``) % 20, nulls being
    one space: 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its
    role user."""
    filled = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rule = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return (filled.withColumn("rule", rule).where("rule <> 0")
            .withColumn("text", F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("rule") == 4, "user").otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(F.col("rule") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))
