"""Repair of conversations: the cheapest edits after which the roles are system?, (user, assistant)*.

Every turn is kept (K, cost 0), given the role that is due, user or assistant (R, 1), or deleted (D, 2);
empty user and assistant turns may be inserted anywhere (I, 5). Blank turns and repetitions of an
earlier turn must be deleted; a truncated turn that stays costs 5 more. Of the cheapest edits those
count whose letters, the audit, come first in ASCII order.

A node is a place between turns and what was emitted last. The costs to the end are found from the last
turn back, for many conversations at once. Arcs that keep a node's cost are optimal. Nodes are ranked by
the audit that begins there: by its first letter, then, as a node's audit of twice the length is its own
followed by the one at its pointer, by 2, 4, 8, … letters, until all pointers are at the end. The ranks
choose each node's arc, and doubled pointers write down the path. Two optimal arcs of a node never
carry the same letter, so a node's pointer is determined.

Conversations of up to ``LONG`` turns are whole in one task, many at a time. Longer ones are numbered by a
range sort and cut into blocks of that size. A block is a matrix of costs from what was emitted before it
to what was emitted last; the small table of matrices gives the costs behind every block, each block
then has an audit per state, and the states that follow from one block to the next choose one of them.

Defined results: null role or text counts as one space; null ids are one conversation; null turns come
first; turns with equal numbers are ordered by role, then text; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.identity import number_in_order
from kinfold.session import materialize

LONG = 10_000  # turns of a conversation that one task handles whole; blocks of longer ones
_ROWS = 20_000  # turns handled together
LETTERS = b"DIKR"  # in ASCII order
SPACES = r"\x20\x09-\x0D"

START, SYSTEM, USER, REPLY = range(4)  # what was emitted last
_DUE = np.array([USER, USER, REPLY, USER])  # after an inserted or renamed turn
_NEXT = np.full((4, 4), -1)  # state, role class (0 other, then s, u, a): state after a kept turn
_NEXT[START, 1] = SYSTEM
_NEXT[[START, SYSTEM, REPLY], 2] = USER
_NEXT[USER, 3] = REPLY
_CLOSE = np.array([0, 10, 5, 0])  # cost of the inserts that make an end allowed
_FAR = 1 << 40

PIECES = (
    "conv_id {id}, block long, blocks long, gaps long, blank long, duplicate long, truncated long,"
    " illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"
)


class Turns(NamedTuple):
    """Turns of several conversations in order; conversation c is ``first[c]:first[c + 1]``."""

    role: np.ndarray  # class of the role's initial
    gone: np.ndarray  # must be deleted
    cut: np.ndarray  # truncated
    first: np.ndarray


def costs_to_end(turns: Turns, final: np.ndarray) -> np.ndarray:
    """Least cost per level, state and end: a conversation of n turns has n + 1 levels.

    ``final`` (conversation, state, end) is the cost behind the last turn.
    """
    first = turns.first
    size, count = np.diff(first), len(first) - 1
    dist = np.empty((first[-1] + count, *final.shape[1:]), np.int64)
    dist[first[1:] + np.arange(count)] = final
    by_size = np.argsort(-size, kind="stable")
    for back in range(int(size.max(initial=0))):
        some = by_size[: np.searchsorted(-size[by_size], -back, "left")]
        row = first[some + 1] - 1 - back
        after = dist[row + some + 1]
        fine = (5 * turns.cut[row])[:, None, None]
        to = _NEXT[:, turns.role[row]].T[:, :, None]
        kept = np.take_along_axis(after, np.maximum(to, 0), 1) + np.where(to < 0, _FAR, fine)
        stays = np.minimum(kept, after[:, _DUE] + 1 + fine)
        best = np.where(turns.gone[row][:, None, None], after + 2, np.minimum(after + 2, stays))
        for _ in range(2):  # more than two inserts in a row are never cheapest
            best = np.minimum(best, best[:, _DUE] + 5)
        dist[row + some] = best
    return dist


class Audits(NamedTuple):
    """Letters of the least paths one after another, path p at ``first[p]:first[p + 1]``.

    ``row`` is the turn that a letter is about or before which a turn is inserted, ``role`` the state
    after it, ``left`` the state at a path's end.
    """

    letter: np.ndarray
    row: np.ndarray
    state: np.ndarray
    first: np.ndarray
    left: np.ndarray


def least_audits(
    turns: Turns, dist: np.ndarray, closed: np.ndarray, conv: np.ndarray, entry: np.ndarray
) -> Audits:
    """The least audits from the first level of ``conv`` in state ``entry``.

    ``closed`` marks conversations that end with their last level; others go on elsewhere.
    """
    first = turns.first
    count, levels = len(first) - 1, len(dist)
    of = np.repeat(np.arange(count), np.diff(first) + 1)  # conversation of a level
    row = np.arange(levels) - of  # at a last level: the first turn of the next conversation
    inner = np.ones(levels, bool)
    inner[first[1:] + np.arange(count)] = False
    here = np.flatnonzero(inner)
    sink = levels * 4
    state = np.arange(4)

    target = np.full((levels, 4, 4), sink)  # by letter
    price = np.full((levels, 4, 4), _FAR)
    target[here, :, 0], price[here, :, 0] = (here[:, None] + 1) * 4 + state, 2
    insert = inner | closed[of]
    target[insert, :, 1], price[insert, :, 1] = np.flatnonzero(insert)[:, None] * 4 + _DUE, 5
    stay = here[~turns.gone[row[here]]]
    fine = 5 * turns.cut[row[stay]][:, None]
    to = _NEXT[:, turns.role[row[stay]]].T
    target[stay, :, 2] = (stay[:, None] + 1) * 4 + np.maximum(to, 0)
    price[stay, :, 2] = np.where(to < 0, _FAR, fine)
    target[stay, :, 3], price[stay, :, 3] = (stay[:, None] + 1) * 4 + _DUE, 1 + fine

    target, price = target.reshape(sink, 4), price.reshape(sink, 4)
    cost = np.append(dist.reshape(sink), _FAR)
    optimal = cost[target] + price == cost[:sink, None]
    none = np.append(~optimal.any(1), True)

    # Rank by 1, 2, 4, … letters; the end has rank 0 and comes first.
    letter = np.append(optimal.argmax(1), 0)
    rank = np.where(none, 0, letter + 1)
    pointer = np.where(none, sink, np.append(target[np.arange(sink), letter[:sink]], sink))
    while (pointer != sink).any():
        _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
        pointer = pointer[pointer]

    # The arc with the least letter, then the least ranked rest.
    key = np.arange(4) * (rank.max() + 1) + rank[target]
    letter = np.append(np.where(optimal, key, key.max() + 1).argmin(1), 0)
    pointer = np.where(none, sink, np.append(target[np.arange(sink), letter[:sink]], sink))

    doubled, steps = [pointer], (~none).astype(np.int64)
    while (doubled[-1] != sink).any():
        steps = steps + steps[doubled[-1]]
        doubled.append(doubled[-1][doubled[-1]])
    begin = (first[conv] + conv) * 4 + entry
    length = steps[begin]
    starts = np.r_[0, np.cumsum(length)]
    k = np.arange(starts[-1]) - np.repeat(starts[:-1], length)
    node = np.empty(len(k), np.int64)
    node[starts[:-1][length > 0]] = begin[length > 0]
    for j, jump in enumerate(doubled):
        at = np.flatnonzero(k >> j == 1)
        node[at] = jump[node[at - (1 << j)]]
    left = begin % 4
    some = length > 0
    last = node[starts[1:][some] - 1]
    left[some] = target[last, letter[last]] % 4
    return Audits(letter[node], row[node // 4], pointer[node] % 4, starts, left)


def _role_class(role: pa.Array) -> np.ndarray:
    initial = pc.utf8_slice_codeunits(role, 0, 1)
    known = pc.fill_null(pc.index_in(initial, value_set=pa.array(["s", "u", "a"])), -1)
    return known.to_numpy(zero_copy_only=False).astype(np.int64) + 1


def _bools(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def _illegal(role: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Neighbours per conversation whose initials are not su, ua or au."""
    fits = np.zeros((4, 4), bool)
    fits[[1, 2, 3], [2, 3, 2]] = True
    wrong = np.zeros(len(role) + 1, np.int64)
    wrong[1:-1] = ~fits[role[:-1], role[1:]]
    wrong[first[:-1]] = 0
    sums = np.r_[0, np.cumsum(wrong[: len(role)])]
    return sums[first[1:]] - sums[first[:-1]]


def _counts(flag: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(flag)]
    return sums[first[1:]] - sums[first[:-1]]


def _gaps(turn: pa.Array, first: np.ndarray) -> np.ndarray:
    """Missing numbers between the least and the largest turn; null turns do not count."""
    known = turn.is_valid().to_numpy(zero_copy_only=False)
    value = pc.fill_null(turn, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))[known]
    value = value[known]  # sorted in each conversation
    out = np.zeros(len(first) - 1, np.int64)
    if len(of):
        opens = np.r_[True, of[1:] != of[:-1]]
        news = opens | np.r_[True, value[1:] != value[:-1]]
        distinct = np.bincount(of[news], minlength=len(out))
        lo, hi = value[opens], value[np.r_[opens[1:], True]]
        out[of[opens]] = hi - lo + 1
        out -= distinct
    return out


def _repeated(first: np.ndarray, digest: pa.Array) -> np.ndarray:
    """Whether the same digest was seen earlier in the conversation."""
    digests, out = digest.to_pylist(), np.zeros(first[-1], bool)
    for a, b in zip(first[:-1], first[1:], strict=True):
        seen = set()
        for i in range(a, b):
            out[i] = digests[i] in seen
            seen.add(digests[i])
    return out


def _apply(table: pa.Table, paths: Audits) -> pa.Array:
    """The turns that are left, per path, with their roles and texts."""
    kept = np.flatnonzero(paths.letter != 0)
    letter, row = paths.letter[kept], paths.row[kept]
    n = table.num_rows
    role = np.where(letter == 2, row, n + (paths.state[kept] == REPLY))
    text = np.where(letter == 1, n, row)

    def take(name: str, extra: list[str], at: np.ndarray) -> pa.Array:
        column = table.column(name).combine_chunks()
        return pa.concat_arrays([column, pa.array(extra, column.type)]).take(pa.array(at))

    turns = pa.StructArray.from_arrays(
        [take("role", ["user", "assistant"], role), take("text", [""], text)], ["role", "text"]
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(kept, paths.first), pa.int32()), turns)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the value of any key changes, with 0 and the number of rows."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in keys:
        column = table.column(name).combine_chunks()
        a, b = column[1:], column[:-1]
        same = pc.fill_null(pc.equal(a, b), False)
        both = pc.and_(a.is_null(), b.is_null())
        change |= ~_bools(pc.or_(same, both))
    return np.r_[0, np.flatnonzero(change) + 1, table.num_rows]


def _whole(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables of whole groups, and where each group begins."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < _ROWS:
            continue
        table = pa.Table.from_batches(held)
        starts = _starts(table, keys)
        if len(starts) > 2:
            yield table.slice(0, starts[-2]), starts[:-1]
            held = table.slice(starts[-2]).to_batches()
            rows = table.num_rows - starts[-2]
    if held:
        table = pa.Table.from_batches(held)
        yield table, _starts(table, keys)


def _turns(turns: DataFrame) -> DataFrame:
    """The turns with what the repair looks at; texts are read here once, in generated code."""
    own = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return own.withColumns(
        {
            "_blank": ~F.col("text").rlike(f"[^{SPACES}]"),
            "_cut": ~F.col("text").rlike(rf"[.!?][{SPACES}]*\z"),
            "_digest": F.unhex(F.sha2(whole.cast("binary"), 256)),
        }
    )


_NAMES = [part.split()[0] for part in PIECES.split(", ")]
_KEYS = ["conv_id", "block"]


def _pieces(table: pa.Table, first: np.ndarray, paths: Audits, numbers: list) -> pa.RecordBatch:
    conv = table.column("conv_id").combine_chunks().take(pa.array(first[:-1]))
    letters = np.frombuffer(LETTERS, np.uint8)[paths.letter].tobytes().decode()
    audits = [letters[a:b] for a, b in zip(paths.first[:-1], paths.first[1:], strict=True)]
    columns = [pa.array(np.asarray(n, np.int64)) for n in numbers]
    return pa.RecordBatch.from_arrays(
        [conv, *columns, pa.array(audits, pa.string()), _apply(table, paths)], names=_NAMES
    )


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, first in _whole(batches, ["conv_id"]):
        role = _role_class(table.column("role").combine_chunks())
        blank = _bools(table.column("_blank"))
        again = _repeated(first, table.column("_digest")) & ~blank
        cut = _bools(table.column("_cut")) & ~blank & ~again
        turns = Turns(role, blank | again, cut, first)
        count = len(first) - 1
        dist = costs_to_end(turns, np.broadcast_to(_CLOSE[None, :, None], (count, 4, 1)))
        every, nothing = np.arange(count), np.zeros(count, np.int64)
        paths = least_audits(turns, dist[:, :, 0], np.ones(count, bool), every, nothing)
        numbers = [
            nothing,
            nothing + 1,
            _gaps(table.column("turn").combine_chunks(), first),
            _counts(blank, first),
            _counts(again, first),
            _counts(cut, first),
            _illegal(role, first),
            dist[first[:-1] + every, START, 0],
        ]
        yield _pieces(table, first, paths, numbers)


def _flagged(table: pa.Table, first: np.ndarray) -> Turns:
    return Turns(
        _role_class(table.column("role").combine_chunks()),
        _bools(table.column("_gone")),
        _bools(table.column("_cut")),
        first,
    )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the costs from every state before it to every state behind it, and its first and
    last role class."""
    ends = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for table, first in _whole(batches, _KEYS):
        turns, count = _flagged(table, first), len(first) - 1
        dist = costs_to_end(turns, np.broadcast_to(ends, (count, 4, 4)))
        matrix = dist[first[:-1] + np.arange(count)].reshape(count, 16)
        keys = [table.column(c).combine_chunks().take(pa.array(first[:-1])) for c in _KEYS]
        yield pa.RecordBatch.from_arrays(
            [
                *keys,
                pa.array(matrix.tolist(), pa.list_(pa.int64())),
                pa.array(turns.role[first[:-1]]),
                pa.array(turns.role[first[1:] - 1]),
            ],
            names=[*_KEYS, "matrix", "opens", "closes"],
        )


def _costs_behind(group: pd.DataFrame) -> pd.DataFrame:
    """From a conversation's matrices (a row per block) the costs behind every block."""
    group = group.sort_values("block", ignore_index=True)
    behind, cost = [], _CLOSE
    for matrix in reversed(group["matrix"].tolist()):
        behind.append(cost)
        cost = np.minimum(np.asarray(matrix).reshape(4, 4) + cost, _FAR).min(1)
    group["behind"] = behind[::-1]
    group["blocks"] = len(group)
    group["before"] = np.r_[0, group["closes"].to_numpy()[:-1]]
    return group[[*_KEYS, "blocks", "before", "behind"]]


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the states behind it by the state before it, on least audits."""
    for table, first in _whole(batches, _KEYS):
        turns, count = _flagged(table, first), len(first) - 1
        at = pa.array(first[:-1])
        behind = np.array(table.column("behind").take(at).to_pylist(), np.int64)
        number, blocks = (table.column(c).to_numpy()[first[:-1]] for c in ("block", "blocks"))
        dist = costs_to_end(turns, behind[:, :, None])[:, :, 0]
        conv, entry = np.repeat(np.arange(count), 4), np.tile(np.arange(4), count)
        left = least_audits(turns, dist, number + 1 == blocks, conv, entry).left
        keys = [table.column(c).combine_chunks().take(at) for c in _KEYS]
        states = pa.array(left.reshape(count, 4).tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*keys, states], names=[*_KEYS, "states"])


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The state before every block of a conversation."""
    group = group.sort_values("block", ignore_index=True)
    entries, state = [], START
    for states in group["states"]:
        entries.append(state)
        state = int(states[state])
    group["entry"] = entries
    return group[[*_KEYS, "entry"]]


def _repair_block(rows: pa.Table, known: pa.Table) -> pa.Table:
    rows = rows.sort_by("_n")
    first = np.array([0, rows.num_rows])
    about = known.to_pylist()[0]
    turns, last = _flagged(rows, first), about["block"] + 1 == about["blocks"]
    behind = np.array(about["behind"], np.int64)
    dist = costs_to_end(turns, behind[None, :, None])[:, :, 0]
    entry = np.array([about["entry"]])
    paths = least_audits(turns, dist, np.array([last]), np.zeros(1, np.int64), entry)
    illegal = _illegal(np.r_[about["before"], turns.role], np.array([0, rows.num_rows + 1]))
    opening = 0 if about["block"] else 1  # nothing stands before the first block
    cost = dist[0, entry] - (0 if last else behind[paths.left])
    blank, again = _bools(rows.column("_blank")), _bools(rows.column("_again"))
    numbers = [
        [about["block"]],
        [about["blocks"]],
        [about["gaps"] if opening else 0],
        [blank.sum()],
        [again.sum()],
        [turns.cut.sum()],
        illegal - opening,
        cost,
    ]
    return pa.Table.from_batches([_pieces(rows, first, paths, numbers)])


def _repair_long(rows: DataFrame, block_rows: int, kind: str) -> DataFrame:
    """The pieces of conversations that do not fit a task."""
    order = ["turn", "role", "text", "_salt"]  # any number of turns may be equal, hence the salt
    placed = number_in_order(rows.withColumn("_salt", F.rand(7)), order, "_n", ["conv_id"])
    block = F.floor((F.col("_n") - 1) / block_rows).cast("long")
    placed = materialize(placed.drop("_salt").withColumn("block", block), "placed")
    firsts = placed.groupBy("conv_id", "_digest").agg(F.min("_n").alias("_at"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), "_at", F.lit(True).alias("_new"))
    new = placed["conv_id"].eqNullSafe(F.col("_conv")) & (placed["_n"] == F.col("_at"))
    again = F.col("_new").isNull() & ~F.col("_blank")
    flagged = placed.join(firsts, new, "left").select(
        *_KEYS,
        "_n",
        "turn",
        "role",
        "text",
        "_blank",
        again.alias("_again"),
        (F.col("_blank") | again).alias("_gone"),
        (F.col("_cut") & ~F.col("_blank") & ~again).alias("_cut"),
    )
    flagged = materialize(flagged, "flagged")
    steps = flagged.select(*_KEYS, "_n", F.substring("role", 1, 1).alias("role"), "_gone", "_cut")

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "_n")

    def joined(df: DataFrame, other: DataFrame) -> DataFrame:
        """Equal conversation and block, of both the same where ``other`` has blocks."""
        named = other.withColumnsRenamed({"conv_id": "_conv", "block": "_block"})
        same = df["conv_id"].eqNullSafe(named["_conv"])
        if "block" in other.columns:
            same = same & (df["block"] == named["_block"])
        return df.join(named, same).drop("_conv", "_block")

    key = f"conv_id {kind}, block long"
    matrices = in_blocks(steps).mapInArrow(
        _matrices, f"{key}, matrix array<long>, opens long, closes long"
    )
    behind = matrices.groupBy("conv_id").applyInPandas(
        _costs_behind, f"{key}, blocks long, before long, behind array<long>"
    )
    behind = materialize(behind, "behind")
    exits = in_blocks(joined(steps, behind.drop("before"))).mapInArrow(
        _exits, f"{key}, states array<long>"
    )
    entries = exits.groupBy("conv_id").applyInPandas(_entries, f"{key}, entry long")
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = flagged.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).alias("gaps"))
    known = materialize(joined(joined(behind, entries), gaps), "known")
    pairs = flagged.groupBy(*_KEYS).cogroup(known.groupBy(*_KEYS))
    return pairs.applyInArrow(_repair_block, PIECES.format(id=kind))


class Repaired(NamedTuple):
    """Pieces of conversations: ``whole`` has one per conversation, ``split`` (or None) several."""

    whole: DataFrame
    split: DataFrame | None

    def pieces(self) -> DataFrame:
        return self.whole if self.split is None else self.whole.unionByName(self.split)


def repair(turns: DataFrame, long: int = LONG) -> Repaired:
    """``conv_id, turn, role, text`` repaired, in pieces of at most ``long`` turns.

    Per piece: ``block`` (from 0) of ``blocks``, what was found (``gaps, blank, duplicate, truncated,
    illegal``), ``cost``, ``audit`` and ``repaired``, the turns that are left. Numbers of a
    conversation's pieces add up, its audits and turns follow one another.
    """
    rows = _turns(turns)
    kind = turns.schema["conv_id"].dataType.simpleString()
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("turns"))
    large = materialize(sizes.where(F.col("turns") > long).select("conv_id"), "large")
    schema = PIECES.format(id=kind)

    def whole(df: DataFrame) -> DataFrame:
        ordered = df.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        return ordered.mapInArrow(_repair_whole, schema)

    if large.isEmpty():
        return Repaired(whole(rows), None)
    large = large.withColumnRenamed("conv_id", "_conv")  # planned by its size
    same = rows["conv_id"].eqNullSafe(large["_conv"])
    split = _repair_long(rows.join(large, same, "left_semi"), long, kind)
    return Repaired(whole(rows.join(large, same, "left_anti")), materialize(split, "split"))


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    conv, digest, empty, names = None, None, True, ["conv_id", "repaired_sha256"]

    def done(kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array([conv[0]], kind), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=names)

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for own, turns in zip(batch["conv_id"].to_pylist(), batch["repaired"], strict=True):
            if conv != (own,):
                if conv:
                    yield done(kind)
                conv, digest, empty = (own,), hashlib.sha256(), True
            for t in turns.as_py():
                digest.update(("" if empty else "\n").encode())
                digest.update(f"{t['role']}:{t['text']}".encode())
                empty = False
    if conv:
        yield done(kind)


def digests(repaired: Repaired) -> DataFrame:
    """Per conversation its sums, its audit and ``repaired_sha256`` of its ``role:text`` lines.

    A conversation of one piece needs no shuffle. SHA-256 can only be taken in order: the lines of a
    longer one pass through one task, piece by piece, and only a digest is held there.
    """
    line = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    digest = F.sha2(F.array_join(line, "\n").cast("binary"), 256).alias("repaired_sha256")
    short = repaired.whole.select("conv_id", *sums, "audit", digest)
    more = repaired.split
    if more is None:
        return short
    kind = more.schema["conv_id"].dataType.simpleString()
    hashed = (
        more.select("conv_id", "block", "repaired")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block")
        .select("conv_id", "repaired")
        .mapInArrow(_hash_pieces, f"conv_id {kind}, repaired_sha256 string")
        .withColumnRenamed("conv_id", "_conv")
    )
    audit = F.array_sort(F.collect_list(F.struct("block", "audit")))["audit"]
    totals = more.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in sums], F.array_join(audit, "").alias("audit")
    )
    joined = totals.join(hashed, totals["conv_id"].eqNullSafe(hashed["_conv"])).drop("_conv")
    return short.unionByName(joined)
