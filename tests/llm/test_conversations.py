"""Conversation repair against a plain recursion over (cost, audit)."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from kinfold.llm import conversations
from kinfold.llm.queries import QUERIES, damaged_turns, op13_conversation_repair
from tests.llm.conftest import SF

AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """One conversation's ``(turn, role, text)`` in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if body[-1] in ".!?" else "truncated"))
        seen.add((role, text))

    @lru_cache(None)
    def best(i, last, inserts):
        found = []
        due = "a" if last == "u" else "u"
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            cost, audit, out = best(i + 1, last, 0)
            found.append((cost + 2, "D" + audit, out))
            if faults[i] in ("", "truncated"):
                fine = 5 if faults[i] else 0
                to = AFTER.get((last, role[:1]))
                if to:
                    cost, audit, out = best(i + 1, to, 0)
                    found.append((cost + fine, "K" + audit, (f"{role}:{text}", *out)))
                name = "assistant" if due == "a" else "user"
                cost, audit, out = best(i + 1, due, 0)
                found.append((cost + fine + 1, "R" + audit, (f"{name}:{text}", *out)))
        if inserts < 3:
            name = "assistant" if due == "a" else "user"
            cost, audit, out = best(i, due, inserts + 1)
            found.append((cost + 5, "I" + audit, (f"{name}:", *out)))
        return min(found, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def plain(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: plain_repair(sorted(own, key=order)) for c, own in groups.items()}


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 13])):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "Why?", "cut off", "", " \n", "a. ", "b! \t", None, "Ünï."])
            number = rng.choice([turn, turn, turn, turn + 1, None])
            rows.append((conv, number, role, text))
    return rows


@pytest.mark.parametrize("long", [10_000, 4, 1])
def test_repair_of_whole_and_of_split_conversations(spark, turns, long):
    df = spark.createDataFrame([(*r, 7) for r in turns], SCHEMA + ", block int").repartition(3)
    repaired = conversations.repair(df, long)
    assert got(conversations.digests(repaired)) == plain(turns)
    pieces = repaired.pieces().collect()
    assert all(len(p.audit) <= 3 * long + 2 for p in pieces)
    assert {(p.conv_id, p.block) for p in pieces if p.blocks == 1} == {
        (p.conv_id, 0) for p in pieces if p.blocks == 1
    }


def test_one_conversation_of_many_equal_turns(spark):
    rows = [(1, 1, "user", "same.")] * 300 + [(1, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(2, 300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(conversations.digests(conversations.repair(df, 50))) == plain(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(df).pieces().count() == 0


def damaged(rows):
    out, convs = [], set()
    for conv, turn, role, text in rows:
        convs.add(conv)
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out, convs


def test_query_equals_the_recursion(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt, convs = damaged(rows)
    want = plain(hurt)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want |= {c: nothing for c in convs if c not in want}
    assert got(op13_conversation_repair(spark, SF)) == want
    assert "op13_conversation_repair" in QUERIES


def test_damage_takes_nulls_as_a_space(spark, turns):
    df = damaged_turns(spark.createDataFrame(turns, SCHEMA))
    kept = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect() if r.fault not in (0, 3)]
    key = lambda r: tuple(map(str, r))
    want = [r for r in damaged(turns)[0]]
    assert set(kept) <= set(want) and len(kept) <= len(want)
    assert sorted(set(map(key, kept)))
