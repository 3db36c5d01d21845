from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from tidewell.llm import conversations

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}  # which initials may follow the last one


def slow_repair(rows: list[tuple[str, str]]) -> tuple:
    """Faults, and the cheapest edits by plain recursion over rows and last initial."""
    seen, faults = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    @cache
    def best(i: int, last: str, inserted: int) -> tuple[int, str, tuple]:
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 2:
            for role in ("user", "assistant"):
                if role[0] in NEXT[last]:
                    c, s, out = best(i, role[0], inserted + 1)
                    options.append((c + 3, "I" + s, (f"{role}:", *out)))
        if i < len(rows):
            role, text = rows[i]
            c, s, out = best(i + 1, last, 0)
            options.append((c + 4, "D" + s, out))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                if role[:1] and role[0] in NEXT[last]:
                    c, s, out = best(i + 1, role[0], 0)
                    options.append((c + more, "K" + s, (f"{role}:{text}", *out)))
                for new in ("user", "assistant"):
                    if new[0] in NEXT[last]:
                        c, s, out = best(i + 1, new[0], 0)
                        options.append((c + 3 + more, "R" + s, (f"{new}:{text}", *out)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    counts = tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
    return (*counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def slow_query(table: list[tuple]) -> dict:
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
            rows += [(turn, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *slow_repair([r[1:] for r in rows]))
    return out


def make_table() -> list[tuple]:
    rnd, rows = random.Random(12), []
    for conv in range(120):
        for turn in range(rnd.randint(1, 9)):
            role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.4 else "user" if turn % 2 else "assistant"
            role = "system" if turn == 0 and rnd.random() < 0.4 else rnd.choice(["tool", None, "", "System"]) if rnd.random() < 0.06 else role
            text = rnd.choice(["Yes.", "No!", "Why? ", "cut off", " \n", None, "", "é.\x0b", "fine.\x1c", f"text {rnd.random()}."])
            rows.append((conv, None if rnd.random() < 0.05 else turn + (turn > 4), role, text))
    rows += [rows[3], rows[3], (None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 2, "assistant", "x" * 100_000)]
    one = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:7".encode()) % 20 == 0)
    return [*rows, (one, 7, "user", "dropped.")]


SCHEMA = "conv_id long, turn long, role string, text string, audit string, place int"


def test_query_equals_recursion(spark):
    table = make_table()
    original = spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.digest(original, conversations.repair(conversations.damage(original))).collect()}
    want = slow_query(table)
    assert got.keys() == want.keys()
    for conv, row in want.items():
        assert got[conv] == row, conv
    assert sum(x[6] == "" for x in want.values()) >= 1


def test_one_conversation_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", 7)
    rnd = random.Random(4)
    rows = [(1, i, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "cut", "No.", f"{i}.", f"{i}"])) for i in range(200)]
    found = conversations.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(5))
    (r,) = found.conversations.collect()
    *counts, sha = slow_repair([x[2:] for x in rows])
    assert [r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit] == counts
    lines = [f"{x.role}:{x.text}" for x in found.turns.orderBy("place").collect()]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == sha == conversations.text_hashes(found.turns).first().repaired_sha256


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.digest(empty, conversations.repair(empty)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 10, 50])
def test_checkpoints_change_nothing(n):
    rnd, work = random.Random(n), conversations.Repairer()
    for _ in range(50):
        letters = [rnd.randrange(16) for _ in range(n)]
        cost, edits = work.repair(letters)
        at, total = work.end, 0
        for x in reversed(letters):
            at, more = work.back(at, x)
            total += more
        price = sum({"D": 4, "I": 3, "R": 3, "K": 0}[e] for e in "".join(edits))
        price += sum(3 for x, e in zip(letters, edits[:n], strict=True) if x >> 2 == 3 and e[-1] != "D")
        assert cost == total + work.vectors[at][0] == price
