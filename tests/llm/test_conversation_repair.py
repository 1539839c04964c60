from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from recordtrust.llm import conversation_repair as repair
from recordtrust.sources.workspace import Workspace

WORDS = re.compile("[^\x20\x09-\x0d]")
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = WORDS.findall(text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def best(rows):
    """Least (cost, audit, repaired) by best-first search over (rows read, last initial)."""
    found, done = faults(rows), set()
    queue = [(0, "", 0, "", ())]
    while queue:
        cost, audit, at, state, made = heapq.heappop(queue)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, made
        if (at, state) in done:
            continue
        done.add((at, state))
        steps = [(5, "I", 0, role, (role, "")) for role in ("user", "assistant")]
        if at < len(rows):
            role, text = rows[at]
            steps.append((2, "D", 1, None, None))
            if found[at] not in ("blank", "duplicate"):
                more = 5 if found[at] else 0
                steps.append((more, "K", 1, role, (role, text)))
                steps += [(1 + more, "R", 1, to, (to, text)) for to in ("user", "assistant")]
        for price, edit, read, role, row in steps:
            to = state if role is None else STEPS.get((state, role[:1]))
            if to is not None:
                heapq.heappush(queue, (cost + price, audit + edit, at + read, to, made + ((row,) if row else ())))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def brute(rows, after):
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in after if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [r[2:] for r in own]
        found = faults(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        cost, audit, made = best(pairs)
        text = "\n".join(f"{a}:{b}" for a, b in made)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string, n int, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d") for r in rows], SCHEMA)


def some_rows(seed, n, longest=9):
    rng, out = random.Random(seed), []
    for conv in range(n):
        turn = rng.randrange(3)
        for _ in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hi.", "Hi", "Why?", " \n", "", None, "é€! \t", "é€😀", "ok.\x0b", "a. "])
            out.append((conv if conv else None, rng.choice([turn, None]) if rng.random() < 0.1 else turn, role, text))
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
    return out


@pytest.mark.parametrize("seed, longest", [(1, 6), (2, 14)])
def test_digests_against_brute_force(spark, seed, longest):
    rows = some_rows(seed, 250, longest)
    given = frame(spark, rows)
    with Workspace(spark) as space:
        found = repair.repair_digests(given, repair.damaged(given), space)
        assert found.columns == COLUMNS
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows, damage(rows))


def test_repaired_rows(spark):
    rows = [(a, b, c or " ", d or " ") for a, b, c, d in some_rows(3, 120)]
    with Workspace(spark) as space:
        found = repair.repair(frame(spark, rows), space).collect()
    texts = {}
    for r in sorted(found, key=lambda r: (str(r.conv_id), r.at)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    wanted = {r[0]: r[-1] for r in brute(rows, rows)}
    empty = hashlib.sha256(b"").hexdigest()
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in texts.items()} == {k: v for k, v in wanted.items() if v != empty}


def test_long_conversation_in_pieces(spark):
    """A conversation over all tasks, and one text in very many of its turns."""
    rng = random.Random(4)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["Again.", f"No {t}.", f"cut {t}"])) for t in range(1500)]
    rows += [(5, 9000, "user", "Same.")] * 700 + some_rows(6, 30)
    with Workspace(spark) as space:
        found = repair.repair_digests(frame(spark, rows), frame(spark, [r for r in damage(rows)]), space)
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows, damage(rows))


def test_lost_and_empty(spark):
    lost = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Gone.")]
    given = frame(spark, rows)
    with Workspace(spark) as space:
        found = repair.repair_digests(given, repair.damaged(given), space).collect()
        assert list(map(tuple, found)) == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
        assert repair.repair_digests(given.limit(0), given.limit(0), space).count() == 0


def test_any_split_gives_the_same_cells():
    rng = random.Random(8)
    for _ in range(200):
        spans = [repair.row_cells(rng.choice(["s", "u", "a", ""]), rng.random() < 0.3, rng.random() < 0.3, rng.randrange(3)) for _ in range(rng.randrange(1, 8))]
        whole, folded = repair.parse_block(spans), spans[0]
        for x in spans[1:]:
            folded = repair.join(folded, x)
        assert whole == folded


def test_whole_table(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    with Workspace(spark) as space:
        found = repair.repair_digests(given, repair.damaged(given), space)
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows, damage(rows))
