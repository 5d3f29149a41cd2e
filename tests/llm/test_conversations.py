"""Repairs against a uniform-cost search over whole edit strings."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from railmill.llm import conversations
from railmill.llm.conversations import Costs, damaged, repair_report, repaired_turns, walk

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def order(row):
    return row[1] is not None, row[1] or 0, row[2], hashlib.sha256(row[3].encode()).digest()


def report(own):
    """Of one conversation's rows in order: the report and the repaired lines."""
    turns = [r[1] for r in own if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in own:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in own]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(own) and state in ("", "a"):
            break
        then = NEXT[state]
        heapq.heappush(heap, (cost + 2, audit + "I", i, then, (*lines, FULL[then] + ":")))
        if i == len(own):
            continue
        _, _, role, text = own[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
        if faults[i] not in ("b", "d"):
            more = faults[i] == "t"
            heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, then, (*lines, FULL[then] + ":" + text)))
            if role[:1] == then or (state == "" and role[:1] == "s"):
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*lines, role + ":" + text)))
    counts = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit)
    return (*counts, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def brute(rows, damage):
    ids, after = {r[0] for r in rows}, []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        after += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: report(sorted((r for r in after if r[0] == c), key=order)) for c in ids}


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def made(seed, conversations_, longest, turns=40):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \t", "So?", "And then.", "ok.  ", None, "漢字。"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "ai", "uncle"]
    rows = []
    for c in range(conversations_):
        for _ in range(rng.randrange(1, longest)):
            rows.append((c if c else None, rng.choice([None, *range(turns)]), rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.fixture(params=["whole", "sections"])
def sections(request, monkeypatch):
    """Conversations in one section, or cut into sections of two or three turns."""
    if request.param == "sections":
        monkeypatch.setattr(conversations, "SECTION", 2)
        monkeypatch.setattr(conversations, "isqrt", lambda n: 3)


def test_equals_brute_force(spark, sections):
    rows = made(1, 30, 14) + made(2, 1, 60)
    df = frame(spark, rows).withColumns({c: F.lit("x") for c in ("key", "digest", "code", "id", "section")})
    want = brute(rows, damage=False)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(df).collect()}
    assert got == {c: found for c, (found, _) in want.items()}
    told = {}
    for r in repaired_turns(df).orderBy("conv_id", "number").collect():
        told.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["number"] == len(told[r["conv_id"]]) - 1
    assert told == {c: list(lines) for c, (_, lines) in want.items() if lines}


def test_damage_and_conversations_without_rows(spark, sections):
    rows = made(3, 25, 9) + [(500 + n, 0, "user", "Gone?") for n in range(60)]
    df = frame(spark, rows)
    want = {c: found for c, (found, _) in brute(rows, damage=True).items()}
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(damaged(df), every=df).collect()}
    assert got == want
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want.values()


def test_repeated_rows_and_one_long_conversation(spark, sections):
    rows = [(7, 3, "user", "Again.")] * 50 + [(7, 4, "assistant", "Once.")] + [(7, n, "user", f"Line {n % 40}.") for n in range(5, 300)]
    got = [tuple(r)[1:] for r in repair_report(frame(spark, rows)).collect()]
    assert got == [report(sorted(rows, key=order))[0]]


def test_empty_table(spark):
    assert repair_report(frame(spark, [])).collect() == [] == repaired_turns(frame(spark, [])).collect()


def test_checkpoints_and_one_block_are_all_that_is_held():
    rng = random.Random(4)
    turns = [(rng.choice([1, 2, 3, 2, 3, 0]) | rng.choice([0, 0, 4, 8, 16]), rng.choice([1, 1, 3])) for _ in range(900)]
    costs = Costs()
    vector, vectors = conversations._END, []
    for turn in reversed(turns):
        vectors.append(vector)
        vector = costs.before(*turn, vector)
    total, state = 0, 0
    for (code, copies), (letters, before) in zip(turns, walk(turns, 0, conversations._END, costs)):
        assert before == state
        for letter in letters:
            if letter == "I":
                state = conversations._NEXT[state]
            elif letter == "K":
                state = conversations._KEEP[state][code & 3]
            elif letter == "R":
                state = conversations._NEXT[state]
        total += 3 * letters.count("D") + 2 * letters.count("I") + 2 * letters.count("R")
        total += 1 if code & 8 and ("K" in letters or "R" in letters) else 0
    assert total + conversations._END[state] == vector[0]
