"""Conversation repair against a plain search over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from seatracks.llm import conversation_repair as R

COLUMNS = "conv_id long, turn long, role string, text string, _c string, n long, audit int"


def damage(data):
    out = []
    for conv, turn, role, text, *_ in data:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def best(rows):
    """Cost, audit and output of the cheapest repair, by all suffixes from every state."""
    role_of, nxt = {0: "user", 1: "user", 2: "assistant", 3: "user"}, {0: 2, 1: 2, 2: 3, 3: 2}
    after = {0: (0, "", ()), 3: (0, "", ()), 2: (3, "I", (("assistant", ""),)), 1: (6, "II", (("user", ""), ("assistant", "")))}
    for fault, role, text in reversed(rows):
        own = {}
        for s in range(4):
            put = lambda cost, letter, line, to: (cost + after[to][0], letter + after[to][1], line + after[to][2])
            c = [put(4, "D", (), s)]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
                if to is not None:
                    c.append(put(more, "K", ((role, text),), to))
                c.append(put(3 + more, "R", ((role_of[s], text),), nxt[s]))
            own[s] = min(c)
        full = dict(own)
        for _ in range(3):
            full = {s: min(own[s], (3 + full[nxt[s]][0], "I" + full[nxt[s]][1], ((role_of[s], ""),) + full[nxt[s]][2])) for s in range(4)}
        after = full
    return after[0]


def brute(data):
    rows = damage(data)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), turn, text))
    out = []
    for conv in {r[0] for r in data}:
        mine, seen, faults = sorted(convs[conv]), set(), []
        for _, _, role, _, _, text in mine:
            core = text.strip(" \t\n\x0b\f\r")
            faults.append(("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated", role, text))
            seen.add((role, text))
        turns = [m[4] for m in mine if m[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = best(faults)
        initials = [m[2][:1] for m in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        count = lambda f: sum(x[0] == f for x in faults)
        out.append((repr(conv), gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((repr(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect())


def table(rng, convs, most):
    data = []
    for c in range(convs):
        for t in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", "", " \n\t", "same.", "Ω long.", None, f"text {rng.randrange(9)}. \n", "one\ntwo."])
            data.append((c, rng.choice([t, t, t, t + 3, None, t // 2]), role, text, "x", 1, 2))
    return data


@pytest.mark.parametrize("block", [64, 4])
def test_equals_search(spark, monkeypatch, block):
    monkeypatch.setattr(R, "LEAST_BLOCK", block)
    rng = random.Random(block)
    data = table(rng, 150, 14) + [(None, t, "user", "No id.", "x", 1, 2) for t in range(3)]
    data += [(9000, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{t}.", f"{t}"]), "x", 1, 2) for t in range(700)]
    data += [(5, t, "user", "Hot.", "x", 1, 2) for t in range(200)]
    assert got(R.damaged_and_repaired(spark.createDataFrame(data, COLUMNS))) == brute(data)


def test_long_texts_lost_conversations_and_empty_tables(spark):
    lost = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    data = [(lost, 0, "user", "Gone."), (1, 0, "user", "word " * 400_000 + "end."), (1, 1, "assistant", "é" * 300_000)]
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("_at", "_b", "_f", "cost")})
    assert got(R.damaged_and_repaired(docs)) == brute(data)
    assert R.damaged_and_repaired(docs.limit(0)).count() == R.repaired(docs.limit(0)).count() == 0


def test_sums_of_blocks_agree_with_the_whole():
    rng = random.Random(3)
    symbols = [rng.choice("012") + rng.choice(["s", "u", "a", "t", ""]) for _ in range(60)]
    halves = R.checkpoints([R.summed(symbols[:25]), R.summed(symbols[25:])])
    assert halves[-1][0] == R.checkpoints([R.summed(symbols)])[-1][0]
