"""Conversation repair against a plain search from the back, persistent strings against Python's, and the edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import dialogue

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string"


def brute(rows):
    """The whole result of one conversation, from its ``(turn, role, text)`` rows."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults = []
    for i, (_, role, text) in enumerate(rows):
        body = text.strip(dialogue.WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in [r[1:] for r in rows[:i]]
                      else "" if body[-1] in ".!?" else "truncated")
    ok = re.compile(r"(s?(ua)+)?\Z")

    @lru_cache(maxsize=None)
    def live(spelt):
        return any(ok.match(spelt + end) for end in ("", "u", "a", "ua", "au", "aua"))

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        """Cheapest edits from row ``i``; ``state`` is enough of the spelling so far: '', s, u or a."""
        spelt = {"": "", "s": "s", "u": "u", "a": "ua"}[state]
        found = []
        if i == len(rows) and ok.match(spelt):
            found.append((0, "", ()))
        steps = [("I", c, 3, (f"{'user' if c == 'u' else 'assistant'}:",)) for c in "ua"] if inserts < 4 else []
        if i < len(rows):
            _, role, text = rows[i]
            extra = 3 if faults[i] == "truncated" else 0
            steps.append(("D", "", 4, ()))
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] in ("s", "u", "a"):
                    steps.append(("K", role[0], extra, (f"{role}:{text}",)))
                steps += [("R", c, 3 + extra, (f"{'user' if c == 'u' else 'assistant'}:{text}",)) for c in "ua"]
        for letter, c, cost, lines in steps:
            if c and not live(spelt + c):
                continue
            rest = best(i + (letter != "I"), c or state, inserts + 1 if letter == "I" else 0)
            if rest:
                found.append((cost + rest[0], letter + rest[1], (*lines, rest[2]) if lines else rest[2]))
        return min(found, key=lambda f: f[:2], default=None)

    for i in reversed(range(len(rows) + 1)):  # from the back, so that the recursion stays flat
        for inserts in reversed(range(5)):
            for state in ("", "s", "u", "a"):
                best(i, state, inserts)
    cost, audit, rest = best(0, "", 0)
    lines = []
    while rest:
        lines.append(rest[0])
        rest = rest[1]
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talk(rng, n):
    rows = []
    for _ in range(n):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "under"])
        text = rng.choice(["Yes.", "No!", "Why? ", "cut off", "", " \n", None, "a b. c", "so.\n", "é?", "x" * 30 + "."])
        rows.append((rng.choice([None, *range(n + 3)]), role, text))
    return rows


def check(spark, talks, partitions=3):
    rows = [(i, *r, "extra") for i, t in talks.items() for r in t]
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = {r[0]: tuple(r)[1:] for r in dialogue.repair(df).collect()}
    assert got == {i: brute(t) for i, t in talks.items()}
    return df, got


def test_equals_plain_search(spark):
    rng = random.Random(13)
    check(spark, {None if i == 7 else i: talk(rng, rng.randrange(1, 9)) for i in range(400)})


def test_long_conversations_span_pieces(spark):
    rng = random.Random(23)
    long = [(k, ["user", "assistant"][k % 2] if rng.random() < 0.9 else "tool", f"{k}." if rng.random() < 0.9 else f"{k}")
            for k in range(2400)]
    talks = {1: talk(rng, 5), 2: long, 3: talk(rng, 6), 4: [(5, "user", "same.")] * 1500, 5: [(None, "user", f"{k}.") for k in range(1100)]}
    want = {i: brute(t) for i, t in talks.items()}
    df = spark.createDataFrame([(i, *r, "") for i, t in talks.items() for r in t], SCHEMA).repartition(6)
    got = {r[0]: tuple(r)[1:] for r in dialogue.repair(df).collect()}
    for i in talks:
        assert got[i][:6] == want[i][:6], i
        assert got[i] == want[i], i
    lines = {}
    for r in dialogue.repaired(df).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    assert {i: dialogue.digest(iter(x)) for i, x in lines.items()} == {i: got[i][-1] for i in lines}
    assert all(got[i][-1] == hashlib.sha256(b"").hexdigest() for i in set(talks) - set(lines))


@pytest.mark.parametrize("modulus", [dialogue.MODULUS, 1, 3, 17])
def test_persistent_strings(modulus):
    """With a small modulus most hashes collide; results stay right."""
    rng = random.Random(modulus)
    trails, texts = dialogue.Trails(modulus), [""]
    for _ in range(300):
        base = rng.randrange(len(texts))
        letter = rng.choice("DIK")
        texts.append(texts[base] + letter)
        assert trails.add(base, letter) == len(texts) - 1
    for _ in range(3000):
        a, b = rng.randrange(301), rng.randrange(301)
        assert trails.less(a, b) == (texts[a] < texts[b])
        assert trails.text(trails.prefix(a, len(texts[a]) // 2)) == texts[a][:len(texts[a]) // 2]


def test_search_does_not_depend_on_hashes():
    rng = random.Random(33)
    for _ in range(100):
        rows = [dialogue.Row(None, r or " ", x or " ", rng.choice(["", "", "cut", "blank"])) for _, r, x in talk(rng, 12)]
        plain, colliding = dialogue.Search(), dialogue.Search(1)
        assert plain.finish(plain.run(rows)) == colliding.finish(colliding.run(rows))


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dialogue.repair(empty).collect() == [] and dialogue.repaired(empty).collect() == []
    nothing = hashlib.sha256(b"").hexdigest()
    df = spark.createDataFrame([(1, 1, "user", "Hi.", None), (2, None, None, None, None), (3, 4, "user", "A" * 3_000_000 + ".", "x"),
                                (3, 4, "assistant", "B.", "x")], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in dialogue.repair(df, copies=F.when(F.col("conv_id") == 1, 0).otherwise(1)).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", nothing) and got[2] == (0, 1, 0, 0, 0, 4, "D", nothing)
    assert got[3] == brute([(4, "user", "A" * 3_000_000 + "."), (4, "assistant", "B.")])
