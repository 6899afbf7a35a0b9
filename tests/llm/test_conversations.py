"""The prefix trie against brute force in plain Python and against SQL."""

import hashlib
import math
import random
from collections import defaultdict
from zlib import crc32

import pytest

from tessera.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), digest, (role or "", text or "")))
    own = {c: [t for *_, t in sorted(turns)] for c, turns in own.items()}
    again = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        again[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in again.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    ends = lambda node: ",".join(str(c) for c in sorted(c for c in members[node] if again[c] == node))
    return sorted(
        (
            (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node], saved[node], hashlib.sha256(ends(node).encode()).hexdigest())
            for node, m in members.items()
        ),
        key=repr,
    )


def run(spark, rows):
    found = C.trie(spark.createDataFrame(rows, SCHEMA)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def made(seed, convs=60, most=7):
    pick = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = pick.choice([pick.randrange(0, 400), pick.randrange(0, 5), 100 * pick.randrange(5)])
        for t in range(pick.randint(1, most)):
            rows.append((c, pick.choice([t, t, None]), pick.choice(["u", "a", None, ""]), pick.choice(["x", "x", "yy", None, "é\U0001f600"])))
    return rows


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, compare, sf):
    assert compare(spark, C.op12_conversation_trie, C.SQL, f"/root/testdata/sf{sf}")


def test_made_conversations(spark):
    rows = made(1)
    assert run(spark, rows) == brute(rows)


def test_blocks(spark, monkeypatch):
    """Long conversations are worked out block by block; ends are joined by the piece."""
    monkeypatch.setattr(C, "BLOCK", 3)
    monkeypatch.setattr(C, "IDS", 2)
    rows = made(2, 40, 30)
    rows += [(c, t, "u", "same") for c in (700, 701, 1, 2, 3, 4) for t in range(14)]
    assert run(spark, rows) == brute(rows)


def test_chains_that_hang_on_chains(spark):
    """Each conversation goes on from the one before it and branches off later."""
    rows = [(100 * c, t, "u", f"t{t}" if t < c else f"own {c}") for c in range(1, 14) for t in range(c + 1)]
    assert run(spark, rows) == brute(rows)


def test_copies_ties_nulls_and_a_hot_conversation(spark):
    rows = [(c, t, "user", "hello" * t) for c in range(0, 300) for t in range(2)]  # a hot first turn, many ends
    rows += [(7, t, "user", "long") for t in range(400)]
    rows += [(None, 0, "user", "of nobody")] * 3 + [(350, None, None, None)] * 4 + [(351, 1, "a", "b")] * 2
    rows += [(-5, 0, "a", "negative"), (10**15, 0, "é", "far")]
    assert run(spark, rows) == brute(rows)


def test_one_turn_empty_table_and_extra_columns(spark):
    assert run(spark, [(100, 0, "u", "x")]) == brute([(100, 0, "u", "x")])
    assert run(spark, []) == [] and run(spark, [(None, 1, "u", "x")]) == []
    df = spark.createDataFrame([(100, 0, "u", "x", 1, "d", 5), (101, 0, "u", "x", 2, "e", 6)], SCHEMA + ", depth int, digest string, pos int")
    assert C.trie(df).count() == len(brute([(100, 0, "u", "x"), (101, 0, "u", "x")]))


def test_no_folder_is_left_but_the_result(spark):
    import os

    from tessera.staging import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert run(spark, made(3))
    assert {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before} == {"conversation-nodes"}
