"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from ledgerlake.llm import queries, trie

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
SCHEMA = "conv_id long, turn long, role string, text string, c long, depth int, size string"


def slow_trie(rows):
    def digest(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = turns.get(base, [])[:h] + turns[c][h:]
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    below = {k: [0, 0, 0] for k in nodes}  # children, leaves, saved
    for k in nodes:
        if k:
            below[k[:-1]][0] += 1
    for k, members in nodes.items():
        own_saving = (len(members) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            below[k[:d]][1] += below[k][0] == 0
            below[k[:d]][2] += own_saving
    out = set()
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if built[c] == list(k))))
        parent = min(nodes[k[:-1]]) if k else None
        out.add((min(members), len(k), parent, len(members), *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(df):
    rows = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def test_findclose_against_a_stack():
    rng = random.Random(3)
    for size in (1, 7, 300, 2500):
        bits, depth, left = [], 0, size
        while left or depth:
            if left and (depth == 0 or rng.random() < 0.55):
                bits.append(1)
                depth, left = depth + 1, left - 1
            else:
                bits.append(0)
                depth -= 1
        stack, closes = [], {}
        for k, b in enumerate(bits):
            if b:
                stack.append(k)
            else:
                closes[stack.pop()] = k
        for block in (2, 16, 256):
            tree = trie.Parentheses(np.array(bits, bool), block)
            assert {k: tree.findclose(k) for k in closes} == closes


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-12, 90), 70):
        for turn in range(rng.choice([1, 2, 5, 9, 14])):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", None, "a"]), rng.choice(["", "é", "x y", None])))
    rows += [(500 + 5 * k, t, "user", f"same {t}") for k in range(12) for t in range(12)]  # copies
    rows += [(1000, t, "user", "long") for t in range(300)] + [(1001, t, "user", "long") for t in range(250)]  # a long shared path
    rows += [(None, 1, "user", "nobody's"), (3000, None, None, None), (3000, None, None, None), (2004, 1, "u", "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], SCHEMA).repartition(5)
    assert found(trie.prefix_trie(df)) == slow_trie(rows)


def test_no_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 1, 1, "")], SCHEMA)).count() == 0


@needs_data
def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_trie(spark, SF_DIR)) == slow_trie(rows)
