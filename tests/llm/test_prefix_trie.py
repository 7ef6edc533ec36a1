import hashlib
import random
import zlib

from cubagem.llm import prefix_trie
from cubagem.llm.prefix_trie import build_trie

SCHEMA = "conv_id long, turn int, role string, text string, depth int"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(t)] for c, t in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        subtree = [x for x in members if x[: len(node)] == node]
        children = [x for x in subtree if len(x) == len(node) + 1]
        leaves = [x for x in subtree if not any(len(y) > len(x) and y[: len(x)] == x for y in subtree)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in subtree if x)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, digest))
    return sorted(out, key=str)


def found(spark, rows, partitions=3):
    frame = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in build_trie(frame).collect()), key=str)


def conversations(seed, n, long=20):
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        if rng.random() < 0.1:
            continue
        for turn in range(rng.choice([1, 2, 5, long])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "é"])))
    return rows


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    rows = conversations(1, 60)
    assert found(spark, rows) == brute(rows)


def test_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HOT", 3)
    turns = [("user", "hello"), ("assistant", "yes"), ("user", "more"), ("assistant", "no"), ("user", "end")]
    rows = [(c, t, r, x) for c in range(0, 90) for t, (r, x) in enumerate(turns[: 3 + c % 3])]
    rows += [(1000, t, "user", f"turn {t}") for t in range(200)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (5, None, "user", "first"), (5, 0, None, None), (5, 0, "user", "b"), (5, 0, "user", "a"), (5, 0, "user", "a"),
        (6, 3, "user", "x" * 5000), (7, 0, None, ""), (None, 0, "user", "nobody"), (2**63 - 1, 0, "user", "last"),
        (-(2**63), 0, "user", "least"), (9, 0, "user", "only"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, 1, "a", "b")]) == []
