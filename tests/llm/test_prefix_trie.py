"""The conversation trie against plain Python, over many small shards, deep conversations and odd rows."""

import hashlib
import random
import zlib

import pytest

from scorewright.llm import prefix_trie
from scorewright.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role, digest, text))
    return {c: [(x[1], x[3]) for x in sorted(v)] for c, v in convs.items()}


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = seqs.get(c - c % 5, [])[:h] + own[h:]
    return out


def nodes(seqs):
    members, kids = {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        below, m = kids.get(k, []), members[k]
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = sum(saved[x] for x in below) + ((len(m) - 1) * len(k[-1][1].encode()) if k else 0)
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(below), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def random_rows(seed, convs, texts, longest):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        rows += [(c * 3 % 1000, i, draw.choice(["user", "assistant", None]) if i else "system", draw.choice(texts)) for i in range(draw.randint(1, longest))]
    return rows


@pytest.mark.parametrize("shard", [3, 10**6])
@pytest.mark.parametrize("limit", [0, 10**6])
def test_random_conversations(spark, monkeypatch, shard, limit):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard * 40)
    monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", limit)
    rows = random_rows(shard, 120, ["", "a", "bé", "longer text"], 7)
    seqs = prefix_trie.turn_sequences(spark.createDataFrame(rows, SCHEMA))
    assert found(prefix_trie.prefix_nodes(seqs)) == nodes(ordered(rows))
    assert found(prefix_trie.prefix_nodes(Q.rebuilt(seqs))) == nodes(rebuilt(ordered(rows)))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (7, None, None, None), (7, None, "user", "b"), (7, None, "user", "a"), (7, 1, "user", "a"), (7, 1, "user", "a"), (8, 1, "user", "a"), (9, 2, "user", None), (-3, 1, None, "a"), (5, 0, "user", "é" * 100_000)]
    plain = spark.createDataFrame(rows, SCHEMA)
    more = plain.selectExpr("*", "1 AS key", "'x' AS ids", "2 AS n", "3 AS depth", "4 AS size", "5 AS digest", "6 AS id", "7 AS turns")
    for df in (plain, more):
        assert found(prefix_trie.prefix_nodes(prefix_trie.turn_sequences(df))) == nodes(ordered(rows))


def test_empty_table_and_empty_sequences(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_nodes(prefix_trie.turn_sequences(empty)).count() == 0
    seqs = spark.createDataFrame([(3, []), (1, []), (2, [(5, 4)])], f"conv_id long, turns {prefix_trie.TURNS}")
    both = found(prefix_trie.prefix_nodes(seqs))
    assert both == sorted([(1, 0, None, 3, 1, 1, 0, hashlib.sha256(b"1,3").hexdigest()), (2, 1, 1, 1, 0, 1, 0, hashlib.sha256(b"2").hexdigest())], key=str)


def test_deep_and_equal_conversations(spark, monkeypatch):
    """A long conversation shared by many, and many copies that end at one node."""
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 500)
    shared = [("user", f"t{i % 7}") for i in range(900)]
    rows = [(c, i, r, x) for c in range(4) for i, (r, x) in enumerate([*shared[: 900 - c], ("user", f"own {c}")])]
    rows += [(100 + c, 0, "user", "same") for c in range(3000)]
    assert found(prefix_trie.prefix_nodes(prefix_trie.turn_sequences(spark.createDataFrame(rows, SCHEMA)))) == nodes(ordered(rows))


def test_insertion_is_balanced():
    tree = prefix_trie.TernaryTree()
    order = list(prefix_trie.medians_first(1000))
    assert sorted(order) == list(range(1000)) and order[0] == 500
    for i in order:
        tree.insert([i])

    def height(child):
        return 0 if not child else 1 + max(height(tree.low[child]), height(tree.high[child]))

    assert height(tree.equal[0]) <= 10
