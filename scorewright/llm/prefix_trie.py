"""Trie of the prefixes of conversations, built from ternary search trees.

Turns are encoded by a dictionary: a turn's id stands for its role and text. Equal sequences of ids are combined, the
distinct ones are dealt by range, and each range shard holds its own in a ternary search tree: a node has a smaller, an
equal and a larger child, and sequences are inserted medians first, so that the search paths stay short. Nodes are
numbered as they are made, so one walk over the numbers from the last to the first sums up every subtree.

Only the prefixes of a shard's first and last sequence can have members in other shards. These boundary nodes leave the
shard with the sums of the finished subtrees that hang on them; they are merged by key, and their own subtrees are
summed by doubling: in round k each node passes its sum to the ancestor 2^k turns up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import stored

SHARD_TURNS = 2_000_000  # turns of distinct sequences that one shard's tree holds, about
BROADCAST_NODES = 200_000  # boundary nodes of about 60 bytes; more than that are joined by a shuffle
EMPTY_SHA256 = hashlib.sha256().hexdigest()
ROOT_KEY = bytes(16)
TURNS = "array<struct<id:bigint,size:int>>"


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (dictionary id and UTF-8 bytes of the text, in order) for every conversation.

    Turns are in order of ``turn``, null first; ties are in order of role, then of the MD5 of role and text. Null
    roles and texts are empty. Rows without conv_id belong to no conversation and are left out; repeated rows are
    turns of their own; other columns are left out. A conversation is one row of 12 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    t = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), F.octet_length(text).alias("size"), digest.alias("digest"))
    t = stored(t, "turns")
    dictionary = stored(t.groupBy("digest").agg(F.max("size").alias("size")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    coded = t.drop("size").join(dictionary, "digest")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "id", "size")))
    return coded.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["id"].alias("id"), x["size"].alias("size"))).alias("turns"))


def end_hashes(ends: DataFrame) -> DataFrame:
    """key and ends_sha256: the SHA-256 of a key's conv_ids, ascending and comma-joined.

    The ids of a key may lie in many ranges, each of which gives texts of one Arrow batch's ids; a key's texts then
    stream through its hash, so memory does not depend on the number of ids.
    """

    def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            runs = list(zip(starts, [*starts[1:], len(keys)]))
            rows = [[keys[a] for a, _ in runs], [ids[a] for a, _ in runs], [",".join(map(str, ids[a:b])) for a, b in runs]]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string())], ["key", "first", "ids"])

    def hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, found, keys, hashes = None, None, [], []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        hashes.append(found.hexdigest())
                    key, found = k, hashlib.sha256(ids.encode())
                else:
                    found.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], ["key", "ends_sha256"])
            keys, hashes = [], []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([found.hexdigest()], pa.string())], ["key", "ends_sha256"])

    parts = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = stored(parts.mapInArrow(join_runs, "key binary, first long, ids string"), "ends")
    return parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hash_runs, "key binary, ends_sha256 string")


class TernaryTree:
    """Ternary search tree over sequences of numbers. Node 0 is the empty prefix; 0 also means no child. ``up`` is the
    node of the prefix that is one shorter. A node's number is larger than those of its prefixes."""

    def __init__(self) -> None:
        self.symbol, self.low, self.equal, self.high, self.up, self.depth = [0], [0], [0], [0], [0], [0]

    def _new(self, symbol: int, up: int) -> int:
        for column, value in ((self.symbol, symbol), (self.low, 0), (self.equal, 0), (self.high, 0), (self.up, up), (self.depth, self.depth[up] + 1)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the whole sequence, made together with those of its prefixes where they are missing."""
        low, high, symbols, at = self.low, self.high, self.symbol, 0
        for s in sequence:
            side, here = self.equal, at
            while child := side[here]:
                if s == symbols[child]:
                    break
                side, here = (low if s < symbols[child] else high), child
            else:
                child = side[here] = self._new(s, at)
            at = child
        return at

    def path(self, node: int) -> list[int]:
        """Nodes from the empty prefix to ``node``."""
        out = [node]
        while out[-1]:
            out.append(self.up[out[-1]])
        return out[::-1]


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1: the middle one, then the middles of both halves, and so on."""
    level = [(0, n)]
    while level:
        halves = []
        for a, b in level:
            if a < b:
                yield (m := (a + b) // 2)
                halves += [(a, m), (m + 1, b)]
        level = halves


NODE = (
    "boundary boolean, key binary, parent_key binary, ups array<binary>, conv_id long, depth int, parent_conv_id long, size long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def shard_nodes(sequences: list[tuple[list[int], list[int], int, int, str]]) -> list[tuple]:
    """Rows of NODE for a shard's distinct sequences (ids, sizes, number of conversations, smallest of them, hash of
    them), which come in order. A boundary node's sums hold only the finished subtrees that hang on it."""
    tree = TernaryTree()
    ends = [0] * len(sequences)
    for i in medians_first(len(sequences)):
        ends[i] = tree.insert(sequences[i][0])
    count = len(tree.symbol)
    size, n, kids, leaves, saved = ([0] * count for _ in range(5))
    conv, sha, boundary = [None] * count, [None] * count, [False] * count
    for node, (_, sizes, copies, smallest, digest) in zip(ends, sequences):
        n[node], conv[node], sha[node] = copies, smallest, digest
        at = node
        for s in reversed(sizes):
            if size[at]:
                break  # its prefixes have theirs
            size[at] = s
            at = tree.up[at]
    keys, ups = {0: ROOT_KEY}, {}
    for node in (ends[0], ends[-1]):
        path = tree.path(node)
        for d, at in enumerate(path):
            boundary[at] = True
            if at not in keys:
                keys[at] = hashlib.blake2b(keys[tree.up[at]] + tree.symbol[at].to_bytes(8, "big", signed=True), digest_size=16).digest()
            ups[at] = [keys[path[d - (1 << k)]] for k in range(d.bit_length())]
    for at in range(count - 1, 0, -1):
        up = tree.up[at]
        n[up] += n[at]
        conv[up] = conv[at] if conv[up] is None else min(conv[up], conv[at])
        if not boundary[at]:
            leaves[at] = leaves[at] or 1
            saved[at] += (n[at] - 1) * size[at]
            kids[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    rows = []
    for at in range(count):
        up = tree.up[at]
        own = (boundary[at], keys.get(at), keys[up] if at and boundary[up] else None, ups.get(at), conv[at], tree.depth[at], conv[up] if at and not boundary[up] else None)
        rows.append((*own, size[at], n[at], kids[at], leaves[at], saved[at], sha[at]))
    return rows


ARROW = pa.schema(
    [("boundary", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("ups", pa.list_(pa.binary())), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), ("size", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("ids", "sizes", "n", "conv_id", "ends_sha256")
    rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in names))]
    found = shard_nodes(rows) if rows else []
    for i in range(0, len(found), 20_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found[i : i + 20_000]), ARROW)], schema=ARROW)


def merge_boundary(nodes: DataFrame) -> DataFrame:
    """Boundary nodes whole: the partial rows of a key combined, then subtrees summed over the boundary nodes below."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    first = [F.max(c).alias(c) for c in ("depth", "size", "ends_sha256", "parent_key", "ups")]
    merged = stored(nodes.where("boundary").groupBy("key").agg(F.min("conv_id").alias("conv_id"), *first, *sums), "boundary")
    below = merged.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    whole = merged.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    own_leaves = F.col("n_leaves") + (F.col("n_children") == 0).cast("long")
    whole = stored(whole.withColumn("n_leaves", own_leaves).withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")), "boundary")
    rounds = whole.agg(F.max(F.size("ups"))).first()[0] or 0  # the logarithm of the greatest depth
    total = whole.select("key", "ups", "n_leaves", "saved_tokens")
    for k in range(rounds):
        no_ups = F.lit(None).cast("array<binary>")
        send: list[Column] = [F.struct("key", "ups", "n_leaves", "saved_tokens"), F.struct(F.get("ups", F.lit(k)).alias("key"), no_ups.alias("ups"), "n_leaves", "saved_tokens")]
        total = total.select(F.explode(F.array(*send)).alias("x")).select("x.*").where(F.col("key").isNotNull())
        total = total.groupBy("key").agg(F.max("ups").alias("ups"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    return stored(whole.drop("ups", "n_leaves", "saved_tokens").join(total.drop("ups"), "key"), "boundary")


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, turns): conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A node is a distinct prefix; its members are the sequences that start with it. n_leaves counts the childless nodes
    of its subtree, itself included; saved_tokens sums (n_convs - 1) times the bytes of the last turn over the
    subtree; ends_sha256 is the SHA-256 of the conv_ids whose whole sequence it is, ascending and comma-joined. Empty
    sequences are members of the root alone. conv_id must be unique. Without sequences there are no nodes.
    """
    spark = sequences.sparkSession
    ids, sizes = F.transform("turns", lambda x: x["id"]), F.transform("turns", lambda x: x["size"])
    key = F.unhex(F.md5(F.array_join(ids.cast("array<string>"), ",").cast("binary")))
    rows = stored(sequences.select("conv_id", ids.alias("ids"), sizes.alias("sizes"), key.alias("key")), "sequences")
    distinct = rows.groupBy("key", "ids", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    distinct = stored(distinct.join(end_hashes(rows.select("key", "conv_id")), "key"), "distinct-sequences")
    turns = distinct.agg(F.sum(F.size("ids"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    dealt = distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    nodes = stored(dealt.select("ids", "sizes", "n", "conv_id", "ends_sha256").mapInArrow(_shards, NODE), "nodes")
    boundary = merge_boundary(nodes)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")]
    inner = nodes.where(~F.col("boundary"))
    hung = inner.where(F.col("parent_key").isNotNull()).drop("parent_conv_id", "key", "ups", "boundary")
    hung = hung.unionByName(boundary.drop("key").select(*hung.columns))
    parents = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    if boundary.count() <= BROADCAST_NODES:
        parents = F.broadcast(parents)
    return inner.where(F.col("parent_key").isNull()).select(*out).unionByName(hung.join(parents, "parent_key", "left").select(*out))
