"""Near-duplicates by the Jaccard similarity of shingle sets, joined on token-combination prefixes.

Tokens are hashed shingles in one global order, rare ones first, by counts of all documents in a table of fixed size.
Two sets of similarity p or more differ in few tokens: a set of n may miss e = n - ceil(p * n) of its own. So a prefix
of e + 1 tokens shares a token with that of any partner. Single rare tokens are indexed as they are. Frequent ones are
dealt to classes by hash and indexed as combinations of two of a class, which are shared far less often; a class then
tells nothing of its first token, so the prefix is extended until the tokens beyond the first of their class, together
with the rare ones, are e + 1. The number of classes follows from the size of the sets, by size windows that any two
partners share.

Equal sets are one node. Entries that the same nodes have are one entry. Nodes that share an entry are candidates. Each
node has a bitmap, in which every token turns over one bit: where two bitmaps differ the sets differ too, in as many
tokens at least. Candidates whose bitmaps differ in more bits than partners' sets may differ in tokens are dropped, the
others are verified on their whole sets, which are made for them alone. Every entry has a pivot, which is compared with
all its nodes; what is linked to it needs no comparison with what is linked to it too, and pairs that are already
connected need none at all. An entry with many nodes that are not connected gets further pivots while these bring links,
so a crowd of near copies costs a few rounds of one pair a node. Pairs just below the similarity are met bitmap by bitmap.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import bound_batches, discard, shuffles_end_with_jobs, stored, texts
from scorewright.llm.components import components
from scorewright.llm.slots import count_slots, slots

SPACE = re.compile(rb"[\t-\r ]")  # fixed: what ends a word
INSIDE = np.array([not SPACE.match(bytes([b])) for b in range(256)])  # fixed: bytes of words
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # fixed: masks of the first bytes of eight
LONG_WORD = 64  # bytes from which a word is hashed by itself
PART = 4 << 20  # bytes of a text that are split into words at once
WORDS_KEPT = 600_000  # hashes of long words that a task keeps
STEP = np.uint64(0xD6E8FEB86659FD93)  # fixed: an odd multiplier
LEVELS = 4  # levels of the order by factor of two of a token's count
FREQUENT = 6 * LEVELS  # tokens of about 64 documents and more are indexed by two
CLASS_TOKENS = 6  # tokens of the smallest set of a window for each class
BITMAP_BITS = 1024
NODES_KEPT = 1_000_000  # nodes whose entries a task knows it has passed on
BROADCAST_PAIRS = 1_000_000
CROWD = 32  # nodes from which an index entry gets further pivots
PIVOT_ROUNDS = 6
FEW_LINKS = 20  # a round that brings a link for fewer than one node in so many is the last one


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * STEP
    return h ^ (h >> np.uint64(29))


def part_hashes(text: bytes, memo: WordHashes) -> np.ndarray:
    """Hashes of the words, eight bytes of every word at a time."""
    text = text.lower()
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = INSIDE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    at, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(text) + 1, "<u8", text + bytes(8), 0, (1,))  # the eight bytes from each byte on
    h = mixed(size.astype(np.uint64) * STEP ^ eight[at] & FIRST_BYTES[np.minimum(size, 8)])
    left, done = np.flatnonzero(size > 8), 8
    while len(left) and done < LONG_WORD:
        rest = size[left] - done
        h[left] = mixed(h[left] ^ eight[at[left] + done] & FIRST_BYTES[np.minimum(rest, 8)])
        left, done = left[rest > 8], done + 8
    for i in left.tolist():
        h[i] = memo[text[at[i] : at[i] + size[i]]]
    return h


def word_hashes(text: bytes, memo: WordHashes) -> np.ndarray:
    """Hashes of the words; a long text is split part by part."""
    found, at = [], 0
    while at < len(text) or not found:
        cut = SPACE.search(text, at + PART)
        end = cut.start() if cut else len(text)
        if len(memo) > WORDS_KEPT:
            memo.clear()
        found.append(part_hashes(text[at:end], memo))
        at = max(end, at + 1)
    return np.concatenate(found) if len(found) > 1 else found[0]


def tokens(text: str, shingle: int, memo: WordHashes) -> np.ndarray:
    """Distinct hashed shingles in ascending order: all words if they are fewer, none without words."""
    h = word_hashes(text.encode(), memo)
    if not len(h):
        return h
    k = min(shingle, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * STEP + h[i : len(h) - k + 1 + i]
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def bitmap(found: np.ndarray) -> np.ndarray:
    """The parity of the tokens of each bit, as 64-bit numbers."""
    odd = np.bincount((found >> np.uint64(32)).astype(np.int64) % BITMAP_BITS, minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_missing(n: int, percent: int) -> int:
    """Tokens that a set of n may not share with a partner."""
    return n - -(-percent * n // 100)


def size_class(n: int, percent: int) -> int:
    """Partners' size classes differ by one at most."""
    return math.floor(math.log(n) / math.log(100 / percent))


def classes_for(window: int, percent: int) -> int:
    """Number of token classes for sets of the size classes window - 1 and window."""
    return max(1, math.ceil((100 / percent) ** (window - 1)) // CLASS_TOKENS)


def signatures(found: np.ndarray, order: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of a set, given its tokens and their levels in the global order."""
    n = len(found)
    need = most_missing(n, percent) + 1
    ranked = np.lexsort((found, order))
    rare = int((order < FREQUENT).sum())
    if rare >= need or n == 1:  # a set of one token has no partner but its equals
        return found[ranked[:need]]
    out, often = [found[ranked[:rare]]], found[ranked[rare:]]
    own = size_class(n, percent)
    for window in (own, own + 1):
        salt = np.uint64(2 * window + 1)
        group = (often * STEP * salt >> np.uint64(33)) % np.uint64(classes_for(window, percent))
        later = np.ones(len(often), bool)
        later[np.unique(group, return_index=True)[1]] = False
        size = int(np.searchsorted(np.cumsum(later), need - rare)) + 1
        at = np.argsort(group[:size], kind="stable")
        grouped, prefix = group[at], often[at]
        for step in range(1, size):
            same = grouped[step:] == grouped[:-step]
            if not same.any():
                break
            a, b = prefix[:-step][same], prefix[step:][same]
            out.append((a * STEP + b) * STEP + salt)
    return np.unique(np.concatenate(out))


def token_levels(docs: DataFrame, shingle: int) -> np.ndarray:
    """Level of each slot in the global order, from the documents that hold its tokens: 16 MB, whatever the input."""
    memo = WordHashes()

    def found(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        each = [tokens(text, shingle, memo) for text in texts(batch)]
        if each:
            yield np.sort(slots(np.concatenate(each)))  # in order of memory

    return count_slots(docs, found, 65535, lambda n: np.floor(LEVELS * np.log2(np.maximum(n, 1))))


def prints(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, node (a 64-bit hash of the set, null if empty), n (its size), bits and entries for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(token_levels(docs.select("text"), shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, memo = shared.value, WordHashes()
        for batch in batches:
            nodes, sizes, bits, entries = [], [], [], []
            for text in texts(batch):
                found = tokens(text, shingle, memo)
                order = levels[slots(found)]
                sizes.append(len(found))
                nodes.append(node_of(found))
                bits.append(bitmap(found))
                entries.append(signatures(found, order, percent) if len(found) else found)
            columns = [batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), lists_of(bits), lists_of(entries)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "bits", "entries"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, node long, n long, bits array<long>, entries array<long>")


def node_of(found: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64)) if len(found) else None


def lists_of(each: list[np.ndarray]) -> pa.ListArray:
    """A list of 64-bit numbers a row."""
    ends = np.cumsum([0, *map(len, each)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array((np.concatenate(each) if each else np.zeros(0, np.uint64)).view(np.int64)))


def marked(keys: DataFrame, name: str) -> np.ndarray:
    """Whether the slots of the column ``name`` have a key, as bits: 2 MB, whatever the input."""

    def found(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.sort(slots(batch.column(name).to_numpy().view(np.uint64)))

    return np.packbits(count_slots(keys.select(name), found, 1, lambda n: np.minimum(n, 1)))


def is_marked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = slots(keys)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def shared_entries(rows: DataFrame) -> DataFrame:
    """entry, node and pivot (the entry's least node) for the index entries that several nodes have; of entries that the
    same nodes have, one. Entries are reduced to their least and greatest node per task first, so neither copies nor
    frequent entries gather. Only entries of the slots of shared ones are dealt out with their nodes."""
    ends = rows.select("node", F.explode("entries").alias("entry")).groupBy("entry").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
    several = stored(ends.where("pivot != top").select("entry", "pivot"), "several")
    shared = rows.sparkSession.sparkContext.broadcast(marked(several, "entry"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: set[int] = set()
        for batch in batches:
            if len(passed) > NODES_KEPT:
                passed.clear()
            nodes, lists = batch.column("node").to_numpy(zero_copy_only=False), batch.column("entries")
            fresh = [i for i, node in enumerate(nodes.tolist()) if not (node in passed or passed.add(node))]
            lists = lists.take(pa.array(fresh, pa.int64()))
            entries = lists.flatten().to_numpy()
            node = np.repeat(nodes[fresh], np.diff(lists.offsets.to_numpy()))
            chosen = is_marked(shared.value, entries.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(entries[chosen], pa.int64()), pa.array(node[chosen], pa.int64())], ["entry", "node"])

    index = rows.where(F.col("node").isNotNull()).select("node", "entries").mapInArrow(run, "entry long, node long")
    index = stored(index.join(several, "entry").dropDuplicates(["entry", "node"]), "entries")
    alike = [F.count("*").alias("nodes"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    one = index.groupBy("entry", "pivot").agg(*alike).groupBy("pivot", "nodes", "x", "y").agg(F.min("entry").alias("entry"))
    out = stored(index.join(one.select("entry"), "entry"), "index")
    discard(several)
    discard(index)
    return out


def sets_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame, shingle: int, few: bool = True) -> DataFrame:
    """node, n and tokens for the nodes ``wanted``, and for others, if anything. One document of each is read again, by
    its doc_id: ``few`` ids are joined, more are marked in a table of fixed size, whose surplus is harmless."""
    one = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.xxhash64("doc_id")).alias("mark"))
    again = docs.select(F.xxhash64("doc_id").alias("mark"), "text")
    again = again.join(F.broadcast(one.select("mark")), "mark", "left_semi") if few else again
    shared = None if few else docs.sparkSession.sparkContext.broadcast(marked(one, "mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        passed: set[int] = set()
        for batch in batches:
            if len(passed) > NODES_KEPT:
                passed.clear()
            if shared is not None:
                batch = batch.take(pa.array(np.flatnonzero(is_marked(shared.value, batch.column("mark").to_numpy().view(np.uint64)))))
            found = [x for x in (tokens(text, shingle, memo) for text in texts(batch)) if len(x)]
            nodes = list(map(node_of, found))
            fresh = [i for i, node in enumerate(nodes) if not (node in passed or passed.add(node))]
            found = [found[i] for i in fresh]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in fresh], pa.int64()), pa.array(list(map(len, found)), pa.int64()), lists_of(found)], ["node", "n", "tokens"])

    sets = stored(again.mapInArrow(run, "node long, n long, tokens array<long>"), "sets")
    if sets.groupBy("node").count().where("count > 1").isEmpty():
        return sets
    single = stored(one_each(sets, "n", "tokens"), "sets")  # rows that are repeated in other tasks
    discard(sets)
    return single


def one_each(sets: DataFrame, *columns: str) -> DataFrame:
    """One row a node, dealt by node as the joins want it."""
    return sets.groupBy("node").agg(*(F.first(c).alias(c) for c in columns))


def could_link(n: str, n2: str, bits: str, bits2: str, percent: int) -> Column:
    """Whether two sets may be partners by their sizes and bitmaps: they differ in as many tokens as bits at least."""
    differ = sum((F.bit_count(F.col(bits)[i].bitwiseXOR(F.col(bits2)[i])) for i in range(BITMAP_BITS // 64)), F.lit(0))
    both = F.col(n) + F.col(n2)
    return (100 * F.least(n, n2) >= percent * F.greatest(n, n2)) & ((100 + percent) * (both - differ) >= 2 * percent * both)


def verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have a Jaccard similarity of ``percent`` or more. Sets are made for the pairs that the
    bitmaps leave. A set leaves its task once for each of its pairs as v, and once as u, which may have very many pairs."""
    side = lambda of, node, n, c, kept: of.select(F.col("node").alias(node), F.col("n").alias(n), F.col(c).alias(kept))
    near = pairs.where("u != v").join(side(sketches, "u", "n", "bits", "bits"), "u").join(side(sketches, "v", "n2", "bits", "bits2"), "v")
    near = stored(near.where(could_link("n", "n2", "bits", "bits2", percent)).select("u", "v"), "near")
    left = near.count()
    if not left:
        return near
    few = left <= BROADCAST_PAIRS
    sent = F.broadcast if few else lambda ids: ids
    sets = sets_of(docs, rows, near.select(F.explode(F.array("u", "v")).alias("node")).distinct(), shingle, few)
    a = side(sets, "u", "n_a", "tokens", "a").join(sent(near.select("u").distinct()), "u", "left_semi")
    b = side(sets, "v", "n_b", "tokens", "b").join(sent(near), "v")
    common = F.size(F.array_intersect("a", "b")).cast("long")
    links = stored(b.join(a, "u").where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("u", "v"), "links")
    discard(sets)
    return links


def linked(docs: DataFrame, rows: DataFrame, index: DataFrame, sketches: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, root) of the nodes that have partners: root is the least node they are connected to.

    First each node is compared with the pivot of its entries, which is done with then. Entries of CROWD further nodes or
    more that are not all connected get up to PIVOT_ROUNDS further pivots, by a hash of node and round, while these bring
    links. What is left are the pairs of an entry that are not connected yet. Those that could link are compared, at one
    common entry.
    """
    check = lambda pairs: verified(pairs.distinct(), sketches, docs, rows, shingle, percent)
    roots = stored(components(check(index.select(F.col("pivot").alias("u"), F.col("node").alias("v")))), "roots")
    others = index.where("node != pivot").select("entry", "node")

    def unsettled(least: int) -> DataFrame:
        """The index with roots, for entries of ``least`` nodes or more that are not all connected."""
        rooted = others.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = rooted.groupBy("entry").agg(F.count("*").alias("nodes"), F.min("root").alias("low"), F.max("root").alias("high"))
        apart = apart.where((F.col("nodes") >= least) & (F.col("low") != F.col("high"))).select("entry")
        return stored(rooted.join(apart, "entry"), "unsettled")

    def join_in(more: DataFrame) -> DataFrame:
        star = roots.where("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        return stored(components(star.unionByName(more)), "roots")

    for turn in range(PIVOT_ROUNDS):
        crowds = unsettled(CROWD)
        if crowds.isEmpty():
            break
        chosen = crowds.groupBy("entry").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "root")).alias("x"))
        chosen = chosen.select("entry", F.col("x.node").alias("u"), F.col("x.root").alias("other_root"))
        more = check(crowds.join(chosen, "entry").where("root != other_root").select("u", F.col("node").alias("v")))
        brought = more.count()
        if brought:
            roots = join_in(more)
        if FEW_LINKS * brought < crowds.select("node").distinct().count():
            break
    rest = unsettled(2).select("entry", "node", "root")
    about = rest.groupBy("node").agg(F.collect_set("entry").alias("own")).join(sketches, "node")
    rest = stored(rest.join(about, "node"), "rest")
    once = F.array_min(F.array_intersect("l.own", "r.own")) == F.col("l.entry")
    may = (F.col("l.root") < F.col("r.root")) & could_link("l.n", "r.n", "l.bits", "r.bits", percent) & once
    met = rest.alias("l").hint("merge")  # files are far smaller than their rows; both sides are one shuffle
    met = met.join(rest.alias("r"), (F.col("l.entry") == F.col("r.entry")) & may)
    more = check(met.select(F.col("l.node").alias("u"), F.col("r.node").alias("v")))
    return roots if more.isEmpty() else join_in(more)


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id for every row.

    Words are what stands between ASCII white space, A-Z in lower case; a set holds the distinct shingles of
    ``shingle`` words, or all words as one if there are fewer. Two rows link when 100 * intersection >= ``percent`` *
    union; component_id is the smallest doc_id that links reach, the row's own included. Null texts and texts without
    words have empty sets and are linked with nothing. Rows without doc_id take part and have the component's smallest
    doc_id (null if none has one); repeated rows each get theirs; other columns are left out, whatever their names. An
    empty table gives an empty result. Shingles and sets are told apart by hashes of 64 bits. A text's memory is about
    40 bytes a word.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    content = docs.select("doc_id", F.col(text).alias("text"))
    with shuffles_end_with_jobs(spark):
        whole = stored(prints(content, shingle, percent), "prints")
        rows, index = stored(whole.select("doc_id", "node", "n"), "rows"), shared_entries(whole)
        single = one_each(whole.where(F.col("node").isNotNull()), "n", "bits")
        sketches = stored(single.join(index.select("node").distinct(), "node", "left_semi"), "sketches")
        discard(whole)
        roots = linked(content, rows, index, sketches, shingle, percent)
        nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("first"))
        nodes = stored(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first"), "nodes")
    least = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = nodes.join(least, "root").select("node", "component_id")
    out = ["doc_id", F.col("n").alias("n_shingles")]
    empty = rows.where(F.col("node").isNull()).select(*out, F.col("doc_id").alias("component_id"))
    return rows.where(F.col("node").isNotNull()).join(labels, "node").select(*out, "component_id").unionByName(empty)
