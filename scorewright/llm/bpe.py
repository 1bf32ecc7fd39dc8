"""Byte-level BPE encoding and decoding from a rank file.

Encoding works on all new pre-tokens of a batch together. Their bytes form linked lists. A queue holds one bucket of
list positions per merge rank and a bitmap of the buckets in use, in three levels of 64-bit words; find-first-set
gives the next rank. A bucket's positions whose pair has changed meanwhile are stale and skipped; the others merge at
once, from left to right where they overlap, and the pairs they form enter the queue. The cost of a pre-token of n
bytes is thus about n queue entries, however long it is.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import bound_batches, by_bytes, texts
from scorewright.llm.pretoken import cut, pretokens

MAX_MEMO = 300_000
NONE = 1 << 30


class RankQueue:
    """Buckets of positions by rank, with a hierarchical bitmap of those in use."""

    def __init__(self, ranks: int):
        self.low, self.mid, self.top = [0] * ((ranks >> 6) + 1), [0] * ((ranks >> 12) + 1), 0
        self.buckets: dict[int, list[np.ndarray]] = defaultdict(list)

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        edges = np.flatnonzero(np.diff(ranks, prepend=-1, append=NONE))
        for a, b, r in zip(edges.tolist(), edges[1:].tolist(), ranks[edges[:-1]].tolist()):
            self.buckets[r].append(positions[a:b])
            self.low[r >> 6] |= 1 << (r & 63)
            self.mid[r >> 12] |= 1 << (r >> 6 & 63)
            self.top |= 1 << (r >> 12)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank in use and its positions, in order, each once."""
        if not self.top:
            return None
        first = lambda word: (word & -word).bit_length() - 1
        a = first(self.top)
        b = a << 6 | first(self.mid[a])
        r = b << 6 | first(self.low[b])
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        got = self.buckets.pop(r)
        return r, np.unique(np.concatenate(got)) if len(got) > 1 else np.sort(got[0])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... length[0] numbers; then those of the next, and so on."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


class Vocabulary:
    """Ranks of byte strings; a token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.rank.values()) + 1
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("the vocabulary does not cover all bytes")
        by_id = [b""] * size
        for t, r in self.rank.items():
            by_id[r] = t
        self.length = np.fromiter(map(len, by_id), np.int64, size)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted((self.rank[t[:i]] << 32 | self.rank[t[i:]], r) for t, r in self.rank.items() for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank)
        self.pair = np.array([p[0] for p in pairs], np.int64)
        self.pair_rank = np.array([p[1] for p in pairs], np.int64)
        self.memo: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.memo.clear()
        self.pool, self.at, self.many = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, or NONE; a token -1 pairs with nothing."""
        key = left << 32 | right
        i = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair[i] == key), self.pair_rank[i], NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(size.sum())
        owner = np.repeat(np.arange(len(pieces)), size)
        token = np.append(self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)], -1)  # position n: no token
        after = np.arange(1, n + 2)
        after[np.cumsum(size) - 1] = n
        before = np.arange(-1, n)
        before[np.cumsum(size) - size] = n
        after[n] = before[n] = n
        pair = np.append(self.ranks_of(token[:-1], token[after[:-1]]), NONE)
        queue = RankQueue(len(self.length))
        fresh = np.flatnonzero(pair < NONE)
        queue.push(pair[fresh], fresh)
        while (next_up := queue.pop()) is not None:
            r, at = next_up
            at = at[pair[at] == r]  # the others are stale
            if not len(at):
                continue
            chained = np.append(False, after[at[:-1]] == at[1:])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
            second = after[at]
            new = np.full(len(at), r)
            left, right = token[before[at]], token[after[second]]
            lower = (self.ranks_of(left, new) < r) | (self.ranks_of(new, right) < r) | (self.ranks_of(new, new) < r)
            if lower.any():  # such a merge goes before the rest of its piece: merge only the first there, for now
                first = np.append(True, np.diff(owner[at]) != 0)
                held = np.isin(owner[at], owner[at][lower]) & ~first
                queue.push(np.full(held.sum(), r), at[held])
                at, second = at[~held], second[~held]
            following = after[second]
            token[at] = r
            token[second] = -1
            pair[second] = NONE
            after[at] = following
            before[following] = at
            before[n] = n
            touched = np.unique(np.concatenate([at, before[at]]))
            touched = touched[touched < n]
            pair[touched] = now = self.ranks_of(token[touched], token[after[touched]])
            touched, now = touched[now < NONE], now[now < NONE]
            queue.push(now, touched)
        kept = np.flatnonzero(token[:n] >= 0)
        return token[kept].astype(np.int32), np.bincount(owner[kept], minlength=len(pieces))

    def learn(self, pieces: list[str]) -> None:
        """Encodes pre-tokens and keeps them; one that is a token itself needs no merge."""
        whole = [self.rank.get(p.encode(), -1) for p in pieces]
        rest = [i for i, r in enumerate(whole) if r < 0]
        ids, n = self.merge([pieces[i].encode() for i in rest])
        count = np.ones(len(pieces), np.int64)
        count[rest] = n
        flat = np.empty(count.sum(), np.int32)
        start = np.cumsum(count) - count
        alone = np.array(whole, np.int64) >= 0
        flat[start[alone]] = np.array(whole, np.int64)[alone]
        flat[ranges(start[~alone], count[~alone])] = ids
        known = len(self.memo)
        for name, need in (("pool", self.used + len(flat)), ("at", known + len(pieces)), ("many", known + len(pieces))):
            if need > len(old := getattr(self, name)):
                setattr(self, name, np.concatenate([old, np.zeros(max(need, 2 * len(old)) - len(old), old.dtype)]))
        self.pool[self.used : self.used + len(flat)] = flat
        self.at[known : known + len(pieces)] = self.used + start
        self.many[known : known + len(pieces)] = count
        self.used += len(flat)
        self.memo.update(zip(pieces, range(known, known + len(pieces))))

    def encode(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        parts = [list(cut(x)) for x in items]
        flat, out, many = [y for p in parts for y in p], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a, b in by_bytes(flat):
            ids, n = self._encode(flat[a:b])
            out.append(ids)
            many.append(n)
        owner = np.repeat(np.arange(len(items)), [len(p) for p in parts])
        n = np.zeros(len(items), np.int64)
        np.add.at(n, owner, np.concatenate(many))
        return np.concatenate(out), n

    def _encode(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, n = pretokens(items)
        if len(self.memo) > MAX_MEMO:
            self.forget()
        if new := sorted(set(pieces).difference(self.memo)):
            self.learn(new)
        number = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        ids = self.pool[ranges(self.at[number], self.many[number])]
        ends = np.append(0, np.cumsum(self.many[number]))
        stop = np.cumsum(n)
        return ids, ends[stop] - ends[stop - n]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids in a row."""
        return self.bytes[ranges(self.start[ids], self.length[ids])]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _lists(n: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(values))


def _decoded(v: Vocabulary, lists: pa.ListArray) -> pa.Array:
    """The bytes of each list of ids; null gives none."""
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    size = np.append(0, np.cumsum(v.length[ids]))
    offsets = np.append(0, size[np.cumsum(n)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(v.decode(ids))])


def _id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, ranks: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id and the token ids of each text as ``ids``, without special tokens; with ``decoded`` also the bytes that
    the ids decode to, in the same task.

    ``ranks`` is the path of a rank file that exists on every machine. A null or empty text has no ids; rows come out
    one for one, also repeated ones and those without doc_id; other columns are left out, whatever their names.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(ranks)
        for batch in batches:
            items = texts(batch)
            for a, b in by_bytes(items):
                ids, n = v.encode(items[a:b])
                out = {"doc_id": batch.column("doc_id").slice(a, b - a), "ids": _lists(n, ids)}
                if decoded:
                    out["decoded"] = _decoded(v, out["ids"])
                yield pa.RecordBatch.from_pydict(out)

    kept = docs.select("doc_id", F.col(text).alias("text"))
    return kept.mapInArrow(run, f"doc_id {_id_type(kept)}, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``, to doc_id and ids; no ids (or null) give no bytes."""
    bound_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(ranks)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": batch.column("ids"), "decoded": _decoded(v, batch.column("ids"))})

    kept = encoded.select("doc_id", "ids")
    return kept.mapInArrow(run, f"doc_id {_id_type(kept)}, ids array<int>, decoded binary")
