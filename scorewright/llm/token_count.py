"""Token counts by compiled finite-state transducers.

Two deterministic transducers run one after the other. The first (``pretoken``) finds pre-token boundaries; its chunk
state maps compose through a parallel prefix scan. The second reads the bytes of one pre-token; each transition is
annotated with the change in the number of emitted tokens. Its state holds, for every position from which a
vocabulary token could still be running, the node of that running token, the last token of the merged prefix before
it and the count there. By the compatibility theorem of byte-pair encoding (a token sequence is the encoding of its
bytes exactly if each adjacent pair is the encoding of its own bytes) that is all the past that the future needs, so
states are few and are compiled when first met. The compiled table is bounded: it starts afresh when full.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import bound_batches, by_bytes, texts
from scorewright.llm.pretoken import cut, pretokens

MAX_STATES = 200_000
MAX_MEMO = 700_000
OFFSET = 512


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a byte's own Latin-1 character, or the next from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Deterministic transducer from the bytes of a pre-token to its number of tokens, compiled on demand.

    A state is a tuple of numbers, each of which packs a running token's node, the token before it and the count
    there, relative to the count now (as OFFSET + count).
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"]]
        raw = {s: bytes(letters[c] for c in s) for s in spec["model"]["vocab"] if s not in self.special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(raw[a], raw[b]): i for i, (a, b) in enumerate(merges)}
        self.tokens = [b"", *raw.values()]
        if len(self.tokens) >= 1 << 24 or max(map(len, self.tokens)) >= OFFSET:  # the widths of a state's fields
            raise ValueError(f"a vocabulary of 2^24 tokens, or with one of {OFFSET} bytes, is not supported")
        self.child: dict[int, int] = {}  # node << 8 | byte to node
        nodes, inner, self.token = 1, set(), {}
        for number, t in enumerate(self.tokens):
            node = 0
            for b in t:
                inner.add(node)
                if (to := self.child.get(node << 8 | b)) is None:
                    to = self.child[node << 8 | b] = nodes
                    nodes += 1
                node = to
            if t:
                self.token[node] = number
        self.inner = bytes(n in inner for n in range(nodes))
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple[int, ...]] = [(OFFSET,)]
        self.number = {self.states[0]: 0}
        self.step: dict[int, int] = {}

    def merged(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.rank.get
        while len(parts) > 1:
            ranks = [get(p, 1 << 30) for p in zip(parts, parts[1:])]
            if (r := min(ranks)) == 1 << 30:
                break
            i = ranks.index(r)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, before: int, token: int) -> bool:
        """Whether the merges of both tokens' bytes end with just these two (before 0: with just this one)."""
        key = before << 24 | token
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > MAX_MEMO:
                self.fits.clear()
            pair = [self.tokens[before], self.tokens[token]][before == 0 :]
            known = self.fits[key] = self.merged(b"".join(pair)) == pair
        return known

    def compile(self, state: int, byte: int) -> int:
        """The transition from ``state`` on ``byte``: next state << 10 | OFFSET + emitted-token count."""
        running, last, emitted = [], 0, OFFSET
        for entry in self.states[state]:
            if (node := self.child.get((entry >> 34) << 8 | byte)) is None:
                continue
            if not last and (token := self.token.get(node)) and self.compatible(entry >> 10 & 0xFFFFFF, token):
                last, emitted = token, (entry & 1023) + 1 - OFFSET
            if self.inner[node]:
                running.append(node << 34 | entry & 0x3FFFFFFFF)
        if not last:
            raise ValueError("the vocabulary does not cover all bytes")
        key = (*[entry - emitted for entry in running], last << 10 | OFFSET)
        if (to := self.number.get(key)) is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        t = self.step[state << 8 | byte] = to << 10 | emitted + OFFSET
        return t

    def count(self, piece: str) -> int:
        if len(self.states) > MAX_STATES:
            self.forget()
        state = total = 0
        get, data = self.step.get, piece.encode()
        for b in data:
            if (t := get(state << 8 | b)) is None:
                if len(self.states) > MAX_STATES:  # starts afresh from the state it is in
                    held = self.states[state]
                    self.forget()
                    get = self.step.get
                    if (state := self.number.setdefault(held, 1)) == 1:
                        self.states.append(held)
                t = self.compile(state, b)
            state = t >> 10
            total += t & 1023
        return total - OFFSET * len(data)

    def counts(self, items: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(items), np.int64)
        owner, parts = [], []
        for i, x in enumerate(items):
            segments = [x]
            for s in self.special:  # a special string is one token and parts what is around it
                segments = [y for z in segments for y in z.split(s)]
            out[i] = len(segments) - 1
            segments = [y for z in segments for y in cut(z)]
            parts += segments
            owner += [i] * len(segments)
        memo, owner = self.memo, np.array(owner, np.int64)
        for a, b in by_bytes(parts):
            pieces, n = pretokens(parts[a:b])
            if len(memo) > MAX_MEMO:
                memo.clear()
            for p in set(pieces).difference(memo):
                memo[p] = self.count(p)
            each = np.fromiter(map(memo.__getitem__, pieces), np.int64, len(pieces))
            np.add.at(out, np.repeat(owner[a:b], n), each)
        return out


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, text: str = "text") -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit) to ``doc_id``.

    ``tokenizer`` is the path of a byte-level BPE file of the `tokenizers` library that exists on every machine.
    Null text counts as empty (0, 0, false); rows come out one for one, also repeated ones and those without doc_id;
    other columns of ``docs`` are left out, whatever their names.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(tokenizer)
        for batch in batches:
            items = texts(batch)
            counts = np.concatenate([np.zeros(0, np.int64), *(t.counts(items[a:b]) for a, b in by_bytes(items))])
            size = [len(x.encode()) for x in items]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kept = docs.select("doc_id", F.col(text).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
