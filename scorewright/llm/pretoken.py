"""Pre-token boundaries by a finite-state transducer over character classes.

The transducer recognises ``public_tokenizers.PATTERN`` (contractions, words, numbers, other runs with one leading
space, white space). Each transition says whether a pre-token starts at the character just read or, where the pattern
looks ahead, at the one before it. A chunk of characters maps every state to a state; the maps of all chunks of all
texts of a batch compose through a parallel prefix scan, after which each chunk is run from its true state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex

LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE, SINGLE, R, V, L, E, END = range(12)
START, WORD, DIGITS, MARKS, ONE_SPACE, SPACES, WHITES, ONE_WHITE, Q, QR, QV, QL = range(12)
HERE, BEFORE = 1, 2
CHUNK = 128
N = 12


def _enter(c: int) -> int:
    """State after a character that starts a pre-token."""
    if c in (LETTER, SINGLE, R, V, L, E):
        return WORD
    return {NUMBER: DIGITS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, OTHER: MARKS, QUOTE: Q}[c]


def _step(state: int, c: int) -> tuple[int, int]:
    """Next state and where pre-tokens start."""
    letter, white = c in (LETTER, SINGLE, R, V, L, E), c in (SPACE, WHITE)
    pending = state in (QR, QV, QL)  # a quote and a letter that may become a contraction
    if c == END:
        return START, BEFORE * pending
    if (state, c) in ((QR, E), (QV, E), (QL, L)) or state == Q and c == SINGLE:
        return START, 0
    if state == Q and c in (R, V, L):
        return {R: QR, V: QV, L: QL}[c], 0
    if pending:
        return (WORD, BEFORE) if letter else (_enter(c), BEFORE | HERE)
    if (state == WORD and letter) or (state == DIGITS and c == NUMBER) or (state in (MARKS, Q) and c in (OTHER, QUOTE)):
        return {WORD: WORD, DIGITS: DIGITS}.get(state, MARKS), 0
    if state in (ONE_SPACE, ONE_WHITE, SPACES, WHITES):
        if white:
            return SPACES if c == SPACE else WHITES, 0
        if state in (ONE_SPACE, SPACES):  # the last space belongs to what follows
            return MARKS if c == QUOTE else _enter(c), BEFORE * (state == SPACES)
        return _enter(c), HERE | BEFORE * (state == WHITES)
    return _enter(c), HERE


_TABLE = [[_step(s, c) for s in range(N)] for c in range(N)]
NEXT = np.array([[x[0] for x in row] for row in _TABLE], np.uint8).ravel()
STARTS = np.array([[x[1] for x in row] for row in _TABLE], np.uint8).ravel()


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    for kind, chars in ((SPACE, " "), (QUOTE, "'"), (SINGLE, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e")):
        table[[ord(c) for c in chars]] = kind
    return table


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (columns), by doubling: column i becomes column 0 then ... then i."""
    step = 1
    while step < maps.shape[1]:
        later = np.take_along_axis(maps[:, step:], maps[:, :-step].astype(np.intp), axis=0)
        maps = np.concatenate([maps[:, :step], later], axis=1)
        step *= 2
    return maps


def starts(kinds: np.ndarray) -> np.ndarray:
    """Flags by position where a pre-token starts, for classes that end with END."""
    n = len(kinds)
    grid = np.full(-(-n // CHUNK) * CHUNK, END, np.uint8)
    grid[:n] = kinds
    columns = np.ascontiguousarray(grid.reshape(-1, CHUNK).T) * np.uint8(N)
    maps = np.repeat(np.arange(N, dtype=np.uint8)[:, None], columns.shape[1], axis=1)
    for c in columns:
        maps = NEXT.take(maps + c)
    state = np.concatenate([[START], compose_scan(maps)[START, :-1]]).astype(np.uint8)
    flags = np.empty(columns.shape, np.uint8)
    for j, c in enumerate(columns):
        flags[j] = STARTS.take(at := c + state)
        state = NEXT.take(at)
    flags = flags.T.ravel()[:n]
    out = (flags & HERE).astype(bool)
    out[:-1] |= (flags[1:] & BEFORE).astype(bool)
    return out


def pretokens(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of the texts in order, and how many each text has."""
    if not texts:
        return [], np.zeros(0, np.int64)
    joined = "\n".join(texts) + "\n"
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kinds = classes()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
    kinds[ends] = END
    at = starts(kinds)
    at[ends] = False
    begin = np.flatnonzero(at)
    n = np.diff(np.searchsorted(begin, ends), prepend=0)
    stop = np.append(begin[1:], 0)
    last = np.cumsum(n)[n > 0] - 1
    stop[last] = ends[n > 0]
    return [joined[a:b] for a, b in zip(begin.tolist(), stop.tolist())], n


def _safe(pieces: list[str]) -> list[str]:
    """Pre-tokens of a part of a text that are the same in the whole text and by themselves. The pattern looks ahead
    three characters at most, so the last ones may go on; and white space is taken otherwise at the end of a text."""
    pieces = pieces[:-4]
    while pieces and pieces[-1][-1].isspace():
        pieces = pieces[:-1]
    return pieces


def cut(text: str, limit: int = 1 << 22) -> Iterator[str]:
    """A long text in parts of about ``limit`` characters that end where pre-tokens do, so that a text of any length
    needs the memory of one part. A run longer than that is one part."""
    at = 0
    while len(text) - at > limit:
        size = limit
        while not (pieces := _safe(pretokens([text[at : at + size]])[0])) and at + size < len(text):
            size *= 2
        if not pieces:
            break
        n = sum(map(len, pieces))
        yield text[at : at + n]
        at += n
    yield text[at:]
