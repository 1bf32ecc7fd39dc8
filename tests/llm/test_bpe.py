"""BPE and token counts against the libraries whose results they give."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from scorewright.llm import bpe, pretoken, token_count
from scorewright.llm import queries as Q

RANKS, JSON = P.path(Q.BPE_RANKS), P.path(Q.COUNT_VOCABULARY)
PARTS = ["a", "s", "t", "r", "e", "v", "l", "l", "m", "d", "'", "'", " ", " ", "\n", "\t", "1", "²", "é", "中", "!", "-", "　", "\x85", "\x1c", "​", "😀", "'ll", "'re", "don't", "aaaa", "<|endoftext|>", "́", "İ"]


def noise(n, size, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, size))) for _ in range(n)]


def points(n, size, seed):
    r = random.Random(seed)
    pick = lambda: chr(r.choice([r.randint(32, 126), r.randint(97, 122), r.randint(0x80, 0x2FF), r.randint(0x4E00, 0x4FFF), r.randint(0x1F300, 0x1F6FF)]))
    return ["".join(pick() for _ in range(r.randint(0, size))) for _ in range(n)]


TEXTS = noise(1500, 150, 1) + points(500, 200, 2) + ["", "'", "'r", "'l", " ", "\n\n", "x" * 5000, "ab" * 3000, " " * 700 + "x", "the " * 2000]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_follow_the_pattern():
    pieces, n = pretoken.pretokens(TEXTS)
    pattern, at = regex.compile(P.PATTERN), 0
    for x, k in zip(TEXTS, n):
        assert pieces[at : at + k] == pattern.findall(x), x
        at += k
    assert at == len(pieces)


@pytest.mark.parametrize("limit", [8, 50])
def test_long_texts_are_cut_between_pretokens(limit):
    for x in TEXTS[:400] + ["", "y" * 300, " " * 90 + "'re" * 40]:
        parts = list(pretoken.cut(x, limit))
        assert "".join(parts) == x
        assert [p for y in parts for p in pretoken.pretokens([y])[0]] == pretoken.pretokens([x])[0], x


def test_results_of_texts_in_parts(reference, monkeypatch):
    for module in (bpe, token_count):
        monkeypatch.setattr(module, "cut", lambda x: pretoken.cut(x, 40))
    some = TEXTS[:200]
    ids, n = bpe.Vocabulary(RANKS).encode(some)
    assert n.tolist() == [len(reference.encode_ordinary(x)) for x in some]
    assert ids.tolist() == [i for x in some for i in reference.encode_ordinary(x)]
    want = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(some, add_special_tokens=False)]
    assert token_count.Transducer(JSON).counts(some).tolist() == want


def test_state_maps_compose():
    kinds = np.random.default_rng(0).integers(0, pretoken.N, (pretoken.N, 300), dtype=np.uint8)
    maps = pretoken.compose_scan(kinds)
    whole = np.arange(pretoken.N)
    for i in range(kinds.shape[1]):
        whole = kinds[whole, i]
        assert (maps[:, i] == whole).all()


def test_ids_equal_the_library(reference):
    v = bpe.Vocabulary(RANKS)
    ids, n = v.encode(TEXTS)
    at = 0
    for x, k in zip(TEXTS, n):
        assert ids[at : at + k].tolist() == reference.encode_ordinary(x), x[:60]
        at += k
    assert v.decode(ids).tobytes() == "".join(TEXTS).encode()


def test_ids_do_not_depend_on_what_was_met_before(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_MEMO", 50)
    v = bpe.Vocabulary(RANKS)
    for i in range(0, 400, 20):
        ids, _ = v.encode(TEXTS[i : i + 20])
        assert ids.tolist() == [t for x in TEXTS[i : i + 20] for t in reference.encode_ordinary(x)]


def test_vocabulary_whose_later_merges_have_lower_ranks(tmp_path):
    """A merge may form a pair of lower rank; that pair goes first within its piece."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"cb", b"ab", b"bca", b"aa", b"abab", b"ca", b"bb", b"cabc"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    odd = tiktoken.Encoding("odd", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    r = random.Random(3)
    texts = ["".join(r.choice("abc") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    v = bpe.Vocabulary(str(path))
    ids, n = v.encode(texts)
    ends = np.cumsum(n)
    assert [ids[e - k : e].tolist() for e, k in zip(ends, n)] == [odd.encode_ordinary(x) for x in texts]


def test_queue_pops_in_rank_order():
    q, r = bpe.RankQueue(70_000), np.random.default_rng(1)
    ranks, at = r.integers(0, 70_000, 500), np.arange(500)
    q.push(ranks, at)
    q.push(ranks[:100], at[:100])
    seen = []
    while (x := q.pop()) is not None:
        assert (np.diff(x[1]) > 0).all() and (ranks[x[1]] == x[0]).all()
        seen.append(x[0])
    assert seen == sorted(set(ranks.tolist()))


def test_digests(spark, reference):
    rows = [(i, x) for i, x in enumerate(TEXTS[:200])] + [(None, None), (7, "twice"), (7, "twice")]
    got = Q.bpe_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, x in rows:
        ids = reference.encode_ordinary(x or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((x or "").encode())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decode_is_the_same_in_a_step_of_its_own(spark):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS[:50])] + [(None, None)], "doc_id long, text string")
    one = bpe.encode(d, RANKS, decoded=True)
    two = bpe.decode(bpe.encode(d, RANKS), RANKS)
    assert one.exceptAll(two).isEmpty() and {bytes(r.decoded) for r in two.collect()} == {x.encode() for x in TEXTS[:50]} | {b""}


def test_counts_equal_the_library():
    t = token_count.Transducer(JSON)
    want = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(TEXTS, add_special_tokens=False)]
    assert t.counts(TEXTS).tolist() == want


def test_counts_when_the_compiled_table_starts_afresh(monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 40)
    monkeypatch.setattr(token_count, "MAX_MEMO", 30)
    t = token_count.Transducer(JSON)
    some = TEXTS[:300]
    want = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(some, add_special_tokens=False)]
    assert [int(t.counts([x])[0]) for x in some] == want


def test_count_columns(spark):
    d = spark.createDataFrame([(1, "é" * 3), (2, None), (3, "the " * 2000)], "doc_id long, text string")
    got = {r.doc_id: r for r in token_count.count_tokens(d, JSON, 1024).collect()}
    assert (got[1].n_bytes, got[2].n_bytes, got[2].n_tokens, got[2].over_limit, got[3].over_limit) == (6, 0, 0, False, True)
