"""Phrase collocations against plain Python, and the cutting of long texts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from scorewright.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, top, longest=5):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    longer = {}
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = lang, w[i : i + k]
                longer[key] = max(longer.get(key, 0), a)
    out = {}
    for (lang, w), a in candidates.items():
        if longer.get((lang, w), -1) >= a:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, le, r, total[lang], -s) for lang, found in out.items() for i, (s, a, p, le, r) in enumerate(sorted(found)[:top]))


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,top,longest", [(3, 1000, 5), (8, 5, 5), (2, 40, 3)])
def test_random_texts(spark, least, top, longest):
    draw = random.Random(least)
    vocabulary = ["the", "The", "a", "b", "çé", "Zürich", "x\x00y", " ", "new", "york", "city"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", ";!"]
    texts = ["".join(draw.choice(vocabulary) + draw.choice(ends) for _ in range(draw.randint(0, 40))) for _ in range(120)]
    rows = [(i, x, draw.choice(["en", "de", "", None])) for i, x in enumerate(texts)]
    rows += [(None, "new york city", "en")] * 9 + [(1, None, "en"), (2, "", None), (3, "a a a a a a a a a", "de"), (4, "...", "fr")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS shard", "2 AS n", "'x' AS phrase", "'y' AS words")
    assert found(C.collocations(df, least, top, longest)) == brute(rows, least, top, longest)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_products_beyond_64_bits(spark, monkeypatch):
    rows = [("en", "a", 1, 3 * 10**12), ("en", "b", 1, 2 * 10**12), ("en", "a b", 2, 10**12), ("en", None, 0, 10**15)]
    monkeypatch.setattr(C, "phrase_counts", lambda docs, least, longest: spark.createDataFrame(rows, "lang string, phrase string, size int, n long"))
    got = found(C.collocations(None))
    assert got == [("en", 1, "a b", 10**12, 3 * 10**12, 2 * 10**12, 10**15, 1000 * 10**12 * 10**15 // (6 * 10**24))]


@pytest.mark.parametrize("size", [1, 7, 50])
def test_parts_keep_pieces_whole(monkeypatch, size):
    monkeypatch.setattr(C, "PART", size)
    text = b"one two three four. five,six;; seven eight nine ten eleven twelve\n\nend without a stop and more"
    cut = list(C.parts(text))
    assert b"".join(cut) == text and (size >= 50 or len(cut) > 3)
    pieces = lambda ws: [x.split() for x in b" ".join(ws).split(C.BORDER) if x.split()]
    assert pieces([w for x in cut for w in C.pieces(x)]) == pieces(C.pieces(text))


def test_every_phrase_is_counted_for_a_whole_cycle():
    """Where what shares their slots made "a b" and "b c" frequent before the word a was, "a b c" starts with a."""
    memo = C.WordHashes()
    words = [b"a", b"b", b"c", C.BORDER]
    batch = C.encoded_rows([("en", 0, C.hashed(words, memo).tobytes())])
    places = C.Places(C.hashed(words, memo), C.salts(["en"], [4]))
    places.longer()
    places.longer()
    first = np.full(1 << C.SLOT_BITS, C.NEVER, np.uint8)
    first[C.slots(places.keys[0][:3])] = [4, 1, 1]
    first[C.slots(places.keys[1][:2])] = 2
    whole = C.slots(places.keys[2])[0]
    counted = []
    for scan in range(12):
        known = np.where(first <= scan, first, C.NEVER).astype(np.uint8)
        counted += [scan] * sum((x == whole).sum() for x in C.active_slots(batch, known, scan, 4, 5))
    assert counted == [4, 5, 6, 7]


def test_frequent_slots_miss_nothing_in_a_small_table(monkeypatch):
    """Of the phrases that occur often enough none is lost where rare ones share slots."""
    bits, least, shards, draw = 10, 6, 4, random.Random(5)
    table = 1 << bits
    monkeypatch.setattr(C, "SLOT_BITS", bits)
    monkeypatch.setattr(C, "slots", lambda keys: ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64))
    monkeypatch.setattr(C, "count_slots", lambda rows, found, limit, result: result(sum((np.bincount(x, minlength=table) for b in rows for x in found(b)), np.zeros(table, np.int64))))

    class Shared:
        def __init__(self, value):
            self.value = value

        def destroy(self):
            pass

    class Session:
        sparkContext = type("Context", (), {"broadcast": staticmethod(Shared)})

    memo, f, parts = C.WordHashes(), Counter(), [[] for _ in range(shards)]
    for _ in range(150):
        words = [b"%d" % int(draw.paretovariate(0.7)) for _ in range(draw.randint(1, 9))]
        parts[draw.randrange(shards)].append(("en", 0, C.hashed([*words, C.BORDER], memo).tobytes()))
        f.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    batches = [[C.encoded_rows(p)] for p in parts]
    frequent = C.frequent_slots(lambda i: batches[i], shards, 5, least, Session())

    def slot(words):
        places = C.Places(C.hashed(list(words), memo), C.salts(["en"], [len(words)]))
        for _ in words[1:]:
            places.longer()
        return C.slots(places.keys[-1])[0]

    often = [w for w, n in f.items() if n >= least]
    assert len(often) > 20 and not [w for w in often if not frequent[slot(w)]]
