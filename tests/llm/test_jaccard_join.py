"""The Jaccard join against all pairs of sets, for texts of rare and of frequent shingles, crowds and odd rows."""

import random
import re

import numpy as np
import pytest

from scorewright.llm import jaccard_join as J

SCHEMA = "doc_id long, text string"


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    sets = [shingles(x, k) for _, x in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(draw, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed,k,percent", [(1, 5, 80), (2, 2, 60), (3, 1, 90)])
def test_random_texts(spark, seed, k, percent):
    """A crowd of near copies, texts made of few passages that all share, short texts, copies and odd rows."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(3000)}"
    base = [word() for _ in range(90)]
    passages = [" ".join(word() for _ in range(draw.randint(3, 12))) for _ in range(6)]
    texts = near_copies(draw, base, 90, 5) + [" ".join(draw.sample(passages, draw.randint(1, 6))) for _ in range(150)]
    texts += [" ".join(word() for _ in range(draw.randint(1, 7))) for _ in range(60)] + ["A b", "a  B", "a b c d e", "A B\x0bc d\te"]
    rows = list(enumerate(texts, 10)) + [(1, texts[5]), (None, texts[6]), (None, "alone one two"), (3, None), (4, ""), (None, " "), (7, texts[200]), (7, texts[200])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS n", "'x' AS entries", "3 AS tokens", "4 AS mark")
    assert found(J.jaccard_components(df, k, percent)) == brute(rows, k, percent)


def test_empty_table(spark):
    assert J.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_partners_share_an_entry(percent):
    """Any two sets that are similar enough have a common entry, however many of their tokens are frequent."""
    draw = np.random.default_rng(percent)
    tokens = np.unique(draw.integers(0, 2**63, 400).astype(np.uint64))
    levels = dict(zip(tokens.tolist(), draw.choice([0, 5, 24, 30, 50], len(tokens), p=[0.1, 0.1, 0.3, 0.3, 0.2]).tolist()))

    def entries(s):
        return set(J.signatures(s, np.array([levels[x] for x in s.tolist()]), percent).tolist())

    similar = 0
    for _ in range(3000):
        n = int(draw.integers(1, 80))
        a = np.sort(draw.choice(tokens, n, replace=False))
        b = np.unique(np.concatenate([draw.choice(a, max(1, n - int(draw.integers(0, 2 + n // 4))), replace=False), draw.choice(tokens, int(draw.integers(0, 2 + n // 5)))]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common) and not np.array_equal(a, b):
            similar += 1
            assert entries(a) & entries(b), (a, b)
    assert similar > 50


def test_long_texts_are_split_whole(monkeypatch):
    text = "One two  three\nfour five six seven eight nine ten " * 40
    whole = J.tokens(text, 5, J.WordHashes())
    monkeypatch.setattr(J, "PART", 17)
    assert np.array_equal(J.tokens(text, 5, J.WordHashes()), whole) and len(whole) == 10


def test_bitmaps_drop_what_is_just_below_the_similarity(spark):
    """Candidates are sifted before sets are shipped: no partner is lost, and few others are kept."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(250)]
    texts = near_copies(draw, base, 120, 8) + ["one two", "one three"]
    sets = [J.tokens(x, 5, J.WordHashes()) for x in texts]
    schema = "node long, n long, bits array<long>"
    rows = spark.createDataFrame([(i, len(x), J.bitmap(x).tolist()) for i, x in enumerate(sets)], schema)
    both = rows.crossJoin(rows.toDF("node2", "n2", "bits2")).where("node < node2")
    kept = {(r.node, r.node2) for r in both.where(J.could_link("n", "n2", "bits", "bits2", 80)).select("node", "node2").collect()}
    common = {(i, j): len(np.intersect1d(sets[i], sets[j])) for j in range(len(sets)) for i in range(j)}
    partners = {(i, j) for (i, j), c in common.items() if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c)}
    assert partners <= kept
    assert len(common) > 3 * len(partners) and len(kept) < 1.5 * len(partners)


def test_entries_of_the_same_nodes_are_one(spark):
    schema = "node long, entries array<long>"
    rows = [(1, [10, 11, 12, 13]), (2, [10, 11, 12]), (1, [10, 11, 12, 13]), (3, [12, 14]), (None, []), (4, [14, 15]), (5, [16])]
    index = J.shared_entries(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, index.select("entry", "node", "pivot").collect())) == [(10, 1, 1), (10, 2, 1), (12, 1, 1), (12, 2, 1), (12, 3, 1), (14, 3, 3), (14, 4, 3)]


def test_repeated_rows_have_one_set(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (3, text + " x")], SCHEMA)
    rows = J.prints(docs, 5, 80).select("doc_id", "node", "n")
    sets = J.sets_of(docs, rows, rows.select("node").distinct(), 5)
    assert sorted(r.n for r in J.one_each(sets, "n").collect()) == [26, 27]


def test_what_the_bitmaps_settle_costs_no_sets_and_no_second_look(spark, monkeypatch):
    """Two texts that share an entry but not enough are compared once, by bitmaps; sets are made for likely pairs alone."""
    texts = [" ".join([*(f"g{g}w{i}" for i in range(21)), *(f"g{g}t{t}o{i}" for i in range(4))]) for g in range(10) for t in range(2)]
    texts += [" ".join([*(f"hw{i}" for i in range(24)), f"o{t}"]) for t in range(2)]
    rows, written, real = list(enumerate(texts)), {}, J.stored

    def stored(df, name):
        out = real(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(J, "stored", stored)
    assert found(J.jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 5, 80)
    assert written["index"] >= 22 and written["sets"] == 2 and written["rest"] == 0


def test_pairs_beyond_what_is_broadcast(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [*enumerate(near_copies(draw, base, 50, 4)), (7, " ".join(base)), (7, " ".join(base)), (None, "w1 w2")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    monkeypatch.setattr(J, "BROADCAST_PAIRS", 0)
    assert found(J.jaccard_components(df)) == brute(rows, 5, 80)
