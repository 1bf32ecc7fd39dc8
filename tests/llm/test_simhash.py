"""SimHash near-duplicates against a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash

from scorewright.llm import components, simhash


def brute_fingerprint(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(fps, distance):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    fs = sorted(root)
    for i, a in enumerate(fs):
        for b in fs[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fs}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint():
    r = random.Random(0)
    for n in (0, 1, 3, 4, 5, 60):
        t = " ".join(r.choice(["Éa", "b c", "THE", "x1", "ß"]) + r.choice(["", "\t", "\x0b\n"]) for _ in range(n))
        assert simhash.fingerprint(t, 4) == brute_fingerprint(t, 4)


@pytest.mark.parametrize("n, spread, crowd", [(300, 6, 64), (400, 3, 8), (200, 2, 2)])
@pytest.mark.parametrize("distance", [4, 0, 2])
def test_links_lose_no_component(spark, monkeypatch, n, spread, crowd, distance):
    """Balls around a few centres, dense enough for crowds with pivots, and lone fingerprints."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    r = random.Random(n + distance)
    centres = [r.getrandbits(64) for _ in range(6)] + [0]
    fps = {r.getrandbits(64) for _ in range(50)}
    for _ in range(n):
        f = r.choice(centres)
        for b in r.sample(range(64), r.randint(0, spread)):
            f ^= 1 << b
        fps.add(f)
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(nodes, distance)
    unsigned = lambda x: x & (1 << 64) - 1
    for e in edges.collect():
        assert (unsigned(e.u) ^ unsigned(e.v)).bit_count() <= distance
    got = {}
    for x in components.components(edges).collect():
        got.setdefault(x.root, set()).add(unsigned(x.node))
    want = {}
    for f, root in brute_roots(fps, distance).items():
        want.setdefault(root, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_thresholds_sum_and_cost():
    r = np.random.default_rng(0)
    costs = [[np.zeros(40), *np.cumsum(r.random((5, 40)), axis=0)] for _ in range(3)]
    t = simhash.allocate(costs, 4)
    assert (t.sum(1) == 4 - 3 + 1).all() and (t >= -1).all()
    for i in range(40):
        best = min(sum(costs[g][x[g] + 1][i] for g in range(3)) for x in ((a, b, 2 - a - b) for a in range(-1, 5) for b in range(-1, 5)) if -1 <= x[2] <= 4)
        assert abs(sum(costs[g][t[i, g] + 1][i] for g in range(3)) - best) < 1e-9


def test_estimates_count_neighbours():
    h = np.random.default_rng(1).integers(0, 5, 1 << 6)
    e = simhash.estimates(h, 6, 3)
    for t in range(4):
        for v in (0, 13, 63):
            assert e[t, v] == sum(h[w] for w in range(64) if (v ^ w).bit_count() <= t)


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1400)} | {5000: 5000, 5001: 5000}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_and_kept_rows(spark):
    r = random.Random(5)
    base = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300))
    other = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300))
    rows = [(9, base), (3, base), (3, base), (4, base + " tail"), (6, other), (None, other), (8, None), (7, ""), (None, "lone words only here")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    fps = {t: simhash.fingerprint(t or "", 4) for _, t in rows}
    roots = brute_roots(set(fps.values()), 4)
    low = {}
    for i, t in rows:
        if i is not None:
            low[roots[fps[t]]] = min(i, low.get(roots[fps[t]], i))
    got = simhash.near_duplicates(d, 4, 4).collect()
    want = [(i, f"{fps[t]:016x}", low.get(roots[fps[t]])) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = simhash.keep_one(d, 4, 4).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in kept) == [(False, 3), (False, 6), (False, 7), (True, 0)]
