"""Language id, quality scores and fingerprints: held-out accuracy and plain Python versions."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import fingerprint, lang_id, quality
from scorewright.llm import queries as Q

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [1, 2, 7, 60])
def test_viterbi_is_optimal(n):
    r = np.random.default_rng(n)
    scores = r.normal(size=(3 * n, 4)).astype(np.float32) * 6
    size = np.array([n, 2 * n, 0])
    first = np.cumsum(size) - size
    got = lang_id.viterbi(scores, first, size, 9.0)
    for a, k in zip(first[:2], size[:2]):
        s, path = scores[a : a + k].astype(float), got[a : a + k]
        best = s[0]
        for t in range(1, k):
            best = (best[:, None] - 9 * (1 - np.eye(4))).max(0) + s[t]
        assert abs(s[np.arange(k), path].sum() - 9 * (np.diff(path) != 0).sum() - best.max()) < 1e-3


@pytest.fixture(scope="module")
def languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return lang_id.learn(docs, Q._remainder(3) != 1)


def test_held_out_languages(spark, languages):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(Q._remainder(3) == 1)
    got = lang_id.label_languages(docs, languages).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a > 0.97 and 0 <= r.lo and r.hi <= 1


def test_spans_of_a_mixed_text(spark, languages):
    texts = {r.lang: r.text.replace("\n", " ")[:600] for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60 and n_chars > 900 and text not like '%|%'").collect()}
    a, b = texts["en"], texts["fr"]
    lang, score, spans = lang_id.label([a + " " + b, "Привет мир", "42 !!"], languages)
    assert [s["lang"] for s in spans[0]] == ["en", "fr"] and abs(spans[0][0]["stop"] - len(a)) < 40 and 0.3 < score[0] < 0.7
    assert lang[1] in languages.languages and (lang[2], score[2], spans[2]) == ("und", 0.0, [])


def test_script_narrows_languages():
    model = lang_id.Model(["el", "en"], np.zeros((lang_id.BUCKETS, 2), np.float32), np.zeros((lang_id.OTHER + 1, 2), bool))
    model.scripts[list(lang_id.SCRIPTS).index("greek"), 0] = model.scripts[list(lang_id.SCRIPTS).index("latin"), 1] = True
    assert lang_id.label(["λόγος και", "word and", "word λόγος λόγος"], model)[0] == ["el", "en", "el"]


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels, Q._remainder(5) != 0)
    got = quality.score(docs, model).join(labels.where((Q._remainder(5) == 0) & F.col("quality").isNotNull()), "doc_id").select("score", "quality").collect()
    low, high = [r.score for r in got if r.quality == 0], [r.score for r in got if r.quality == 1]
    assert all(0 <= s <= 1 for s in low + high)
    assert np.mean([a < b for a in low for b in high]) > 0.95
    assert np.mean([s >= Q.QUALITY_THRESHOLD for s in high]) > 0.97


def test_neighbour_votes_are_exact():
    r = np.random.default_rng(0)
    model = quality.fit(r.poisson(0.05, (200, quality.TERMS)).astype(np.float32), r.integers(0, 2, 200))
    rows = r.poisson(0.05, (30, quality.TERMS)).astype(np.float32)
    got, x = model.scores(rows), model.latent(rows)
    for i in range(30):
        c = model.vectors @ x[i]
        near = np.argsort(-c)[: quality.NEIGHBOURS]
        w = np.maximum(c[near], 0).astype(float) ** quality.SHARPNESS
        assert abs(got[i] - (w * model.labels[near]).sum() / w.sum()) < 1e-6


def brute_likeness(x, y):
    a, b = Counter(fingerprint.pieces(x)), Counter(fingerprint.pieces(y))
    total = sum((a + b).values())
    return 1 - sum(((a - b) + (b - a)).values()) / total if total else 1.0


def test_peeling_recovers_all_differences():
    r = np.random.default_rng(2)
    parts = [f"paragraph {i}." for i in range(400)] + ["again.\n"] * 5 + ["word " * 300]
    texts = ["".join(r.choice(parts, r.integers(0, 200))) for _ in range(60)] + ["", "", "x"]
    got = fingerprint.compare(texts, texts[1:] + texts[:1])
    for i, (x, y) in enumerate(zip(texts, texts[1:] + texts[:1])):
        h = len(x) // 2
        edited = x[: len(x) - h] + y[:h]
        assert got["edited_sha256"][i] == hashlib.sha256(edited.encode()).hexdigest() and got["n_chars"][i] == len(x)
        assert abs(got["near_edited"][i] - brute_likeness(x, edited)) < 1e-12 and abs(got["near_next"][i] - brute_likeness(x, y)) < 1e-12
    assert got["fingerprint"][60] == got["fingerprint"][61] != got["fingerprint"][62]


def test_successors(spark):
    rows = [(i * 8 % 301 - 50, f"é{i}. " * (i % 9) + f"tail {i}") for i in range(300)]
    got = {r.doc_id: r for r in fingerprint.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == 300
    for (i, x), (_, y) in zip(order, order[1:] + order[:1]):
        h = len(x) // 2
        assert got[i].edited_sha256 == hashlib.sha256((x[: len(x) - h] + y[:h]).encode()).hexdigest()
        assert abs(got[i].near_next - brute_likeness(x, y)) < 1e-12
