"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import base64
import hashlib
import re
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from scorewright.llm import quality
from scorewright.llm import queries as Q
from scorewright.llm import simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in C.STAGES:
        after = C.stored(stage(spark, docs, SF), name)
        out[name] = (rows(docs), rows(after))
        docs = after
    return out


def test_names_and_columns(spark, stages):
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    for name, (_, after) in list(stages.items())[:-1]:
        assert set(next(iter(after.values()))) == {"doc_id", "text", "lang", "source", "n_chars"}, name


def test_run_gives_the_last_stage(spark, stages):
    assert rows(C.run(spark, SF)) == stages["byte_bpe"][1]


def test_quality(spark, stages):
    before, after = stages["quality_classifier"]
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels, Q._remainder(5) != 0)
    import numpy as np

    ids = sorted(before)
    scores = model.scores(np.array([quality.counts(before[i]["text"]) for i in ids]))
    assert after == {i: before[i] for i, s in zip(ids, scores) if s >= Q.QUALITY_THRESHOLD}
    assert 0.8 < len(after) / len(before) < 1


def test_lines(stages):
    before, after = stages["line_dedup"]
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    n = Counter(k for r in before.values() for k in {key(x) for x in r["text"].split("\n")} if k)
    assert set(after) == set(before) and any(v >= 10 for v in n.values())
    for i, r in before.items():
        kept = [x for x in r["text"].split("\n") if n[key(x)] < 10]
        dropped = len(kept) < r["text"].count("\n") + 1
        text = "\n".join(kept)
        assert after[i] == r | {"text": text, "n_chars": len(text) if dropped else r["n_chars"]}


def test_near_copies(stages):
    before, after = stages["simhash_near_dedup"]
    fps = {i: simhash.fingerprint(r["text"], Q.SIMHASH_SHINGLE) for i, r in before.items()}
    group = {i: i for i in fps}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= Q.SIMHASH_DISTANCE:
                group[max(find(a), find(b))] = min(find(a), find(b))
    assert after == {i: before[i] for i in ids if find(i) == i} and len(after) < len(before)


def test_contamination(spark, stages):
    before, after = stages["decontamination"]
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = WORD.findall(lower(r.text))
        grams |= {tuple(w[a : a + 13]) for a in range(max(len(w) - 12, 1))}
    clean = {}
    for i, r in before.items():
        w = WORD.findall(lower(r["text"]))
        hit = {k for n in {len(g) for g in grams} for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in grams for k in range(a, a + n)}
        if not hit or 20 * len(hit) < len(w):
            clean[i] = r
    assert after == clean and len(after) < len(before)


def test_ids(stages):
    before, after = stages["byte_bpe"]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(Q.BPE_RANKS), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(after) == set(before)
    for i, r in before.items():
        ids = library.encode_ordinary(r["text"])
        assert after[i]["n_tokens"] == len(ids)
        assert after[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert after[i]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_odd_rows_and_empty_tables(spark, tmp_path):
    """Nulls in any column, repeated rows, blank texts and further columns pass all stages; empty tables give none."""
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, 0), (2, "", None, None, 0), (3, "the same line", "en", "s", 13), (3, "the same line", "en", "s", 13), (None, "another\nline", "en", "s", 12)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, some in (("odd", odd), ("empty", [])):
        d = str(tmp_path / name)
        docs = spark.createDataFrame(some, schema).withColumn("key1", F.lit(1)).withColumn("score", F.lit("x"))
        docs.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(3, 1, 0)] if some else [], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, None), (None, "nothing of it")] if some else [], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = C.run(spark, d).collect()
        # the blank texts are one group, of which doc 1 stays; a row without doc_id stays where its group has no other
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == ([(False, 1), (False, 3), (True, 0)] if some else [])
