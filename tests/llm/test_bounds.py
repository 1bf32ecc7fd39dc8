"""Bounds of what is broadcast, collected or dealt to one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import decontam, license_scan, quality


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_windows_that_many_items_share_hold_no_lists(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", broadcast)
    passage = "one two three four five six"
    bench = spark.createDataFrame([(i, f"{passage} tail{i % 3}") for i in range(40)] + [(None, passage), (7, passage)], "item_id long, text string")
    windows, pairs = decontam.item_windows(bench, 4)
    assert not [c for c, kind in windows.dtypes if c != "gram" and kind.startswith("array")]
    assert windows.select("gram").distinct().count() == windows.count() == 3 + 3
    assert pairs.count() == 4 * 40
    docs = spark.createDataFrame([(1, f"a {passage} b {passage}"), (2, "five six tail0 x four five six tail0"), (3, "none"), (1, passage)], "doc_id long, text string")
    found = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontam.scan(docs, bench, 4).collect())
    every = sorted(map(str, range(40)))
    assert found == [(1, 6, 6, every), (1, 14, 12, every), (2, 8, 4, sorted(str(i) for i in range(0, 40, 3))), (3, 1, 0, [])]


def test_repeated_rows_of_a_doc_id_vote_once(spark):
    rows = [(i, f"word{i} some text") for i in range(20)] + [(3, f"copy {i % 5}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    learn = lambda rows: quality.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels, F.lit(True))
    model, again = learn(rows), learn(rows[::-1])
    assert len(model.vectors) == 20 and model.labels.sum() == 10
    assert np.array_equal(model.vectors, again.vectors)


def test_all_mandatory_phrases_of_a_template_are_verified(spark):
    t = license_scan.Template("x", "one two and three four and five six and seven", ("one two", "three four", "five six", "seven"))
    # The third phrase has its words in other places; the words of the others stand where they should.
    texts = [t.text, t.text.replace("five six", "six five"), t.text.replace("seven", "eight"), t.text.replace("and", "or")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: len(r.matches) for r in license_scan.scan(docs, (t,), ()).collect()}
    assert found == {0: 1, 1: 0, 2: 0, 3: 1}
