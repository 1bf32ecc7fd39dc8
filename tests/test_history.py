"""The run history: what the run queries leave undone."""

from scorewright.operators import store
from scorewright.plans import history as H, registry as R

from conftest import SF_SMALL


def test_run_queries_merge_no_latest_scores(spark, monkeypatch):
    written = []
    cut = H.cut_lineage
    monkeypatch.setattr(R, "_DERIVED", {})
    monkeypatch.setattr(H, "cut_lineage", lambda df, name="stage": written.append(name) or cut(df, name))
    assert R.QUERIES["s6_run_state_from_log"](spark, SF_SMALL).count() == 5
    assert "latest" not in written and "scored_runs" in written
    h = R.history(spark, SF_SMALL)
    assert h.latest.count() == store.latest_scores(h.predictions).count() > 0
    assert written.count("latest") == h.passed.count() > 0
    assert h.latest is h.latest
