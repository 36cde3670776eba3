"""No single task writes a whole lot of the feed."""

import glob

from wagelens.checks import catalog, inputs


def test_lots_of_events_are_written_by_many_tasks(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    found = catalog.queries()["D3_streaming_first_seen"](spark, small)
    assert found.count() == inputs.table(spark, small, "events").select("user_id").distinct().count()
    assert len(glob.glob(f"{tmp_path}/arrivals/*.parquet")) > 4
