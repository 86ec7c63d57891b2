from __future__ import annotations

import bench


def test_timings_of_one_query_and_of_the_stages(spark, monkeypatch):
    monkeypatch.setattr(bench, "HEADLINE", ["dense_key_digest"])
    sf_dir = "/root/testdata/sf0.001"
    assert set(bench.query_timings(spark, sf_dir)) == {"dense_key_digest"}
    stages = bench.stage_timings(spark, sf_dir)
    assert len(stages) == 5 and all(seconds > 0 for seconds in stages.values())
    assert bench.medians([{"a": 1.0}, {"a": 5.0}, {"a": 2.0}]) == {"a": 2.0}
