"""What steps of an operator leave behind in the driver and in the shared folder."""

import os

from traceframe.llm import common, components


def test_a_step_has_the_drivers_garbage_collected(spark, monkeypatch):
    called = []
    monkeypatch.setattr(common, "let_go", called.append)
    assert common.stored(spark.range(3)).count() == 3
    assert len(called) == 1


def test_rounds_of_components_are_tables_that_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path))
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a long, b long")
    got = components.components(edges)
    assert len(os.listdir(tmp_path)) == 1
    assert {(r["node"], r["label"]) for r in got.collect()} == {(i, 0) for i in range(41)} | {(90, 90), (91, 90)}
