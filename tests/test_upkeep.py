"""Resets of many tables in one pass, and snapshot files of folders whose names begin alike."""

import json

import pytest
from millrace.operators import changes
from millrace.sources import files
from pyspark.sql.utils import AnalysisException

ROWS = "table string, _op string, _lsn long"


def test_resets_by_table(spark):
    states = spark.createDataFrame([("same", "S", 5), ("same", "U", 9), ("other", "S", 5), ("cut", "U", 9), ("old cut", "U", 9), ("quiet", "U", 1), (None, "U", 3)], ROWS)
    later = spark.createDataFrame([("same", "S", 5), ("same", "U", 12), ("other", "S", 20), ("cut", "T", 10), ("old cut", "T", 9), ("new", "U", 1), (None, "T", 2)], ROWS)
    got = {r.table: r.reset for r in changes.resets(states, later, "table").filter("table IS NOT NULL").collect()}
    assert got == {"same": False, "other": True, "cut": True, "old cut": False, "quiet": False, "new": True}
    for name, reset in got.items():
        assert changes.needs_reset(states.filter(states.table == name), later.filter(later.table == name)) is reset
    assert changes.needs_reset(states.limit(0), later.limit(0))


def test_later_paths_win_by_whole_names(spark, tmp_path):
    run = lambda v: json.dumps({"run_key": "r", "run_at": "2024-01-01T00:00:00Z", "metrics": [{"area": "a", "metric": "m", "dimension": "d", "value": v}]})
    for name, value in (("r 1+%", 1.0), ("r 1+%0", 2.0)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.json").write_text(run(value))
    paths = [str(tmp_path / "r 1+%"), str(tmp_path / "r 1+%0")]
    for order in (paths, paths[::-1]):
        last = 2.0 if order[-1].endswith("0") else 1.0
        for given in (order, [f"file://{p}/" for p in order], [f"{p}/f.json" for p in order]):
            assert [r.value for r in files.collect_runs(spark, given)[1].collect()] == [last]
    with pytest.raises(AnalysisException):
        files.collect_runs(spark, [str(tmp_path / "none")])
