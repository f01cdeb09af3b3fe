"""Statistics merged per load, compared with one full read."""
import math
import random
import re
import statistics

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from paneltide.operators.running_stats import RunningDetector

SCHEMA = StructType().add("series", "string").add("at", "integer").add("value", "double")


def _detector(tmp_path, threshold=1.5):
    return RunningDetector(str(tmp_path / "running"), SCHEMA, ("series",), threshold)


def _add(spark, detector, loads):
    for n, rows in enumerate(loads):
        detector.add(spark.createDataFrame(rows, SCHEMA), n)


def _full(rows, threshold=1.5):
    """(series, at) -> z of a plain full read, beyond the threshold."""
    out = {}
    for s in {r[0] for r in rows}:
        vals = [r[2] for r in rows if r[0] == s and r[2] is not None]
        if len(vals) < 2 or statistics.stdev(vals) == 0:
            continue
        mean, dev = statistics.fmean(vals), statistics.stdev(vals)
        for _, at, v in (r for r in rows if r[0] == s and r[2] is not None):
            if abs((v - mean) / dev) > threshold:
                out[(s, at)] = round((v - mean) / dev, 9)
    return out


def _alerts(df):
    return {(r["series"], r["at"]): round(r["z_score"], 9) for r in df.collect()}


def _random_loads(seed):
    rnd, at, loads = random.Random(seed), 0, []
    for n in range(4):
        rows = []
        for _ in range(0 if n == 2 else 60):
            s = rnd.choice(["a", "a", "a", "b", "c", None, "flat", "none"])
            v = {"flat": 5.0, "none": None}.get(s, rnd.choice([None, rnd.gauss(1e6, 1), rnd.gauss(1e6, 30)]))
            rows.append((s, at, v))
            at += 1
        loads.append(rows + ([("late", -1, 3.0)] if n == 3 else []))
    return loads


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_give_the_alerts_of_one_full_read(spark, tmp_path, seed):
    loads, detector = _random_loads(seed), _detector(tmp_path)
    seen = []
    for n, rows in enumerate(loads):          # one load is empty
        detector.add(spark.createDataFrame(rows, SCHEMA), n)
        seen += rows
        want = _full(seen)
        assert _alerts(detector.current(spark, n)) == pytest.approx(want, abs=1e-6)
        own = {k: z for k, z in want.items() if k in {(r[0], r[1]) for r in rows}}
        assert _alerts(detector.of_load(spark, n)) == pytest.approx(own, abs=1e-6)
    got = {r["series"]: r for r in detector.through(spark, 3).collect()}
    for s in {r[0] for r in seen}:
        vals = [r[2] for r in seen if r[0] == s and r[2] is not None]
        if not vals:
            assert s not in got
            continue
        assert got[s]["n"] == len(vals) and (got[s]["low"], got[s]["high"]) == (min(vals), max(vals))
        assert math.isclose(got[s]["mean"], statistics.fmean(vals), rel_tol=1e-12)
        if len(vals) > 1 and s != "flat":
            assert math.isclose(got[s]["m2"], statistics.variance(vals) * (len(vals) - 1), rel_tol=1e-9)
    assert got["flat"]["m2"] == 0.0


def test_earlier_rows_are_judged_anew(spark, tmp_path):
    """Row 3 of ``x`` becomes an alert through the second load; row 5 of ``y`` stops being one."""
    first = [("x", i, v) for i, v in enumerate([0.0, 0.0, 10.0, 12.0])] + \
            [("y", i, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 1.0, 9.0])]
    second = [("x", 10 + i, 0.5) for i in range(8)] + [("y", 10 + i, 9.0) for i in range(6)]
    detector = _detector(tmp_path)
    _add(spark, detector, [first, second])
    assert _alerts(detector.of_load(spark, 0)).keys() == {("y", 5)}
    assert _alerts(detector.current(spark, 1)) == _full(first + second)
    assert ("x", 3) in _full(first + second) and ("y", 5) not in _full(first + second)
    assert [r["series"] for r in detector.reopened(spark, 1).collect()] == ["x"]


def test_a_load_added_again_replaces_itself(spark, tmp_path):
    detector = _detector(tmp_path)
    a, b = [("s", i, float(i)) for i in range(5)], [("s", 9, 40.0)]
    _add(spark, detector, [a, [("s", 8, 1000.0)]])
    detector.add(spark.createDataFrame(b, SCHEMA), 1)
    assert _alerts(detector.current(spark, 1)) == _full(a + b)
    assert detector.through(spark, 1).first()["n"] == 6


def test_moments_before_must_be_there(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        _detector(tmp_path).add(spark.createDataFrame([("s", 1, 1.0)], SCHEMA), 2)


def test_a_detection_reads_its_load_and_one_moments_table(spark, tmp_path):
    detector = _detector(tmp_path)
    _add(spark, detector, [[("s", 10 * n + i, float(i)) for i in range(3)] for n in range(3)])
    df = detector.of_load(spark, 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id#\d+L? = 2", plan)
    assert plan.count("FileScan") == 2
    assert set(re.findall(r"moments-\d", " ".join(df.inputFiles()))) == {"moments-2"}


def test_empty_history(spark, tmp_path):
    detector = _detector(tmp_path)
    _add(spark, detector, [[], []])
    assert detector.current(spark, 1).count() == 0 and detector.through(spark, 1).count() == 0
