"""Detection threshold, top-k, dispatch and the size-checked join."""
import datetime as dt

from paneltide.operators import anomalies
from paneltide.params import Params

P = Params(detected_at=dt.datetime(2024, 1, 2))


def test_threshold_is_strict(spark):
    # values chosen so that one row has |z| exactly 2 (excluded) -> n=5: 0,0,0,0,x
    rows = [("gdp_annual", "DE", y, v) for y, v in
            zip(range(2000, 2010), [0.0] * 9 + [10.0])]
    df = spark.createDataFrame(rows, "dataset string, country_code string, year int, value double")
    out = anomalies.detect_panel_anomalies(df, P).collect()
    assert [(r["year"], r["severity"]) for r in out] == [(2009, "LOW")]
    z = out[0]["z_score"]
    assert abs(z - 2.846) < 1e-3 and out[0]["detected_at"] == dt.datetime(2024, 1, 2)


def test_equal_two_excluded(spark):
    # mean 0.5, sample std of (0, 1, 0, 1 ...) variants: build |z| == 2 exactly
    import math
    n = 5
    vals = [0.0, 0.0, 0.0, 0.0, 1.0]
    mean = sum(vals) / n
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1))
    z = (1.0 - mean) / std
    assert z < 2  # (n-1)/sqrt(n) bound: a 5-point series never reaches 2
    df = spark.createDataFrame([("g", "DE", i, v) for i, v in enumerate(vals)],
                               "dataset string, country_code string, year int, value double")
    assert anomalies.detect_panel_anomalies(df, P).count() == 0


def test_top_k_per_dataset(spark):
    rows = []
    for c in range(5):
        rows += [("gdp_annual", f"C{c}", y, 0.0) for y in range(20)]
        rows.append(("gdp_annual", f"C{c}", 99, 100.0 + c))
    df = spark.createDataFrame(rows, "dataset string, country_code string, year int, value double")
    out = anomalies.detect_panel_anomalies(df, P.with_(top_k=3)).collect()
    assert len(out) == 3


def test_dispatch(spark):
    ev = spark.createDataFrame([("x_full_pipeline",), ("gdp_annual",), ("nope",)], "dataset string")
    out = anomalies.dispatch(ev).groupBy("dataset").count().collect()
    assert {r["dataset"]: r["count"] for r in out} == {"x_full_pipeline": 4, "gdp_annual": 1}


def test_alert_message_round_trip(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    alerts = spark.createDataFrame(
        [("gdp_annual", "DE", 2001, None, 2.5, 1.0, 1.0, "LOW", ts)],
        "dataset string, country_code string, year int, value double, z_score double, "
        "mean double, std_dev double, severity string, detected_at timestamp_ntz")
    back = anomalies.parse_alert_messages(anomalies.alert_messages(alerts)).first()
    assert back["value"] == 0.0 and back["z_score"] == 2.5 and back["detected_at"] == ts


def test_event_detection_hot_type_same_on_both_joins(spark):
    """One event type holds most rows: broadcast and sort-merge join of the
    statistics give the same alerts."""
    import random
    rnd = random.Random(7)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i % 40,
             "hot" if i % 10 else "cold", round(rnd.gauss(50, 10) + (90 if i % 97 == 0 else 0), 2),
             "{}") for i in range(3000)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                                     "event_type string, value double, props string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    a = sorted(tuple(r) for r in anomalies.detect_event_anomalies(ev, P).collect())
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        b = sorted(tuple(r) for r in anomalies.detect_event_anomalies(ev, P).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b and len(a) > 0
    assert {r[0] for r in a} <= {"hot", "cold"}
