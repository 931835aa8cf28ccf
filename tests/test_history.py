import random
from datetime import datetime, timedelta, timezone

from helpers import rows

from pulsegrid.operators.history import version_history

T0 = datetime(2026, 1, 5, tzinfo=timezone.utc)
SCHEMA = "entity string, ts long, value double, first_seen_update_utc timestamp, last_seen_update_utc timestamp, version string"


def ms(m):
    return int(T0.timestamp() * 1000) + m * 60_000


def row(e, v, a, b):
    at = lambda m: None if m is None else T0 + timedelta(minutes=m)
    return (e, 1, v, at(a), at(b), "x")


def test_stays_returns_and_missing_instants(spark):
    data = [
        row("a", 5.0, 0, 10), row("a", 5.0, 5, 20), row("a", 7.0, 30, 30), row("a", 5.0, 40, None), row("a", 5.0, None, 900), row("a", None, 35, 36),
        row("b", 1.0, 0, 0), row("b", 1.0, 0, 0), row("c", None, 0, 0), row("d", 1.0, None, None), row(None, 1.0, 3, 3), row(None, 2.0, 3, 9),
    ]
    out = version_history(spark.createDataFrame(data, SCHEMA), ("entity", "ts"))
    assert rows(out, "entity", "version", "n_versions", "value", "from_ms", "to_ms") == [
        ("a", 1, 3, 5.0, ms(0), ms(30)), ("a", 2, 3, 7.0, ms(30), ms(40)), ("a", 3, 3, 5.0, ms(40), -1),
        ("b", 1, 1, 1.0, ms(0), -1), (None, 1, 2, 1.0, ms(3), ms(3)), (None, 2, 2, 2.0, ms(3), -1),
    ]


def test_spans_do_not_change_the_result(spark):
    r = random.Random(3)
    data = [row("hot", float(r.randrange(3)), m, m + r.randrange(5)) for m in r.sample(range(5000), 400)]
    df = spark.createDataFrame(data, SCHEMA)
    one, many = (rows(version_history(df, ("entity", "ts"), span_ms=s)) for s in (10**12, 600_000))
    assert one == many
    expected = []
    for _, _, v, a, _, _ in sorted(data, key=lambda x: (x[3], x[4], x[2])):
        if not expected or expected[-1][0] != v:
            expected.append((v, int(a.timestamp() * 1000)))
    assert [(x[4], x[5]) for x in one] == expected


def test_empty(spark):
    assert version_history(spark.createDataFrame([], SCHEMA), ("entity", "ts")).count() == 0
