import random
from datetime import datetime, timedelta, timezone

from helpers import rows

from pulsegrid.operators.snapdiff import changes_by_delivery, snapshot_changes

T0 = datetime(2026, 1, 5, tzinfo=timezone.utc)
SCHEMA = "stream string, timestamp_utc timestamp, entity string, field string, value_text string, fetched_at_utc timestamp, chunk string, _leaf string"


def brute(records):
    kept = {}
    for s, t, e, f, v, fetched, chunk, _ in records:
        if t is None:
            continue
        text = (v or "").strip(" \t")
        key = (s, t, e, f)
        rank = (fetched is None, fetched or T0, chunk is None, chunk or "", text)
        if key not in kept or rank < kept[key][0]:
            kept[key] = (rank, text)
    out = []
    for s in {k[0] for k in kept}:
        times = sorted({k[1] for k in kept if k[0] == s})
        for a, b in zip(times, times[1:]):
            old = {k[2:]: v[1] for k, v in kept.items() if k[:2] == (s, a)}
            new = {k[2:]: v[1] for k, v in kept.items() if k[:2] == (s, b)}
            for key in old.keys() | new.keys():
                kind = "added" if key not in old else "removed" if key not in new else "changed" if old[key] != new[key] else None
                if kind:
                    out.append((s, *key, b.replace(tzinfo=None), kind))
    return sorted(out, key=str)


def check(spark, records, **kw):
    found = snapshot_changes(spark.createDataFrame(records, SCHEMA), **kw).collect()
    assert sorted(((r.stream, r.entity, r.field, r.timestamp_utc, r.change_kind) for r in found), key=str) == brute(records)
    return found


def random_deliveries(seed, n=40):
    r = random.Random(seed)
    state = {(f"e{i}", f): str(r.randrange(5)) for i in range(n) for f in ("x", "y")}
    out = []
    for d in range(5):
        for _ in range(4):
            key = r.choice([*state, (f"n{r.randrange(9)}", "x")])
            state.pop(key) if r.random() < 0.4 and key in state else state.__setitem__(key, r.choice(["7", "8 ", "", None]))
        t = T0 + timedelta(days=d)
        for (e, f), v in state.items():
            for copy in range(1 + (r.random() < 0.2)):
                out.append((r.choice(["p"]), t, e, f, v if copy == 0 or r.random() < 0.7 else "other", t + timedelta(seconds=9 * copy), f"c{copy}", "z"))
    r.shuffle(out)
    return out


def test_against_brute_force(spark):
    for seed in (1, 2):
        check(spark, random_deliveries(seed))
    check(spark, random_deliveries(3), leaf_bits=4, level_bits=2)


def test_blanks_nulls_and_missing_deliveries(spark):
    t = [T0 + timedelta(days=i) for i in range(3)]
    records = [
        ("a", t[0], "e", "f", " x\t", t[0], "c", ""), ("a", t[1], "e", "f", "x", t[1], "c", ""), ("a", t[2], "e", "f", "X", t[2], "c", ""),
        ("a", t[0], None, "f", None, t[0], "c", ""), ("a", t[1], None, "f", "", t[1], "c", ""), ("a", t[2], None, None, None, t[2], None, ""),
        ("b", t[0], "e", "f", "1", None, None, ""), ("b", t[2], "e", "f", "1\n", t[2], "c", ""), ("b", None, "e", "f", "9", t[2], "c", ""),
        (None, t[0], "e", "f", "1", t[0], "c", ""), (None, t[1], "g", "f", "1", t[1], "c", ""),
    ]
    found = check(spark, records)
    assert {(r.stream, r.entity, r.change_kind) for r in found} == {("a", "e", "changed"), ("a", None, "removed"), ("a", None, "added"), ("b", "e", "changed"), (None, "e", "removed"), (None, "g", "added")}


def test_empty_and_report(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert snapshot_changes(empty).count() == 0
    assert changes_by_delivery(snapshot_changes(empty)).count() == 0
    t = T0
    df = spark.createDataFrame([("a", t, "e", "f", "1", t, "c", ""), ("a", t + timedelta(1), "e", "g", "1", t, "c", "")], SCHEMA)
    assert rows(changes_by_delivery(snapshot_changes(df)), "added", "removed", "changed") == [(1, 1, 0)]
