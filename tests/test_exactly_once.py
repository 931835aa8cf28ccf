import random
from datetime import datetime, timedelta, timezone

from helpers import rows
from pyspark.sql import functions as F

from pulsegrid.operators.exactly_once import DeliveryIndex, _Ids, arrival_batches

T0 = datetime(2026, 1, 5, tzinfo=timezone.utc)
SCHEMA = "row_id long, timestamp_utc timestamp, stream string, entity string, field string, fetched_at_utc timestamp, chunk string, src string, ms string"


def make(n, seed, hot=0.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if r.random() < hot else r.randrange(n // 2)
        at = None if r.random() < 0.02 else T0 + timedelta(seconds=key, microseconds=r.randrange(1000))
        fetched = None if r.random() < 0.05 else T0 + timedelta(seconds=r.randrange(50))
        out.append((i, at, "s", r.choice(["e", None]), "f", fetched, r.choice(["c1", "c2", None]), "x", "y"))
    return out


def brute(data):
    best, ids = {}, [d for d in data if d[1] is not None]
    rank = lambda d: (d[5] is None, d[5] or T0, d[6] is None, d[6] or "", d[0])
    key = lambda d: (d[2], d[3], d[4], d[1].replace(microsecond=d[1].microsecond // 1000 * 1000))
    for d in ids:
        if key(d) not in best or rank(d) < rank(best[key(d)]):
            best[key(d)] = d
    return sorted((d[0],) for d in ids if best[key(d)][0] != d[0])


def test_batches_in_any_order_drop_the_same_rows(spark, tmp_path):
    data = make(600, 1)
    df = spark.createDataFrame(data, SCHEMA)
    for i, merge_every in enumerate((1, 9)):
        index = DeliveryIndex(spark, f"{tmp_path}/i{i}", prefix_bits=3, merge_every=merge_every)
        batches = arrival_batches(df, 4)
        for batch in reversed(batches) if i else batches:
            index.admit(batch)
        assert rows(index.dropped()) == brute(data)
        assert len(index.runs()) == (1 if merge_every == 1 else 4)
        index.compact()
        assert rows(index.dropped()) == brute(data) and len(index.runs()) == 1


def test_a_hot_identifier_and_unfinished_runs(spark, tmp_path):
    data = make(900, 2, hot=0.4)
    df = spark.createDataFrame(data, SCHEMA)
    index = DeliveryIndex(spark, f"{tmp_path}/i", prefix_bits=2)
    index.admit(df.filter("row_id < 500"))
    (tmp_path / "i" / "index-1-2" / "_temporary").mkdir(parents=True)  # a merge that failed while it was written
    index.admit(df.filter("row_id >= 500"))
    assert rows(index.dropped()) == brute(data)
    index.admit(df.filter("row_id >= 500"))  # once more, as after a failure behind the write
    assert rows(index.dropped().distinct()) == brute(data)
    again = DeliveryIndex(spark, f"{tmp_path}/i")  # found again with its own number of prefixes
    again.compact()
    assert again.bits == 2 and len(again.runs()) == 1 and rows(again.dropped().distinct()) == brute(data)


def test_the_index_stays_where_it_is(spark, tmp_path, capsys):
    df = spark.createDataFrame(make(200, 4), SCHEMA)
    index = DeliveryIndex(spark, f"{tmp_path}/i", prefix_bits=2)
    index.admit(df.filter("row_id < 100"))
    table = spark.table(index._bucketed("index-0-2"))
    pairs = df.select(F.lit(1).alias("prefix")).groupBy("prefix").cogroup(table.groupBy("prefix")).applyInArrow(lambda a, b: b.select(["prefix"]), "prefix int")
    pairs.explain()
    assert capsys.readouterr().out.count("Exchange") == 1  # the batch only


def test_identifiers_that_share_a_hash_are_told_apart():
    ids = lambda *x: _Ids([5] * len(x), x, [0] * len(x), [0] * len(x), [0] * len(x), x, ["c"])
    assert ids(1, 2, 4).find(ids(4, 3, 1)).tolist() == [2, -1, 0] and ids().find(ids(1)).tolist() == [-1]


def test_empty(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert arrival_batches(empty, 3) == []
    index = DeliveryIndex(spark, f"{tmp_path}/i")
    index.admit(empty)
    assert index.dropped().count() == 0
    index.admit(empty.unionByName(spark.createDataFrame(make(20, 3), SCHEMA)).withColumn("more", F.lit(1)))
    assert rows(index.dropped()) == brute(make(20, 3))
