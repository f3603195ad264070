import os
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import rows
from starmill.operators import folders
from starmill.plans import changes
from starmill.streaming import sales_stream


def test_merge_takes_the_latest_change_per_key(spark):
    stored = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "id string, v string")
    feed = spark.createDataFrame([("a", "x", False, 1), ("a", "y", None, 2), ("b", "z", True, 5), ("d", None, False, 1), ("e", "q", True, 1),
                                  ("f", "n", None, 3), (None, "n", False, 3)],
                                 "id string, v string, deleted boolean, version int")
    merged = changes.merge_changes(stored, feed, "id", "version", "deleted")
    assert rows(merged) == sorted([("a", "y"), ("c", None), ("d", None), ("f", "n")], key=repr)


def test_history_against_a_plain_loop(spark):
    rnd = random.Random(3)
    data = [(f"C{rnd.choice([0, 0, rnd.randint(0, 9)])}", date(2024, 1, 1) + timedelta(days=rnd.randint(0, 25)), rnd.choice(["x", "y", None]))
            for _ in range(200)]
    got = rows(changes.customer_history(spark.createDataFrame(data, "id string, day date, city string"), "id", "day", ["city"]))
    expected = []
    for key in {d[0] for d in data}:
        days = {}
        for _, day, city in (d for d in data if d[0] == key):
            days[day] = max(days.get(day) or "", city or "") or None
        periods = []
        for day in sorted(days):
            if not periods or periods[-1][0] != days[day]:
                periods.append((days[day], day))
        for i, (city, start) in enumerate(periods):
            end = periods[i + 1][1] if i + 1 < len(periods) else None
            expected.append((key, city, start, end, end is None))
    assert got == sorted(expected, key=repr)


def test_stream_appends_each_sale_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    base = datetime(2024, 1, 1)

    def drop(ids):
        df = spark.createDataFrame([(i, base + timedelta(minutes=i)) for i in ids], "sale_id long, ts timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(source)
        return df.schema

    def ingest(schema):
        stream = sales_stream.read_stream(spark, source, schema)
        sales_stream.append_stream(stream, "sale_id", target, checkpoint).awaitTermination()

    ingest(drop([1000, 1001, 1002, 1002]))
    ingest(drop([1002, 1003, 1001, 1004]))
    ingest(drop([500, 1]))  # hours behind the others
    assert rows(spark.read.parquet(target).select("sale_id")) == [(1,), (1000,), (1001,), (1002,), (1003,), (1004,), (500,)]


def _files(path):
    return {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(f"k{i}", i) for i in range(200)] + [(None, 1), (None, None)]
    changes.create_buckets(spark.createDataFrame(data, "id string, v int"), path, "id", 16)
    before = _files(path)
    feed = spark.createDataFrame([("k3", -1, False, 1), ("new", 7, False, 1), ("k5", 0, True, 1), (None, 9, False, 1)],
                                 "id string, v int, deleted boolean, version int")
    for _ in range(2):
        touched = changes.merge_into_buckets(spark, path, feed, "version", "deleted")
        assert 1 <= len(touched) <= 3
        kept = {k: t for k, t in before.items() if not any(k[0].endswith(f"_bucket={b}") for b in touched)}
        assert kept.items() <= _files(path).items() and len(kept) > 10
        want = [("k3", -1), ("new", 7)] + [r for r in data if r[0] not in ("k3", "k5")]
        assert rows(changes.read_buckets(spark, path)) == sorted(want, key=repr)
    everything = spark.createDataFrame([(i, v, True, 2) for i, v in want], "id string, v int, deleted boolean, version int")
    changes.merge_into_buckets(spark, path, everything, "version", "deleted")
    assert rows(changes.read_buckets(spark, path)) == sorted([(None, 1), (None, None)], key=repr)
    assert changes.merge_into_buckets(spark, path, feed.where("false"), "version", "deleted") == []


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_merge_that_died_is_completed_or_dropped(spark, tmp_path, monkeypatch, moves):
    path, data = str(tmp_path / "t"), [(i, 0) for i in range(100)]
    changes.create_buckets(spark.createDataFrame(data, "id int, v int"), path, "id", 4)
    feed = spark.createDataFrame([(i, 1, i % 2 == 0, 1) for i in range(100)], "id int, v int, deleted boolean, version int")
    rename, done = folders.rename, []

    def fails(spark_, source, goal):
        if len(done) == moves:
            raise OSError("died")
        done.append(goal)
        rename(spark_, source, goal)

    with monkeypatch.context() as m:
        m.setattr(folders, "rename", fails)
        with pytest.raises(OSError):
            changes.merge_into_buckets(spark, path, feed, "version", "deleted")
    assert rows(changes.read_buckets(spark, path)) == sorted([(i, 1) for i in range(1, 100, 2)], key=repr)
    write = changes._write_buckets

    def breaks(df, to):
        write(df, to)
        raise OSError("died")

    monkeypatch.setattr(changes, "_write_buckets", breaks)
    again = spark.createDataFrame([(1, 5, False, 2)], "id int, v int, deleted boolean, version int")
    with pytest.raises(OSError):
        changes.merge_into_buckets(spark, path, again, "version", "deleted")
    assert rows(changes.read_buckets(spark, path)) == sorted([(i, 1) for i in range(1, 100, 2)], key=repr)


def test_late_versions_and_members_as_of_a_day(spark):
    rnd, start = random.Random(5), date(2023, 12, 20)
    make = lambda n: [(f"C{rnd.randint(0, 6)}", start + timedelta(days=rnd.randint(0, 90)), rnd.choice(["x", "y", None])) for _ in range(n)]
    schema = "id string, day date, city string"
    history = changes.customer_history(spark.createDataFrame(make(60), schema), "id", "day", ["city"])
    late = list({(k, d): (k, d, c) for k, d, c in make(15)}.values()) + [(None, start, "x"), ("new", start, "x")]
    states = {}
    for key, city, since, *_ in rows(history):
        states.setdefault(key, {})[since] = city
    for key, day, city in late[:-2] + late[-1:]:
        states.setdefault(key, {})[day] = city
    got = changes.insert_versions(history, spark.createDataFrame(late, schema), "id", "day", ["city"])

    def member(key, day):
        known = [d for d in states.get(key, {}) if d <= day]
        return (True, states[key][max(known)]) if known else (None, None)

    facts = [(f"C{rnd.randint(0, 8)}", start + timedelta(days=rnd.randint(-40, 200))) for _ in range(300)] + [(None, start), ("C1", None)]
    found = changes.as_of(spark.createDataFrame(facts, "id string, sold date"), "sold",
                          got.withColumn("known", got["id"].isNotNull()).drop("is_current"), "id")
    want = [(k, d, *reversed(member(k, d) if k and d else (None, None))) for k, d in facts]
    assert rows(found, "id", "sold", "city", "known") == sorted(want, key=repr)
    for key in states:
        periods = sorted(((r[2], r[3], r[1]) for r in rows(got) if r[0] == key), key=lambda p: p[0])
        assert all(a[1] == b[0] and a[2] != b[2] for a, b in zip(periods, periods[1:])) and periods[-1][1] is None
    assert changes.as_of(spark.createDataFrame([], "id string, sold date"), "sold", got, "id").count() == 0
