"""The fold against a row-at-a-time model, in one shot, in slices and in batches."""

import contextlib
import datetime as dt
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from scdflow.functions import naive
from scdflow.operators import scd
from scdflow.schemas import CUSTOMER_TRACKED, CUSTOMER_TYPE1

START = dt.datetime(2024, 1, 1)
SCHEMA = (
    "customer_id bigint, partition int, offset bigint, op string, ts timestamp_ntz, "
    "first_name string, last_name string, email string, phone string, address string, "
    "city string, country string"
)


def random_changes(seed, n, hot=0.4, keys=30):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if r.random() < hot else r.randrange(1, keys)
        op = r.choices(["c", "u", "d", "r", None], [1, 6, 1, 2, 0.3])[0]
        # Some times lie well before that of the change ahead.
        time = START + dt.timedelta(minutes=i - r.choice([0, 0, 0, r.randrange(200)]))
        phone, city = r.choice(["1", "2", None]), r.choice(["X", None])
        rows.append((key, key % 3, i, op, time, "A", r.choice(["B", "C", None]), None, phone, None, city, "Y"))
    return rows


def model(rows):
    """What one event at a time makes of the changes: the rules in their plainest form."""
    current, versions, clock = {}, {}, {}
    for key, partition, offset, op, ts, *attributes in rows:
        ts = max(ts, clock.get(key, ts))
        type1, tracked = attributes[:3], attributes[3:]
        live = current.get(key)
        if op == "d":
            if live:
                live.update(valid_to=ts, is_current=False)
                del current[key]
                clock[key] = ts
            continue
        if live and op not in ("c", "u"):
            continue
        if live and live["tracked"] == tracked:
            live["type1"] = type1
            continue
        if live:
            live.update(valid_to=ts, is_current=False)
        clock[key] = ts
        number = live["version"] + 1 if live else 1
        new = {"version": number, "valid_from": ts, "valid_to": dt.datetime(9999, 12, 31)}
        new |= {"is_current": True, "tracked": tracked, "type1": type1}
        current[key] = versions[(key, partition, offset)] = new
    return versions


def plain(stored):
    return {
        (r["customer_id"], r["open_partition"], r["open_offset"]): {
            "version": r["version"],
            "valid_from": r["valid_from"],
            "valid_to": r["valid_to"],
            "is_current": r["is_current"],
            "tracked": [r[c] for c in CUSTOMER_TRACKED],
            "type1": [r[c] for c in CUSTOMER_TYPE1],
        }
        for r in stored.collect()
    }


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 20, "slice_rows": 60}, {"hot_rows": 5, "slice_rows": 40}])
def test_one_shot(spark, seed, sizes):
    rows = random_changes(seed, 900)
    got = scd.as_stored(scd.customer_dimension(spark.createDataFrame(rows, SCHEMA), **sizes))
    assert plain(got) == model(rows)


@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 20, "slice_rows": 50}])
def test_batches(spark, sizes):
    rows = random_changes(7, 500, hot=0.5, keys=12)
    cuts = [0, 130, 131, 320, 500]
    stored = None
    for a, b in zip(cuts, cuts[1:]):
        changes = spark.createDataFrame(rows[a:b], SCHEMA)

        def dimension(frame):
            return scd.customer_dimension(frame, **sizes)

        if stored is None:
            result = scd.as_stored(dimension(changes))
        else:
            result = scd.apply_to(stored, changes, "customer_id", dimension)
        # Stored as rows, so that each batch starts from data and not from a plan.
        stored = spark.createDataFrame(result.collect(), result.schema)
    assert plain(stored) == model(rows)
    assert stored.select("customer_key").distinct().count() == stored.count()


def test_slices_of_a_key_with_every_kind_of_run(spark):
    """Runs longer than a slice: only reads, only overwrites, only deletes."""
    ops = ["r"] * 30 + ["d"] * 25 + ["r"] * 30 + ["u"] * 40 + ["d"] + ["c"] * 30
    rows = [
        (1, 0, i, op, START + dt.timedelta(minutes=i), "A", str(i), None, "1", None, None, None)
        for i, op in enumerate(ops)
    ]
    got = scd.customer_dimension(spark.createDataFrame(rows, SCHEMA), hot_rows=10, slice_rows=8)
    assert plain(scd.as_stored(got)) == model(rows)


def test_change_flags_and_integrity_in_slices(spark):
    rows = random_changes(3, 600)
    changes = spark.createDataFrame(rows, SCHEMA).withColumn("seq", scd.by_address())
    sizes = {"hot_rows": 20, "slice_rows": 40}
    flags = scd.change_flags(changes, "customer_id", CUSTOMER_TRACKED, **sizes)
    opened = {(r["customer_id"], r["seq"]["partition"], r["seq"]["offset"]) for r in flags.filter("opens").collect()}
    expected = model(rows)
    assert opened == set(expected)

    versions = scd.customer_dimension(changes)
    whole = scd.integrity(versions, "customer_id").collect()[0]
    sliced = scd.integrity(versions, "customer_id", **sizes).collect()[0]
    assert whole == sliced
    assert whole["versions"] == len(expected)
    assert (whole["broken"], whole["keys_with_two_current"]) == (0, 0)
    torn = versions.withColumn(
        "valid_to", F.when(F.col("version") == 1, F.lit(START)).otherwise(F.col("valid_to"))
    )
    assert scd.integrity(torn, "customer_id").collect()[0]["broken"] > 0


def test_as_of_against_brute_force(spark):
    rows = random_changes(5, 500, hot=0.5)
    versions = scd.customer_dimension(spark.createDataFrame(rows, SCHEMA))
    r = random.Random(9)
    asked = [
        (n, r.choice([0, 0, *range(1, 32), None]), START + dt.timedelta(minutes=r.randrange(-20, 520)))
        for n in range(400)
    ]
    asked_frame = spark.createDataFrame(asked, "n int, customer_id bigint, order_date timestamp_ntz")
    all_versions = model(rows)
    expected = {}
    for n, key, at in asked:
        found = [v for (k, *_), v in all_versions.items() if k == key and v["valid_from"] <= at < v["valid_to"]]
        assert len(found) <= 1
        expected[n] = found[0]["version"] if found else None
    for sizes in ({}, {"hot_rows": 30, "slice_rows": 40}):
        got = scd.as_of(asked_frame, versions, "customer_id", "order_date", ["version"], **sizes)
        assert {row["n"]: row["version"] for row in got.collect()} == expected


def test_as_of_is_what_stood_at_the_time(spark):
    """However times run: the version found for a time is the one valid then."""
    versions = scd.customer_dimension(spark.createDataFrame(random_changes(11, 400), SCHEMA))
    for minutes in (30, 150, 299, 390):
        at = START + dt.timedelta(minutes=minutes)
        stood = scd.valid_at(versions, naive(at)).select("customer_id", "version").collect()
        asked = versions.select("customer_id").distinct().withColumn("at", naive(at))
        found = scd.as_of(asked, versions, "customer_id", "at", ["version"]).filter("version IS NOT NULL")
        assert {tuple(r) for r in stood} == {(r["customer_id"], r["version"]) for r in found.collect()}


def test_backward_interval_is_broken(spark):
    versions = scd.customer_dimension(spark.createDataFrame(random_changes(3, 200), SCHEMA))
    turned = versions.withColumns({"valid_from": F.col("valid_to"), "valid_to": F.col("valid_from")})
    assert scd.integrity(turned, "customer_id").collect()[0]["broken"] > 0


def test_literals_do_not_depend_on_the_time_zone_of_the_driver(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        shown = spark.range(1).select(naive(dt.datetime(2024, 1, 31)).cast("string")).first()[0]
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert shown == "2024-01-31 00:00:00"


def test_third_decimal_makes_no_version(spark):
    rows = [
        (1, 0, 1, "c", START, "p", None, None, None, 10.004, 4.0),
        (1, 0, 2, "u", START + dt.timedelta(1), "p", None, None, None, 10.003, 4.0),
        (1, 0, 3, "u", START + dt.timedelta(2), "q", None, None, None, 10.01, 4.0),
    ]
    schema = (
        "product_id bigint, partition int, offset bigint, op string, ts timestamp_ntz, "
        "product_name string, category string, brand string, description string, "
        "price double, cost double"
    )
    got = scd.product_dimension(spark.createDataFrame(rows, schema)).orderBy("version").collect()
    assert [(r["version"], float(r["price"]), r["product_name"]) for r in got] == [
        (1, 10.0, "p"),
        (2, 10.01, "q"),
    ]
    assert float(got[0]["margin_percentage"]) == 60.0


def test_plain_fold_shuffles_and_sorts_once(spark):
    changes = spark.createDataFrame(random_changes(1, 50), SCHEMA)
    plan = scd.customer_dimension(changes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort ") == 1


def test_versions_stay_in_their_slices(spark):
    """Only the ends of versions that run on into later slices are moved, not all versions."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        day = dt.datetime(2024, 1, 1)
        # A version of key 1 runs over many slices; key 2 has many versions.
        rows = [(1, 0, i, day + dt.timedelta(hours=i), "u", "a", f"n{i}") for i in range(60)]
        rows += [(2, 0, 100 + i, day + dt.timedelta(hours=i), "u", f"p{i // 7}", f"n{i}") for i in range(60)]
        changes = spark.createDataFrame(
            rows, "k long, partition int, offset long, ts timestamp_ntz, op string, phone string, name string"
        ).withColumn("seq", F.struct("partition", "offset"))
        whole = scd.fold(changes, "k", ["phone"], ["name"])
        cut = scd.fold(changes, "k", ["phone"], ["name"], hot_rows=10, slice_rows=8)
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            cut.explain()
        assert not re.search(r"Exchange hashpartitioning\([^)]*open_seq", out.getvalue())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
