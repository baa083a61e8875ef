"""Envelopes: operation, image and outcome for each shape, and the checks on rows."""

import datetime as dt
import itertools
import json

import pytest

from scdflow.operators import envelope, validate
from scdflow.schemas import CUSTOMERS, ORDER_ITEMS, PRODUCTS, RECORD

ROW = {"customer_id": 7, "email": "a@b.c"}
OLD = {"customer_id": 8, "email": "a@b.c"}
ABSENT = object()


def read(spark, values, topic=CUSTOMERS):
    rows = [
        (topic, 0, n, dt.datetime(2024, 1, 1), None, v if v is None or isinstance(v, str) else json.dumps(v))
        for n, v in enumerate(values)
    ]
    return envelope.normalize(spark.createDataFrame(rows, RECORD))


def model(event, items=False):
    """(op, customer_id or None when skipped) of a well-formed envelope."""
    if "payload" in event:
        body, op = event["payload"], event["payload"].get("op", "c")
    else:
        body = event
        op = "c" if event.get("before") is None else "u"
        if event.get("after") is None:
            op = "d"
    image = body.get("before") if op == "d" and not items else body.get("after")
    if items and op != "c":
        image = None
    return op, image["customer_id"] if image else None


def envelopes():
    images = [ABSENT, None, {}, ROW]
    ops = [ABSENT, None, "c", "u", "d", "r", "x"]
    for wrapped, before, after, op in itertools.product([True, False], images, images, ops):
        fields = {"before": OLD if before is ROW else before, "after": after, "op": op}
        body = {k: v for k, v in fields.items() if v is not ABSENT}
        yield {"payload": body} if wrapped else body


@pytest.mark.parametrize("topic", [CUSTOMERS, ORDER_ITEMS])
def test_truth_table(spark, topic):
    events = list(envelopes())
    got = read(spark, events, topic).selectExpr(
        "offset", "op", "outcome", "wrapped", "try_variant_get(image, '$.customer_id', 'int') as id"
    )
    for row in got.collect():
        event = events[row["offset"]]
        op, found = model(event, topic == ORDER_ITEMS)
        assert (row["op"], row["id"]) == (op, found), event
        assert row["outcome"] == ("skipped" if found is None else "change")
        assert row["wrapped"] == ("payload" in event)


@pytest.mark.parametrize(
    ("value", "outcome", "error"),
    [
        (None, "tombstone", None),
        ("null", "tombstone", None),
        ("{bad", "failed", "JSONDecodeError"),
        ("", "failed", "JSONDecodeError"),
        ("[1]", "failed", "AttributeError"),
        ('"text"', "failed", "AttributeError"),
        (" 5", "failed", "TypeError"),
        ("true", "failed", "TypeError"),
        ('{"payload":null}', "failed", "AttributeError"),
        ('{"payload":[]}', "failed", "AttributeError"),
        ('{"payload":3}', "failed", "AttributeError"),
        ('{"before":null,"after":7}', "failed", "AttributeError"),
        ('{"before":null,"after":"x"}', "failed", "AttributeError"),
        ('{"before":null,"after":[1]}', "failed", "AttributeError"),
        ('{"before":null,"after":[]}', "skipped", None),
        ('{"before":null,"after":0}', "skipped", None),
        ('{"before":null,"after":""}', "skipped", None),
        ('{"before":null,"after":false}', "skipped", None),
        ('{"before":null,"after":{"other":1}}', "change", None),
        ("{}", "skipped", None),
    ],
)
def test_odd_values(spark, value, outcome, error):
    row = read(spark, [value]).collect()[0]
    assert (row["outcome"], row["error_type"]) == (outcome, error)


def first_errors(checked):
    rows = checked.selectExpr("offset", "errors").orderBy("offset").collect()
    return [r["errors"][0]["error_type"] if r["errors"] else None for r in rows]


def test_customer_checks(spark):
    cases = [
        ({"customer_id": 1, "email": "a@b.c"}, None),
        ({"customer_id": 1, "email": "an-eRRor@b.c"}, "ValueError"),
        ({"customer_id": 1, "email": None}, "AttributeError"),
        ({"customer_id": 1}, None),
        ({"customer_id": None, "email": "a"}, "IntegrityError"),
        ({"customer_id": 1, "phone": "1" * 21}, "DataError"),
        ({"customer_id": 1, "phone": "1" * 20}, None),
    ]
    rows = read(spark, [{"before": None, "after": image} for image, _ in cases])
    checked = validate.check_customers(envelope.changes_of(rows, CUSTOMERS))
    assert first_errors(checked) == [error for _, error in cases]
    # The email is checked for deletes too; limits of columns are not.
    gone = read(
        spark,
        [
            {"before": {"customer_id": 1, "email": "error"}, "after": None},
            {"before": {"customer_id": 1, "phone": "1" * 21}, "after": None},
        ],
    )
    checked = validate.check_customers(envelope.changes_of(gone, CUSTOMERS))
    assert first_errors(checked) == ["ValueError", None]
    unchecked = validate.check_customers(envelope.changes_of(gone, CUSTOMERS), emails=False)
    assert first_errors(unchecked) == [None, None]


def test_product_checks(spark):
    cases = [
        ({"price": 10, "cost": 4}, None),
        ({"price": "10.5", "cost": 4}, None),
        ({"price": 10}, None),
        ({}, None),
        ({"price": 10, "cost": None}, "TypeError"),
        ({"price": "n/a", "cost": 4}, "ValueError"),
        ({"price": 0, "cost": 4}, None),
        ({"price": 1, "cost": 20}, "DataError"),
        ({"price": 123456789012.5, "cost": 4}, "DataError"),
        ({"price": 10, "cost": 4, "brand": "b" * 101}, "DataError"),
    ]
    rows = read(
        spark, [{"before": None, "after": {"product_id": 1} | image} for image, _ in cases], PRODUCTS
    )
    checked = validate.check_products(envelope.changes_of(rows, PRODUCTS))
    assert first_errors(checked) == [error for _, error in cases]
    amounts = [(r["price"], r["cost"]) for r in checked.orderBy("offset").collect()]
    assert amounts[:4] == [(10.0, 4.0), (10.5, 4.0), (10.0, 0.0), (0.0, 0.0)]
    valid, bad = validate.valid(checked), validate.rejected(checked)
    assert valid.count() + bad.count() == len(cases)
