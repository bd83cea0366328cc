"""Which object-change messages count, and why the others do not."""

import json

import pytest

from basketflow.operators.notifications import EVENT_NAMES, touched_tables, validate_notifications


def record(source="aws:s3", event="ObjectCreated:Put", bucket="raw", key="data/orders.csv"):
    return {"eventSource": source, "eventName": event, "s3": {"bucket": {"name": bucket}, "object": {"key": key}}}


def without(*path):
    made = record()
    inner = made
    for step in path[:-1]:
        inner = inner[step]
    del inner[path[-1]]
    return made


CASES = [
    ({"Records": [record()]}, None),
    ({"Records": [record(), record(key="data/aisles.csv")]}, None),
    ({}, "records"),
    ({"Records": []}, "records"),
    ({"Records": None}, "records"),
    ("no json", "records"),
    ({"Records": [record(source="aws:sqs")]}, "source"),
    ({"Records": [without("eventSource")]}, "source"),
    ({"Records": [None]}, "source"),
    ({"Records": [record(event="ObjectRestore:Post")]}, "event"),
    ({"Records": [without("s3")]}, "bucket"),
    ({"Records": [without("s3", "bucket")]}, "bucket"),
    ({"Records": [without("s3", "bucket", "name")]}, "bucket"),
    ({"Records": [without("s3", "object")]}, "key"),
    ({"Records": [record(key=None)]}, "key"),
    ({"Records": [record(key="logs/orders.csv")]}, "prefix"),
    ({"Records": [record(), record(source="x"), record(key="y")]}, "source"),
]


@pytest.mark.parametrize("message, reason", CASES)
def test_message(spark, message, reason):
    text = message if isinstance(message, str) else json.dumps(message)
    row = validate_notifications(spark.createDataFrame([(text,)], "value string")).first()
    assert (row.valid, row.reason) == (reason is None, reason)


def test_all_change_events_count(spark):
    messages = [(json.dumps({"Records": [record(event=name)]}),) for name in EVENT_NAMES]
    assert validate_notifications(spark.createDataFrame(messages, "value string")).filter("valid").count() == 6


def test_other_prefix(spark):
    messages = spark.createDataFrame([(json.dumps({"Records": [record(key="in/orders.csv")]}),)], "value string")
    assert validate_notifications(messages, prefix="in/").first().valid


def test_touched_tables(spark):
    keys = ["data/orders.csv", "data/orders.csv/part-1.csv", "data/aisles/x.csv", "data/unknown.csv"]
    messages = [(json.dumps({"Records": [record(key=key)]}),) for key in keys]
    messages.append((json.dumps({"Records": [record(key="data/products.csv"), record(source="x")]}),))
    checked = validate_notifications(spark.createDataFrame(messages, "value string"))
    assert sorted(r.table for r in touched_tables(checked).collect()) == ["aisles", "orders"]
