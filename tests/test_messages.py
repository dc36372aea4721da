import base64
import json

import pytest

from flatweave.sources.messages import decode_messages, parse_arrivals, parse_lifecycle
from flatweave.streaming.intraday import latest_actions


def messages(spark, bodies):
    texts = [body if isinstance(body, str) else json.dumps(body) for body in bodies]
    rows = [(i, base64.b64encode(text.encode()).decode()) for i, text in enumerate(texts)]
    return decode_messages(spark.createDataFrame(rows, "n int, data string"))


def arrival(path):
    return {"protoPayload": {"resourceName": path}}


@pytest.mark.parametrize(
    "table, expected",
    [
        ("events_20250113", ("events", "20250113")),
        ("pseudonymous_users_20250113", ("pseudonymous_users", "20250113")),
        ("users_20241107", ("users", "20241107")),
        ("events_intraday_20250114", ("events_intraday", "20250114")),
        ("events", None),
        ("users_x_20250113", None),
        ("events_19991231", None),
        ("events_20250113_old", None),
    ],
)
def test_arrivals(spark, table, expected):
    row = parse_arrivals(messages(spark, [arrival(f"projects/p-1/datasets/analytics_9/tables/{table}")])).first()
    assert row.valid == (expected is not None)
    if expected:
        assert (row.project, row.dataset, row.source, row.shard) == ("p-1", "analytics_9", *expected)


def test_malformed_messages_are_kept_as_invalid(spark):
    good = arrival("projects/p/datasets/d/tables/events_20250113")
    rows = parse_arrivals(messages(spark, ["not json", {"other": 1}, good])).orderBy("n").collect()
    assert [r.valid for r in rows] == [False, False, True]
    broken = decode_messages(spark.createDataFrame([("%%%",)], "data string"))
    assert [r.valid for r in parse_arrivals(broken).collect()] == [False]


def lifecycle(action, shard="20250114", dataset="analytics_123456789", at="2025-01-14T07:00:17.888Z", entries=1):
    table = f"events_intraday_{shard}"
    resource = {"resource": f"projects/p/datasets/{dataset}/tables/{table}"}
    payload = {"methodName": f"tableservice.{action}", "authorizationInfo": [resource] * entries}
    if action == "insert":
        payload["authorizationInfo"] = [{"resource": f"projects/p/datasets/{dataset}"}]
        name = {"projectId": "p", "datasetId": dataset, "tableId": table}
        payload["serviceData"] = {"tableInsertResponse": {"resource": {"tableName": name}}}
    return {"timestamp": at, "protoPayload": payload}


def test_lifecycle(spark):
    other = lifecycle("insert")
    other["protoPayload"]["serviceData"]["tableInsertResponse"]["resource"]["tableName"]["tableId"] = "events_20250114"
    bodies = [
        lifecycle("insert"), lifecycle("delete"), lifecycle("delete", dataset="analytics_7"),
        lifecycle("delete", entries=2), lifecycle("delete", dataset="crm"), other, lifecycle("update"),
    ]
    rows = parse_lifecycle(messages(spark, bodies)).orderBy("n").collect()
    assert [r.valid for r in rows] == [True, True, True, False, False, False, False]
    assert [(r.action, r.project, r.dataset, r.source, r.shard) for r in rows[:3]] == [
        ("create", "p", "analytics_123456789", "events_intraday", "20250114"),
        ("delete", "p", "analytics_123456789", "events_intraday", "20250114"),
        ("delete", "p", "analytics_7", "events_intraday", "20250114"),
    ]


def test_latest_action_wins(spark):
    bodies = [
        lifecycle("delete", at="2025-01-14T09:00:00Z"),
        lifecycle("insert", at="2025-01-14T08:00:00Z"),
        lifecycle("insert", shard="20250115", at="2025-01-15T08:00:00Z"),
    ]
    rows = {r.shard: r.action for r in latest_actions(messages(spark, bodies)).collect()}
    assert rows == {"20250114": "delete", "20250115": "create"}
