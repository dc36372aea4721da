"""Audit messages about source tables: a daily table arrived, a same-day one came or went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Message fields and resource names.
_DAY = r"(20\d{6})"
_PROJECT, _ANY_DATASET, _EXPORT_DATASET = r"^projects/([^/]+)", r"/datasets/([^/]+)", r"/datasets/(analytics_\d+)"
ARRIVAL_PATTERN = rf"{_PROJECT}{_ANY_DATASET}/tables/(events|events_intraday|users|pseudonymous_users)_{_DAY}$"
INTRADAY_TABLE_PATTERN = rf"^(events_intraday)_{_DAY}$"
INTRADAY_RESOURCE_PATTERN = rf"{_PROJECT}{_EXPORT_DATASET}/tables/(events_intraday)_{_DAY}$"
INSERT_METHOD = "tableservice.insert"
DELETE_METHOD = "tableservice.delete"
_NOT_JSON = "__not_json"
ARRIVAL_SCHEMA = "protoPayload struct<resourceName: string>"
LIFECYCLE_SCHEMA = """
    timestamp string,
    protoPayload struct<
      methodName: string,
      authorizationInfo: array<struct<resource: string>>,
      serviceData: struct<tableInsertResponse: struct<resource: struct<
        tableName: struct<projectId: string, datasetId: string, tableId: string>>>>>
    """


def _group(text: str | Column, pattern: str, group: int) -> Column:
    """A capture group, NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _parsed_once(messages: DataFrame, schema: str) -> DataFrame:
    """Add the parsed message as ``__body``.

    As the only element of an exploded array it is a row of its own to the optimizer,
    which would otherwise repeat the parse in every filter and column that uses it.
    """
    body = F.from_json("message", f"{schema}, {_NOT_JSON} string", {"columnNameOfCorruptRecord": _NOT_JSON})
    return messages.select("*", F.explode(F.array(body)).alias("__body"))


def _reason(accepted: Column, *others: tuple[Column, str]) -> Column:
    """Why a message is not accepted, the first that holds; NULL for one that is."""
    unread = [
        (F.col("message").isNull(), "not base64 text"),
        (F.col(f"__body.{_NOT_JSON}").isNotNull(), "not a JSON object"),
    ]
    reason = F.when(accepted, F.lit(None).cast("string"))
    for holds, text in [*unread, *others]:
        reason = reason.when(holds, text)
    return reason


def decode_messages(raw: DataFrame, column: str = "data") -> DataFrame:
    """Add the text of base64 messages as ``message``; NULL if it is not base64."""
    return raw.withColumn("message", F.try_to_binary(F.col(column), F.lit("base64")).cast("string"))


def parse_arrivals(messages: DataFrame) -> DataFrame:
    """``project, dataset, source, shard`` of each arrival, whether it is ``valid``, and else the ``reason``."""
    parsed = _parsed_once(messages, ARRIVAL_SCHEMA)
    path = "__body.protoPayload.resourceName"
    names = ("project", "dataset", "source", "shard")
    fields = {name: _group(path, ARRIVAL_PATTERN, i + 1) for i, name in enumerate(names)}
    found = parsed.withColumns(fields)
    valid = F.col("shard").isNotNull()
    reason = _reason(
        valid, (F.col(path).isNull(), "no resource name"), (F.col("shard").isNull(), "names no table of an export")
    )
    return found.withColumns({"valid": valid, "reason": reason}).drop("__body")


def parse_lifecycle(messages: DataFrame) -> DataFrame:
    """Creation or deletion of a same-day table.

    A creation names its table in the response; a deletion in its only
    authorisation entry.  Anything else, several entries or no readable time included, is not ``valid``; ``reason`` says why.
    """
    payload = F.col("__body.protoPayload")
    table = payload["serviceData"]["tableInsertResponse"]["resource"]["tableName"]
    entries = payload["authorizationInfo"]
    resource = F.when(F.size(entries) == 1, F.get(entries, F.lit(0))["resource"])
    method = payload["methodName"]

    def either(inserted: Column, deleted: Column) -> Column:
        return F.when(method == INSERT_METHOD, inserted).when(method == DELETE_METHOD, deleted)

    valid = (
        F.col("shard").isNotNull()
        & F.col("project").isNotNull()
        & F.col("dataset").isNotNull()
        & F.col("logged_at").isNotNull()
    )
    reason = _reason(
        valid,
        (F.col("action").isNull(), "neither a creation nor a deletion"),
        ((F.col("action") == "delete") & ~F.coalesce(F.size(entries) == 1, F.lit(False)), "not one resource"),
        (F.col("shard").isNull() | F.col("project").isNull() | F.col("dataset").isNull(), "names no same-day table"),
        (F.col("logged_at").isNull(), "no readable time"),
    )
    return (
        _parsed_once(messages, LIFECYCLE_SCHEMA)
        .withColumns(
            {
                "action": F.when(method == INSERT_METHOD, "create").when(method == DELETE_METHOD, "delete"),
                "project": either(table["projectId"], _group(resource, INTRADAY_RESOURCE_PATTERN, 1)),
                "dataset": either(table["datasetId"], _group(resource, INTRADAY_RESOURCE_PATTERN, 2)),
                "source": either(
                    _group(table["tableId"], INTRADAY_TABLE_PATTERN, 1),
                    _group(resource, INTRADAY_RESOURCE_PATTERN, 3),
                ),
                "shard": either(
                    _group(table["tableId"], INTRADAY_TABLE_PATTERN, 2),
                    _group(resource, INTRADAY_RESOURCE_PATTERN, 4),
                ),
                "logged_at": F.try_to_timestamp(F.col("__body.timestamp")),
            }
        )
        .withColumns({"valid": valid, "reason": reason})
        .drop("__body")
    )
