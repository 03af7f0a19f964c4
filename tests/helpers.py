"""Small frames for the tests, in the shape of the contract."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from tidemark import schemas as S

T0 = datetime(2024, 1, 15, 14, 0, 0)


def txn(event_id, account="a", at=T0, amount=10.0, merchant="m", **over):
    row = {
        "event_id": event_id,
        "account_id": account,
        "event_timestamp": at,
        "transaction_date": at.date() if at else None,
        "amount": amount,
        "merchant_id": merchant,
        "merchant_category": "retail",
        "transaction_type": "purchase",
        "latitude": None,
        "longitude": None,
        "is_online": False,
        "card_present": True,
        "country_code": "US",
        "ingested_at": at,
    }
    row.update(over)
    return row


def frame(spark, rows, schema=S.TRANSACTION):
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)


def minutes(n):
    return T0 + timedelta(minutes=n)


ACCOUNT = "north"


def event(**over):
    """A message body with every required field; ``...`` leaves a field out."""
    body = {
        "event_id": "first",
        "account_id": ACCOUNT,
        "timestamp": f"{T0:%Y-%m-%dT%H:%M:%S}Z",
        "amount": 7.25,
        "merchant_id": "kiosk",
        "transaction_type": "transfer",
    }
    body.update(over)
    return {k: v for k, v in body.items() if v is not ...}


def messages(spark, values):
    rows = [
        ("k", v if isinstance(v, (str, type(None))) else json.dumps(v), "topic", i % 8, i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset bigint"
    )


def same(left, right):
    """Equal as bags of rows."""
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def filled(schema, account, at):
    """A row of a contract's schema: values follow from a field's type and place."""
    values = {"bigint": lambda i: 2 * i + 1, "int": lambda i: i, "double": lambda i: i / 16}
    values |= {"boolean": lambda i: i % 2 == 0, "string": lambda i: "xyz"[i % 3] * 2}
    row = {
        f.name: at if f.dataType.typeName() == "timestamp_ntz" else values[f.dataType.simpleString()](i)
        for i, f in enumerate(schema)
    }
    return {**row, "account_id": account}


def realtime(account=ACCOUNT, at=T0, **over):
    return {**filled(S.REALTIME, account, at), **over}


def batch(account=ACCOUNT, at=T0, **over):
    return {**filled(S.BATCH, account, at), **over}
