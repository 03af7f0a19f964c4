"""Strict path: decode messages, name every broken rule, set bad rows aside with the reason."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.clock import wall

_POSITION = ["value", "topic", "partition", "offset"]
_HELPERS = ["_unreadable", "_malformed", "_nulls", "error_text", *_POSITION]

# Fields that are not text, and what they are read as.
_TYPED = {
    "timestamp": "timestamp",
    "amount": "double",
    "latitude": "double",
    "longitude": "double",
    "is_online": "boolean",
    "card_present": "boolean",
}

_KINDS = ", ".join(f"'{t}'" for t in S.TRANSACTION_TYPES)

# What makes a field invalid, in the order the errors are listed.
RULES = {
    "event_id": "event_id IS NULL",
    "account_id": "account_id IS NULL",
    "timestamp": "event_timestamp IS NULL",
    "amount": "amount IS NULL OR isnan(amount) OR amount < 0",
    "merchant_id": "merchant_id IS NULL",
    "merchant_category": "false",
    "transaction_type": f"transaction_type IS NULL OR transaction_type NOT IN ({_KINDS})",
    "latitude": f"isnan(latitude) OR abs(latitude) > {S.LATITUDE_LIMIT}",
    "longitude": f"isnan(longitude) OR abs(longitude) > {S.LONGITUDE_LIMIT}",
    "is_online": "false",
    "card_present": "false",
    "country_code": f"length(country_code) > {S.COUNTRY_CODE_LENGTH}",
}


def decode_messages(raw: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """JSON value to typed columns; the raw value and its source position stay alongside.

    A field that is present but cannot be read becomes NULL and its name goes to ``_unreadable``. With
    ``strict_nulls`` the fields that have a default and are there as null go to ``_nulls``: they break
    the message, while an absent field takes its default. Without it both take the default.
    """
    parsed = F.from_json(
        "value", S.MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    position = [c for c in _POSITION if c in raw.columns]
    # A generator, not a plain column: filters stay above it, so each value is parsed once.
    decoded = decode_parsed(
        raw.select(*position, F.inline(F.array(parsed))), explicit_nulls() if strict_nulls else None
    )
    return decoded


def explicit_nulls() -> Column:
    """Names of the fields with a default that the JSON text ``value`` holds as null, by commas."""
    said = F.try_parse_json("value")

    def is_null(name: str) -> Column:
        return F.is_variant_null(F.try_variant_get(said, f"$.{name}", "variant"))

    names = [F.when(is_null(n), F.lit(n)) for n in S.EVENT_DEFAULTS]
    return F.concat_ws(",", *names)


def decode_parsed(fields: DataFrame, nulls: Column | None = None) -> DataFrame:
    """Typed columns from the text columns of parsed messages, whichever reader parsed them.

    A row without the message's own text is malformed only if its reader says so.
    """
    position = [c for c in _POSITION if c in fields.columns]
    missing = " OR value IS NULL" if "value" in fields.columns else ""
    columns = []
    for name in S.MESSAGE.names[:-1]:
        if name == "timestamp":
            columns.append("CAST(try_cast(timestamp AS timestamp) AS timestamp_ntz) event_timestamp")
        elif name in _TYPED:
            columns.append(f"try_cast({name} AS {_TYPED[name]}) AS {name}")
        else:
            columns.append(name)
    bad = ", ".join(
        f"CASE WHEN {n} IS NOT NULL AND try_cast({n} AS {t}) IS NULL THEN '{n}' END"
        for n, t in _TYPED.items()
    )
    return fields.select(
        *[F.expr(c) for c in columns],
        F.expr(f"concat_ws(',', {bad}) AS _unreadable"),
        F.expr(f"_corrupt IS NOT NULL{missing} AS _malformed"),
        *([] if nulls is None else [nulls.alias("_nulls")]),
        *position,
    )


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill absent optional fields with their declared defaults."""
    present = {n: v for n, v in S.EVENT_DEFAULTS.items() if n in df.columns}
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in present.items()})


def _error_list(df: DataFrame) -> str:
    """The names of the broken fields as arguments of a SQL call; NULL where a rule holds."""
    decoded = "_malformed" in df.columns
    strict = "_nulls" in df.columns
    cases = ["CASE WHEN _malformed THEN 'malformed' END"] if decoded else []
    for name, rule in RULES.items():
        if decoded and name in _TYPED:
            rule = f"{rule} OR find_in_set('{name}', _unreadable) > 0"
        if strict and name in S.EVENT_DEFAULTS:
            rule = f"{rule} OR find_in_set('{name}', _nulls) > 0"
        if decoded:
            rule = f"NOT _malformed AND ({rule})"
        cases.append(f"CASE WHEN {rule} THEN '{name}' END")
    return ", ".join(cases)


def validate(df: DataFrame) -> DataFrame:
    """Add ``errors``: the names of the fields that break a rule, in field order."""
    return df.withColumn("errors", F.expr(f"array_compact(array({_error_list(df)}))"))


def check(df: DataFrame) -> DataFrame:
    """Add ``error_text``: the names of the broken fields separated by commas, empty for valid rows.

    Made by a generator so that the rules run once per row, however often the text is filtered on.
    """
    return df.selectExpr(
        "*", f"inline(array(struct(concat_ws(', ', {_error_list(df)}) AS error_text)))"
    )


def split_valid(
    df: DataFrame,
    failed_at: datetime | str | Column,
    source_topic: str = S.TRANSACTIONS_TOPIC,
) -> tuple[DataFrame, DataFrame]:
    """Valid rows with defaults filled, and the dead-letter envelopes of the rest.

    ``df`` comes from decode_messages. Both halves are narrow filters over the same frame; write it
    first, as the stream does, if both are consumed in one run.
    """
    checked = check(df)
    valid = _accepted(checked)
    dead = checked.where("error_text <> ''")
    return valid, envelope(dead, error_reason(), failed_at, source_topic)


def valid_only(df: DataFrame) -> DataFrame:
    """The valid rows with defaults filled; ``df`` needs no message text."""
    return _accepted(check(df))


def _accepted(checked: DataFrame) -> DataFrame:
    return with_defaults(checked.where("error_text = ''").drop(*_HELPERS))


def error_reason() -> Column:
    return F.concat(F.lit("Validation error: "), F.col("error_text"))


def envelope(
    rows: DataFrame,
    reason: Column,
    failed_at: datetime | str | Column,
    source_topic: str = S.TRANSACTIONS_TOPIC,
    metadata: Column | None = None,
) -> DataFrame:
    """Wrap failed messages; the original text stays intact for a later redrive.

    ``metadata`` may be text pairs or, for any JSON, a VARIANT (``parse_json``).
    """
    has = set(rows.columns)
    no_metadata = F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    return rows.select(
        F.col("value").alias("original_message"),
        reason.alias("error_reason"),
        (F.col("topic") if "topic" in has else F.lit(source_topic)).alias("source_topic"),
        (F.col("partition") if "partition" in has else F.lit(None))
        .cast("int")
        .alias("source_partition"),
        (F.col("offset") if "offset" in has else F.lit(None)).cast("bigint").alias("source_offset"),
        wall(failed_at).alias("failed_at"),
        (no_metadata if metadata is None else metadata).alias("metadata"),
    )


def redrive(dead: DataFrame) -> DataFrame:
    """Read dead letters back as messages and check them again; ``errors`` tells what still fails."""
    raw = dead.select(
        F.col("original_message").alias("value"),
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
    )
    return validate(decode_messages(raw))
