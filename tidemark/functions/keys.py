"""Key-derived expressions: message routing and serving keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic width and serving key prefix.
TOPIC_PARTITIONS = 8
KEY_PREFIX = "fraud:features"


def route_partition(key: Column, partitions: int = TOPIC_PARTITIONS) -> Column:
    """Partition number from the leading 32 bits of the key's MD5, as an unsigned integer."""
    leading = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return (leading % partitions).cast("int")


def serving_key(account: Column, group: Column, prefix: str = KEY_PREFIX) -> Column:
    return F.concat_ws(":", F.lit(prefix), account, group)
