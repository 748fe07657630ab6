"""Virtual shard of a domain. Spark has no blake2, so this one runs in Arrow batches."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

SHARDS = 1024


def shard_of(domain: str) -> int:
    return int.from_bytes(hashlib.blake2b(domain.encode(), digest_size=8).digest(), "big") % SHARDS


@F.pandas_udf(IntegerType())
def _shard(domains: pd.Series) -> pd.Series:
    distinct = {d: shard_of(d) for d in domains.dropna().unique()}
    return domains.map(distinct).astype("Int32")


def shard(domain: Column) -> Column:
    """0 to 1023; NULL for a NULL domain."""
    return _shard(domain)
