"""Attach token metadata to aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "contract_address"


def with_metadata(df: DataFrame, m: DataFrame, *columns: str, missing: str = "null") -> DataFrame:
    """Left join on the token address.

    Callers aggregate per token first and join the result, which is valid because loaded metadata has one
    row per token. There is no broadcast hint: metadata grows with the number of tokens, so Spark decides
    by ``autoBroadcastJoinThreshold``, and beyond it a merge join reuses the partitioning that the
    aggregate by token already has. ``missing="default"`` gives '' and 0 where a token is unknown.
    """
    measures = [c for c in df.columns if c != KEY]
    joined = df.join(m.select(KEY, *columns), KEY, "left").select(KEY, *columns, *measures)
    if missing == "default":
        for name in columns:
            blank = F.lit("") if name in ("name", "symbol") else F.lit(0)
            joined = joined.withColumn(name, F.coalesce(name, blank.cast(m.schema[name].dataType)))
    elif missing != "null":
        raise ValueError("missing must be 'null' or 'default'")
    return joined
