"""Shapes of plans that matter at scale."""

import re

import __spark_entry__ as contract


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_codes_are_never_shuffle_keys(spark, data):
    """Usage and meter codes have a handful of values; no raw row may be dealt by them."""
    for df in [contract.queries()[n](spark, data) for n in ("daily_usage_zone", "enriched_history", "lookup_join") if n in contract.queries()] + [contract.entry(spark)]:
        text = plan(df)
        assert not re.search(r"Exchange hashpartitioning\((usageId|meterTypeId)#\d+, \d+\)", text), text
