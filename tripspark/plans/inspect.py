"""Physical-plan checks used by the plan tests.

They read the executed plan text (AQE final plan when available) and answer
the questions asked of every operator: is there a Python UDF, are the
dimension joins broadcast, which aggregate strategy runs, and are filters
pushed to the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``explain(mode)`` prints it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def executed_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def has_python_udf(df: DataFrame) -> bool:
    text = plan_text(df, "extended")
    return bool(re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas", text))


def count_nodes(df: DataFrame, name: str) -> int:
    return len(re.findall(rf"\b{name}\b", executed_plan(df)))


def join_strategies(df: DataFrame) -> list[str]:
    return re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                      r"CartesianProduct)", executed_plan(df))


def aggregate_strategies(df: DataFrame) -> list[str]:
    return re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", executed_plan(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df))
