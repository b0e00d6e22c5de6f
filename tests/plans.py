"""Reading physical plans in tests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def planned(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame: DataFrame) -> str:
    """The final adaptive plan, after running the query."""
    frame.collect()
    return planned(frame)


def count(plan: str, node: str) -> int:
    return sum(line.lstrip(" :+-*()0123456789").startswith(node) for line in plan.splitlines())


def jobs_of(spark, work) -> int:
    """Spark jobs that ``work`` starts in this thread."""
    context, group = spark.sparkContext, f"counted-{uuid.uuid4().hex}"
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))
