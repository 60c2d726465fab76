"""Shared by the tests: plans as text and results as comparable rows."""

import re

TESTDATA = "/root/testdata"


def final_plan(df):
    """The physical plan after adaptive execution has run it."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchanges(plan):
    """Number of shuffles a plan performs (reused ones not counted)."""
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)\bExchange ", plan))


def rows(df, *order):
    order = order or df.columns
    return [tuple(r) for r in df.orderBy(*order).collect()]
