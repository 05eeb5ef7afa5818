"""Helpers of the tests."""

from collections import Counter


def rows(df):
    """The rows as a bag of tuples."""
    return Counter(tuple(row) for row in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    """How often a physical operator occurs in the plan."""
    words = (line.strip(" :+-*()0123456789") for line in plan(df).splitlines())
    return sum(word.startswith(name) for word in words)
