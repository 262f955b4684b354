from __future__ import annotations


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def plan(df) -> str:
    """The physical plan; the final one if ``df`` has been run."""
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
