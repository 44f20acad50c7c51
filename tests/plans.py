"""Text of physical plans, for checks on their shape."""

from __future__ import annotations

import re


def planned(df) -> str:
    """The plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan that ran, of the query and its subqueries, without the plans they started from."""
    df.collect()
    kept, skip_from = [], None
    for line in planned(df).splitlines():
        start = len(line) - len(re.sub(r"^[ :|]*", "", line))
        if skip_from is not None and start > skip_from:
            continue
        skip_from = start if "== Initial Plan ==" in line else None
        if skip_from is None:
            kept.append(line)
    return "\n".join(kept)


def scans(plan: str, table: str) -> int:
    return sum("FileScan" in s and f"{table}.parquet" in s for s in plan.splitlines())
