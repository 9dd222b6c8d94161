"""Plan inspection helpers (what ``.explain`` prints, as text)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_problems(df: DataFrame) -> list[str]:
    """Things that should never appear in these plans: all-pairs joins and
    row-at-a-time Python."""
    text = plan_text(df, "extended")
    bad = [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin") if n in text]
    bad += [n for n in PYTHON_NODES if n in text]
    return bad
