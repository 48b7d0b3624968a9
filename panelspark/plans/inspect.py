"""Plan inspection helpers (used by tests and the bench)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (``explain(mode)`` without printing)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow",
                "FlatMapGroupsInPandas")


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df)
    return [n for n in PYTHON_NODES if n in text]
