"""Plan text for tests and tuning: what ``explain`` prints, as a string."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it.

    With AQE on, call it after an action to see the final adaptive plan.
    """
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode=mode)
    return buffer.getvalue()
