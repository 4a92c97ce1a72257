"""Event-time replay: a system under test observes what is dated before each question, then answers it."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldmark.operators.machine import fold


class System(Protocol):
    """What is replayed: one instance per subject."""

    def observe(self, text: str) -> None: ...

    def answer(self, question: str) -> str: ...


class Silent:
    """The floor: it never answers."""

    def observe(self, text: str) -> None: ...

    def answer(self, question: str) -> str:
        return ""


class LastHeard:
    """A simple baseline: it repeats the last thing it heard."""

    def __init__(self) -> None:
        self.last = ""

    def observe(self, text: str) -> None:
        self.last = text

    def answer(self, question: str) -> str:
        return self.last


def replay(sessions: DataFrame, probes: DataFrame, factory: Callable[[], System]) -> DataFrame:
    """``subject, probe_id, response``. ``sessions`` (subject, at, text) dated on or before a probe (subject, at,
    probe_id, question) are observed first, in order; a system that raises gives a null response."""
    rows = sessions.select("subject", "at", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("probe_id"), "text").unionByName(
        probes.select("subject", "at", F.lit(1).alias("kind"), F.col("probe_id").cast("string").alias("probe_id"), F.col("question").alias("text"))
    )

    def step(system: System, row) -> tuple[System, tuple | None]:
        if row.kind == 0:
            system.observe(row.text)
            return system, None
        try:
            said = system.answer(row.text)
        except Exception:  # an answer that fails is a wrong answer, not the end of the replay
            said = None
        return system, (row.subject, row.probe_id, said)

    kind = dict(rows.dtypes)["subject"]
    return fold(rows.withColumn("text", F.coalesce("text", F.lit(""))), "subject", ["at", "kind", "probe_id", "text"], f"subject {kind}, probe_id string, response string", factory, step)
