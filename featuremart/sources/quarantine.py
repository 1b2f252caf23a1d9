"""Setting aside what cannot be processed, so that the rest can be."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .tables import SNAPSHOT

QUARANTINE = f"layer string, table_name string, {SNAPSHOT} date, reason string"


def reason_of(error: Exception) -> str:
    """The first line of an error, with its kind."""
    lines = str(error).strip().splitlines()
    return f"{type(error).__name__}: {lines[0][:500] if lines else ''}"


def failing(parts: Sequence[str], attempt: Callable[[Sequence[str]], object]) -> dict[str, str]:
    """The parts on which ``attempt`` fails, with the reason, found by halving: k bad ones among n cost
    some k log n attempts. A part counts as bad if the attempt fails on it alone."""
    if not parts:
        return {}
    try:
        attempt(parts)
        return {}
    except Exception as error:  # whatever it is, it is the reason
        if len(parts) == 1:
            return {parts[0]: reason_of(error)}
    half = len(parts) // 2
    return failing(parts[:half], attempt) | failing(parts[half:], attempt)


def process_good(
    parts: Sequence[str], action: Callable[[Sequence[str]], object], probe: Callable[[Sequence[str]], object]
) -> dict[str, str]:
    """Run ``action`` on all parts at once. Only if that fails, look for the bad parts with ``probe`` (the
    same work without a result), and run it on the others at once. Gives the bad parts and their reasons;
    an error that no single part shows, or that every part shows, is raised."""
    try:
        action(parts)
        return {}
    except Exception:
        bad = failing(parts, probe)
        if not bad or len(bad) == len(parts):
            raise
    action([p for p in parts if p not in bad])
    return bad


def quarantined(spark: SparkSession, layer: str, table: str, bad: Mapping[str, str]) -> DataFrame:
    """The bad dates of a table as rows."""
    rows = [(layer, table, day, why) for day, why in sorted(bad.items())]
    frame = spark.createDataFrame(rows, "layer string, table_name string, day string, reason string")
    return frame.selectExpr("layer", "table_name", f"CAST(day AS DATE) AS {SNAPSHOT}", "reason")
