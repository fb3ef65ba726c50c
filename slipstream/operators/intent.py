"""Which report a question asks for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream import fixed_values as fv
from slipstream.functions.columns import first_match


def tag_intent(
    questions: DataFrame,
    text: str = "text",
    patterns: Sequence[tuple[str, str]] = fv.INTENT_PATTERNS,
    default: str = fv.DEFAULT_INTENT,
) -> DataFrame:
    """Add the report of the first pattern found anywhere in the lower-case text."""
    lowered = F.lower(F.col(text))
    # (?d): only a line feed ends a line, so "." matches every other character.
    found = [(lowered.rlike("(?d)" + p), report) for p, report in patterns]
    return questions.withColumn("intent", first_match(found, default))
