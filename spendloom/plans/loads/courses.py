"""Course lists: text as delivered to typed rows with their academic year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from spendloom.contracts import Checked
from spendloom.contracts.tables import COURSE_LISTS_PRD


def typed(courses: DataFrame, academic_year: Column) -> Checked:
    """Typed course rows, and rejects; no rule gives the year, so it is passed in."""
    return COURSE_LISTS_PRD.enforce(courses.withColumn("ACADEMIC_YEAR", academic_year))
