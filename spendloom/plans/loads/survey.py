"""Survey responses of the last 7 days, insert-only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked
from spendloom.contracts.tables import ASK_NICELY_RESPONSES
from spendloom.functions.dates import epoch_s_date, or_text
from spendloom.functions.text import unescape
from spendloom.operators.filters import trailing_window
from spendloom.operators.merge import rows_to_insert
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import select_renamed
from spendloom.sources.pages import read_pages
from spendloom.store import Table

WINDOW_DAYS = 7
KEYS = ["RESPONSE_ID", "RESPONSE_DATE"]

# Source field and staging column.
FIELDS = {
    "response_id": "RESPONSE_ID",
    "responded": "RESPONSE_DATE",
    "name": "NAME",
    "segment": "SEGMENT",
    "email": "EMAIL",
    "answer": "ANSWER",
}
RECORD = ", ".join(f"{field} string" for field in (*FIELDS, "comment"))


def extract(records: DataFrame, as_of, days: int = WINDOW_DAYS) -> Checked:
    """Staging rows of the trailing window, and rejects."""
    named = select_renamed(records, FIELDS)
    dated = named.withColumn("RESPONSE_DATE", or_text(epoch_s_date(F.col("RESPONSE_DATE")), F.col("RESPONSE_DATE")))
    return ASK_NICELY_RESPONSES.enforce(dated, required=("RESPONSE_DATE",)).map_good(lambda good: trailing_window(good, "RESPONSE_DATE", as_of, days))


def comments(records: DataFrame) -> DataFrame:
    """Responses with their comment in plain text; not part of the stored table."""
    return records.select("response_id", unescape(F.col("comment")).alias("comment"))


@logged("survey")
def run(spark: SparkSession, landing: str, staging: Table, production: Table, rejects: Table, as_of, **read) -> DataFrame:
    """An empty batch leaves production untouched."""
    staging.stage(extract(read_pages(spark, landing, "data", RECORD, unreadable=unreadable_to(rejects), **read), as_of), rejects)
    production.append_nonempty(rows_to_insert(production.read(), staging.read(), KEYS, "RESPONSE_DATE"))
    return production.read()
