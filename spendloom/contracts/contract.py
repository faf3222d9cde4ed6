"""What a stored table promises about its columns, and how a batch is held to it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERRORS = "_errors"

# Fixed value: raw text beyond this length does not fit the rejects table of a warehouse.
MAX_RAW = 2_000_000


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType
    max_length: int | None = None


def whole(name: str) -> Field:
    """Ids and counts."""
    return Field(name, T.DecimalType(18, 0))


def number(name: str, scale: int) -> Field:
    return Field(name, T.DecimalType(18, scale))


def money(name: str) -> Field:
    return number(name, 2)


def rate(name: str) -> Field:
    return number(name, 10)


def text(name: str, max_length: int | None = None) -> Field:
    return Field(name, T.StringType(), max_length)


def day(name: str) -> Field:
    return Field(name, T.DateType())


def moment(name: str) -> Field:
    return Field(name, T.TimestampType())


def flag(name: str) -> Field:
    return Field(name, T.BooleanType())


@dataclass(frozen=True)
class Checked:
    """A batch held to a contract: its columns, and what was wrong with the faulty rows.

    ``over`` puts other rows of the same layout in place, such as the same ones
    written and read back, so that good rows and rejects come from one pass.
    """

    tagged: DataFrame
    names: tuple[str, ...]
    changes: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    @property
    def good(self) -> DataFrame:
        rows = self.tagged.filter(F.col(ERRORS) == "").select(*self.names)
        for change in self.changes:
            rows = change(rows)
        return rows

    @property
    def bad(self) -> DataFrame:
        return self.tagged.filter(F.col(ERRORS) != "").select(
            F.col("_row_nr").alias("ROW_NR"),
            F.col(ERRORS).alias("ERROR_TEXT"),
            (F.char_length("_raw") > MAX_RAW).alias("TRUNCATED"),
            F.col("_raw").alias("CSV_DATA"),
        )

    def map_good(self, change: Callable[[DataFrame], DataFrame]) -> Checked:
        return replace(self, changes=(*self.changes, change))

    def over(self, tagged: DataFrame) -> Checked:
        return replace(self, tagged=tagged)


@dataclass(frozen=True)
class Contract:
    """Columns are bound by name and stored in the declared order.

    A table is laid out in folders by the columns of ``partition_by``, or by a
    hash of those of ``bucket_by`` if rows are updated by key.
    """

    name: str
    fields: tuple[Field, ...]
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype) for f in self.fields])

    def empty(self, spark) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def tag(self, df: DataFrame, keep: tuple[str, ...] = (), required: tuple[str, ...] = ()) -> DataFrame:
        """Typed columns plus what was wrong with the row, as text that is empty for a good one.

        Empty text counts as missing.  Contract columns the batch lacks become
        typed NULLs, which is how retired source fields are stored.
        """
        have = {f.name: f.dataType for f in df.schema.fields}
        values, given, faults = [], [], []
        for field in self.fields:
            if field.name not in have:
                values.append(F.lit(None).cast(field.dtype).alias(field.name))
                if field.name in required:
                    faults.append(F.lit(f"{field.name}: missing"))
                continue
            source = _given(F.col(f"`{field.name}`"), have[field.name])
            fitting, fault = _held_to(field, have[field.name])
            values.append(fitting(source).alias(field.name))
            if fault is not None or field.name in required:
                given.append(source.isNotNull().alias(_GIVEN + field.name))
            if fault is not None:
                faults.append(fault)
            if field.name in required:
                faults.append(F.when(~F.col(_GIVEN + field.name), F.lit(f"{field.name}: missing")))
        # Values are converted in one projection and judged in the next, so that
        # each conversion runs once.
        typed = df.select(*values, *keep, *given)
        errors = F.concat_ws("; ", *faults) if faults else F.lit("")
        return typed.select(*self.names, *keep, errors.alias(ERRORS))

    def enforce(self, df: DataFrame, row_nr: str | None = None, required: tuple[str, ...] = ()) -> Checked:
        """Rows that meet the contract, and the others in the rejects layout; ``required`` columns must have a value."""
        raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        number_ = F.col(row_nr).cast("decimal(18,0)") if row_nr else F.lit(None).cast("decimal(18,0)")
        kept = df.withColumns({"_row_nr": number_, "_raw": raw})
        tagged = self.tag(kept, keep=("_row_nr", "_raw"), required=required)
        # Good rows have no use for their raw text.
        return Checked(tagged.withColumn("_raw", F.when(F.col(ERRORS) != "", F.col("_raw"))), tuple(self.names))

    def conform(self, df: DataFrame) -> DataFrame:
        """Contract columns in order; a value that does not fit fails the job.

        For batches already split by :meth:`enforce` or built from typed tables.
        """
        have = set(df.columns)
        return df.select(
            *[
                (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dtype).alias(f.name)
                for f in self.fields
            ]
        )


_GIVEN = "_given_"


def _given(col: Column, dtype: T.DataType) -> Column:
    return F.nullif(col, F.lit("")) if isinstance(dtype, T.StringType) else col


def _held_to(field: Field, dtype: T.DataType) -> tuple[Callable[[Column], Column], Column | None]:
    """How a value is converted and, unless the types already agree, its fault message."""
    value = F.col(field.name)
    if isinstance(field.dtype, T.StringType):
        if field.max_length is None:
            return _as_text, None
        too_long = F.char_length(value) > field.max_length
        return _as_text, F.when(too_long, F.lit(f"{field.name}: longer than {field.max_length}"))
    if dtype == field.dtype:
        return _unchanged, None
    lost = F.col(_GIVEN + field.name) & value.isNull()
    message = F.lit(f"{field.name}: not a {field.dtype.simpleString()}")
    return lambda source: source.try_cast(field.dtype), F.when(lost, message)


def _as_text(source: Column) -> Column:
    return source.cast("string")


def _unchanged(source: Column) -> Column:
    return source
