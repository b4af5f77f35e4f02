"""Types of text columns, from all rows.

Each column's values are tested against every type in one aggregate over
all rows (no sample, no first lines); the narrowest type that holds them
all is taken.  Types merge upwards::

    boolean -> string        int -> bigint -> double -> string
    date -> timestamp -> string

so a column of whole numbers and fractions is double, of days and times a
timestamp, and of numbers and words a string.  A column without values is
a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: how a text of each type looks
WHOLE = r"^[+-]?[0-9]{1,19}$"
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def _tests(c: Column) -> dict[str, Column]:
    return {"boolean": F.lower(c).isin("true", "false"), "int": c.rlike(WHOLE) & c.try_cast("int").isNotNull(),
            "bigint": c.rlike(WHOLE) & c.try_cast("bigint").isNotNull(), "double": c.rlike(NUMBER),
            "date": c.rlike(DAY) & c.try_cast("date").isNotNull(), "timestamp": (c.rlike(DAY) | c.rlike(TIME)) & c.try_cast("timestamp").isNotNull()}


def schema(df: DataFrame, empty_is_null: bool = True) -> T.StructType:
    """The narrowest schema that holds every value of the text columns."""
    aggs = []
    for i, name in enumerate(df.columns):
        c = F.trim(F.col(f"`{name}`").cast("string"))
        c = F.when(c != "", c) if empty_is_null else c
        aggs.append(F.count(c).alias(f"n{i}"))
        aggs += [F.coalesce(F.bool_and(F.when(c.isNotNull(), test)), F.lit(False)).alias(f"{kind}{i}") for kind, test in _tests(c).items()]
    found = df.agg(*aggs).first()
    fields = []
    for i, name in enumerate(df.columns):
        kinds = [k for k in ("boolean", "int", "bigint", "double", "date", "timestamp") if found[f"n{i}"] and found[f"{k}{i}"]]
        fields.append(T.StructField(name, T._parse_datatype_string(kinds[0] if kinds else "string")))
    return T.StructType(fields)


def typed(df: DataFrame, to: T.StructType | None = None, empty_is_null: bool = True) -> DataFrame:
    """Text columns cast to their narrowest types."""
    to = to or schema(df, empty_is_null)

    def value(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return c.alias(f.name)
        c = F.trim(c)
        return F.when(c != "", c).cast(f.dataType).alias(f.name)
    return df.select(*[value(f) for f in to.fields])


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV with inferred types.  ``multiLine`` lets quoted values hold line
    ends (a file is then one task's work)."""
    return typed(spark.read.options(header="true", **options).csv(path))
