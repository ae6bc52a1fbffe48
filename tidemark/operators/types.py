"""Types of releases that arrive as text, from what their cells hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds of value from the narrowest on: a column has the first type that all its cells can be read
# as. Whole numbers are numbers and dates are times, so that mixtures take the wider type. A digit
# sequence with leading zeros, or one that a double would round, is a name and no number.
_KINDS: list[tuple[T.DataType, str, str]] = [
    (T.BooleanType(), r"(?i)^(true|false)$", ""),
    (T.LongType(), r"^[+-]?(0|[1-9][0-9]{0,18})$", "BIGINT"),
    (T.DoubleType(), r"^[+-]?((0|[1-9][0-9]{0,14})|([0-9]+[.][0-9]*|[.][0-9]+)|([0-9]+[.]?[0-9]*|[.][0-9]+)[eE][+-]?[0-9]+)$", "DOUBLE"),
    (T.DateType(), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "DATE"),
    (T.TimestampType(), r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$", "TIMESTAMP"),
]
_ANY = (1 << len(_KINDS)) - 1


def fitting_types(value: Column) -> Column:
    """Bit mask of the types that a text can be read as; a blank one says nothing against any."""
    bare = F.btrim(value.cast("string"))
    mask = F.lit(0)
    for i, (_, pattern, ddl) in enumerate(_KINDS):
        fits = bare.rlike(pattern)
        if ddl:
            fits = fits & bare.try_cast(ddl).isNotNull()
        mask = mask.bitwiseOR(F.when(fits, F.lit(1 << i)).otherwise(F.lit(0)))
    return F.when(bare.isNull() | (bare == ""), F.lit(_ANY)).otherwise(mask)


def infer_types(rows: DataFrame) -> T.StructType:
    """`rows`' columns with the narrowest types that hold all their cells; text if nothing does, or
    if all cells are blank.

    One pass over all rows; what is shuffled is one mask per column and task.
    """
    names = rows.columns
    placed = rows.toDF(*[f"c{i}" for i in range(len(names))])
    masks = placed.agg(*[F.bit_and(fitting_types(F.col(c))).alias(c) for c in placed.columns]).first() if names else []

    def kind(mask: int | None) -> T.DataType:
        if mask is None or mask == _ANY:
            return T.StringType()
        return next((t for i, (t, _, _) in enumerate(_KINDS) if mask >> i & 1), T.StringType())

    return T.StructType([T.StructField(name, kind(mask)) for name, mask in zip(names, masks)])
