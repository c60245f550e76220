"""Fields beyond the known columns, kept as one VARIANT per row: what there is of them."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How deep nested objects are listed.
LEVELS = 4


def joined(names: list[str]) -> Column:
    """The VARIANT columns of these names as one object; null if a row has none of them.

    A field that is null in the line is kept as null, one that is not there is not.
    """
    if not names:
        return F.lit(None).cast("variant")
    quoted = [f"`{name.replace('`', '``')}`" for name in names]
    pairs = zip(names, quoted, strict=True)
    entries = F.create_map(*[c for name, column in pairs for c in (F.lit(name), F.col(column))])
    there = F.map_filter(entries, lambda _, value: value.isNotNull())
    return F.when(F.size(there) > 0, F.to_variant_object(there))


def kind(value: Column) -> Column:
    """The type of a VARIANT without its details: OBJECT, ARRAY, STRING, BIGINT, VOID and so on."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def listed(rows: DataFrame, column: str, levels: int = LEVELS) -> DataFrame:
    """The rows' other columns with (field, value), a row for each field; nested ones as ``a.b``.

    Array elements are not fields; an array is a value.
    """
    others = [c for c in rows.columns if c != column]

    def exploded(frame: DataFrame, prefix: Column) -> DataFrame:
        parts = frame.alias("_of").lateralJoin(frame.sparkSession.tvf.variant_explode(F.col("_at").outer()))
        return parts.select(*others, F.concat(prefix, F.col("key")).alias("field"), "value")

    top = rows.select(*others, F.col(column).alias("_at")).filter(F.col("_at").isNotNull())
    found = [exploded(top, F.lit(""))]
    for _ in range(levels - 1):
        inner = found[-1].filter(kind(F.col("value")) == "OBJECT")
        inner = inner.select(*others, F.col("field").alias("_field"), F.col("value").alias("_at"))
        found.append(exploded(inner, F.concat(F.col("_field"), F.lit("."))))
    return reduce(DataFrame.unionByName, found)


def census(rows: DataFrame, column: str, key: str, levels: int = LEVELS) -> DataFrame:
    """(field, type, rows, digest): how often each field comes with each type.

    The digest adds up a hash of each row's key and value, so it is the same
    whatever the order and tells whether every value was kept.
    """
    value = F.to_json("value")
    named = F.concat(F.coalesce(F.col(key), F.lit("")), F.lit("="), value)
    number = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("bigint")
    parts = listed(rows.select(key, column), column, levels)
    return (
        parts.select("field", kind(F.col("value")).alias("type"), number.alias("number"))
        .groupBy("field", "type")
        .agg(F.count("*").alias("rows"), F.sum("number").alias("digest"))
    )
