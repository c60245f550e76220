"""Input files: transactions as JSON lines, lookups as CSV."""

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.functions import parsing, rules
from txnrisk.operators import extras
from txnrisk.operators.clean import STATE, with_state
from txnrisk.schemas import DOUBLE_COLUMNS, RAW_COLUMNS, text_schema, typed_schema

log = logging.getLogger(__name__)

CORRUPT_TEXT = "corrupt_line"
EXTRA = "extra_fields"
#: Ours: further fields that the lines may have. Each becomes a column while they are read.
MOST_FIELDS = 1000


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or pattern is there. Nothing below a folder is listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return bool(found)


def further_fields(spark: SparkSession, path: str, most: int = MOST_FIELDS) -> list[str]:
    """Names of the top-level fields beyond the twelve columns, in one pass over the lines.

    Lines that are no strict JSON tell no names. More than ``most`` names are
    refused, never cut: such lines use field names as data. Columns are told
    apart without regard to case, so a name that is another in other case is
    left out with a warning.
    """
    keys = F.explode(F.json_object_keys("value")).alias("name")
    names = spark.read.text(path).select(keys).filter(~F.col("name").isin(RAW_COLUMNS)).distinct()
    found = sorted(row["name"] for row in names.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"the lines have more than {most} different fields")
    taken, kept = {c.lower() for c in (*RAW_COLUMNS, CORRUPT_TEXT, STATE, EXTRA)}, []
    for name in found:
        if name.lower() in taken:
            log.warning("field %r is not kept: another one has this name in other case", name)
            continue
        taken.add(name.lower())
        kept.append(name)
    return kept


def read_lines(spark: SparkSession, path: str, further: list[str] | None = None) -> DataFrame:
    """Every JSON line as text values, with its record state; a missing path is an error.

    Values stay as they arrived, and silver casts them one by one, so an odd
    value costs that value there and not the line. A line that is no JSON object has the state
    ``CORRUPT_LINE`` and its text in ``corrupt_line``. Blank lines are skipped.
    Store the result before counting it: Spark refuses to scan JSON for the
    corrupt text alone, which is what such a count would come down to.

    With ``further`` names (see ``further_fields``), the column ``extra_fields`` has
    these fields as one VARIANT object, with their types and nested ones. A line
    in which one of them repeats a nested field is corrupt then.
    """
    fields = [T.StructField(name, T.VariantType()) for name in further or []]
    lines = (
        spark.read.schema(T.StructType([*text_schema([*RAW_COLUMNS, CORRUPT_TEXT]), *fields]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_TEXT)
        .json(path)
    )
    checked = with_state(lines)
    state = F.when(F.col(CORRUPT_TEXT).isNotNull(), rules.CORRUPT).otherwise(F.col(STATE))
    checked = checked.withColumn(STATE, state)
    if further is None:
        return checked
    known = [*RAW_COLUMNS, CORRUPT_TEXT, STATE]
    return checked.select(*known, extras.joined(further).alias(EXTRA))


def readable(lines: DataFrame) -> DataFrame:
    """The raw layer: every line that held a JSON object, its values as text."""
    return lines.filter(F.col(STATE) != rules.CORRUPT).drop(CORRUPT_TEXT)


def corrupt(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(STATE) == rules.CORRUPT).select(CORRUPT_TEXT)


def read_lookup(
    spark: SparkSession,
    path: str | None,
    columns: list[str],
    null_tokens: tuple[str, ...] = (),
) -> DataFrame:
    """A CSV file with a header, columns found by name, scores as doubles.

    Without a file the result is empty but has its columns. Only empty fields
    are null unless ``null_tokens`` names more, such as ``NA``.
    """
    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], typed_schema(columns))
    table = spark.read.option("header", True).option("escape", '"').csv(path)

    def value(name: str):
        text = F.col(name)
        return F.when(~text.isin(*null_tokens), text).alias(name) if null_tokens else text

    table = table.select([value(name) for name in columns])
    scores = {c: parsing.to_double(table, c) for c in DOUBLE_COLUMNS if c in columns}
    return table.withColumns(scores)


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first of several input paths that exists."""
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")
