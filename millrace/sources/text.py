"""Text files as one-column DataFrames, and the comma-separated finance lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names, order and types of the seven fields of a finance line.
FINANCE_SCHEMA = T.StructType(
    [
        T.StructField("FinanceKey", T.LongType()),
        T.StructField("DateKey", T.StringType()),
        T.StructField("OrganizationName", T.StringType()),
        T.StructField("DepartmentGroupName", T.StringType()),
        T.StructField("ScenarioName", T.StringType()),
        T.StructField("AccountDescription", T.StringType()),
        T.StructField("Amount", T.DoubleType()),
    ]
)
ACCOUNT = "AccountDescription"


def scan_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, also for empty lines."""
    return spark.read.text(path)


def scan_values(spark: SparkSession, values: list[str]) -> DataFrame:
    """Literal strings as a collection."""
    return spark.createDataFrame([(v,) for v in values], "value string")


def scan_finance_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_finance_lines(scan_text(spark, path))


def scan_finance_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lenient reading: quotes are honoured within a line, blank and bad lines skipped,
    whichever columns the query goes on to use."""
    bad = "_bad"
    schema = T.StructType([*FINANCE_SCHEMA.fields, T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    fields = F.from_csv(F.col("value"), schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    # As below, the generator keeps the filter above the parsing.
    once = scan_text(spark, path).select("value", F.explode(F.array(fields)).alias("_fields"))
    sound = (F.trim("value") != "") & F.col(f"_fields.{bad}").isNull() & F.col("_fields").isNotNull()
    return once.where(sound).select(*[F.col("_fields")[f.name].alias(f.name) for f in FINANCE_SCHEMA.fields])


def _whole_number(text: Column) -> Column:
    # Spark's cast takes blanks around the digits, which are refused here.
    first, last = F.ascii(text), F.ascii(F.right(text, F.lit(1)))
    return F.when((first > 32) & (last > 32), text.try_cast("bigint"))


def parse_finance_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Cut at every comma: no header, no quotes, fields past the seventh are
    ignored.  A line that does not parse fails the job, whichever columns the
    query goes on to use."""
    part = F.col("_part")
    fields = [F.get(part, F.lit(i)) for i in range(len(FINANCE_SCHEMA))]
    key, amount = _whole_number(fields[0]), fields[6].try_cast("double")
    complaint = F.concat(F.lit("not a finance line: "), F.coalesce(F.col(text), F.lit("NULL")))
    sound = F.when(key.isNotNull() & amount.isNotNull(), F.lit(True)).otherwise(
        F.raise_error(complaint).cast("boolean")
    )
    values = [key, *fields[1:6], amount]
    # The generator keeps the check above the split.  Over a plain column Catalyst
    # would push it down as a second split of every line.
    cut = lines.select(text, F.explode(F.array(F.split(F.col(text), ","))).alias("_part"))
    return cut.where(sound).select(
        *[v.alias(f.name) for v, f in zip(values, FINANCE_SCHEMA.fields)]
    )
