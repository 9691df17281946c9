"""Schema inference for delimited pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageframe.functions.text import body_text, drop_tail, split_lines
from pageframe.operators.line_pages import DELIMITERS, split_line
from pageframe.options import SourceOptions

# Fixed value: types tried from narrow to wide; text fits everything.
LATTICE = ("int", "bigint", "double", "boolean")
WHOLE = r"^[+-]?\d+$"
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TRUTH = r"(?i)^(true|false)$"


def sample_lines(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """The first lines of the first page of each seed: ``seed, line_no, line``.

    The sample size counts the header line. Only that much of a page is exploded.
    """
    first = responses.filter(F.col("page_no") == 0)
    limit = -1 if options.sample_size is None else options.sample_size + 1
    split = first.select("seed", split_lines(body_text(F.col("body")), limit).alias("pieces"))
    every = drop_tail(F.col("pieces"))
    if options.sample_size is not None:
        every = F.slice(every, 1, options.sample_size)
    return split.select("seed", F.posexplode(every).alias("line_no", "line"))


def _fits(value: Column, name: str) -> Column:
    if name in ("int", "bigint"):
        return value.rlike(WHOLE) & value.try_cast(name).isNotNull()
    return value.rlike(DECIMAL if name == "double" else TRUTH)


def infer_columns(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """Column types per seed: ``seed, position, name, type, nullable``.

    A column has the narrowest type that fits all its values in the sample and is nullable if
    one is empty or absent. Names come from the header line, else they are ``body_0``,
    ``body_1``, ... All folds are min/max aggregates over (seed, column).
    """
    delimiter = DELIMITERS[options.page_format]
    sampled = sample_lines(responses, options)
    values = split_line(F.col("line"), delimiter, options.enable_quoted_values)
    cells = sampled.select("seed", "line_no", F.posexplode(values).alias("position", "value"))
    value = F.nullif(F.col("value"), F.lit(""))
    is_header = (F.col("line_no") == 0) if options.csv_skip_first_row else F.lit(False)
    # the first line decides which columns there are; shorter lines leave them empty
    folded = cells.groupBy("seed", "position").agg(
        F.max(F.when(F.col("line_no") == 0, F.col("value"))).alias("first_value"),
        F.count_if(~is_header).alias("n_cells"),
        F.count_if(~is_header & value.isNull()).alias("n_empty"),
        *[
            F.bool_and(F.when(~is_header & value.isNotNull(), _fits(value, name))).alias(f"is_{name}")
            for name in LATTICE
        ],
    )
    kind = F.lit("string")
    for name in reversed(LATTICE):
        kind = F.when(F.col(f"is_{name}"), F.lit(name)).otherwise(kind)
    name = F.concat(F.lit("body_"), F.col("position").cast("string"))
    if options.csv_skip_first_row:
        name = F.coalesce(F.nullif(F.trim("first_value"), F.lit("")), name)
    described = F.struct(
        F.col("position").cast("int").alias("position"), name.alias("name"), kind.alias("type"), "n_empty", "n_cells", "first_value"
    )
    # one row per column of a seed; every line has a first column, so its cells count the lines
    columns = folded.groupBy("seed").agg(F.max("n_cells").alias("n_rows"), F.collect_list(described).alias("columns"))
    return (
        columns.select("seed", "n_rows", F.inline("columns"))
        .filter(F.col("first_value").isNotNull())
        .select("seed", "position", "name", "type", ((F.col("n_empty") > 0) | (F.col("n_cells") < F.col("n_rows"))).alias("nullable"))
    )


def infer_schema(responses: DataFrame, options: SourceOptions) -> T.StructType:
    """Schema of one delimited source. Only the description of its columns reaches the driver."""
    seed = responses.filter(F.col("seed") == options.url)
    columns = infer_columns(seed, options).orderBy("position").collect()
    if not columns:
        raise ValueError("the first page has no lines to infer a schema from")
    return T.StructType(
        [T.StructField(c["name"], T._parse_datatype_string(c["type"]), c["nullable"]) for c in columns]
    )
