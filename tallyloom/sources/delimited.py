"""CSV sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.labels import NULL_TOKENS
from tallyloom.functions.text import or_raise

# Where a row stood in the source: file, block of the file, row of the block's task. Compared as a
# struct this is the arrival order, also when many tasks read many files.
SEQ = "_seq"


def read_text_cells(
    spark: SparkSession, path: str | list[str], delimiter: str = ",", header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Every cell as text, columns named by the header, null tokens read as null.

    ``multiline`` allows line breaks inside quotes; such files cannot be split between tasks.
    """
    raw = (
        spark.read.option("header", header).option("sep", delimiter).option("quote", '"')
        .option("escape", '"').option("multiLine", multiline).option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )
    return raw.select(
        *[F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)).alias(c) for c in raw.columns],
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(SEQ),
    )


def _typed(name: str, kind: str) -> Column:
    """A cell as its type. Whole numbers may be written with decimals, as in ``2.0``.

    A cell that is not of the type raises, whether or not the session is an ANSI one.
    """
    text = F.trim(F.col(name))
    if kind != "bigint":
        return or_raise(text.try_cast(kind), text, f"{name} is not {kind}")
    number = or_raise(text.try_cast("decimal(38,9)"), text, f"{name} is not a number")
    return F.when(number == F.floor(number), number.try_cast("bigint")).when(
        number.isNotNull(), F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), text)).cast("bigint")
    )


def inferred_types(cells: DataFrame) -> dict[str, str]:
    """bigint, double or boolean for the text columns all of whose cells are; one pass over all rows.

    A column with other cells, or with none but nulls, is left out and stays text.
    """
    names = [f.name for f in cells.schema.fields if f.dataType.simpleString() == "string"]
    if not names:
        return {}
    counts = []
    for i, name in enumerate(names):
        text = F.trim(F.col(name))
        counts += [
            F.count(text).alias(f"n{i}"),
            F.count(text.try_cast("bigint")).alias(f"bigint{i}"),
            F.count_if(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")).alias(f"double{i}"),
            F.count_if(F.lower(text).isin("true", "false")).alias(f"boolean{i}"),
        ]
    found = cells.agg(*counts).first()
    types = {}
    for i, name in enumerate(names):
        kind = next((k for k in ("bigint", "double", "boolean") if found[f"{k}{i}"] == found[f"n{i}"]), None)
        if kind and found[f"n{i}"]:
            types[name] = kind
    return types


def typed(cells: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the text columns named in ``types``; a malformed value fails the job."""
    return cells.withColumns({
        name: _typed(name, kind) for name, kind in types.items()
        if name in cells.columns and cells.schema[name].dataType.simpleString() == "string"
    })


def write_csv(df: DataFrame, path: str) -> None:
    """One header per file, no row numbers, text as it is."""
    (
        df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
