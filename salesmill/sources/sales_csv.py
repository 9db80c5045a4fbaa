"""Reading raw sales files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmill.functions import parse_sales_date
from salesmill.schema import RAW_TYPES, RENAME
from salesmill.sources.inference import infer_types

#: Holds the text of a line with too few or too many fields.
MALFORMED = "_malformed_line"
#: What such lines are counted under.
MALFORMED_LINES = "malformed_lines"
_DATES = ("Order Date", "Ship Date")
_RARELY_REPEATED = ("Order ID", "Unit Price", "Total Revenue", "Total Cost", "Total Profit")
_CSV = {
    "header": True,
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    # Reading fewer columns, the parser would not see that a line is too short or too long.
    "columnPruning": False,
}


def read_sales_text(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The fields of headed CSV files as text, in the order of the header, and ``MALFORMED``.

    Only the header line is read beforehand. Each file's header is checked against it, so a file
    with another column order fails instead of filling the wrong columns.
    """
    reader = spark.read.options(**_CSV).options(**options)
    headers = [h for h in reader.csv(path).columns if h != MALFORMED]
    fields = [T.StructField(h, T.StringType()) for h in [*headers, MALFORMED]]
    return reader.schema(T.StructType(fields)).option("enforceSchema", False).csv(path)


#: Holds for every text that converts to a whole number; a cast that fails throws, which costs far more.
_LIKE_WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"


def _converted(header: str, dtype: T.DataType) -> Column:
    value = F.col(f"`{header}`")
    cast = value.try_cast(dtype)
    return F.when(value.rlike(_LIKE_WHOLE), cast) if isinstance(dtype, T.LongType) else cast


def _rejected(text: DataFrame) -> dict[str, tuple[Column, Column]]:
    """By cleaned name: whether a field is there but does not convert, and its text."""
    found = {}
    for header in text.columns:
        value = F.col(f"`{header}`")
        if header in _DATES:
            fits = parse_sales_date(value)
        elif RAW_TYPES.get(header, T.StringType()) != T.StringType():
            fits = _converted(header, RAW_TYPES[header])
        else:
            continue
        found[RENAME[header]] = value.isNotNull() & (F.trim(value) != "") & fits.isNull(), value
    found[MALFORMED_LINES] = F.col(MALFORMED).isNotNull(), F.col(MALFORMED)
    return found


def reject_counts(text: DataFrame) -> dict[str, Column]:
    """Aggregates: fields per column that are there but do not convert, and malformed lines."""
    return {name: F.count_if(bad) for name, (bad, _) in _rejected(text).items()}


def split_rejects(text: DataFrame) -> DataFrame:
    """The rows of ``read_sales_text`` and, beside them, one row for each rejected field.

    Column ``kind`` is ``row`` or ``reject``. A row has the raw columns; a reject has ``file``,
    ``block_start`` (the byte where the block of the file begins that a task read), ``place`` (how
    many rows the task had met), ``column_name`` and ``raw_text``, the field's or the whole line's.
    Written partitioned by ``kind``, both come from one pass over the text.
    """
    raw = [c for c in text.columns if c != MALFORMED]
    # One element for the row, and one for each field that may be rejected: null where it is not.
    # Dropping nulls after the explosion stays in generated code; a function over the array does not.
    row = F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("raw_text"))
    fields = [
        F.when(bad, F.struct(F.lit(name).alias("column_name"), value.alias("raw_text")))
        for name, (bad, value) in _rejected(text).items()
    ]
    found = text.select(
        *(F.col(f"`{c}`") for c in raw),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        F.array(row, *fields).alias("rejects"),
    )
    each = found.withColumn("reject", F.explode("rejects")).where("reject IS NOT NULL")
    is_row = F.col("reject.column_name").isNull()
    return each.select(
        F.when(is_row, "row").otherwise("reject").alias("kind"),
        *(F.when(is_row, F.col(f"`{c}`")).alias(c) for c in raw),
        *(F.when(~is_row, F.col(c)).alias(c) for c in ("file", "block_start", "place")),
        "reject.column_name",
        "reject.raw_text",
    )


def write_split_rejects(text: DataFrame, path: str) -> None:
    """Write ``split_rejects`` partitioned by ``kind``, in one pass and without sorting the rows.

    A task keeps both kinds' files open, so it need not sort its rows by kind first. Fields that
    rarely repeat are written without a dictionary, which would be given up after much hashing.
    """
    session, option = text.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    writer = split_rejects(text).write.partitionBy("kind")
    for header in _RARELY_REPEATED:
        writer = writer.option(f"parquet.enable.dictionary#{header}", "false")
    before = session.get(option)
    session.set(option, max(2, int(before)))
    try:
        writer.parquet(path)
    finally:
        session.set(option, before)


def rejects(text: DataFrame) -> DataFrame:
    """One row per typed column, and one for malformed lines: how many fields were rejected."""
    counts = reject_counts(text)
    row = text.agg(*(count.alias(name) for name, count in counts.items()))
    return row.unpivot([], list(counts), "column_name", "rejected")


def typed_sales(text: DataFrame, extra: dict[str, T.DataType] | None = None) -> DataFrame:
    """Known columns in their types; what does not convert is null. Dates stay text."""
    types = {**(extra or {}), **RAW_TYPES}
    return text.select(
        *(
            _converted(h, types.get(h, T.StringType())).alias(h)
            for h in text.columns
            if h != MALFORMED
        )
    )


def unknown_headers(text: DataFrame) -> list[str]:
    """Columns of ``read_sales_text`` that no schema names."""
    return [h for h in text.columns if h not in RAW_TYPES and h != MALFORMED]


def read_sales_csv(
    spark: SparkSession, path: str, infer: bool = False, **options: str
) -> DataFrame:
    """Sales rows of headed CSV files under ``path``.

    Known headers have known types, in whatever order a file has them; other columns are text, or
    with ``infer=True`` the least type that holds all their fields, which costs a pass over the data if
    there are such columns. Fields that do not convert become null; ``rejects`` counts them.
    """
    text = read_sales_text(spark, path, **options)
    return typed_sales(text, infer_types(text, unknown_headers(text)) if infer else None)
