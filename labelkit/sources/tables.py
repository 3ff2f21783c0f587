"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkit.operators.ranks import join_groups, ordered_rank
from labelkit.operators.relations import union_examples
from labelkit.session import sized_table

EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("example_id", T.LongType()),
        T.StructField("task_id", T.IntegerType()),
        T.StructField("dataset_type", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("input_text", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

# RFC 4180 quoting; blanks and empty strings are kept, NULL is written as \\N
# and read from that or from an unquoted empty field.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "FAILFAST",
}

FILE_ROWS_LIMIT = 100_000


def read_examples(
    spark: SparkSession, path: str, schema: T.StructType = EXAMPLE_SCHEMA, format: str = "csv", multi_line: bool = True
) -> DataFrame:
    """Example table from CSV with a header, or from a columnar format.

    Quoted text may span lines (``multi_line``); such a CSV file is read by one task, so
    large tables should come as many files or as parquet.
    """
    reader = spark.read.schema(schema)
    if format == "csv":
        return reader.options(**CSV_OPTIONS).csv(path, multiLine=multi_line)
    return reader.format(format).load(path)


def read_fixed_splits(
    spark: SparkSession, paths: Mapping[str, str], schema: T.StructType = EXAMPLE_SCHEMA, format: str = "csv"
) -> DataFrame:
    """Ready-made files per split, such as train, val and test, as one table with ``split``."""
    return union_examples(
        [read_examples(spark, path, schema, format).withColumn("split", F.lit(split)) for split, path in paths.items()]
    )


def write_examples(df: DataFrame, path: str, format: str = "csv", mode: str = "errorifexists") -> None:
    """Any example, split or prediction table, with its key column."""
    writer = df.write.mode(mode)
    if format == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.format(format).save(path)


def rater_schema(raters: Sequence[str]) -> T.StructType:
    lists = T.StructType(
        [
            T.StructField("index", T.ArrayType(T.LongType())),
            T.StructField("predicted", T.ArrayType(T.StringType())),
            T.StructField("ground_truth", T.ArrayType(T.StringType())),
        ]
    )
    return T.StructType([T.StructField(r, lists) for r in raters])


def read_raters(spark: SparkSession, path: str, raters: Sequence[str], multi_line: bool = False) -> DataFrame:
    """Nested rater files as ``(rater, example_id, predicted, ground_truth)``.

    Each JSON document has one object of parallel lists per rater.  Documents are read
    one per line, or one per file with ``multi_line``.  All raters come out of one scan.
    A broken document, or lists of unequal length, end the job with an error.
    """
    documents = spark.read.schema(rater_schema(raters)).json(path, multiLine=multi_line, mode="FAILFAST")
    lists = F.array(*[F.struct(F.lit(r).alias("rater"), F.col(f"`{r}`").alias("lists")) for r in raters])
    per_rater = documents.select(F.explode(lists).alias("_r")).select("_r.rater", "_r.lists.*")
    sizes = [F.size(c) for c in ("index", "predicted", "ground_truth")]
    equal = (sizes[0] == sizes[1]) & (sizes[1] == sizes[2])
    zipped = F.arrays_zip("index", "predicted", "ground_truth")
    rows = F.when(equal, zipped).otherwise(F.raise_error(F.concat(F.lit("lists of unequal length for rater "), "rater")))
    return per_rater.select("rater", F.explode(rows).alias("_row")).select(
        "rater", F.col("_row.index").alias("example_id"), "_row.predicted", "_row.ground_truth"
    )


def with_row_key(df: DataFrame, order: Sequence[str], name: str = "example_id") -> DataFrame:
    """Contiguous 0-based key in the order of columns that identify a row.

    Only the order columns are ranked; other columns are joined back by them.
    """
    keyed = ordered_rank(df.select(*order), order, name="_rank").select(*order, (F.col("_rank") - 1).alias(name))
    return keyed if set(df.columns) == set(order) else join_groups(df, keyed, list(order))


def read_with_row_key(spark: SparkSession, path: str, name: str = "example_id") -> DataFrame:
    """A parquet table with a contiguous 0-based key in file and row order.

    The scan itself knows each row's place in its file; only the row counts of earlier
    files are added, so the data is not shuffled.
    """
    table = spark.read.parquet(path)
    placed = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts, n_files = sized_table(placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")), "file-rows")
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    if n_files <= FILE_ROWS_LIMIT:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, "_file").select((F.col("_offset") + F.col("_row")).alias(name), *table.columns)


def write_split_bundle(splits: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists") -> None:
    """All splits with their keys under one folder, one subfolder per split."""
    writer = splits.write.mode(mode).partitionBy("split")
    if format == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.format(format).save(path)


def read_split_bundle(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """A written bundle; a filter on ``split`` reads only its folders."""
    reader = spark.read.schema(schema)
    if format == "csv":
        return reader.options(**CSV_OPTIONS).csv(path, multiLine=True)
    return reader.format(format).load(path)


def write_predictions(predictions: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_examples(predictions.select("example_id", "predicted", "ground_truth"), path, "csv", mode)


def write_trial_summary(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per run: accuracies in trial order, mean and deviation."""
    summary.write.mode(mode).json(path)
