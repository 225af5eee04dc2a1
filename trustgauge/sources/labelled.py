"""Labelled tables and saved error tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgauge.sources.workspace import settle

# The columns a labelled table must have, and the cell texts that mean "missing"
# in a CSV file.
REQUIRED_COLUMNS = ("text", "target")
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

SAVED_ERROR_TYPES = {
    "model": "string",
    "text": "string",
    "true_label": "int",
    "predicted_label": "int",
    "confidence": "double",
}

# Copies of one row are numbered in runs of this length, so no task expands all of them.
COPY_RUN = 10_000


def _read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; every column a string."""
    try:
        raw = spark.read.csv(
            path, header=True, multiLine=multi_line, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no labelled table at {path}") from error
        raise
    return raw.select(
        *[
            F.when(F.col(f"`{c}`").isin(MISSING_MARKERS), None).otherwise(F.col(f"`{c}`")).alias(c)
            for c in raw.columns
        ]
    )


def checked_labels(df: DataFrame, origin: str = "table") -> DataFrame:
    """Require text and target, fill missing text, and make target an int.

    A missing target fails the job that reads it.
    """
    absent = sorted(set(REQUIRED_COLUMNS) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns in {origin}: {absent}")
    target = F.col("target").cast("double").cast("int")
    return df.withColumns(
        {
            "text": F.coalesce(F.col("text").cast("string"), F.lit("")),
            "target": F.when(target.isNull(), F.raise_error(F.lit("missing target")).cast("int"))
            .otherwise(target),
        }
    )


def with_row_ids(df: DataFrame) -> DataFrame:
    """Add a string ``id`` that depends on the row alone, not on where Spark reads it.

    Equal rows are counted before the shuffle and then numbered in short runs, so a row with
    very many copies neither fills one task nor makes one long array.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    runs = counted.withColumn(
        "_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_RUN)))
    )
    runs = runs.repartition(*[F.col(f"`{c}`") for c in df.columns], F.col("_run"))
    start = F.col("_run") * COPY_RUN
    end = F.least(start + COPY_RUN, F.col("_copies")) - 1
    numbered = runs.withColumn("_copy", F.explode(F.sequence(start, end)))
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return numbered.select(
        F.md5(F.concat_ws(":", F.col("_copy").cast("string"), row)).alias("id"),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def _with_checked_ids(df: DataFrame) -> DataFrame:
    """Keep usable ids, else derive them; derived ids are written once, not again for each reader."""
    if "id" not in df.columns:
        return settle(with_row_ids(df))
    text = F.col("id").cast("string")
    whole = text.rlike("^-?[0-9]{1,18}$")
    seen = df.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.every(whole).alias("whole"))
    state = seen.agg(
        F.max("n").alias("most"), F.every(F.col("id").isNotNull()).alias("given"),
        F.every("whole").alias("whole"),
    ).first()
    if state["most"] is not None and (state["most"] > 1 or not state["given"]):
        return settle(with_row_ids(df.withColumnRenamed("id", "given_id")))
    return df.withColumn("id", F.col("id").cast("long")) if state["whole"] else df


def load_labelled_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Labelled CSV: text and target checked and typed, other columns kept as strings.

    Texts may hold line breaks, so a file is read by one task; a very large input should come
    in many files, or with ``multi_line=False`` when no text has a line break.

    An ``id`` column becomes a long when every id is a whole number, else it stays text; without an
    ``id``, or when ids are missing or repeated, one is derived from the row.
    """
    return _with_checked_ids(checked_labels(_read_csv(spark, path, multi_line), path))


def load_labelled_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no labelled table at {path}") from error
        raise
    return _with_checked_ids(checked_labels(df, path))


def load_saved_errors(spark: SparkSession, path: str) -> DataFrame:
    """Errors written by an earlier run. An empty table is refused."""
    df = _read_csv(spark, path)
    # The probability column may be named after the positive class of its time.
    types = {c: "double" for c in df.columns if c.startswith("prob_")} | SAVED_ERROR_TYPES
    typed = df.select(
        *[F.col(f"`{c}`").cast(types.get(c, "string")).alias(c) for c in df.columns]
    )
    if typed.isEmpty():
        raise ValueError(f"{path} is empty")
    # A missing text reads as the word that stands for it, one token long.
    return typed.withColumn("text", F.coalesce("text", F.lit("nan")))
