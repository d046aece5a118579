"""Malformed CSV records, beside the NULL-in-field rule.

``files.load_csv`` turns a value that does not fit its type into NULL, and the
record goes on. ``load_csv_quarantined`` sets such records aside instead, with
the line as it stood and every fault in it, so that
raw rows = kept + quarantined, and kept = clean + dropped later on.

A record is malformed where a value does not fit its column's type, or where
the line has fewer or more fields than the schema. An empty field is NULL and
no fault.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from valuekit.sources.files import load_csv, write_parquet_counted

RAW = "_raw_record"
SURPLUS = "_surplus"
END = "\u0001"


def load_csv_quarantined(spark: SparkSession, path: str, schema: StructType, **options) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): rows of ``schema`` without a fault, and for each
    other record ``raw`` (its line) and ``faults`` (array of field, reason).

    Every use reads all columns: a fault in a column that a query does not read
    would not be seen."""
    options = {**options, "columnPruning": "false", "columnNameOfCorruptRecord": RAW}
    rows = load_csv(spark, path, StructType([*schema.fields, StructField(RAW, StringType())]), **options)
    # Always true; it reads every column, as only columns that are read are converted and tested.
    rows = rows.where(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields]) >= "")
    return rows.where(F.col(RAW).isNull()).drop(RAW), _faults(rows.where(F.col(RAW).isNotNull()), schema, options)


def _faults(rows: DataFrame, schema: StructType, options: dict) -> DataFrame:
    """One more field is put at each line's end: where it comes out tells how
    many fields the line has, which NULLs for empty fields do not."""
    sep = options.get("sep", options.get("delimiter", ","))
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields) + f", {SURPLUS} string"
    parse = {k: str(v) for k, v in options.items() if k in ("quote", "escape")}
    text = F.from_csv(F.concat(F.col(RAW), F.lit(sep + END)), texts, {**parse, "sep": sep})
    fault = lambda field, reason: F.struct(F.lit(field).cast("string").alias("field"), F.lit(reason).alias("reason"))
    found, ended, broken = [], F.lit(False), F.lit(False)
    for f in schema.fields:
        value = F.coalesce(F.col("t").getField(f.name), F.lit(""))
        ended = ended | (value == END)
        unclosed = (value != END) & value.endswith(END)
        broken = broken | unclosed
        found.append(F.when(ended, fault(f.name, "missing")).when(unclosed, fault(f.name, "quote not closed"))
                     .when(~broken & (value != "") & F.col(f"`{f.name}`").isNull(), fault(f.name, f"not {f.dataType.simpleString()}")))
    whole = F.coalesce(F.col("t").getField(SURPLUS) == END, F.lit(False))
    found.append(F.when(~ended & ~broken & ~whole, fault(None, "more fields than columns")))
    return rows.withColumn("t", text).select(F.col(RAW).alias("raw"), F.array_compact(F.array(*found)).alias("faults"))


def fault_counts(quarantined: DataFrame) -> DataFrame:
    """field, reason, n_records: a record with two faults counts in both."""
    return (quarantined.select(F.explode("faults").alias("f")).groupBy("f.field", "f.reason")
            .agg(F.count(F.lit(1)).alias("n_records")))


def write_quarantined(spark: SparkSession, path: str, schema: StructType, kept_path: str, quarantine_path: str,
                      **options) -> dict[str, int]:
    """Write both tables; their row counts, taken on the writes, and the sum."""
    kept, quarantined = load_csv_quarantined(spark, path, schema, **options)
    counts = {"kept": write_parquet_counted(kept, kept_path, "kept"),
              "quarantined": write_parquet_counted(quarantined, quarantine_path, "quarantined")}
    return {"raw": sum(counts.values()), **counts}
