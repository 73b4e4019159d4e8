"""Sources and sinks."""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "csv",
               header: bool = True, **options) -> DataFrame:
    """Read a table with a declared schema (CSV: header row, quoted strings, UTF-8; an empty field is NULL).

    Schema inference is only used when no schema is given (a helper for
    exploration; it costs an extra pass over the data).
    """
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", header).option("encoding", "UTF-8").option("quote", '"').option("escape", '"') \
             .option("multiLine", options.pop("multiLine", False))
        if schema is None:
            r = r.option("inferSchema", True)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


#: one CSV record: runs without a quote or line break, and quoted parts, which may hold both (a doubled quote is two parts side by side)
RECORD = r'(?:[^"\n]++|"[^"]*+(?:"|\z))++'


def read_csv_text(df: DataFrame, text: str, schema: T.StructType | str, keep: Sequence[str] = (),
                  header: bool = True) -> DataFrame:
    """Rows from CSV held in a string column (one table per row of ``df``).

    Records end at line breaks outside quotes, so quoted fields may hold line
    breaks and doubled quotes; a quote that is never closed runs to the end of
    the text.  Blank lines are no records.  The header record is dropped and each
    record is parsed with ``from_csv`` against the declared schema.
    """
    sch = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    records = F.transform(F.regexp_extract_all(F.col(text), F.lit(RECORD), F.lit(0)), lambda r: F.regexp_replace(r, r"\r\z", ""))
    records = F.filter(records, lambda r: F.length(F.trim(r)) > 0)
    records = F.slice(records, 2, F.greatest(F.size(records) - 1, F.lit(0))) if header else records
    rows = df.select(*keep, F.explode(records).alias("_record"))
    parsed = rows.select(*keep, F.from_csv("_record", sch, {"multiLine": "true", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}).alias("_r"))
    return parsed.select(*keep, "_r.*")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), **options) -> None:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        # the quote and escape that read_table expects; outer spaces are part of a text
        w = w.options(header=True, encoding="UTF-8", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def with_manifest(df: DataFrame, model: str, version: str, params: Mapping, prompt_template: str | None = None,
                  run_date: str | None = None) -> DataFrame:
    """Attach the run manifest (model, version, date, parameters as JSON, prompt template) to every row."""
    run_date = run_date or _dt.date.today().isoformat()
    cols = {"run_model": F.lit(model), "run_version": F.lit(version), "run_date": F.lit(run_date),
            "run_params": F.lit(json.dumps(dict(params), sort_keys=True))}
    if prompt_template is not None:
        cols["run_prompt_template"] = F.lit(prompt_template)
    return df.withColumns(cols)


def append_run(df: DataFrame, path: str, model: str, version: str, params: Mapping, prompt_template: str | None = None,
               run_date: str | None = None) -> None:
    """Append a batch with its manifest to a parquet table partitioned by run date and model."""
    m = with_manifest(df, model, version, params, prompt_template, run_date)
    write_table(m, path, mode="append", partition_by=["run_date", "run_model"])
