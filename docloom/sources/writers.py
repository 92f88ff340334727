"""Result files.  Large outputs stay distributed; ``single`` is for small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(records: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON record per line, in as many files as there are partitions."""
    records.write.mode(mode).json(path)


def single(records: DataFrame, most: int = 100_000) -> str:
    """Few records as one JSON text: an object if there is one, else an array; more than ``most`` are refused."""
    rows = records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} records: write them with json_lines")
    texts = [r["j"] for r in rows]
    return texts[0] if len(texts) == 1 else "[" + ",\n".join(texts) + "]"


def with_sources(documents: DataFrame, statistics: DataFrame, run_id: str, path: str, mode: str = "error") -> None:
    """Document records, and beside them the run's statistics."""
    documents.write.mode(mode).json(f"{path}/results")
    n = documents.agg(F.count(F.lit(1)).cast("int").alias("total_documents"))
    statistics.crossJoin(n).withColumn("run_id", F.lit(run_id)).write.mode(mode).json(f"{path}/run")


def append_golden(annotations: DataFrame, path: str) -> None:
    """Adds annotated documents to a golden table; readers let the last one of an id count."""
    annotations.write.mode("append").parquet(path)


def calibrator(knots: DataFrame, path: str, mode: str = "overwrite") -> None:
    knots.write.mode(mode).parquet(path)


def report(text: str, path: str) -> None:
    """A report's text as one small file on the driver's file system."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def iso(ts):
    """A time as ISO 8601 text."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def run_id():
    """The current time as a run's name."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
