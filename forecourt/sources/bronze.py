"""Land raw extracts in the bronze layer.

Bronze keeps data exactly as received: every column is text, nothing is
cleaned, filtered or joined.  ``_rescued`` has the text of records that do not
fit the header.  Two audit columns are added: ``_ingested_at`` (UTC text, only when the extract lacks one) and
``_ingest_date`` (the run date, also the partition column).

Each entity is one lazy read -> write plan, split across executors by file
split; re-running a day overwrites only that day's partition.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forecourt.sources.csv_records import read_records

# ---------------------------------------------------------------- FIXED VALUES
# Source system -> entity -> extract file name (as delivered).
SOURCES = {
    "dms": {
        "work_orders": "dms_work_orders.csv",
        "work_order_lines": "dms_work_order_lines.csv",
        "technicians": "dms_technicians.csv",
    },
    "erp": {
        "parts": "erp_parts.csv",
        "stock_movements": "erp_stock_movements.csv",
        "suppliers": "erp_suppliers.csv",
    },
    "crm": {"customers": "crm_customers.csv", "vehicles": "crm_vehicles.csv"},
    "pos": {"invoices": "pos_invoices.csv", "payments": "pos_payments.csv"},
    "telematics": {"events": "telematics_events.csv"},
    "supplier_feeds": {"price_list": "supplier_price_list.csv"},  # P48: a new file every day
}
# ------------------------------------------------------------ END FIXED VALUES

INGESTED_AT = "_ingested_at"
INGEST_DATE = "_ingest_date"
#: Files that a task may have open; with 0 Spark sorts all rows by the partition, of which a landing has one.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def run_id() -> str:
    """A name for a landing's folder that no other landing has."""
    return uuid.uuid4().hex[:12]


def to_bronze(df: DataFrame, ingested_at: str, ingest_date: str) -> DataFrame:
    """Every column as text, plus the audit columns."""
    cols = [F.col("`" + c.replace("`", "``") + "`").cast("string").alias(c) for c in df.columns]
    if INGESTED_AT not in df.columns:
        cols.append(F.lit(ingested_at).alias(INGESTED_AT))
    cols.append(F.lit(ingest_date).alias(INGEST_DATE))
    return df.select(*cols)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text, exactly as received, and ``_rescued``
    (see ``csv_records``; the header decides the column set)."""
    return read_records(spark, path)


def _exists(spark: SparkSession, path: str) -> bool:
    """S3: existence check that works for any file system Spark can read:
    building a file-source DataFrame lists the path and fails if it is missing."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException:
        return False


@dataclass
class LandReport:
    loaded: dict = field(default_factory=dict)   # "source.entity" -> rows
    skipped: list = field(default_factory=list)  # "source.entity" missing


def land_entity(spark: SparkSession, csv_path: str, out_root: str, source: str, entity: str,
                ingested_at: str, ingest_date: str) -> int:
    """Land one extract into ``{out_root}/{source}/{entity}/_ingest_date=.../``
    (S7 layout; the source folder is the namespace, S8; the write replaces the
    day's data, S6; a daily supplier price list is one more day's partition, P48).

    Dynamic partition overwrite makes the job idempotent per run date.  The
    row count comes from an ``Observation`` on the write itself (S9), so the
    data is read once.
    """
    obs = Observation(f"land_{source}_{entity}")
    df = to_bronze(read_text_csv(spark, csv_path), ingested_at, ingest_date)
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(INGEST_DATE).parquet(os.path.join(out_root, source, entity)))
    return int(obs.get["rows"])


def land_all(spark: SparkSession, raw_dir: str, out_root: str, ingested_at: str, ingest_date: str,
             sources: dict | None = None, concurrent_jobs: int = 4) -> LandReport:
    """Land every registered extract; missing files are skipped and reported.

    Entities are independent Spark jobs; up to ``concurrent_jobs`` are
    submitted at once so many small extracts do not leave the cluster idle
    (each job is itself split across executors by file split).
    """
    from concurrent.futures import ThreadPoolExecutor

    rep = LandReport()
    todo = []
    for source, entities in (sources or SOURCES).items():
        for entity, fname in entities.items():
            path = os.path.join(raw_dir, fname)
            key = f"{source}.{entity}"
            if _exists(spark, path):
                todo.append((key, source, entity, path))
            else:
                rep.skipped.append(key)
    before = spark.conf.get(OPEN_FILES, "0")
    spark.conf.set(OPEN_FILES, "2")
    try:
        with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
            futures = {key: pool.submit(land_entity, spark, path, out_root, source, entity, ingested_at, ingest_date)
                       for key, source, entity, path in todo}
            for key, fut in futures.items():
                rep.loaded[key] = fut.result()
    finally:
        spark.conf.set(OPEN_FILES, before)
    return rep


def read_bronze(spark: SparkSession, out_root: str, source: str, entity: str,
                ingest_date: str | None = None) -> DataFrame:
    """Scan a bronze table; a date filter prunes partitions."""
    df = spark.read.parquet(os.path.join(out_root, source, entity))
    if ingest_date is not None:
        df = df.where(F.col(INGEST_DATE) == ingest_date)
    return df
