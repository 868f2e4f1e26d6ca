"""Queries that land extracts as delivered: quoted CSV (S1), all entities (T1) and
the daily supplier price list with its changes (P48)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators import snapshots
from forecourt.plans import duck_sql as S
from forecourt.plans.registry import register
from forecourt.plans.workshop import Workshop
from forecourt.session import scratch_path
from forecourt.sources import bronze
from forecourt.sources import star_extracts as X
from forecourt.sources.tables import Tables

RUN_TS = "2024-06-01 06:00:00"
DAYS = ["2024-06-01", "2024-06-02", "2024-06-03"]


def deliver(df: DataFrame, path: str) -> None:
    """A folder of CSV files as sources write them: quotes doubled, newlines kept."""
    df.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def deliver_lines(lines: Column, df: DataFrame, header: str, path: str) -> None:
    """A folder of CSV files of ready-made records."""
    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        yield from batches

    df.select(lines.alias("value")).mapInArrow(with_header, "value string").write.text(path)


# ----------------------------------------------------------------------- S1
@register("bronze_as_received", """
WITH n AS (SELECT c_custkey AS k, c_name, CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS balance,
  CASE c_custkey % 6 WHEN 0 THEN 'plain' WHEN 1 THEN 'said "hi", twice' WHEN 2 THEN 'two' || chr(10) || 'lines' WHEN 3 THEN ''
       WHEN 4 THEN NULL ELSE ' padded,' || chr(13) || chr(10) || '"' || c_mktsegment || '"' || chr(10) || chr(10) || ' ' END AS note
  FROM customer),
r AS (SELECT *, 'C' || k || ',' || c_name || ',' || coalesce('"' || replace(note, '"', '""') || '"', '') AS head FROM n)
SELECT 'C' || k AS customer_id, c_name AS customer_name, note, CASE WHEN k % 41 <> 0 THEN balance END AS balance,
       CASE WHEN k % 41 = 0 THEN head WHEN k % 43 = 0 THEN head || ',' || balance || ',surplus' END AS rescued,
       '2024-06-01' AS _ingest_date
FROM r""")
def bronze_as_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with commas, doubled quotes, newlines and CRLF inside fields, empty and
    missing fields, and records with too few or too many fields, landed and read back."""
    drop = scratch_path(spark, f"landing/{bronze.run_id()}")
    k = F.col("c_custkey")
    note = X.form(k, "plain", 'said "hi", twice', "two\nlines", "", F.lit(None).cast("string"),
                  F.concat(F.lit(' padded,\r\n"'), F.col("c_mktsegment"), F.lit('"\n\n ')))
    quoted = F.coalesce(F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
    head = F.concat(F.lit("C"), k.cast("string"), F.lit(","), F.col("c_name"), F.lit(","), quoted)
    balance = F.concat(F.lit(","), F.col("c_acctbal").cast("decimal(14,2)").cast("string"))
    record = (F.when(k % 41 == 0, head).when(k % 43 == 0, F.concat(head, balance, F.lit(",surplus")))
              .otherwise(F.concat(head, balance)))
    deliver_lines(record, Tables(spark, sf_dir).customer, "customer_id,customer_name,note,balance", f"{drop}/raw/crm_customers.csv")
    bronze.land_all(spark, f"{drop}/raw", f"{drop}/bronze", RUN_TS, DAYS[0], {"crm": {"customers": "crm_customers.csv"}})
    landed = bronze.read_bronze(spark, f"{drop}/bronze", "crm", "customers", DAYS[0])
    return landed.select("customer_id", "customer_name", "note", "balance", F.col("_rescued").alias("rescued"),
                         F.col("_ingest_date").cast("string").alias("_ingest_date"))


# ----------------------------------------------------------------------- T1
def extracts(w: Workshop) -> dict[str, DataFrame]:
    """All registered extracts as text, by file name."""
    t = w.t
    return {
        "dms_work_orders.csv": w.work_orders_raw, "dms_work_order_lines.csv": w.lines_raw, "dms_technicians.csv": w.technicians_raw,
        "erp_parts.csv": w.parts_raw, "erp_stock_movements.csv": X.stock_movements_raw(t.lineitem, t.part),
        "erp_suppliers.csv": X.supplier_contacts(t.supplier), "crm_customers.csv": X.customers_raw(t.customer),
        "crm_vehicles.csv": X.vehicles_raw(t.customer), "pos_invoices.csv": X.invoices_raw(t.orders),
        "pos_payments.csv": X.payments_raw(t.orders), "telematics_events.csv": X.telematics_raw(t.events),
        "supplier_price_list.csv": X.price_list_raw(t.part, 0),
    }


@register("bronze_entities", """
WITH f AS (SELECT * FROM orders WHERE o_orderstatus = 'F'),
n AS (
  SELECT 'dms.work_orders' AS entity, sum(1 + CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 251 = 9 THEN 1 ELSE 0 END) AS n, 15 AS w FROM orders
  UNION ALL SELECT 'dms.work_order_lines', count(*), 10 FROM lineitem
  UNION ALL SELECT 'dms.technicians', count(*), 7 FROM supplier
  UNION ALL SELECT 'erp.parts', count(*), 10 FROM part
  UNION ALL SELECT 'erp.stock_movements', (SELECT count(*) FROM part) + count(*), 6 FROM lineitem
            WHERE l_returnflag = 'N' OR (l_returnflag = 'R' AND l_linenumber % 5 = 0)
  UNION ALL SELECT 'erp.suppliers', count(*) + count(*) FILTER (s_suppkey % 12 IN (5, 7)) + count(*) FILTER (s_suppkey % 40 = 9), 5 FROM supplier
  UNION ALL SELECT 'crm.customers', count(*), 7 FROM customer
  UNION ALL SELECT 'crm.vehicles', count(*), 8 FROM customer
  UNION ALL SELECT 'pos.invoices', count(*), 5 FROM f
  UNION ALL SELECT 'pos.payments', 2 * count(*) FILTER (o_orderkey % 3 = 0) + count(*) FILTER (o_orderkey % 3 = 1), 4 FROM f
  UNION ALL SELECT 'telematics.events', count(*), 7 FROM events
  UNION ALL SELECT 'supplier_feeds.price_list', count(*), 6 FROM part WHERE p_partkey % 17 <> 4)
SELECT entity, CAST(n AS BIGINT) AS rows_landed, CAST(n AS BIGINT) AS rows_read, CAST(0 AS BIGINT) AS rows_rescued, CAST(w AS BIGINT) AS n_columns FROM n""")
def bronze_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered entity delivered as CSV with all its columns, landed in one
    call, and counted when read back (audit columns not counted)."""
    drop = scratch_path(spark, f"landing/{bronze.run_id()}")
    for name, df in extracts(Workshop(spark, sf_dir)).items():
        deliver(df, f"{drop}/raw/{name}")
    report = bronze.land_all(spark, f"{drop}/raw", f"{drop}/bronze", RUN_TS, DAYS[0])
    found = None
    for key, rows in report.loaded.items():
        landed = bronze.read_bronze(spark, f"{drop}/bronze", *key.split("."), DAYS[0])
        audit = {"_ingested_at", "_ingest_date", "_rescued"}
        one = landed.agg(F.count(F.lit(1)).alias("rows_read"), F.count("_rescued").alias("rows_rescued")).select(
            F.lit(key).alias("entity"), F.lit(rows).cast("bigint").alias("rows_landed"), "rows_read", "rows_rescued",
            F.lit(sum(c not in audit for c in landed.columns)).cast("bigint").alias("n_columns"))
        found = one if found is None else found.unionByName(one)
    return found


# ---------------------------------------------------------------------- P48
PRICE_COLUMNS = ["supplier_id", "description", "list_price", "lead_time", "availability"]


def land_price_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price list of each day, delivered and landed as that day's partition."""
    drop = scratch_path(spark, f"landing/{bronze.run_id()}")
    part = Tables(spark, sf_dir).part
    for k, day in enumerate(DAYS):
        deliver(X.price_list_raw(part, k), f"{drop}/{day}/supplier_price_list.csv")
        bronze.land_all(spark, f"{drop}/{day}", f"{drop}/bronze", RUN_TS, day, {"supplier_feeds": bronze.SOURCES["supplier_feeds"]})
    return bronze.read_bronze(spark, f"{drop}/bronze", "supplier_feeds", "price_list")


_PRICES = """
WITH d(d) AS (VALUES (0), (1), (2)),
s AS (SELECT p_partkey AS p, d, 'P' || CASE WHEN length(p_partkey::VARCHAR) < 5 THEN lpad(p_partkey::VARCHAR, 5, '0') ELSE p_partkey::VARCHAR END AS part_number,
  'SUP-' || lpad((p_partkey % 25)::VARCHAR, 4, '0') AS supplier_id,
  CASE p_partkey % 3 WHEN 0 THEN '"' || p_brand || '", genuine' WHEN 1 THEN 'boxed' || chr(10) || 'set of ' || (p_partkey % 4 + 2) END AS description,
  CAST(CAST(p_retailprice AS DECIMAL(14,2)) + CASE WHEN (p_partkey + d) % 10 < 3 THEN d * 25 ELSE 0 END AS DECIMAL(14,2))::VARCHAR AS list_price,
  (p_partkey % 9 + CASE WHEN (p_partkey + d) % 13 = 0 THEN d ELSE 0 END) || ' days' AS lead_time,
  CASE (p_partkey + (p_partkey // 7) * d) % 2 WHEN 0 THEN 'in stock' ELSE 'on order' END AS availability
  FROM part, d WHERE (p_partkey + 3 * d) % 17 <> 4)"""


@register("price_list_changes", _PRICES + """,
c AS (SELECT b.d AS d0, a.d AS d1, coalesce(b.part_number, a.part_number) AS part_number,
  CASE WHEN b.p IS NULL THEN 'added' WHEN a.p IS NULL THEN 'withdrawn' ELSE 'changed' END AS change,
  CASE WHEN a.p IS NULL OR b.p IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.list_price <> b.list_price THEN 'list_price' END,
    CASE WHEN a.lead_time <> b.lead_time THEN 'lead_time' END, CASE WHEN a.availability <> b.availability THEN 'availability' END) END AS changed_columns,
  b.list_price AS old_price, a.list_price AS new_price
  FROM (SELECT * FROM s WHERE d < 2) b FULL JOIN (SELECT * FROM s WHERE d > 0) a ON a.p = b.p AND a.d = b.d + 1)
SELECT CASE coalesce(d1, d0 + 1) WHEN 1 THEN '2024-06-02' ELSE '2024-06-03' END AS changed_on, part_number, change, changed_columns, old_price, new_price
FROM c WHERE change <> 'changed' OR changed_columns <> ''""")
def price_list_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price lists of three days, landed one after the other; what each day added,
    changed (and in which columns) and withdrew."""
    lists, found = land_price_lists(spark, sf_dir), None
    for before, after in zip(DAYS, DAYS[1:]):
        c = snapshots.compare(lists.where(F.col("_ingest_date") == before), lists.where(F.col("_ingest_date") == after),
                              "part_number", PRICE_COLUMNS)
        c = c.select(F.lit(after).alias("changed_on"), "part_number", "change", F.array_join("changed_columns", ",").alias("changed_columns"),
                     F.col("before.list_price").alias("old_price"), F.col("after.list_price").alias("new_price"))
        found = c if found is None else found.unionByName(c)
    return found


@register("price_list_effective", _PRICES + """,
v AS (SELECT *, lag(d) OVER k AS before, (supplier_id, description, list_price, lead_time, availability) AS row,
  lag((supplier_id, description, list_price, lead_time, availability)) OVER k AS last FROM s WINDOW k AS (PARTITION BY p ORDER BY d)),
g AS (SELECT *, sum(CASE WHEN before = d - 1 AND last IS NOT DISTINCT FROM row THEN 0 ELSE 1 END) OVER (PARTITION BY p ORDER BY d) AS version FROM v)
SELECT part_number, supplier_id, description, list_price, lead_time, availability,
  CAST(DATE '2024-06-01' + CAST(min(d) AS INTEGER) AS VARCHAR) AS valid_from,
  CASE WHEN max(d) < 2 THEN CAST(DATE '2024-06-02' + CAST(max(d) AS INTEGER) AS VARCHAR) END AS valid_to, max(d) = 2 AS is_current
FROM g GROUP BY p, version, part_number, supplier_id, description, list_price, lead_time, availability""")
def price_list_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The effective-dated price table of the landed lists."""
    lists = land_price_lists(spark, sf_dir).withColumn("_day", F.col("_ingest_date").cast("string"))
    return snapshots.effective(lists, "part_number", "_day", PRICE_COLUMNS)
