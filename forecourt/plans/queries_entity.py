"""Queries for entity resolution: exact phone / e-mail pass, fuzzy name pass,
review queue and golden ids (P10-P13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vocab
from forecourt.operators import entity as ER
from forecourt.operators.components import merge_links, stored_forest
from forecourt.plans import duck_sql as S
from forecourt.plans.registry import register
from forecourt.plans.silver import title_case
from forecourt.session import scratch_path, write_scratch
from forecourt.sources import star_extracts as X
from forecourt.sources.bronze import run_id
from forecourt.sources.tables import Tables

MATCH_DISTANCE = 2          # pass 2: auto-merge at <= 2 edits
REVIEW_DISTANCE = 4         # pass 3: 3..4 edits go to the review queue (dagger)


def normalised_contacts(spark: SparkSession, sf_dir: str, suppliers: bool = False) -> DataFrame:
    t = Tables(spark, sf_dir)
    if suppliers:
        return normalise(X.supplier_contacts(t.supplier), "supplier_id", "supplier_name")
    return normalise(X.customer_contacts(t.customer), "customer_id", "customer_name")


def normalise(raw: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Contact records as the matching passes compare them."""
    city = F.coalesce(C.map_vocab("address_city", vocab.CITY_ALIASES, default=None), title_case("address_city"))
    return raw.select(
        id_col,
        F.upper(C.collapse_ws(name_col)).alias("name_norm"),
        C.phone_e164("phone_primary").alias("phone_e164"),
        C.email("email").alias("email"),
        city.alias("city"))


CONTACTS_SQL = S.contacts("customer", "c_custkey", "c_nationkey", "CUST-", "DUP-")
SUPPLIER_SQL = S.contacts("supplier", "s_suppkey", "s_nationkey", "SUP-", "SUPDUP-")


def clusters_sql(contacts: str, id_name: str, golden_name: str) -> str:
    return f"""
WITH RECURSIVE {contacts},
e AS (SELECT a.id AS src, b.id AS dst FROM n a JOIN n b ON a.ph = b.ph AND a.id < b.id
      UNION SELECT a.id, b.id FROM n a JOIN n b ON a.em = b.em AND a.id < b.id
      UNION SELECT a.id, b.id FROM n a JOIN n b ON a.city = b.city AND a.id < b.id
                                            AND levenshtein(a.nm, b.nm) <= {MATCH_DISTANCE}),
ee AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
cc(id, label) AS (SELECT id, id FROM n UNION SELECT ee.dst, cc.label FROM cc JOIN ee ON cc.id = ee.src)
SELECT id AS {id_name}, min(label) AS {golden_name} FROM cc GROUP BY id"""


@register("entity_clusters", clusters_sql(CONTACTS_SQL, "customer_id", "golden_customer_id"))
def entity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact phone or e-mail, then Levenshtein <= 2 on the name in
    the same city; golden id = smallest id in the connected cluster; every
    original id is kept in the mapping."""
    n = normalised_contacts(spark, sf_dir)
    mapping = ER.resolve(n, "customer_id", ["phone_e164", "email"], "name_norm", "city", tau=MATCH_DISTANCE)
    return mapping.withColumnRenamed("golden_id", "golden_customer_id")


@register("entity_clusters_merged", clusters_sql(CONTACTS_SQL, "customer_id", "golden_customer_id"))
def entity_clusters_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same clusters from a stored forest, to which the links come in three batches."""
    n = normalised_contacts(spark, sf_dir)
    links = ER.links_of(n, "customer_id", ["phone_e164", "email"], "name_norm", "city", tau=MATCH_DISTANCE)
    links = spark.read.parquet(write_scratch(links, "entity-links"))
    store = scratch_path(spark, f"forest/{run_id()}")
    for k in range(3):
        merge_links(links.where(F.pmod(F.xxhash64("src", "dst"), F.lit(3)) == k), store, k)
    golden = stored_forest(spark, store)
    ids = n.select("customer_id").distinct()
    if golden is None:
        return ids.withColumn("golden_customer_id", F.col("customer_id"))
    return ids.join(golden.withColumnRenamed("id", "customer_id"), "customer_id", "left").select(
        "customer_id", F.coalesce("component", "customer_id").alias("golden_customer_id"))


def _groups_sql(name: str, distance: int) -> str:
    """Components of the names within ``distance`` edits in a city."""
    return f"""
{name}_e AS (SELECT a.id AS src, b.id AS dst FROM r a JOIN r b ON a.city = b.city AND a.id <> b.id
             AND levenshtein(a.nm, b.nm) <= {distance}),
{name}(id, label) AS (SELECT id, id FROM r UNION SELECT {name}_e.dst, {name}.label FROM {name} JOIN {name}_e ON {name}.id = {name}_e.src)"""


def review_sql(match: int, review: int) -> str:
    """The CTEs up to ``review``: one row per name in a group with several matches."""
    return f"""r AS (SELECT city, nm, min(id) AS id FROM n WHERE nm IS NOT NULL AND city IS NOT NULL GROUP BY city, nm),
{_groups_sql('m', match)}, {_groups_sql('v', review)},
b AS (SELECT id, match_group, review_group FROM (SELECT id, min(label) AS match_group FROM m GROUP BY id)
      JOIN (SELECT id, min(label) AS review_group FROM v GROUP BY id) USING (id)),
review AS (SELECT id AS customer_id, match_group, review_group, match_groups
FROM b JOIN (SELECT review_group, count(DISTINCT match_group) AS match_groups FROM b GROUP BY 1 HAVING count(DISTINCT match_group) > 1)
     USING (review_group))"""


@register("customer_match_review", f"""
WITH RECURSIVE {CONTACTS_SQL}, {review_sql(MATCH_DISTANCE, REVIEW_DISTANCE)}
SELECT * FROM review""")
def customer_match_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probable duplicates (3-4 edits, same city) for human review, one row
    per name and review group, names of every length."""
    return ER.review_queue(normalised_contacts(spark, sf_dir), "customer_id", "name_norm", "city",
                           MATCH_DISTANCE, REVIEW_DISTANCE)


@register("supplier_clusters", clusters_sql(SUPPLIER_SQL, "supplier_id", "golden_supplier_id"))
def supplier_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier de-duplication with the same three passes."""
    n = normalised_contacts(spark, sf_dir, suppliers=True)
    mapping = ER.resolve(n, "supplier_id", ["phone_e164", "email"], "name_norm", "city", tau=MATCH_DISTANCE)
    return mapping.withColumnRenamed("golden_id", "golden_supplier_id")
