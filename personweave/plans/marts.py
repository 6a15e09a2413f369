"""Marts and analytic queries over golden records and crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personweave.schemas import PII_FIELDS

CUSTOMER_COLUMNS = ("entity_id", "email", "phone", "first_name", "last_name", "company_name", "confidence_score",
                    "entity_type", "source_name", "created_at")


def resolved_customers(golden: DataFrame) -> DataFrame:
    return golden.select(*CUSTOMER_COLUMNS)


def customer_crosswalk(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.select("source_system", "source_id", "entity_id")


def source_coverage(crosswalk: DataFrame) -> DataFrame:
    """Number and list of systems, and number of source records, per entity.

    Counted per (entity, system) first: the list then holds one item per system however many records an entity has.
    """
    per_system = crosswalk.groupBy("entity_id", "source_system").agg(F.count(F.lit(1)).alias("records"))
    return per_system.groupBy("entity_id").agg(
        F.count("source_system").alias("source_count"),
        F.array_join(F.sort_array(F.collect_set("source_system")), ", ").alias("source_systems"),
        F.sum("records").alias("total_source_records"))


def customer_360(golden: DataFrame, crosswalk: DataFrame) -> DataFrame:
    customers = golden.select(*CUSTOMER_COLUMNS[:7])
    return customers.join(source_coverage(crosswalk), "entity_id", "left")


def count_customers(golden: DataFrame) -> DataFrame:
    return golden.agg(F.count(F.lit(1)).alias("n_customers"))


def multi_system_customers(c360: DataFrame, n: int = 3) -> DataFrame:
    """Customers in at least n systems, those in most systems first."""
    return c360.where(F.col("source_count") >= n).orderBy(F.desc("source_count"), "entity_id")


RECORD = ("source_system", "source_id")


def facts_with_entity(facts: DataFrame, crosswalk: DataFrame, source: str | None = None, id_column: str = "source_id",
                      keep_unresolved: bool = True) -> DataFrame:
    """Attach the entity id to facts that name a record: by `source_system` and `source_id`, or, for facts of one
    `source`, by the record id in `id_column`."""
    links = crosswalk.select(*RECORD, "entity_id")
    keys = list(RECORD)
    if source is not None:
        links = links.where(F.col("source_system") == source).select(F.col("source_id").alias(id_column), "entity_id")
        keys = [id_column]
    return facts.join(links, keys, "left" if keep_unresolved else "inner")


def _per_entity(facts: DataFrame, crosswalk: DataFrame, source: str | None, id_column: str, amount: str | None) -> DataFrame:
    """Number and sum of facts per entity. Facts are summed per record before any join, so a record with very many of
    them shuffles as one row per task."""
    keys = list(RECORD) if source is None else [id_column]
    sums = [F.sum(amount).alias("total")] if amount else []
    per_record = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)
    linked = facts_with_entity(per_record, crosswalk, source, id_column, keep_unresolved=False)
    return linked.groupBy("entity_id").agg(F.sum("n").alias("n"), *([F.sum("total").alias("total")] if amount else []))


def top_invoiced(invoices: DataFrame, crosswalk: DataFrame, golden: DataFrame, n: int = 20, source: str | None = None,
                 id_column: str = "source_id") -> DataFrame:
    """Customers with the largest invoice totals."""
    totals = _per_entity(invoices, crosswalk, source, id_column, "amount_cents")
    return (totals.join(golden.select("entity_id", "first_name", "last_name"), "entity_id")
            .select("entity_id", "first_name", "last_name", (F.col("total") / 100.0).alias("total_invoiced"))
            .orderBy(F.desc("total_invoiced"), "entity_id").limit(n))


def fact_totals(facts: DataFrame, crosswalk: DataFrame, name: str, amount: str | None = None, source: str | None = None,
                id_column: str = "source_id") -> DataFrame:
    """`n_<name>` and, with an amount column, `total_<name>` per entity."""
    return _per_entity(facts, crosswalk, source, id_column, amount).withColumnsRenamed({"n": f"n_{name}", "total": f"total_{name}"})


def customer_360_enriched(c360: DataFrame, facts: list[DataFrame]) -> DataFrame:
    """360 rows with the per-entity fact tables joined on; customers without facts keep nulls."""
    for table in facts:
        c360 = c360.join(table, "entity_id", "left")
    return c360


def with_company(c360: DataFrame, companies: DataFrame) -> DataFrame:
    """Attach company attributes by company name; the first company id wins among equal names."""
    key = F.lower(F.trim("company_name"))
    attributes = F.struct("domain", "industry", "employee_count")
    lookup = (companies.groupBy(key.alias("_company")).agg(F.min_by(attributes, "crm_company_id").alias("_c"))
              .select("_company", "_c.*"))
    return c360.withColumn("_company", key).join(lookup, "_company", "left").drop("_company")


def mask_pii(df: DataFrame, fields: tuple[str, ...] | None = None, salt: str = "") -> DataFrame:
    """Replace personal fields by their hash: those marked `pii` in the schema, or the given ones.

    Without a secret `salt` the hash of a value from a small set, such as a phone number, can be found by trying all.
    """
    marked = tuple(f.name for f in df.schema.fields if f.metadata.get("pii"))
    chosen = fields if fields is not None else (marked or PII_FIELDS)
    return df.withColumns({c: F.sha2(F.concat(F.lit(salt), F.col(c)), 256) for c in chosen if c in df.columns})
