"""Identity sources derived from the given tables by one SQL text that runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# `p` is the true person, `k` the record, `s` the source. Noise: missing emails and phones, plus-tags, typos, and
# names and companies shared by many persons.
RAW_CTES = """
base as (
  select c_custkey k, cast(floor(c_custkey / 3) as bigint) p from customer
),
truth as (
  select k, p,
    split_part('robert,alice,charles,dana,eve,frank,grace,henry,zara,xavier,betty,victoria,christina,raymond,george,amber', ',', cast(1 + p % 16 as int)) f,
    split_part('smith,johnson,brown,lee,martinez,wilson,taylor,anderson,nguyen,bloom,baker,cook,howard,watson,harris,clark,lewis,walker,young', ',', cast(1 + p % 19 as int)) l,
    split_part('Acme Corp|TechStart|Peanuts Inc|Brightside|Cloudworks|DataDriven|Summit LLC', '|', cast(1 + p % 7 as int)) co
  from base
),
noisy as (
  select k, p, cast(k % 5 as int) s,
    case when k % 7 = 3 then null else concat(f, '.', l, cast(p as varchar(20)), case when k % 9 = 4 then '+x' else '' end, '@example.com') end email,
    case when k % 11 = 5 then null else concat('(555) ', substr(cast(10000000 + p as varchar(20)), 2, 3), '-', substr(cast(10000000 + p as varchar(20)), 5, 4)) end phone,
    f, case when k % 13 = 4 then concat(substr(l, 1, 2), substr(l, 4)) else l end l, co
  from truth
),
raw as (
  select k, p, s,
    split_part('crm_contacts,billing_accounts,support_users,app_signups,partner_leads', ',', s + 1) source_system,
    concat(split_part('CRM,BILL,SUP,APP,PART', ',', s + 1), '_', lpad(cast(k as varchar(20)), 9, '0')) external_id,
    case when s = 3 then ' ' || upper(email) else email end email,
    case when s in (0, 2) then phone end phone,
    case when s in (0, 3, 4) then f end first_name,
    case when s = 3 then upper(l) when s in (0, 4) then l end last_name,
    case when s = 1 then concat(l, ', ', f) end account_name,
    case when s = 2 then upper(concat(f, ' ', l)) end display_name,
    case when s = 3 then null when s = 2 then upper(co) else co end company_name
  from noisy
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = f"with {RAW_CTES} select * from raw".replace("from customer", "from {customer}")
    return spark.sql(sql, customer=table(spark, sf_dir, "customer"))


def sources_of(raw: DataFrame) -> dict[str, DataFrame]:
    """The five raw source tables."""
    def rows(s: int) -> DataFrame:
        return raw.where(F.col("s") == s)

    key = F.col("external_id")
    return {
        "crm_contacts": rows(0).select(key.alias("crm_contact_id"), "email", "first_name", "last_name", "phone", "company_name"),
        "billing_accounts": rows(1).select(key.alias("billing_account_id"), "email", "account_name", "company_name"),
        "support_users": rows(2).select(key.alias("support_user_id"), "email", "display_name", "phone", F.col("company_name").alias("company")),
        "app_signups": rows(3).select(key.alias("app_user_id"), "email", "first_name", "last_name"),
        "partner_leads": rows(4).select(key.alias("partner_lead_id"), "email", "first_name", "last_name", F.col("company_name").alias("company")),
    }


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return sources_of(raw_records(spark, sf_dir))


def _record_of(customer: str) -> list[Column]:
    """Source system and record id of a customer number, as in `raw`."""
    kind = (F.col(customer) % 5 + 1).cast("int")
    name = lambda names: F.split_part(F.lit(names), F.lit(","), kind)
    return [name("crm_contacts,billing_accounts,support_users,app_signups,partner_leads").alias("source_system"),
            F.concat(name("CRM,BILL,SUP,APP,PART"), F.lit("_"), F.lpad(F.col(customer).cast("string"), 9, "0")).alias("source_id")]


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as invoices of the customer's record."""
    return table(spark, sf_dir, "orders").select(
        *_record_of("o_custkey"), F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_cents"))


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, each of one user's record."""
    return table(spark, sf_dir, "events").select(*_record_of("user_id"), "event_id", "event_type", "value")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per company of the records: the segment of its first customer, and how many it has."""
    named = raw_records(spark, sf_dir).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment"), "k")
    name = F.lower("company_name")
    return (named.where(F.col("company_name").isNotNull()).groupBy(name.alias("company_name"))
            .agg(F.min("k").alias("first"), F.min_by("c_mktsegment", "k").alias("industry"), F.count(F.lit(1)).cast("int").alias("employee_count"))
            .select(F.concat(F.lit("CO_"), F.col("first").cast("string")).alias("crm_company_id"), "company_name",
                    F.concat(F.regexp_replace("company_name", " ", ""), F.lit(".com")).alias("domain"), "industry", "employee_count"))
