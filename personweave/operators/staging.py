"""Staging projections: one canonical record layout per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personweave.functions.text import after_first_blank, clean_email, digits_only, title_case
from personweave.sources.files import map_attributes, unify


def _staged(df: DataFrame, source: str, key: str, keep: Column, **attributes: Column) -> DataFrame:
    prepared = df.where(keep).select(F.col(key), *[c.alias(f"s_{name}") for name, c in attributes.items()])
    return map_attributes(prepared, source, key, {name: f"s_{name}" for name in attributes})


def stage_crm(df: DataFrame) -> DataFrame:
    return _staged(
        df, "crm_contacts", "crm_contact_id", df.email.isNotNull() | df.phone.isNotNull(),
        email=clean_email(df.email), phone=digits_only(df.phone), first_name=title_case(df.first_name),
        last_name=title_case(df.last_name), company_name=F.trim(df.company_name))


def stage_billing(df: DataFrame) -> DataFrame:
    """`Last, First` when the account name has a comma, else `First Rest`."""
    name, comma = df.account_name, df.account_name.contains(",")

    def part(delimiter: str, index: int) -> Column:
        return F.split_part(name, F.lit(delimiter), F.lit(index))

    return _staged(
        df, "billing_accounts", "billing_account_id", df.email.isNotNull(),
        email=clean_email(df.email),
        first_name=title_case(F.when(comma, part(",", 2)).otherwise(part(" ", 1))),
        last_name=title_case(F.when(comma, part(",", 1)).otherwise(after_first_blank(name))),
        company_name=F.trim(df.company_name))


def stage_support(df: DataFrame) -> DataFrame:
    return _staged(
        df, "support_users", "support_user_id", df.email.isNotNull() | df.phone.isNotNull(),
        email=clean_email(df.email), phone=digits_only(df.phone),
        first_name=title_case(F.split_part(df.display_name, F.lit(" "), F.lit(1))),
        last_name=title_case(after_first_blank(df.display_name)), company_name=title_case(df.company))


def stage_app(df: DataFrame) -> DataFrame:
    return _staged(
        df, "app_signups", "app_user_id", df.email.isNotNull(),
        email=clean_email(df.email), first_name=title_case(df.first_name), last_name=title_case(df.last_name))


def stage_partner(df: DataFrame) -> DataFrame:
    return _staged(
        df, "partner_leads", "partner_lead_id", df.email.isNotNull() | df.first_name.isNotNull(),
        email=clean_email(df.email), first_name=title_case(df.first_name), last_name=title_case(df.last_name),
        company_name=F.trim(df.company))


STAGERS = {
    "crm_contacts": stage_crm, "billing_accounts": stage_billing, "support_users": stage_support,
    "app_signups": stage_app, "partner_leads": stage_partner,
}


def stage_all(raw: dict[str, DataFrame]) -> DataFrame:
    """Stage every given raw source and union the results."""
    return unify([STAGERS[source](df) for source, df in raw.items()])
