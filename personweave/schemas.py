"""Table schemas: raw sources, staged records, outputs."""

from __future__ import annotations

from pyspark.sql import types as T

STAGED_COLUMNS = ("external_id", "source_system", "email", "phone", "first_name", "last_name", "company_name")
ATTRIBUTES = ("email", "phone", "first_name", "last_name", "company_name")
PII_FIELDS = ("email", "phone", "first_name", "last_name")


def _strings(*names: str, required: tuple[str, ...] = (), extra: tuple[T.StructField, ...] = ()) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), n not in required, {"pii": n in PII_FIELDS}) for n in names]
    return T.StructType(fields + list(extra))


_CREATED = T.StructField("created_at", T.DateType())

CRM_CONTACTS = _strings("crm_contact_id", "email", "first_name", "last_name", "phone", "company_name", extra=(_CREATED,))
BILLING_ACCOUNTS = _strings("billing_account_id", "email", "account_name", "company_name", extra=(_CREATED,))
SUPPORT_USERS = _strings("support_user_id", "email", "display_name", "phone", "company", extra=(_CREATED,))
APP_SIGNUPS = _strings("app_user_id", "email", "first_name", "last_name", extra=(_CREATED,))
PARTNER_LEADS = _strings("partner_lead_id", "email", "first_name", "last_name", "company", extra=(_CREATED,))
CRM_COMPANIES = T.StructType([
    T.StructField("crm_company_id", T.StringType()), T.StructField("company_name", T.StringType()),
    T.StructField("domain", T.StringType()), T.StructField("industry", T.StringType()),
    T.StructField("employee_count", T.IntegerType()), T.StructField("created_at", T.TimestampType()),
])
BILLING_INVOICES = T.StructType([
    T.StructField("billing_account_id", T.StringType()), T.StructField("amount_cents", T.LongType()),
])

STAGED = _strings(*STAGED_COLUMNS)
CHANGES = T.StructType(STAGED.fields + [
    T.StructField("_action", T.StringType()), T.StructField("_is_update", T.BooleanType()),
    T.StructField("_seq", T.LongType()),
])

# Declared fields of every source: name -> may be null.
DECLARED = {
    "crm_contacts": {"email": False, "phone": False, "first_name": False, "last_name": False, "company_name": False},
    "billing_accounts": {"email": False, "first_name": False, "last_name": False, "company_name": False},
    "support_users": {"email": True, "phone": True, "first_name": False, "last_name": False, "company_name": False},
    "app_signups": {"email": False, "first_name": True, "last_name": True},
    "partner_leads": {"email": True, "first_name": True, "last_name": True, "company_name": False},
}
