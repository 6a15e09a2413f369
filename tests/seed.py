"""Twenty seed records of three sources, and the six change cases that follow them."""

from personweave.schemas import CHANGES, STAGED_COLUMNS

# The published seed rows and change cases.
CRM = [
    ("C001", "bob@gmail.com", "Bob", "Smith", "5551234567", "Acme Corp"),
    ("C002", "alice@company.com", "Alice", "Johnson", None, "TechStart"),
    ("C003", "charlie@hotmail.com", "Charlie", "Brown", "5559876543", "Peanuts Inc"),
    ("C004", "dana@work.com", "Dana", "Lee", "5551112222", "Brightside"),
    ("C005", "eve@outlook.com", "Eve", "Martinez", None, "Cloudworks"),
    ("C006", "frank@gmail.com", "Frank", "Wilson", "5553334444", "DataDriven"),
    ("C007", "grace@company.com", "Grace", "Taylor", "5554445555", "TechStart"),
    ("C008", "henry@mail.com", "Henry", "Anderson", "5556667777", "Summit LLC"),
]
BILLING = [
    ("B001", "bob@work.com", "Smith, Robert", "Acme Corp"),
    ("B002", "alice@company.com", "Johnson, Alice", "TechStart"),
    ("B003", "charlie.brown@hotmail.com", "Brown, Charles", "Peanuts Inc"),
    ("B004", "dana.lee@work.com", "Lee, Dana", "Brightside"),
    ("B005", "frank.wilson@gmail.com", "Wilson, Frank", "DataDriven"),
    ("B006", "grace@company.com", "Taylor, Grace", "TechStart"),
]
SUPPORT = [
    ("S001", "bob@gmail.com", "Bob S", "5551234567", "Acme"),
    ("S002", None, "Alice Johnson", "5558889999", "TechStart"),
    ("S003", "charlie@hotmail.com", "Charlie Brown", "5559876543", None),
    ("S004", "dana@work.com", "Dana Lee", None, "Brightside"),
    ("S005", "eve.m@outlook.com", "Eve Martinez", "5557778888", "Cloudworks"),
    ("S006", "henry@mail.com", "Henry Anderson", "5556667777", "Summit"),
]
CASES = [
    ("NEW_CRM_001", "crm_contacts", "bob.smith@gmail.com", "5551234567", "Bob", "Smith", None),
    ("NEW_BILL_001", "billing_accounts", "charlie@hotmail.com", None, "Charlie", "Brown", "Peanuts Inc"),
    ("NEW_CRM_002", "crm_contacts", "newperson@example.com", "5550000001", "Zara", "Nguyen", "FreshCo"),
    ("NEW_SUP_001", "support_users", "unknown@nowhere.com", None, "Xavier", "Bloom", None),
    ("NEW_CRM_002", "crm_contacts", "newperson@example.com", "5550000001", "Zara", "Nguyen", "FreshCo"),
    ("NEW_BILL_002", "billing_accounts", "zara.nguyen@work.com", None, "Zara", "Nguyen", "FreshCo"),
]


def raw_seed(spark):
    return {
        "crm_contacts": spark.createDataFrame(CRM, "crm_contact_id string, email string, first_name string, last_name string, phone string, company_name string"),
        "billing_accounts": spark.createDataFrame(BILLING, "billing_account_id string, email string, account_name string, company_name string"),
        "support_users": spark.createDataFrame(SUPPORT, "support_user_id string, email string, display_name string, phone string, company string"),
    }


def change_rows(spark, rows, first=1, action="INSERT"):
    return spark.createDataFrame([(*r, action, False, first + i) for i, r in enumerate(rows)], CHANGES)


def staged(spark, rows):
    """Staged records from (external_id, source, email, phone, first, last, company) tuples."""
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in STAGED_COLUMNS))
