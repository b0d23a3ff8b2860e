"""Columns of the five entities in the raw and curated layers, and of the audit log."""

from __future__ import annotations

from pyspark.sql.types import StructType

ENTITIES = ("customer", "branch", "account", "products", "transaction")

# The header of each landed file.
RAW_COLUMNS = {
    "customer": (
        "customer_id customer_name email phone account_id gender dob address kyc_status "
        "registration_date transaction_id"
    ).split(),
    "branch": (
        "branch_id branch_name location manager_name opened_date region branch_type contact_number"
    ).split(),
    "account": "account_id account_name email phone_number address created_date".split(),
    "products": (
        "product_id product_name product_type price launch_date is_active category vendor_name"
    ).split(),
    "transaction": (
        "transaction_id account_id product_id branch_id date timestamp amount payment_method "
        "status currency remarks is_refund"
    ).split(),
}

# The columns and types of each curated table.
CURATED_DDL = {
    "customer": (
        "customer_id string, name string, email string, phone string, account_id string, "
        "gender string, dob date, address string, kyc_status string, registration_date date, "
        "transaction_id string, load_time timestamp, created_at timestamp, updated_at timestamp"
    ),
    "branch": (
        "branch_id string, branch_name string, location string, manager_name string, "
        "opened_date date, region string, branch_type string, contact_number string, "
        "created_at timestamp, updated_at timestamp"
    ),
    "account": (
        "account_id string, account_name string, phone_number string, address string, "
        "created_date date, created_at timestamp, updated_at timestamp"
    ),
    "products": (
        "product_id string, product_name string, product_type string, price double, "
        "launch_date date, is_active string, category string, vendor_name string, "
        "created_at timestamp, updated_at timestamp"
    ),
    "transaction": (
        "transaction_id string, account_id string, product_id string, branch_id string, "
        "date date, timestamp timestamp, amount double, payment_method string, status string, "
        "currency string, remarks string, is_refund boolean, "
        "created_at timestamp, updated_at timestamp"
    ),
}

AUDIT_DDL = "run_id string, logged_at timestamp, step string, entity string, metric string, rows long"


def raw_schema(entity: str, stamped: bool = True) -> StructType:
    """All columns as text: inference would turn ``+919517728478`` and ``00123`` into numbers."""
    fields = ", ".join(f"`{name}` string" for name in RAW_COLUMNS[entity])
    return StructType.fromDDL(fields + (", ingestion_timestamp timestamp" if stamped else ""))


def curated_schema(entity: str) -> StructType:
    return StructType.fromDDL(CURATED_DDL[entity])
