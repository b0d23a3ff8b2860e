"""Rows in the shape of the landed files, made by rule."""

import csv
import os

from coinwharf.schemas import RAW_COLUMNS


def account(key, name="Abc", phone="+919876543210", address="1 Ab Street", created="2024-01-01", email="a@b.co"):
    return {"account_id": key, "account_name": name, "email": email, "phone_number": phone,
            "address": address, "created_date": created}


def branch(key, opened="2010-05-05", contact="9876543210", **other):
    return {"branch_id": key, "branch_name": f"Branch_{key}", "location": "Town", "manager_name": "M_1",
            "opened_date": opened, "region": "East", "branch_type": "Rural", "contact_number": contact, **other}


def customer(key, account_id, name="Cust", email="C@x.com", phone="9876543210", registered="2024-02-02", **other):
    return {"customer_id": key, "customer_name": name, "email": email, "phone": phone, "account_id": account_id,
            "gender": "Male", "dob": "1980-01-31", "address": "706 Long Road, Town", "kyc_status": "Verified",
            "registration_date": registered, "transaction_id": "T1", **other}


def product(key, launch="2020-01-01", active="True", price="100", **other):
    return {"product_id": key, "product_name": f"Product_{key}", "product_type": "Savings Account", "price": price,
            "launch_date": launch, "is_active": active, "category": "Retail", "vendor_name": "Vendor_1", **other}


def transaction(key, account_id, product_id="P1", branch_id="B1", day="2025-06-15", amount="1000",
                status="Success", **other):
    return {"transaction_id": key, "account_id": account_id, "product_id": product_id, "branch_id": branch_id,
            "date": day, "timestamp": "2025-06-16 00:00:00", "amount": amount, "payment_method": "Net Banking",
            "status": status, "currency": "INR", "remarks": None, "is_refund": "False", **other}


def write_csv(folder, name, rows, columns=None, entity=None):
    os.makedirs(folder, exist_ok=True)
    columns = columns or (RAW_COLUMNS[entity] if entity else list(rows[0]))
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, columns)
        writer.writeheader()
        writer.writerows(rows)
    return path


def raw_rows(spark, entity, rows):
    from coinwharf.schemas import raw_schema

    data = [tuple(r.get(c) for c in RAW_COLUMNS[entity]) for r in rows]
    return spark.createDataFrame(data, raw_schema(entity, stamped=False))
