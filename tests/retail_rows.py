"""Hand-made source rows of the retail tables."""

from datetime import datetime

from tidemark.operators.calendar import date_dimension, days_between

LIFE = "date_added timestamp, date_removed timestamp, date_modified timestamp, date_deleted timestamp"
SCHEMAS = {
    "authors": f"author_id int, author_uuid string, author_name string, {LIFE}",
    "categories": f"category_id int, category_name string, {LIFE}",
    "publishers": f"publisher_id int, publisher_uuid string, publisher_name string, {LIFE}",
    "channels": f"channel_id int, channel_uuid string, channel_name string, channel_type string, "
                f"description string, {LIFE}",
    "payment_types": f"payment_type_id int, payment_type_uuid string, type_name string, description string, {LIFE}",
    "promotion_groups": "promotion_group_id int, group_name string, group_type string, description string, "
                        f"category_id int, {LIFE}",
    "suppliers": "supplier_id int, supplier_uuid string, supplier_name string, description string, "
                 "country string, city string, province string, address string, postal_code string, "
                 f"contact_name string, contact_number string, contact_email string, {LIFE}",
    "products": "product_id int, product_uuid string, name string, description string, year_published int, "
                "cost_price decimal(10,4), msrp decimal(10,4), unit_price decimal(10,4), status string, " + LIFE,
    "promotions": "promotion_id int, promotion_uuid string, promotion_name string, promotion_code string, "
                  "description string, discount_level string, discount_pool string, stackable boolean, "
                  "priority int, discount_type string, discount_value decimal(10,4), min_quantity int, "
                  "min_subtotal decimal(10,4), promotion_group_id int, status string, start_date timestamp, "
                  f"end_date timestamp, {LIFE}",
    "customers": "customer_id long, customer_uuid string, first_name string, last_name string, email string, "
                 "gender string, province string, date_of_birth date, status string, signup_platform string, "
                 "registration_date timestamp, date_modified timestamp, date_deleted timestamp",
    "transaction_headers": "transaction_id long, transaction_uuid string, channel_id int, employee_id long, "
                           "customer_id long, gross_subtotal_amount decimal(10,4), "
                           "total_tax_amount decimal(10,4), total_amount decimal(10,4), "
                           "transaction_type string, original_transaction_id long, "
                           "transaction_date timestamp, date_modified timestamp",
    "transaction_lines": "transaction_line_id long, transaction_id long, line_number int, product_id int, "
                         "quantity int, unit_price decimal(10,4), gross_line_total decimal(10,4), "
                         "transaction_date timestamp, date_modified timestamp",
    "transaction_discounts": "transaction_discount_id long, promotion_id int, transaction_line_id long, "
                             "transaction_id long, discounted_units int, discount_amount decimal(10,4), "
                             "discount_sequence int, date_applied timestamp, date_modified timestamp",
    "transaction_payments": "transaction_payment_id long, transaction_id long, payment_type_id int, "
                            "amount_paid decimal(10,4), payment_provider_reference string, "
                            "payment_date timestamp, date_modified timestamp",
    **{
        f"{plural}_products": f"{singular}_id int, product_id int, {LIFE}"
        for plural, singular in (("authors", "author"), ("categories", "category"), ("publishers", "publisher"),
                                 ("suppliers", "supplier"), ("promotion_groups", "promotion_group"))
    },
}


def at(day: str, hour: int = 10) -> datetime:
    return datetime.fromisoformat(f"2025-01-{day}T{hour:02}:00:00")


def frame(spark, table, rows):
    """Rows given as dicts; columns left out are null."""
    from decimal import Decimal

    schema = SCHEMAS[table]
    empty = spark.createDataFrame([], schema)
    decimals = {f.name for f in empty.schema if f.dataType.typeName() == "decimal"}
    values = [
        tuple(
            Decimal(str(r[c])) if c in decimals and r.get(c) is not None else r.get(c) for c in empty.columns
        )
        for r in rows
    ]
    return spark.createDataFrame(values, schema)


def entity(day="01", **columns):
    return {"date_added": at("01"), "date_modified": at(day), **columns}


def header(i, kind="Purchase", tax=12, day="02", customer=1, original=None, channel=1):
    return {"transaction_id": i, "transaction_uuid": f"u{i}", "channel_id": channel, "customer_id": customer,
            "gross_subtotal_amount": 100, "total_tax_amount": tax, "total_amount": 112,
            "transaction_type": kind, "original_transaction_id": original,
            "transaction_date": at(day, 14), "date_modified": at(day, 14)}


def line(i, order, gross, day="02", product=1, modified=None, hour=14):
    return {"transaction_line_id": i, "transaction_id": order, "line_number": i % 10, "product_id": product,
            "quantity": 1, "unit_price": gross, "gross_line_total": gross,
            "transaction_date": at(day, hour), "date_modified": at(modified or day, hour)}


def discount(i, amount, line_id=None, order=None, day="02", promotion=1):
    return {"transaction_discount_id": i, "promotion_id": promotion, "transaction_line_id": line_id,
            "transaction_id": order, "discounted_units": 1 if line_id else None, "discount_amount": amount,
            "discount_sequence": 1, "date_applied": at(day, 14), "date_modified": at(day, 14)}


def payment(i, order, amount, day="02"):
    return {"transaction_payment_id": i, "transaction_id": order, "payment_type_id": 1, "amount_paid": amount,
            "payment_date": at(day, 14), "date_modified": at(day, 14)}


def customer(i, day="01", **columns):
    return {"customer_id": i, "customer_uuid": f"c{i}", "first_name": "A", "last_name": "B",
            "email": f"c{i}@example.org", "gender": "F", "province": "BC", "status": "Active",
            "signup_platform": "IOS", "registration_date": at("01", 9), "date_modified": at(day, 9), **columns}


def first_day():
    """Everything known by the end of 2 January."""
    return {
        "authors": [entity(author_id=1, author_uuid="a", author_name="Ada")],
        "categories": [entity(category_id=1, category_name="Strategy")],
        "publishers": [entity(publisher_id=1, publisher_uuid="p", publisher_name="Pub")],
        "suppliers": [entity(supplier_id=1, supplier_uuid="s", supplier_name="Sup")],
        "channels": [entity(channel_id=1, channel_uuid="w", channel_name="Web", channel_type="Online")],
        "payment_types": [entity(payment_type_id=1, payment_type_uuid="x", type_name="Card")],
        "promotion_groups": [entity(promotion_group_id=1, group_name="G", group_type="Category", category_id=1)],
        "promotions": [entity(promotion_id=1, promotion_uuid="y", promotion_name="P", discount_level="ORDER",
                              discount_pool="FLAT", priority=1, discount_type="FLAT", discount_value=5,
                              start_date=at("01"))],
        "products": [entity(product_id=i, product_uuid=f"g{i}", name=f"Game {i}", unit_price=10) for i in (1, 2)],
        "customers": [customer(1), customer(2)],
        "authors_products": [entity(author_id=1, product_id=1)],
        "categories_products": [entity(category_id=1, product_id=1), entity(category_id=1, product_id=2)],
        "publishers_products": [entity(publisher_id=1, product_id=1)],
        "suppliers_products": [entity(supplier_id=1, product_id=1)],
        "promotion_groups_products": [entity(promotion_group_id=1, product_id=2)],
        "transaction_headers": [header(1), header(2, tax=6, customer=2), header(3, "Return", 3, original=1)],
        # Line 11 arrives twice; order 2 nets to zero.
        "transaction_lines": [line(11, 1, 50, hour=12), line(11, 1, 60), line(12, 1, 40, product=2),
                              line(21, 2, 20), line(31, 3, 30)],
        "transaction_discounts": [discount(1, 10, line_id=11), discount(2, 9, order=1),
                                  discount(3, 20, line_id=21)],
        "transaction_payments": [payment(1, 1, 50), payment(2, 1, 43)],
    }


def second_day():
    """Changes of 4 January, some late."""
    return {
        "customers": [customer(1, "04", province="ON"), customer(3, "04")],
        "products": [entity("04", product_id=1, product_uuid="g1", name="Game 1b", unit_price=11)],
        "channels": [], "payment_types": [], "promotions": [], "promotion_groups": [], "authors": [],
        "categories": [], "publishers": [], "suppliers": [],
        "categories_products": [{**entity("04", category_id=1, product_id=2), "date_removed": at("04")}],
        "authors_products": [], "publishers_products": [], "suppliers_products": [],
        "promotion_groups_products": [],
        "transaction_headers": [header(4, day="04", tax=2), header(1, tax=24, day="02") | {"date_modified": at("04")}],
        # Order 1 gets a corrected line; its other line is unchanged.
        "transaction_lines": [line(12, 1, 10, product=2, modified="04"), line(41, 4, 10, day="04")],
        "transaction_discounts": [discount(4, 1, order=4, day="04")],
        "transaction_payments": [payment(3, 4, 11, day="04"), payment(1, 1, 55) | {"date_modified": at("04")}],
    }


def all_days(spark):
    return date_dimension(days_between(spark, "2025-01-01", "2025-12-31"))
