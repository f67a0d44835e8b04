"""Small hand-made frames for the unit tests."""

from datetime import date
from decimal import Decimal

from ordermill.schemas import PROCESSED, RAW, ddl

DAY = date(2025, 11, 30)
RUN = "2025-12-01"
NEXT_RUN = "2025-12-02"


def frame(spark, contract, rows):
    return spark.createDataFrame(rows, ddl(contract))


def customers(spark, rows=(("C001", "Ann"), ("C002", "Bob")), run_date=RUN):
    return frame(spark, RAW["customers"], [(i, n, f"{n}@example.com", "FR", DAY, run_date) for i, n in rows])


def products(spark, rows=(("P001", "Books"), ("P002", "Sports")), run_date=RUN):
    return frame(spark, RAW["products"], [(i, c, f"{c} {i}", 5.0, 10.0, run_date) for i, c in rows])


def orders(spark, rows, run_date=RUN):
    """Rows of (order, customer, product, quantity, price)."""
    return frame(spark, RAW["orders"], [(o, DAY, c, p, q, price, "FR", run_date) for o, c, p, q, price in rows])


def payments(spark, rows, run_date=RUN):
    """Rows of (payment, order, method, amount)."""
    return frame(spark, RAW["payments"], [(i, o, m, DAY, a, run_date) for i, o, m, a in rows])


def enriched(spark, rows):
    """Rows of (order, customer, product, name, category, quantity, amount, run)."""
    return frame(
        spark,
        PROCESSED["orders_enriched"],
        [
            (p, c, o, DAY, run, q, 1.0, "FR", c, None, "FR", DAY, category, name, 1.0, 1.0, None if a is None else Decimal(a))
            for o, c, p, name, category, q, a, run in rows
        ],
    )


def money(rows, *positions):
    return [tuple(Decimal(v) if i in positions and v is not None else v for i, v in enumerate(row)) for row in rows]
