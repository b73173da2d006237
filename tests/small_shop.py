"""A shop of a few orders, one per special case, as staged tables."""

import datetime as dt
from decimal import Decimal

ORDERS = """order_id long, customer_id long, order_status string, purchased_at timestamp_ntz,
  approved_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz,
  promised_at timestamp_ntz"""
CUSTOMERS = "customer_id long, customer_uid long, city string, state string, zip_prefix long"
ITEMS = """order_id long, item_no long, product_id long, seller_id long, price decimal(18,2),
  freight decimal(18,2)"""
PAYMENTS = """order_id long, payment_seq long, payment_type string, installments long,
  payment_value decimal(18,2)"""
REVIEWS = "review_id long, order_id long, score long"
PRODUCTS = """product_id long, category_src string, category_en string, weight_g long,
  length_cm long, height_cm long, width_cm long"""
SELLERS = "seller_id long, city string, state string, zip_prefix long"
GEOLOCATION = "zip_prefix long, lat double, lng double"


def at(day: int, hour: int = 0, month: int = 1) -> dt.datetime:
    return dt.datetime(2020, month, day, hour)


class SmallShop:
    """Orders: 1 paid twice, two sellers, two reviews; 2 same customer and day, other city;
    3 unpaid with items; 4 neither paid nor with items; 5 delivered on an unknown day;
    6 cancelled."""

    def __init__(self, spark):
        self.spark = spark
        d = self._frame
        self.orders = d(
            ORDERS,
            [
                (1, 1, "delivered", at(1), at(1, 2), at(2), at(5, 10), at(5, 9)),
                (2, 2, "delivered", at(1, 5), at(2), at(3), at(4), at(9)),
                (3, 3, "delivered", at(7, month=2), None, at(8, month=2), at(9, month=2), at(9, 5, 2)),
                (4, 4, "created", at(8, month=2), None, None, None, at(20, month=2)),
                (5, 5, "delivered", at(9, month=2), at(9, 1, 2), at(10, month=2), None, at(20, month=2)),
                (6, 6, "canceled", at(3, month=3), None, None, None, at(20, month=3)),
            ],
        )
        self.customers = d(
            CUSTOMERS,
            [
                (1, 100, "north", "N", 10),
                (2, 100, "south", "S", 11),
                (3, 101, "north", "N", 10),
                (4, 102, "north", "N", 10),
                (5, 103, "nowhere", "X", 99),
                (6, 104, "north", "N", 10),
            ],
        )
        self.items = d(
            ITEMS,
            [
                (1, 1, 1, 1, Decimal("10.00"), Decimal("1.00")),
                (1, 2, 1, 1, Decimal("10.00"), Decimal("1.00")),
                (1, 3, 2, 2, Decimal("30.00"), Decimal("2.50")),
                (2, 1, 1, 1, Decimal("10.00"), Decimal("1.00")),
                (3, 1, 2, 1, Decimal("20.00"), Decimal("3.00")),
                (5, 1, 1, 2, Decimal("5.00"), Decimal("0.50")),
                (6, 1, 1, 2, Decimal("7.00"), Decimal("0.70")),
            ],
        )
        self.payments = d(
            PAYMENTS,
            [
                (1, 1, "credit_card", 3, Decimal("40.00")),
                (1, 2, "voucher", 1, Decimal("14.50")),
                (2, 1, "boleto", 1, Decimal("11.00")),
                (5, 1, "credit_card", 1, Decimal("5.50")),
                (6, 1, "credit_card", 2, Decimal("7.70")),
            ],
        )
        self.reviews = d(REVIEWS, [(1, 1, 5), (2, 1, 2), (3, 2, 4), (3, 6, 4)])
        self.products = d(
            PRODUCTS,
            [(1, "src", "things", 100, 10, 10, 12), (2, "none", None, 400, 10, None, 12)],
        )
        self.sellers = d(SELLERS, [(1, "mill", "M", 10), (2, "farm", "F", 12)])
        self.geolocation = d(GEOLOCATION, [(10, 0.0, 0.0), (11, 1.0, 0.0), (12, 10.0, 0.0)])

    def _frame(self, schema, rows):
        return self.spark.createDataFrame(rows, schema)

    def base(self):
        from souk.operators.facts import order_base
        from souk.operators.staging import payments_per_order

        return order_base(
            self.orders,
            self.customers,
            self.items,
            payments_per_order(self.payments),
            self.reviews,
            self.geolocation,
        )

    def lines(self):
        from souk.operators.dimensions import dim_products, dim_sellers
        from souk.operators.facts import fact_order_items

        return fact_order_items(
            self.items,
            self.base(),
            dim_products(self.products),
            dim_sellers(self.sellers, self.geolocation),
        )

    def people(self):
        from souk.operators.dimensions import dim_customers

        return dim_customers(self.base(), self.orders)
