"""Codes and labels that results and checks must agree on."""

# Fixed values
ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
DELIVERED = "delivered"
CANCELLED_STATUSES = ["canceled", "unavailable"]
NOT_YET_SHIPPABLE_STATUSES = ["created", "approved", "invoiced", "processing"]

PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
CREDIT_CARD = "credit_card"

REVIEW_SCORES = [1, 2, 3, 4, 5]
POSITIVE_SCORE = 4
NEGATIVE_SCORE = 2

NO_CATEGORY = "Uncategorized"

SEGMENT_RECURRENT = "recurrent"
SEGMENT_ONE_TIME = "one_time"
SEGMENTS = [SEGMENT_RECURRENT, SEGMENT_ONE_TIME]

# (exclusive upper bound in grams, label); the last label also takes unknown weights
WEIGHT_BUCKETS = [
    (500, "light (<500g)"),
    (2000, "medium (500g-2kg)"),
    (5000, "heavy (2kg-5kg)"),
    (None, "very heavy (5kg+)"),
]
# cm3 of parcel volume that weigh as much as one gram
VOLUME_CM3_PER_GRAM = 6.0

# (exclusive upper bound in km, label)
DISTANCE_BUCKETS = [
    (100, "local (<100km)"),
    (500, "regional (100-500km)"),
    (1500, "national (500-1500km)"),
    (None, "long distance (1500km+)"),
]
EARTH_RADIUS_KM = 6371.0

# (exclusive upper bound of whole days against the promise, label)
PUNCTUALITY_BUCKETS = [
    (0, "early"),
    (1, "on day"),
    (4, "late (1-3 days)"),
    (None, "very late (4+ days)"),
]

TIER_TOP_10 = "Top 10"
TIER_TOP_1_PCT = "Top 1%"
TIER_TOP_10_PCT = "Top 10%"
TIER_REST = "Rest"
DIMENSION_SELLERS = "sellers"
DIMENSION_CATEGORIES = "categories"
DIMENSIONS = [DIMENSION_SELLERS, DIMENSION_CATEGORIES]

SIGNIFICANT_ORDERS = 100
SIGNIFICANT_SELLER_ORDERS = 20

COMMISSION = 0.15
PAYMENT_FEE = 0.03
RECONCILIATION_TOLERANCE = 0.01


def bucket_labels(buckets):
    return [label for _, label in buckets]
