"""Row-derivation rules of the landing writer, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TAX_HIGH_RATE, TAX_LOW_RATE, TAX_LOW_UP_TO
from .money import as_money

# Keyword -> category family, tried in this order, first match
# wins; any other product type falls in the default family.
CATEGORY_FAMILIES = [
    ("footwear", ["shoe", "sandal", "chappal", "loafer", "slipper", "boot"]),
    ("accessories", ["belt", "cap", "scarf", "socks", "muffler", "backpack"]),
    ("ethnic", ["saree", "salwar", "kameez", "lehenga", "kurti", "dupatta", "anarkali", "churidar",
                "kurta", "sherwani", "nehru", "dhoti", "pajama", "pathani"]),
    ("sport", ["track", "sport", "active", "gym", "workout", "jersey"]),
    ("formal", ["shirt", "blazer", "suit", "tie", "formal"]),
    ("winter", ["jacket", "sweater", "hoodie", "sweatshirt"]),
    ("party", ["gown", "dress", "party"]),
]
DEFAULT_FAMILY = "default"


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """round(quantity x unit_price, 2), exact in DECIMAL, as double."""
    return F.round(as_money(unit_price) * quantity, 2).cast("double")


def tax_amount(amount: Column, unit_price: Column) -> Column:
    """round(amount x rate, 2); the low rate applies up to and including
    the threshold unit price."""
    rate = (F.when(unit_price <= TAX_LOW_UP_TO, F.lit(TAX_LOW_RATE))
            .otherwise(F.lit(TAX_HIGH_RATE))).cast("decimal(4,2)")
    return F.round(as_money(amount) * rate, 2).cast("double")


def name_color(name: Column) -> Column:
    """D3: first token of the product name."""
    return F.try_element_at(F.split(name, " "), F.lit(1))


def name_size(name: Column) -> Column:
    """D3: last-but-one token (NULL for a one-word name)."""
    return F.try_element_at(F.split(name, " "), F.lit(-2))


def category_family(product_type: Column) -> Column:
    """Ordered keyword rules on the lower-cased type, first match wins
    ('Sweatshirt' and 'T-Shirt' are formal because 'shirt' comes first)."""
    lowered = F.lower(product_type)
    out = None
    for family, words in CATEGORY_FAMILIES:
        hit = lowered.rlike("|".join(words))
        out = F.when(hit, F.lit(family)) if out is None else out.when(hit, F.lit(family))
    return out.otherwise(F.lit(DEFAULT_FAMILY))


def single_line_address(address: Column) -> Column:
    """Newlines become ', '."""
    return F.regexp_replace(address, "\n", ", ")
