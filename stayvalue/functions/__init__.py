"""Reusable column expressions."""

from stayvalue.functions.money import exact_avg, exact_sum, share_pct
from stayvalue.functions.parsing import parse_price, parse_review_date, price_digits
from stayvalue.functions.text import misread_text, repair_text

__all__ = [
    "exact_avg",
    "exact_sum",
    "misread_text",
    "parse_price",
    "parse_review_date",
    "price_digits",
    "repair_text",
    "share_pct",
]
