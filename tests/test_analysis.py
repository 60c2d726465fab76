"""The whole analysis against a plain Python computation, on skewed and dirty input."""

import collections
import datetime as dt
import random
import re

import pytest

from stayvalue.operators.segments import DEFAULT_RULES
from stayvalue.plans import Settings, customer_table

REFERENCE = dt.date(2022, 6, 1)
DIRTY = [None, "", "invalid", "2021-13-45", "2021-02-30", "2021-03-04xyz"]


def make_input(n=9000, seed=4):
    """A third of the rows on one listing, on one reviewer, and as copies of one review."""
    rng = random.Random(seed)
    reviews = []
    for _ in range(n):
        if rng.random() < 0.33:
            reviews.append(("5", 7, "2021-03-04"))
            continue
        listing = "5" if rng.random() < 0.5 else str(rng.randrange(400))
        reviewer = 7 if rng.random() < 0.5 else rng.choice([None, *range(100, 700)])
        day = dt.date(2018, 1, 1) + dt.timedelta(days=rng.randrange(1700))
        text = rng.choice([day.isoformat(), f"{day:%Y/%m/%d}", f"{day.year}-{day.month}-{day.day}"])
        reviews.append((listing, reviewer, rng.choice(DIRTY) if rng.random() < 0.1 else text))
    listings = []
    for i in range(400):
        price = rng.choice(["", "free", "$5", None]) if i % 9 == 1 else f"${rng.randrange(1000, 99999) / 100:,.2f}"
        area = rng.choice([None, "", "Unknown"]) if i % 11 == 1 else f"area {rng.randrange(30)}"
        listings.append((str(i), price, area))
    listings.append(("5", "$70.07", "second"))  # a repeated id multiplies its stays
    return reviews, listings


def python_date(text):
    match = re.match(r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", text or "")
    try:
        return dt.date(*map(int, match.groups())) if match else None
    except ValueError:
        return None


def python_price(text):
    try:
        value = float(re.sub(r"[^0-9.]", "", text or ""))
    except ValueError:
        return None
    return value if 10 <= value <= 10000 else None


def python_analysis(reviews, listings):
    offers = collections.defaultdict(list)
    for listing, price, area in listings:
        if area not in (None, "", "Unknown") and python_price(price) is not None:
            offers[listing].append((round(python_price(price) * 100), area))
    stays = collections.defaultdict(list)
    for listing, reviewer, text in set(reviews):
        if python_date(text):
            for cents, area in offers[listing]:
                stays[reviewer].append((python_date(text), cents, area))
    out = {}
    for reviewer, visits in stays.items():
        recency = max(0, (REFERENCE - max(v[0] for v in visits)).days)
        frequency, monetary = len(visits), sum(v[1] for v in visits) * 3 / 100
        areas = collections.Counter(v[2] for v in visits)
        best = min(areas, key=lambda a: (-areas[a], a))
        segment = next(
            (
                rule.segment
                for rule in DEFAULT_RULES
                if recency <= rule.max_recency
                and frequency >= rule.min_frequency
                and monetary >= rule.min_monetary
            ),
            "Lost",
        )
        out[reviewer] = (recency, frequency, monetary, best, segment)
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_plain_python(spark, conf, broadcast):
    if not broadcast:
        conf(
            spark__sql__autoBroadcastJoinThreshold="-1",
            spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        )
    reviews, listings = make_input()
    customers = customer_table(
        spark.createDataFrame(reviews, "listing_id string, reviewer_id long, date string"),
        spark.createDataFrame(listings, "id string, price string, neighbourhood_cleansed string"),
        Settings(reference_date=REFERENCE),
    )
    found = {r["reviewer_id"]: tuple(r)[1:] for r in customers.collect()}
    assert found == python_analysis(reviews, listings)
    assert None in found and len({v[4] for v in found.values()}) >= 4
