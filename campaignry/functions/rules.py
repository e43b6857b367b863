"""Score rules: the first rule whose ranges hold names the row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY = (0, 5)

# Label, R range, F range, M range; quintile scores 1-5.
QUINTILE_LABELS = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("Potential Loyalists", (3, 5), (2, 5), ANY),
    ("At Risk", (2, 5), (2, 5), ANY),
    ("New Customers", (5, 5), (0, 1), ANY),
]
QUINTILE_OTHER = "Lost"

# Recommended action by the same scores, for customers who may be contacted.
ACTIONS = [
    ("Priority: Upsell / Reward", (4, 5), (4, 5), (4, 5)),
    ("Include: Retention Campaign", (3, 5), (3, 5), ANY),
    ("Include: Cross-Sell Campaign", (3, 5), (2, 5), ANY),
    ("Include: Win-Back Campaign", (0, 2), (0, 2), ANY),
]
ACTION_BANNED = "Excluded — DNC"
ACTION_OTHER = "Monitor — No Action"

# Label by the additive scores, R and F 1-5, M 0-4.
ADDITIVE_LABELS = [
    ("Champions", (4, 5), (4, 5), (4, 4)),
    ("Loyal Customers", (3, 5), (4, 5), ANY),
    ("New Customers", (4, 5), (1, 2), ANY),
    ("Potential Loyalists", (3, 5), (3, 5), ANY),
    ("Can't Lose Them", (1, 2), (4, 5), (4, 4)),
    ("At Risk", (1, 2), (3, 5), ANY),
    ("High-Value Infrequent", (3, 5), ANY, (4, 4)),
    ("New Customers", (4, 5), ANY, (0, 0)),
    ("Hibernating", (1, 2), (1, 2), (0, 2)),
]
ADDITIVE_OTHER = "Needs Attention"


def first_match(rules: list[tuple], otherwise: str, r: Column, f: Column, m: Column) -> Column:
    out = F
    for name, *ranges in rules:
        held = [score.between(*span) for score, span in zip((r, f, m), ranges) if span != ANY]
        out = out.when(reduce(Column.__and__, held), name)
    return out.otherwise(otherwise)
