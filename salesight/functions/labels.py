"""Business labels and price tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and default thresholds of the reports.
PRICE_CUTS = (150, 550)
HIGH_REVENUE = 5_000_000
URGENT_MARGIN_GAP = -10

MONITOR = "Monitor"
MARGIN_PRESSURE = "High revenue but margin pressure"
LOW_MARGIN_VOLUME = "High volume but low margin"
LOW_MARGIN_SHARE = "High revenue share but below-average margin"
SEGMENTS = ("High-Value", "Mid-Value", "Emerging")
SCALE_UP = "Priority: Scale Up"
PROMOTE = "Priority: Promote"
URGENT = "Urgent: improve margin"
REVIEW = "Corrective action: review pricing/cost"


def tier_labels(cuts: Sequence[float] = PRICE_CUTS) -> list[str]:
    """Tier names in price order, one more than cut points."""
    if not cuts:
        return ["All prices"]
    bounds = list(zip(cuts, cuts[1:], strict=False))
    middle = "Mid-Range" if len(bounds) == 1 else "Tier {n}"
    between = [f"{middle.format(n=n)} ({a}-{b})" for n, (a, b) in enumerate(bounds, 2)]
    return [f"Budget (<{cuts[0]})", *between, f"Premium ({cuts[-1]}+)"]


def tier_number(price: Column, cuts: Sequence[float] = PRICE_CUTS) -> Column:
    """1-based tier: a price equal to a cut belongs to the tier above it."""
    above = [F.when(price < F.lit(cut), 0).otherwise(1) for cut in cuts]
    return sum(above, F.lit(1))


def price_tier(price: Column, cuts: Sequence[float] = PRICE_CUTS) -> Column:
    return nth_label(tier_number(price, cuts), tier_labels(cuts))


def nth_label(number: Column, labels: Sequence[str]) -> Column:
    """Label number 1, 2, ... of the list."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), number)
