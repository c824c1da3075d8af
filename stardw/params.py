"""Cut-points and report parameters.

The defaults are the source pipeline's business rules.  On the driver's test
tables the defaults put every seller into one tier and every product into one
price band, so the registered queries use ``FIXTURE_PARAMS`` (documented in
FIXTURES.md) to get non-trivial classes; the defaults are covered by the
golden unit tests.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    # price band on list_price: < budget -> Budget, < mid -> Mid, < premium -> Premium, else Luxury
    band_budget: Decimal = Decimal("50")
    band_mid: Decimal = Decimal("200")
    band_premium: Decimal = Decimal("500")
    # is_premium: list_price >= premium_min (NULL price -> False)
    premium_min: Decimal = Decimal("500")
    # seller size on item count: NULL or < small -> Small, < medium -> Medium, else Large
    size_small: int = 50
    size_medium: int = 500
    # seller tier on sum(price): NULL or < bronze -> Bronze, < silver -> Silver, else Gold
    tier_bronze: Decimal = Decimal("5000")
    tier_silver: Decimal = Decimal("50000")
    # assumed cost ratio: unit_cost = round(list_price * cost_ratio, 2)
    cost_ratio: Decimal = Decimal("0.60")
    # simulated attributes
    seed: int = 42
    seller_epoch: _dt.date = _dt.date(2016, 9, 1)

    # report slicers / thresholds (the source gives none: they are parameters)
    period_from: _dt.date = _dt.date(1996, 1, 1)
    period_to: _dt.date = _dt.date(1998, 12, 31)
    slicer_groups: tuple[str, ...] = ("Electronics", "Home & Garden", "Fashion")
    slicer_categories: tuple[str, ...] = ("audio", "bed_bath_table", "toys", "health_beauty")
    focus_group: str = "Electronics"
    focus_year: int = 1997
    focus_quarter: int = 4
    risk_min_revenue: Decimal = Decimal("50000")
    risk_max_review: Decimal = Decimal("3.0")
    growth_min_review: Decimal = Decimal("4.5")
    regions: tuple[str, ...] = field(
        default=("Center-West", "North", "Northeast", "Other", "South", "Southeast"))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT_PARAMS = Params()

# Cut-points that split the driver's synthetic tables into several classes
# (see FIXTURES.md "Cut-points are parameters").
FIXTURE_PARAMS = Params(
    band_budget=Decimal("45000"),
    band_mid=Decimal("55000"),
    band_premium=Decimal("65000"),
    premium_min=Decimal("65000"),
    size_small=610,
    size_medium=640,
    tier_bronze=Decimal("32000000"),
    tier_silver=Decimal("33800000"),
    risk_min_revenue=Decimal("22800000"),
    risk_max_review=Decimal("3.1"),
    growth_min_review=Decimal("3.1"),
)
