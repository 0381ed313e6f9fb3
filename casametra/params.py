"""Parameters of the listing-market engine, with their default values.

Everything a deployment may want to change lives here: which districts are in
scope, what counts as a relevant apartment, the rolling window, bin widths and
health thresholds. The operators themselves are not tied to one city.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The two kinds of listing.
OPERATIONS = ("rent", "sale")

# Default scope districts (plain ASCII apostrophe).
SCOPE_DISTRICTS = ("Extramurs", "Ciutat Vella", "L'Eixample")

# Document versions that readers accept.
GOLD_SCHEMA_VERSION = "1.0"
HEALTH_SCHEMA_VERSION = "1.1"
READABLE_GOLD_VERSIONS = ("1.0",)
READABLE_HEALTH_VERSIONS = ("1.0", "1.1")

# The public search settings echoed into the gold document.
SEARCH_CONFIG = {
    "center_lat": 39.4693441,
    "center_lon": -0.379561,
    "distance_m": 1500,
    "min_size_m2": 100,
    "max_size_m2": 160,
    "elevator": True,
    "air_conditioning": True,
    "preservation": "good",
    "property_type": "homes",
    "sale_credential_label": "sale_requests",
    "rent_credential_label": "rent_requests",
}

# Credentials that the requests of each operation are charged to, and their labels.
CREDENTIAL_SET_BY_OPERATION = {"sale": "sale_requests", "rent": "rent_requests"}
CREDENTIAL_SET_LABELS = {"sale_requests": "sale", "rent_requests": "rent"}

# Cost services that do not count toward the budget.
EXCLUDED_SERVICES = ("Amazon Registrar", "Amazon Route 53 Domains")

# Log lines that close an invocation, and signs of failure in them.
INVOCATION_PATTERN = "REPORT"
FAILURE_PATTERN = "Task timed out|ERROR|Process exited before completing request"

# Pipeline stage to function name.
STAGE_FUNCTIONS = {
    "bronze": "bronze-collector",
    "silver": "silver-cleaner",
    "gold": "gold-aggregator",
}


@dataclass(frozen=True)
class SalePriceBounds:
    """Open interval of plausible sale prices per square metre."""

    low: float = 1000.0
    high: float = 10000.0


@dataclass(frozen=True)
class RelevantSpec:
    """Which listings count as comparable apartments."""

    has_lift: bool = True
    floor_not: str = "1"
    size_gt: int = 120
    rooms_gte: int = 2
    bathrooms_gte: int = 2


@dataclass(frozen=True)
class MarketParams:
    """Settings of the gold datasets."""

    scope_districts: tuple[str, ...] = SCOPE_DISTRICTS
    relevant: RelevantSpec = field(default_factory=RelevantSpec)
    min_count: int = 5
    window_months: int = 3
    size_bin_m2: int = 10
    price_bin_widths: Mapping[str, float] = field(
        default_factory=lambda: {"sale": 250.0, "rent": 1.0}
    )
    default_price_bin: float = 250.0
    grid_decimals: int = 3


@dataclass(frozen=True)
class HealthParams:
    """Settings of the health rollups."""

    function_names: tuple[str, ...] = tuple(STAGE_FUNCTIONS.values())
    history_window: int = 5
    lookback_days: int = 30
    duration_yellow_seconds: float = 60.0
    duration_red_seconds: float = 120.0
    credential_labels: Mapping[str, str] = field(
        default_factory=lambda: dict(CREDENTIAL_SET_LABELS)
    )
    quota_monthly_requests: int = 100
    quota_yellow_requests: float = 80.0
    quota_red_requests: float = 95.0
    evaluation_months: int = 5
    cost_yellow: float = 2.0
    cost_red: float = 5.0
    excluded_services: tuple[str, ...] = EXCLUDED_SERVICES
