"""Column roles and run settings."""

from __future__ import annotations

import difflib
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

# The header names each role is looked up under, in priority order.
DATE_NAMES = ("CheckoutDate", "Checkout Date", "checkoutdate", "Date", "date")
YEAR_NAMES = ("CheckoutYear", "Checkout Year", "checkoutyear", "Year", "year")
MONTH_NAMES = ("CheckoutMonth", "Checkout Month", "checkoutmonth", "Month", "month")
CATEGORY_NAMES = (
    "Collection", "collection", "UsageClass", "usageclass", "CheckoutType", "checkouttype",
    "Audience", "audience", "ItemType", "itemtype", "Format", "format",
    "MaterialType", "materialtype",
)
COUNT_NAMES = ("Checkouts", "checkouts", "CheckoutCount", "checkoutcount", "Count", "count")
MATERIAL_NAMES = ("MaterialType", "materialtype", "Format", "format", "ItemType", "itemtype")

SEASON = 12
# Orders of the seasonal model.
ARIMA_ORDER = (1, 1, 1)
SEASONAL_ORDER = (1, 1, 1)

# Model names, their display labels.
MODEL_LABELS = {
    "naive": "Seasonal Naive",
    "holt": "Holt-Winters",
    "regression": "Ridge Regression",
    "sarima": "SARIMA",
    "naive_bayes": "Naive Bayes",
    "random_forest": "Random Forest",
    "gradient_boost": "Gradient Boosting",
    "ensemble": "Ensemble (avg)",
    "ensemble_w": "Weighted Ensemble",
}
ENSEMBLES = ("ensemble", "ensemble_w")


class RoleError(ValueError):
    """A column role could not be bound to a column."""


def _role_error(problem: str, columns: Sequence[str]) -> RoleError:
    """An error that also lists the table's columns, at most 25 of them."""
    rest = f" and {len(columns) - 25} others" if len(columns) > 25 else ""
    return RoleError(f"{problem}; the table has {', '.join(columns[:25])}{rest}")


def resolve_role(
    columns: Sequence[str], requested: str | None, candidates: Sequence[str], label: str
) -> str | None:
    """Bind a role to a column by requested name, else by candidate list.

    Works on column names only, so it launches no job. An exact name beats a
    case-insensitive one; an unknown requested name is an error with hints; a
    role nobody asked for and nothing matches is ``None``.
    """
    by_lower: dict[str, str] = {}
    for name in columns:
        by_lower[name.lower()] = name
    if requested:
        if requested in columns:
            return requested
        folded = [c for c in columns if c.lower() == requested.lower()]
        if folded:
            return folded[0]
        close = difflib.get_close_matches(requested, columns, n=5, cutoff=0.6)
        hint = f" (similar: {', '.join(close)})" if close else ""
        raise _role_error(f"no {label} column named {requested}{hint}", columns)
    exact = [c for c in candidates if c in columns]
    loose = [by_lower[c.lower()] for c in candidates if c.lower() in by_lower]
    return next(iter(exact + loose), None)


@dataclass(frozen=True)
class Roles:
    """Physical column behind each role."""

    category: str
    date: str | None = None
    year: str | None = None
    month: str | None = None
    count: str | None = None
    material: str | None = None


@dataclass(frozen=True)
class Material:
    """Words of the two-stage material filter."""

    exact: str = "book"
    contains: str = "book"
    excludes: tuple[str, ...] = ("ebook", "audiobook")


@dataclass(frozen=True)
class ModelOptions:
    """Settings of the single models.

    ``season`` is the season length of smoothing and ARIMA, ``arima_order`` and
    ``seasonal_order`` their (p, d, q) and (P, D, Q). ``fallback_window`` is the recent mean a
    seasonal-naive zero gives way to. ``anchor`` says which month the inputs of naive Bayes,
    forest and boosting describe, and the yearly lag of ridge: "last_row" or "next_month".
    """

    forest_trees: int = 300
    boost_rounds: int = 400
    season: int = SEASON
    arima_order: tuple[int, int, int] = ARIMA_ORDER
    seasonal_order: tuple[int, int, int] = SEASONAL_ORDER
    fallback_window: int = 3
    anchor: str = "last_row"


@dataclass(frozen=True)
class ForecastConfig:
    """Everything one run needs; defaults follow the interactive front end."""

    category: str | None = None
    date: str | None = None
    year: str | None = None
    month: str | None = None
    count: str | None = None
    material: str | None = None
    only_material: Material | None = field(default_factory=Material)
    exclude_latest: bool = True
    top_items: int = 0
    min_history: int = 3
    recent_window: int = 6
    min_recent_nonzero: int = 1
    relax_below: int = 5
    models: tuple[str, ...] = ("regression", "random_forest", "gradient_boost")
    backtest_months: int = 3
    guardrail: float | None = 3.0
    weight_floor: float = 0.001
    forest_trees: int = 300
    boost_rounds: int = 400
    season: int = SEASON
    arima_order: tuple[int, int, int] = ARIMA_ORDER
    seasonal_order: tuple[int, int, int] = SEASONAL_ORDER
    fallback_window: int = 3
    anchor: str = "last_row"
    # Layouts of date text besides ISO, tried in order; empty means the usual ones.
    date_layouts: tuple[str, ...] = ()

    def model_options(self) -> ModelOptions:
        return ModelOptions(**{f.name: getattr(self, f.name) for f in fields(ModelOptions)})

    def roles(self, columns: Sequence[str]) -> Roles:
        """P1 for every role; a date column wins over year + month."""
        material = None
        if self.only_material is not None:
            material = resolve_role(columns, self.material, MATERIAL_NAMES, "material")
            if material is None:
                raise _role_error("no material column to filter by", columns)
        category = resolve_role(columns, self.category, CATEGORY_NAMES, "category")
        if category is None:
            raise _role_error("no category column", columns)
        count = resolve_role(columns, self.count, COUNT_NAMES, "count")
        date = resolve_role(columns, self.date, DATE_NAMES, "date")
        if date:
            return Roles(category, date=date, count=count, material=material)
        year = resolve_role(columns, self.year, YEAR_NAMES, "year")
        month = resolve_role(columns, self.month, MONTH_NAMES, "month")
        if not (year and month):
            raise _role_error("neither a date column nor year and month columns", columns)
        return Roles(category, year=year, month=month, count=count, material=material)
