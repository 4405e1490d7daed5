"""What a caller decides about the derived tables (one object, passed to ``Warehouse``)."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """``horizon_weeks``: how many latest fiscal weeks the forecast covers; the rates are keyed shares of
    the source rows, so those tables grow with the data; ``weeks_of_supply`` is the stock target."""

    horizon_weeks: int
    review_rate: str
    case_rate: str
    override_rate: str
    weeks_of_supply: int = 8


#: What the registered queries use: half a year, and about one review in 300 lines, one case in 600.
REGISTERED = Settings(horizon_weeks=26, review_rate="0.003300", case_rate="0.001700", override_rate="0.010000")
