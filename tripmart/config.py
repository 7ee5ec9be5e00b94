"""Run parameters: quality thresholds and the month a run replaces."""

from __future__ import annotations

from dataclasses import dataclass

from tripmart.errors import InvalidRequest

# Accepted services and calendar bounds of a month request.
SERVICES = ("yellow",)
FIRST_YEAR = 2009
LAST_YEAR = 2100

# The three columns that identify one service month, in partition order.
MONTH_COLUMNS = ("service", "source_year", "source_month")


@dataclass(frozen=True)
class Rules:
    """Thresholds used by classification, the anomaly mart and the data checks."""

    # Default thresholds and the two airport zones.
    max_duration_minutes: float = 1440.0
    max_speed_mph: float = 100.0
    anomaly_speed_mph: float = 65.0
    airport_zone_ids: tuple[int, ...] = (132, 138)


@dataclass(frozen=True, order=True)
class Month:
    """One (service, year, month); the unit that every run replaces."""

    service: str
    year: int
    month: int

    @staticmethod
    def checked(year: int, month: int, service: str = "yellow") -> "Month":
        if not FIRST_YEAR <= year <= LAST_YEAR:
            raise InvalidRequest(f"year must lie in {FIRST_YEAR}..{LAST_YEAR}, got {year}")
        if not 1 <= month <= 12:
            raise InvalidRequest(f"month must lie in 1..12, got {month}")
        if service not in SERVICES:
            raise InvalidRequest(f"unknown service {service!r}; known: {', '.join(SERVICES)}")
        return Month(service, year, month)

    @property
    def directory(self) -> str:
        return f"service={self.service}/source_year={self.year}/source_month={self.month}"
