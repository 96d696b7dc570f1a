"""Tier prices, workload templates, calendar and decision limits."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Tier:
    """Prices of one storage tier. ``latency`` is seconds per read."""

    name: str
    store: float
    read: float
    write: float
    egress: float
    ingress: float
    latency: float


@dataclass(frozen=True)
class Persona:
    """Load template of one class of dataset."""

    name: str
    initial_backend: str
    base_reads: float
    base_writes: float


@dataclass(frozen=True)
class CalendarEntry:
    """A dated demand multiplier for some personas. Days count from 0 within the cycle."""

    name: str
    start_day: int
    duration_days: int
    personas: tuple[str, ...]
    read_multiplier: float = 1.0
    write_multiplier: float = 1.0


@dataclass(frozen=True)
class Limits:
    """Thresholds of the decision and job rules; pass another instance to change any of them."""

    hot_reads: float = 100
    cold_reads: float = 10
    fast_latency: float = 0.10
    min_savings: float = 0.50
    min_savings_percent: float = 5.0
    max_attempts: int = 3
    retry_backoff_sec: float = 3.0


# Tier prices; the position decides ties.
TIERS = (
    Tier("on-prem", store=0.40, read=0.0, write=0.0, egress=0.0, ingress=0.0, latency=0.01),
    Tier("private-cloud", store=0.25, read=0.05, write=0.05, egress=0.0, ingress=0.0, latency=0.03),
    Tier("public-hot", store=0.20, read=0.04, write=0.04, egress=0.002, ingress=0.0, latency=0.07),
    Tier("public-cold", store=0.04, read=0.001, write=0.001, egress=0.002, ingress=0.0, latency=4.0),
)
DEFAULT_TIER = "on-prem"
COLD_TIER = "public-cold"
WARM_TIERS = ("on-prem", "private-cloud", "public-hot")

# Workload templates.
PERSONAS = (
    Persona("business_hours", "on-prem", base_reads=5000, base_writes=500),
    Persona("batch_processing", "private-cloud", base_reads=800, base_writes=400),
    Persona("cold_archive", "public-cold", base_reads=1, base_writes=0.1),
    Persona("viral_content", "public-hot", base_reads=8000, base_writes=100),
)

# Demand calendar within a 30-day cycle.
CALENDAR = (
    CalendarEntry("FlashSale", 5, 3, ("business_hours", "viral_content"), read_multiplier=5.0),
    CalendarEntry("MonthlyETL", 15, 2, ("batch_processing",), write_multiplier=8.0),
    CalendarEntry("ComplianceAudit", 20, 1, ("cold_archive",), read_multiplier=30.0),
)
CYCLE_DAYS = 30

# Cost constants of the live model and of the report.
HOURS_PER_MONTH = 720.0
LIVE_LATENCY_PENALTY = 0.10
LIVE_MOVE_FEE = 0.001
REPORT_LATENCY_PENALTY = 0.0001
REPORT_MOVE_FEE = 0.5

# Entries of history kept per dataset.
HISTORY_LENGTH = 24
LIMITS = Limits()
