"""Every business choice in one place; functions take a policy, never a global."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any

# Category names of the public sales feed, exactly as it spells them.
PREMIUM_CATEGORIES = (
    "IMPORTED DRY GINS",
    "IMPORTED GINS",
    "FLAVORED GINS",
    "FLAVORED GIN",
)
OTHER_CATEGORIES = ("AMERICAN DRY GINS",)
CATEGORY_ALIASES = {"FLAVORED GIN": "FLAVORED GINS"}

# Domains of the CRM export.
ACCOUNT_STATUSES = ("Active", "Prospect")
ACCOUNT_SEGMENTS = (
    "Premium Off-Trade",
    "Independent Specialist",
    "Grocery Multiple",
    "Wholesale Club",
)
OPPORTUNITY_STAGES = (
    "Prospecting",
    "Qualification",
    "Proposal Sent",
    "Negotiation",
    "Closed Won",
    "Closed Lost",
)
CONTACT_TITLES = (
    "Owner",
    "Beverage Director",
    "Spirits Buyer",
    "Wine & Spirits Manager",
    "Store Manager",
)

# First day of the sales rollup, and its scan ceiling (10 GiB) where none is stated.
SALES_START_DATE = "2021-01-01"
SCAN_CEILING_BYTES = 10 * 1024**3


@dataclass(frozen=True)
class CategoryPolicy:
    """Which raw category names count, and towards which group.

    Membership is by explicit list on the trimmed, upper-cased name. A substring
    test would catch look-alikes, see ``plans.market.category_audit``.
    """

    premium: tuple[str, ...] = PREMIUM_CATEGORIES
    other: tuple[str, ...] = OTHER_CATEGORIES
    aliases: dict[str, str] = field(default_factory=lambda: dict(CATEGORY_ALIASES))
    premium_group: str = "GIN_PREMIUM"
    other_group: str = "GIN_OTHER"
    outside_group: str = "NON_GIN"

    @property
    def listed(self) -> tuple[str, ...]:
        return self.premium + self.other

    @property
    def groups(self) -> tuple[str, ...]:
        return (self.premium_group, self.other_group, self.outside_group)

    @property
    def details(self) -> tuple[str, ...]:
        """The names that remain once aliases are collapsed, in list order."""
        return tuple(dict.fromkeys(self.aliases.get(name, name) for name in self.listed))


@dataclass(frozen=True)
class TargetingPolicy:
    categories: CategoryPolicy = field(default_factory=CategoryPolicy)
    sales_start: str = SALES_START_DATE
    # The same months for every store, so good for ranking. The last year may be
    # partial, so never compare the years of this window with each other.
    window_years: tuple[int, ...] = (2025, 2026)
    # Complete years only; used by the trend reports.
    trend_years: tuple[int, ...] = (2021, 2022, 2023, 2024, 2025)
    premium_floor: int = 600
    exclude_closed_lost: bool = False
    demote_closed_lost: bool = True
    list_size: int = 25
    title_precedence: tuple[str, ...] = CONTACT_TITLES
    statuses: tuple[str, ...] = ACCOUNT_STATUSES
    segments: tuple[str, ...] = ACCOUNT_SEGMENTS
    stages: tuple[str, ...] = OPPORTUNITY_STAGES
    # None: the ceiling above on a local master; a job on a cluster has to state
    # one. 0: no ceiling.
    scan_ceiling_bytes: int | None = None

    @property
    def excluded_states(self) -> tuple[str, ...]:
        """Won accounts are customers already; lost ones leave only on request."""
        return ("closed_won", "closed_lost") if self.exclude_closed_lost else ("closed_won",)

    def market_choices(self) -> str:
        """What the sales rollup depends on, as text."""
        return json.dumps({"categories": asdict(self.categories), "sales_start": self.sales_start}, sort_keys=True)

    def changed(self, choices: Mapping[str, Any]) -> TargetingPolicy:
        """The policy with some fields set, by name; ``categories`` takes a mapping of its own fields."""
        return _changed(self, choices)

    @classmethod
    def from_json(cls, text: str) -> TargetingPolicy:
        """The defaults with the fields a JSON object names."""
        return cls().changed(json.loads(text))


def _changed(policy: Any, choices: Mapping[str, Any]) -> Any:
    known = {one.name for one in fields(policy)}
    if unknown := set(choices) - known:
        raise ValueError(f"no such policy field: {sorted(unknown)}; there are {sorted(known)}")
    held = {}
    for name, value in choices.items():
        if isinstance(value, Mapping) and isinstance(getattr(policy, name), CategoryPolicy):
            value = _changed(getattr(policy, name), value)
        held[name] = tuple(value) if isinstance(value, list) else value
    return replace(policy, **held)
