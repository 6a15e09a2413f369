"""Settings of an identity job as plain dataclasses: sources, blocking keys, scoring fields, survivorship."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from personweave.functions.nicknames import NICKNAMES


# Below this Jaro-Winkler value two texts need hardly a common character.
LOWEST_THRESHOLD = 0.4


@dataclass(frozen=True)
class ScoreField:
    """One compared attribute with its Fellegi-Sunter probabilities. Agreement never counts against a match: m >= u."""

    name: str
    comparator: str  # "exact" or "jaro_winkler"
    weight: float
    m: float
    u: float
    normalizer: str  # "email", "phone", "nickname", "name" or "generic"
    threshold: float = 0.88

    def __post_init__(self) -> None:
        if not 0 < self.u <= self.m < 1:
            raise ValueError(f"{self.name}: probabilities must have 0 < u <= m < 1, not m = {self.m}, u = {self.u}")
        if not LOWEST_THRESHOLD <= self.threshold <= 1:
            raise ValueError(f"{self.name}: the threshold must be from {LOWEST_THRESHOLD} to 1")

    @property
    def column(self) -> str:
        return f"n_{self.name}"

    @property
    def agree(self) -> float:
        return self.weight * math.log2(self.m / self.u)

    @property
    def disagree(self) -> float:
        return self.weight * math.log2((1 - self.m) / (1 - self.u))


@dataclass(frozen=True)
class Survivorship:
    """How one golden attribute is chosen among the members of an entity."""

    strategy: str = "source_priority"  # or "most_complete"
    priority: tuple[str, ...] = ()


@dataclass(frozen=True)
class IdentitySpec:
    sources: tuple[str, ...]
    blocking: tuple[tuple[str, ...], ...]
    fields: tuple[ScoreField, ...]
    survivorship: dict[str, Survivorship]
    entity_type: str = "customer"
    match: float = 8.0
    possible: float = 4.0
    non_match: float = -5.0
    merge: float = 12.0
    match_confidence: float = 0.9
    review_confidence: float = 0.7
    max_random_pairs: int = 1_000_000
    max_iterations: int = 25
    convergence: float = 0.001
    # Blocks above this many distinct profiles are refined by further evidence instead of being paired up whole.
    block_limit: int = 256
    # A dictionary, or a table with `alias` and `formal` of any size.
    nicknames: dict[str, str] | DataFrame = field(default_factory=lambda: dict(NICKNAMES))

    def key_name(self, parts: tuple[str, ...]) -> str:
        return "+".join(parts)

    def survivor(self, attribute: str) -> Survivorship:
        return self.survivorship.get(attribute, Survivorship())

    def with_parameters(self, params: dict[str, tuple[float, float]]) -> "IdentitySpec":
        """The same spec with trained (m, u) per field name."""
        fields = tuple(replace(f, m=params[f.name][0], u=params[f.name][1]) if f.name in params else f
                       for f in self.fields)
        return replace(self, fields=fields)


# Declared scoring fields, blocking keys, sources and priorities; they must equal the published
# specification.
SCORE_FIELDS = (
    ScoreField("email", "exact", 2.0, 0.95, 0.001, "email"),
    ScoreField("phone", "exact", 1.5, 0.85, 0.005, "phone"),
    ScoreField("first_name", "jaro_winkler", 1.0, 0.85, 0.05, "nickname"),
    ScoreField("last_name", "jaro_winkler", 1.0, 0.88, 0.02, "name"),
    ScoreField("company_name", "jaro_winkler", 1.0, 0.80, 0.02, "generic"),
)
BLOCKING_KEYS = (("email",), ("phone",), ("last_name", "first_name"), ("company_name", "last_name"))
BATCH_SOURCES = ("crm_contacts", "billing_accounts", "support_users", "app_signups", "partner_leads")
REALTIME_SOURCES = ("crm_contacts", "billing_accounts", "support_users")


def _survivorship(company_priority: tuple[str, ...]) -> dict[str, Survivorship]:
    return {
        "email": Survivorship("most_complete"),
        "phone": Survivorship("source_priority", ("crm_contacts", "support_users")),
        "first_name": Survivorship("most_complete"),
        "last_name": Survivorship("most_complete"),
        "company_name": Survivorship("source_priority", company_priority),
    }


def batch_spec(**changes) -> IdentitySpec:
    """Five-source batch settings."""
    spec = IdentitySpec(BATCH_SOURCES, BLOCKING_KEYS, SCORE_FIELDS,
                        _survivorship(("crm_contacts", "billing_accounts", "partner_leads")))
    return replace(spec, **changes)


def realtime_spec(**changes) -> IdentitySpec:
    """Three-source settings of the incremental job."""
    spec = IdentitySpec(REALTIME_SOURCES, BLOCKING_KEYS, SCORE_FIELDS,
                        _survivorship(("crm_contacts", "billing_accounts")), max_random_pairs=500_000)
    return replace(spec, **changes)
