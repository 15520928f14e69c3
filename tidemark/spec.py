"""Source specifications and record contracts (declarative, no Spark state)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

INTEGER, DECIMAL, TIMESTAMP, STRING = "integer", "decimal", "timestamp", "string"
REJECT_POLICIES = ("fail", "quarantine", "warn")
EXTRA_POLICIES = ("ignore", "forbid")


@dataclass(frozen=True)
class FieldRule:
    """One typed field of a record contract.

    ``name`` is the staging column; ``alias`` the source key (either is accepted,
    the alias wins when both are present). ``clean`` runs on the typed value and
    ``check`` returns an error code Column (NULL when fine); both are plain
    Column expressions, so rules stay JVM-side.
    """

    name: str
    kind: str
    alias: str | None = None
    required: bool = True
    precision: int = 12
    scale: int = 4
    staged: bool = True
    clean: Callable[[Column], Column] | None = None
    check: Callable[[Column], Column] | None = None

    def __post_init__(self) -> None:
        if self.kind not in (INTEGER, DECIMAL, TIMESTAMP, STRING):
            raise ValueError(f"unknown field kind {self.kind!r}")

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.alias, self.name) if self.alias and self.alias != self.name else (self.name,)


@dataclass(frozen=True)
class Contract:
    """Ordered field rules plus the policy for keys the contract does not know."""

    fields: tuple[FieldRule, ...]
    extra: str = "ignore"

    def __post_init__(self) -> None:
        if self.extra not in EXTRA_POLICIES:
            raise ValueError(f"extra policy must be one of {EXTRA_POLICIES}")

    @property
    def known_keys(self) -> tuple[str, ...]:
        seen: list[str] = []
        for rule in self.fields:
            for key in rule.keys:
                if key not in seen:
                    seen.append(key)
        return tuple(seen)


@dataclass(frozen=True)
class DimSpec:
    """Slowly-changing (type 1) dimension: latest attributes plus first/last seen."""

    name: str
    key: str
    attributes: tuple[str, ...]
    seen_column: str
    first_seen: str = "first_seen_utc"
    last_seen: str = "last_seen_utc"


@dataclass(frozen=True)
class FactSpec:
    """Fact table: grain columns (unique) plus carried columns.

    ``month_of`` names a time column of the grain by whose month the table is
    published part by part (None: as a whole).
    """

    name: str
    grain: tuple[str, ...]
    columns: tuple[str, ...]
    dim_key: str | None = None
    month_of: str | None = None

    def __post_init__(self) -> None:
        if self.month_of is not None and self.month_of not in self.grain:
            raise ValueError(f"{self.month_of!r} is no column of the grain: an upsert could move a row to another month")


@dataclass(frozen=True)
class SourceSpec:
    """Everything the stages need to know about one source."""

    name: str
    contract: Contract
    key_field: str  # source JSON key of the business key
    cursor_field: str  # source JSON key of the cursor
    business_key: str  # staging column of the business key
    cursor: str = "_id"  # raw/staging cursor column
    reject_policy: str = "fail"
    clean_columns: tuple[str, ...] = ()
    nullable_clean_columns: tuple[str, ...] = ()
    # Derived staging columns: (name, builder of a Column over staging columns).
    derived: tuple[tuple[str, Callable[[], Column]], ...] = ()
    dim: DimSpec | None = None
    fact: FactSpec | None = None
    freshness_delivery: str | None = None
    key_buckets: int = 64  # folders of the staged keys' index; fixed once it is written
    # Where the records come from, as (reader format, options): with it a source is configuration alone.
    # Rows of ``saved_pages`` are unwrapped; any other format is read as a table by its cursor column.
    source: tuple[str, dict] | None = None
    # Extra mart steps run by transform in this order after dim and fact:
    # (table name, builder from cleaned staging to the table's rows).
    mart_steps: tuple[tuple[str, Callable], ...] = ()
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.reject_policy not in REJECT_POLICIES:
            raise ValueError(f"reject_policy must be one of {REJECT_POLICIES}")

    @property
    def staged_fields(self) -> tuple[FieldRule, ...]:
        return tuple(r for r in self.contract.fields if r.staged)
