"""How the two systems look, and which fields are kept in step."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

UNIFIED_ID = "unified_contact_id"


@dataclass(frozen=True)
class System:
    """One source system.

    ``id`` and ``modified`` are unique to the system; ``attributes`` may share names with the other
    system, so a matched record prefixes them with the system's name (see ``matched``).

    ``json_names`` tells how landed records name columns, where not as here: ``id`` and ``modified`` unless given, and
    attributes by their own names.  ``records_at`` leads to the list of records in a landed page.
    """

    name: str
    id: str
    modified: str
    email: str
    attributes: tuple[str, ...]
    bronze_only: tuple[str, ...] = ()
    nested: str | None = None  # JSON object that holds the attributes, if any
    json_names: Mapping[str, str] = field(default_factory=dict, hash=False)
    records_at: tuple[str, ...] = ()

    def json_name(self, column: str) -> str:
        """The name of a column in landed records."""
        usual = {self.id: "id", self.modified: "modified"}.get(column, column)
        return self.json_names.get(column, usual)

    @property
    def snapshot_columns(self) -> tuple[str, ...]:
        return (self.id, self.modified, *self.attributes)

    def matched(self, column: str) -> str:
        return column if column in (self.id, self.modified) else f"{self.name}_{column}"


# The attributes of either system.
SYSTEM_A = System(
    name="a",
    id="a_id",
    modified="a_modified",
    email="email",
    attributes=("email", "firstname", "lastname", "phone", "mobilephone", "jobtitle", "company"),
    bronze_only=("lifecyclestage",),
    nested="properties",
    records_at=("results",),
)
SYSTEM_B = System(
    name="b",
    id="b_id",
    modified="b_modified",
    email="emailaddress1",
    attributes=("emailaddress1", "firstname", "lastname", "telephone1", "mobilephone", "jobtitle", "company"),
    records_at=("value",),
)


@dataclass(frozen=True)
class FieldRule:
    """A unified field, its column on either side, and how differences travel.

    ``direction`` is ``bi``, ``to_a`` or ``to_b``; ``strategy`` is ``overwrite`` or
    ``fill_if_missing``.  A field without a column on both sides is never pushed.
    """

    unified: str
    a: str | None
    b: str | None
    direction: str = "bi"
    strategy: str = "overwrite"

    def __post_init__(self) -> None:
        if self.direction not in ("bi", "to_a", "to_b"):
            raise ValueError(f"unknown direction {self.direction!r} for field {self.unified!r}")
        if self.strategy not in ("overwrite", "fill_if_missing"):
            raise ValueError(f"unknown strategy {self.strategy!r} for field {self.unified!r}")

    def column(self, system: System) -> str | None:
        return self.a if system.name == "a" else self.b


# The default field rules.
CONTACT_RULES = (
    FieldRule("email", "email", "emailaddress1", "bi", "overwrite"),
    FieldRule("firstname", "firstname", "firstname", "bi", "fill_if_missing"),
    FieldRule("lastname", "lastname", "lastname", "bi", "fill_if_missing"),
    FieldRule("phone", "phone", "telephone1", "bi", "overwrite"),
    FieldRule("mobilephone", "mobilephone", "mobilephone", "bi", "fill_if_missing"),
    FieldRule("jobtitle", "jobtitle", "jobtitle", "to_a", "overwrite"),
    FieldRule("company", "company", "company", "to_b", "fill_if_missing"),
)



@dataclass(frozen=True)
class Entity:
    """A kind of record that both systems hold.  Other kinds than contacts bring their own."""

    name: str
    a: System
    b: System
    rules: tuple[FieldRule, ...]

    @property
    def systems(self) -> tuple[System, System]:
        return self.a, self.b

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(rule.unified for rule in self.rules)

    @property
    def matched_columns(self) -> tuple[str, ...]:
        return tuple(s.matched(c) for s in self.systems for c in s.snapshot_columns)

    def partner(self, system: System) -> System:
        return self.b if system.name == self.a.name else self.a


CONTACTS = Entity("contacts", SYSTEM_A, SYSTEM_B, CONTACT_RULES)
