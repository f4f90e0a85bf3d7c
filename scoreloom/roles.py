"""The role record every operator agrees on."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Roles:
    """Which column plays which part.  Inferred once, then passed explicitly."""

    id: str
    target: str | None
    prediction: str
    numeric: tuple[str, ...] = field(default_factory=tuple)
    cats: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.cats

    def with_numeric(self, *names: str) -> Roles:
        extra = tuple(n for n in names if n not in self.numeric)
        return replace(self, numeric=self.numeric + extra)
