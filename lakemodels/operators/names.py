"""Column names, compared as Spark compares them: without regard to case."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Drift:
    """How the columns of a model differ from those of its target."""

    missing: list[str]
    new: list[str]

    def __bool__(self) -> bool:
        return bool(self.missing or self.new)

    def __iter__(self):
        return iter((self.missing, self.new))

    def error(self, allowed: str = "") -> ValueError:
        hint = f" ({allowed})" if allowed else ""
        return ValueError(f"Schema drift: missing from the model {self.missing}, new in the model {self.new}{hint}")


class Names:
    """The columns of a frame or table, found by any spelling."""

    def __init__(self, columns: Iterable[str]):
        self.spelled = list(columns)
        self._own = {name.lower(): name for name in self.spelled}

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._own

    def resolve(self, names: Iterable[str], purpose: str) -> list[str]:
        """The frame's own spelling of some names; an error names those it does not have."""
        names = list(names)
        unknown = [n for n in names if n not in self]
        if unknown:
            raise ValueError(f"{purpose}: no column {unknown} among {self.spelled}")
        return [self._own[n.lower()] for n in names]

    def others(self, other: Names) -> list[str]:
        """Columns that the other side does not have."""
        return [n for n in self.spelled if n not in other]

    def repeated(self) -> list[str]:
        count = Counter(n.lower() for n in self.spelled)
        return sorted(n for n in self.spelled if count[n.lower()] > 1)


def drift_between(columns: Sequence[str], target_columns: Sequence[str]) -> Drift:
    model, target = Names(columns), Names(target_columns)
    return Drift(missing=target.others(model), new=model.others(target))


def as_names(value, purpose: str) -> list[str]:
    """A list of names from nothing, one name, or a list or tuple of them."""
    match value:
        case None:
            return []
        case str():
            return [value] if value.strip() else []
        case list() | tuple() if all(isinstance(n, str) for n in value):
            return [n for n in value if n.strip()]
    raise TypeError(f"{purpose} takes a column name or a list of names, not {value!r}")
