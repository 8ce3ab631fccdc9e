"""What an analysis is told about its tables: roles of columns by name."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """Roles of columns. row_id identifies a row: Spark has no row order, so nothing is aligned by position."""

    row_id: str
    target: str
    keys: tuple[str, ...] = ()
    time: str | None = None
    block: str | None = None
    category: str | None = None


@dataclass(frozen=True)
class TaskSpec:
    """What is predicted, and how it is judged."""

    kind: str  # regression, binary or multiclass
    metric: str
    greater_is_better: bool
    output: str  # value, label or probability
    labels: tuple[str, ...] = field(default=())
