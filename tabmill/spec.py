"""Table description shared by every step."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """Which column is the row key, which are targets, which are features.

    Rows in Spark have no position, so every step is keyed by ``id``; the
    key is never a feature."""
    id: str
    targets: list[str] = field(default_factory=list)
    features: list[str] = field(default_factory=list)

    def with_features(self, features: list[str]) -> "TableSpec":
        return TableSpec(self.id, list(self.targets), list(features))

    def with_targets(self, targets: list[str]) -> "TableSpec":
        return TableSpec(self.id, list(targets), list(self.features))
