"""Load statistics K9."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Row


@dataclass(frozen=True)
class LoadStats:
    """Exact counters of one load."""

    rows_from_api: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_skipped: int = 0
    rows_filtered: int = 0

    @property
    def rows_written(self) -> int:
        return self.rows_inserted + self.rows_updated

    def to_dict(self) -> dict[str, int]:
        return {**asdict(self), "rows_written": self.rows_written}

    @classmethod
    def from_row(cls, row: Row) -> "LoadStats":
        return cls(*[row[f] for f in cls.__dataclass_fields__])

    def __add__(self, other: "LoadStats") -> "LoadStats":
        return LoadStats(*[getattr(self, f) + getattr(other, f) for f in self.__dataclass_fields__])
