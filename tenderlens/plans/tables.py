"""Result tables that are planned when they are asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping[str, DataFrame]):
    """Tables by name.

    Planning a table takes the driver a moment even if nobody reads it, so each is planned at its first use.
    """

    def __init__(self, plans: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._plans = dict(plans)
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = self._plans[name]()
        return self._planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)
