"""Named relations: the upstream tables an analysis may refer to."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from depotflow.model import PRIMARY_KEYS, TABLES
from depotflow.sources.files import read_dataset
from depotflow.sources.jdbc import Database, read_table

Loader = Callable[[], DataFrame]


class Relations:
    """Name to lazy DataFrame. A loader runs once, when its relation is first asked for."""

    def __init__(self, loaders: Mapping[str, Loader]):
        self._loaders = dict(loaders)
        self._loaded: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaders:
            raise KeyError(f"Unknown relation: {name}")
        if name not in self._loaded:
            self._loaded[name] = self._loaders[name]()
        return self._loaded[name]

    def __contains__(self, name: str) -> bool:
        return name in self._loaders

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def missing(self, required: Iterable[str]) -> list[str]:
        return sorted(set(required) - set(self._loaders))

    def extended(self, **frames: DataFrame) -> Relations:
        """These relations plus, or replaced by, the given frames."""
        grown = Relations(self._loaders | {name: (lambda f=f: f) for name, f in frames.items()})
        grown._loaded = {name: f for name, f in self._loaded.items() if name not in frames}
        return grown

    def publish_views(self, names: Iterable[str] | None = None) -> None:
        """Make relations readable from SQL under their names; nothing is computed."""
        for name in names if names is not None else self.names():
            self[name].createOrReplaceTempView(name)


def parquet_relations(spark: SparkSession, root: str, names: Iterable[str] = tuple(TABLES)) -> Relations:
    """One Parquet dataset per operational table under a folder."""
    return Relations(
        {
            name: (lambda name=name: read_dataset(spark, f"{root}/{name}", TABLES.get(name)))
            for name in names
        }
    )


def jdbc_relations(
    spark: SparkSession,
    database: Database,
    namespace: str = "public",
    partitions: int = 64,
    names: Iterable[str] = tuple(TABLES),
) -> Relations:
    """One database table per operational table, scanned in ranges of its primary key."""
    return Relations(
        {
            name: (
                lambda name=name: read_table(
                    spark, database, f"{namespace}.{name}", PRIMARY_KEYS.get(name), partitions
                )
            )
            for name in names
        }
    )
