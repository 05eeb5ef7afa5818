from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A query over the tables of a folder, and the SQL that must give the same rows.

    For entities, ``run`` is ``refine`` of ``payload``; a bench can store the payload and time the rest.
    """

    run: Run
    oracle: str
    payload: Run | None = None
    refine: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Catalog:
    queries: dict[str, Query] = field(default_factory=dict)

    def add(self, name: str, oracle: str) -> Callable[[Run], Run]:
        def keep(run: Run) -> Run:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = Query(lambda spark, folder: portable(run(spark, folder)), oracle)
            return run

        return keep

    def add_entity(
        self, name: str, payload: Run, refine: Callable[[DataFrame], DataFrame], oracle: str
    ) -> None:
        self.add(name, oracle)(lambda spark, folder: refine(payload(spark, folder)))
        kept = self.queries[name]
        self.queries[name] = Query(kept.run, oracle, payload, lambda df: portable(refine(df)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Types that compare across engines: wall-clock timestamps, and amounts as double."""

    def cast(column: T.StructField) -> str | None:
        if isinstance(column.dataType, T.TimestampType):
            return "timestamp_ntz"
        return "double" if isinstance(column.dataType, T.DecimalType) else None

    return df.withColumns(
        {column.name: F.col(column.name).cast(cast(column)) for column in df.schema if cast(column)}
    )
