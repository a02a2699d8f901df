"""The tables of one data folder, built once per application when first needed."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import attribution, bronze, engagement, episodes, features, metrics
from ..schemas import EPISODE_KEY
from ..sources.staging import drop_path, fresh_path, stage_bucketed
from ..sources.tables import write_partitions
from . import inputs as I


class Tables:
    """Bronze, silver and gold tables of a folder; each is staged, as the steps of a daily run are.

    Tables of one row per episode, or some, lie in as many ``buckets`` by the episode's key, so that steps join them
    where they lie. A production run takes as many buckets as its shuffles have partitions.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 8):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.paths: list[str] = []

    def stage(self, df: DataFrame, label: str, *partition_cols: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        if partition_cols:
            write_partitions(df, path, partition_cols)
        else:
            df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path).select(df.columns)

    def by_episode(self, df: DataFrame, label: str) -> DataFrame:
        staged = stage_bucketed(df, self.buckets, *EPISODE_KEY, label=label, gather=True)
        self.paths.append(staged.staged_path)
        return staged

    def drop(self) -> None:
        """Remove the staged files."""
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()

    def raw(self) -> DataFrame:
        return I.raw_events(self.spark, self.folder)

    def input(self, name: str) -> DataFrame:
        return getattr(I, name)(self.spark, self.folder)

    @property
    def as_of(self):
        return F.lit(I.AS_OF).cast("date")

    @cached_property
    def events(self) -> DataFrame:
        return self.stage(bronze.bronze_events(self.raw(), I.FIRST_DAY, I.LAST_DAY), "bronze", "event_date")

    @cached_property
    def moments(self) -> DataFrame:
        return self.stage(episodes.flow_moments(self.events), "moments")

    @cached_property
    def initiations(self) -> DataFrame:
        found = episodes.initiations(
            self.events, self.input("companies"), cut=lambda df, label: self.moments
        )
        return self.by_episode(found, "initiations")

    @cached_property
    def engagement(self) -> DataFrame:
        return self.by_episode(
            engagement.offer_engagement(self.initiations, self.events, self.input("offers")),
            "engagement",
        )

    @cached_property
    def attribution(self) -> DataFrame:
        return self.by_episode(
            attribution.save_attribution(
                self.initiations,
                self.engagement,
                self.input("reactive_saves"),
                self.input("offer_history"),
            ),
            "attribution",
        )

    @cached_property
    def gold(self) -> DataFrame:
        wide = metrics.final_metrics(
            self.initiations,
            self.attribution,
            self.engagement,
            self.input("subscriber_status"),
            self.as_of,
        )
        return self.stage(wide, "metrics")

    @cached_property
    def features(self) -> DataFrame:
        return self.stage(features.features(self.gold), "features")


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, folder)
    return _TABLES[key]


def forget() -> None:
    """Build everything anew on the next use; the staged files of ended uses go."""
    for (application, _), held in _TABLES.items():
        active = SparkSession.getActiveSession()
        if active is not None and active.sparkContext.applicationId == application:
            held.drop()
    _TABLES.clear()


def plain(df: DataFrame) -> DataFrame:
    """Times without zone, so that a result reads the same in every session."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df
