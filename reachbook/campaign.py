"""The inputs of a report: three tables and the moment it is taken."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reachbook.functions import classify
from reachbook.functions.calendar import AsOf
from reachbook.operators import filters
from reachbook.operators.sideways import Bloom, key_filter
from reachbook.sources import tables


@dataclass(frozen=True)
class Campaign:
    """Conformed input tables plus the choices a report leaves open.

    `unmapped_first` keeps messages with an unlisted disposition ahead of
    listed ones when the best message is picked; False puts them last.
    `reduce` filters loan book and areas to messaged agreements before they are
    shuffled: worth its second look at the messages' agreement numbers where most
    agreements get none. Results are the same.
    """

    activity: DataFrame
    loans: DataFrame
    areas: DataFrame
    as_of: AsOf
    products: tuple[str, ...] = classify.PRODUCTS
    run_channels: tuple[str, ...] = classify.RUN_CHANNELS
    message_channels: tuple[str, ...] = classify.MESSAGE_CHANNELS
    unmapped_first: bool = True
    reduce: Bloom | None = None
    #: The areas as stored, if their snapshot key may be compared there.
    stored_areas: DataFrame | None = None

    @classmethod
    def of(
        cls,
        activity: DataFrame,
        loans: DataFrame,
        areas: DataFrame,
        as_of: AsOf,
        *,
        collation: str | None = None,
        **choices,
    ) -> Campaign:
        """Build from any three DataFrames that have the declared columns."""
        return cls(
            tables.conform(activity, tables.ACTIVITY, collation),
            tables.conform(loans, tables.LOANS, collation),
            tables.conform(areas, tables.AREAS, collation),
            as_of,
            stored_areas=None if collation else areas,
            **choices,
        )

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, as_of: AsOf, activity: str, loans: str, areas: str, **options
    ) -> Campaign:
        """Build from catalog tables, named with up to three parts."""
        return cls.of(spark.table(activity), spark.table(loans), spark.table(areas), as_of, **options)

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, as_of: AsOf, activity: str, loans: str, areas: str, **options
    ) -> Campaign:
        """Build from parquet paths; store activity by pt and loans by ReportDate."""
        read = spark.read.parquet
        return cls.of(read(activity), read(loans), read(areas), as_of, **options)

    @cached_property
    def messages(self) -> DataFrame:
        return filters.month_to_date(self.activity, self.as_of)

    @cached_property
    def snapshots(self) -> DataFrame:
        return filters.snapshot_window(self.loans, self.as_of)

    @cached_property
    def month_end_areas(self) -> DataFrame:
        areas = self.areas
        if self.stored_areas is not None:
            # A test that the files understand comes first; the exact one follows.
            areas = tables.conform(filters.near_month_end(self.stored_areas, self.as_of), tables.AREAS)
        return filters.month_end_snapshot(areas, self.as_of)

    @cached_property
    def _messaged(self):
        """A test for agreements with messages this month; none under a collation,
        where equal numbers may differ as bytes."""
        plain = self.messages.schema["agreement_key"].dataType == T.StringType()
        if self.reduce is None or not plain:
            return None
        channels = tuple(dict.fromkeys((*self.run_channels, *self.message_channels)))
        keys = self.messages.where(filters.in_channels(channels, stored=True)).select("agreement_key")
        return key_filter(keys, "agreement_key", self.reduce)

    @cached_property
    def served_snapshots(self) -> DataFrame:
        """The month's snapshots of at least every agreement with messages."""
        return self.snapshots.where(self._messaged("agreement_key")) if self._messaged else self.snapshots

    @cached_property
    def served_areas(self) -> DataFrame:
        """Their areas at the month's end."""
        areas = self.month_end_areas
        return areas.where(self._messaged("agreement_key")) if self._messaged else areas
