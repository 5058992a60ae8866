"""Entities kept up to date by day, instead of derived from a month of sources for each query."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from flowspark.functions import instant
from flowspark.functions.times import PARTITION_DAY
from flowspark.operators.aws import entities as aws
from flowspark.operators.azure import entities as azure
from flowspark.operators.gcp import entities as gcp
from flowspark.operators.parts import EntityView, Part
from flowspark.sources import replace_days

ENTITY_VIEWS: dict[str, EntityView] = {
    "aws_instances": aws.INSTANCES,
    "aws_enis": aws.ENIS,
    "azure_nics": azure.NICS,
    "azure_vms": azure.VMS,
    "azure_vms_nics": azure.VMS_NICS,
    "gcp_vms": gcp.VMS,
}
_EPOCH = date(1970, 1, 1)
_DAY = timedelta(days=1)


def _span(lookback: str | timedelta) -> timedelta:
    if isinstance(lookback, timedelta):
        return lookback
    number, unit = lookback.split()
    return timedelta(**{unit if unit.endswith("s") else f"{unit}s": float(number)})


class EntityDays:
    """The parts of entity views in a folder that all executors share, a table each, cut by day of recording.

    `merge` folds days of the sources and replaces them in the tables, so a day that came late or twice is simply merged again,
    and a run that was lost is repeated. `view` makes the entities from the days of their look-back. The first of these
    days usually lies only partly within it: that one is folded from the sources again, from the instant on. So views
    equal the operators over the sources, which are read for one day at the most.
    """

    def __init__(self, spark: SparkSession, path: str, sources: Mapping[str, DataFrame]):
        self._spark, self._path, self._sources = spark, path, dict(sources)
        self._views = {}
        for name, view in ENTITY_VIEWS.items():
            if all(self._has(part) for part in view.parts) and set(view.views) <= self._views.keys():
                self._views[name] = view

    def _has(self, part: Part) -> bool:
        return set(part.sources) <= self._sources.keys()

    def _inputs(self, part: Part) -> list[DataFrame]:
        return [self._sources[name] for name in part.sources]

    def _parts(self) -> dict[str, Part]:
        return {part.name: part for view in self._views.values() for part in view.parts}

    def __iter__(self):
        return iter(self._views)

    def merge(self, *days: date) -> None:
        """Fold these days of the sources, without any given all of them."""
        numbers = [(day - _EPOCH).days for day in days] or None
        for name, part in self._parts().items():
            replace_days(part.by_day(self._inputs(part), numbers), f"{self._path}/{name}", numbers or ())

    def _kept(self, part: Part) -> DataFrame:
        fields = part.by_day(self._inputs(part)).schema
        schema = type(fields)([f for f in fields if f.name != PARTITION_DAY]).add(PARTITION_DAY, IntegerType())
        return self._spark.read.schema(schema).parquet(f"{self._path}/{part.name}")

    def part(self, part: Part, now: datetime, lookback: str | timedelta | None) -> DataFrame:
        """A part over the last `lookback`, or over all days."""
        kept = self._kept(part)
        if lookback is not None and part.latest is not None:
            return part.fold(kept).where(F.col(part.latest) >= instant(now - _span(lookback)))
        if lookback is not None:
            start = now - _span(lookback)
            day, rest = divmod(start - datetime(1970, 1, 1, tzinfo=timezone.utc), _DAY)
            kept = kept.where(F.col(PARTITION_DAY) >= day + bool(rest))
            if rest:
                kept = kept.unionByName(part.by_day(self._inputs(part), [day], start))
        return part.fold(kept)

    def view(self, name: str, now: datetime | None = None, lookbacks: Mapping[str, str | timedelta | None] | None = None) -> DataFrame:
        """An entity view of now. `lookbacks` by name of a part; others have the look-back of the operator."""
        now = now or datetime.now(timezone.utc)
        now = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
        view, spans = self._views[name], dict(lookbacks or {})
        parts = [self.part(part, now, spans.get(part.name, part.lookback)) for part in view.parts]
        return view.build(*parts, *[self.view(other, now, lookbacks) for other in view.views])
