"""What an observation table looks like: its key, period and measure columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# Calendar seasons; winter is December, January, February of the same year.
SEASONS = (
    ("winter", (12, 1, 2)),
    ("spring", (3, 4, 5)),
    ("summer", (6, 7, 8)),
    ("autumn", (9, 10, 11)),
)

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Measure:
    """A numeric column. ``scale`` is a number of decimals that its values never exceed.

    Sums are exact, so that means do not depend on the order in which tasks finish. With a scale they are sums
    of integers, which are fast; it may be larger than needed, but values with more decimals would be rounded. Without
    one, doubles are cut into limbs and added as these, at several times the cost.
    """

    name: str
    label: str = ""
    unit: str = ""
    scale: int | None = None


@dataclass(frozen=True)
class ObservationSpec:
    """One row per (entity, year, month), and one double column per measure."""

    measures: tuple[Measure, ...]
    entity: str = "station"
    year: str = "year"
    month: str = "month"
    seasons: tuple[tuple[str, tuple[int, ...]], ...] = SEASONS
    types: tuple[tuple[str, str], ...] = ()

    @property
    def measure_names(self) -> list[str]:
        return [m.name for m in self.measures]

    @property
    def columns(self) -> list[tuple[str, str]]:
        """Ordered (name, type name) pairs; the default types unless ``types`` gives others."""
        if self.types:
            return list(self.types)
        keys = [(self.entity, "string"), (self.year, "int"), (self.month, "int")]
        return keys + [(name, "double") for name in self.measure_names]

    @property
    def values(self) -> list[str]:
        """Columns after entity, year and month, in the order in which text lines have them."""
        return [name for name, _ in self.columns if name not in (self.entity, self.year, self.month)]

    def struct_type(self, values_as_strings: bool = False, provisional: bool = False) -> T.StructType:
        """Schema of the stored table. Legacy-cleaned tables keep their values as strings; strictly
        cleaned ones can be read with their ``provisional`` flag.
        """
        names = set(self.values) if values_as_strings else set()
        fields = [
            T.StructField(name, T.StringType() if name in names else _TYPES[kind])
            for name, kind in self.columns
        ]
        if provisional:
            fields.append(T.StructField("provisional", T.BooleanType()))
        return T.StructType(fields)

    @classmethod
    def from_config(
        cls,
        config: Mapping,
        labels: Mapping[str, tuple[str, str]] | None = None,
        scales: Mapping[str, int] | None = None,
    ) -> ObservationSpec:
        """Build a spec from a job's settings: ``schema`` (a list of cname/ctype pairs in the order of
        the text, of which the first three are entity, year and month), ``measuresCols``, and
        optionally ``winterMonths`` and so on; all of it may stand under ``config``. ``labels`` gives each
        measure's wording and unit, ``scales`` the decimals of those that are known to have so many.
        """
        config = config.get("config", config)
        types = tuple((field["cname"], field["ctype"]) for field in config["schema"])
        unknown = [kind for _, kind in types if kind not in _TYPES]
        if unknown:
            raise ValueError(f"unknown column types {unknown}; known are {sorted(_TYPES)}")
        labels, scales = labels or {}, scales or {}
        measures = tuple(
            Measure(name, *labels.get(name, (name, "")), scale=scales.get(name)) for name in config["measuresCols"]
        )
        (entity, _), (year, _), (month, _) = types[:3]
        seasons = tuple((name, tuple(config.get(f"{name}Months", months))) for name, months in SEASONS)
        return cls(measures, entity, year, month, seasons, types)


DECIMALS = 4  # station reports have one; the rest is room

# The measures of monthly station reports, their wording and units.
STATION_REPORT = ObservationSpec(
    measures=(
        Measure("tmax", "maximum temperature", "degC", DECIMALS),
        Measure("tmin", "minimum temperature", "degC", DECIMALS),
        Measure("af", "frosty days", "days", DECIMALS),
        Measure("rain", "rainfall", "mm", DECIMALS),
        Measure("sun", "sunshine", "hours", DECIMALS),
    )
)
