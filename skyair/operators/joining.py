"""Joins: full outer by shared keys, enrichment, bounding boxes, country names.

The dimension side of J2-J4 is usually small but not known to be, so no join carries a hint: adaptive execution
broadcasts a side by its measured bytes and otherwise splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyair.operators.skew import lookup_join
from skyair.schemas import BOXES, LONGITUDE_RANGE


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with the key columns of both sides merged. Null keys never match.

    A full join cannot be split by the engine, so it is made of two that can: the left join, and the rows
    of the right side that match nothing. Where both sides are unique in the keys (aggregates over them),
    pass them as they are: no key is hot then, and ``aligned_full_join`` adds no shuffle.
    """
    both = left.join(right, list(keys), "left")
    alone = right.join(left.select(*keys), list(keys), "left_anti")
    return both.unionByName(alone, allowMissingColumns=True)


def aligned_full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J1 for sides that hold each key once, such as aggregates grouped by ``keys``: one full outer join."""
    return left.join(right, list(keys), "full")


def enrich(readings: DataFrame, sensors: DataFrame, on: str = "sensor_id") -> DataFrame:
    """Attach sensor and location metadata; readings of unknown sensors are dropped."""
    return lookup_join(readings, sensors, [on])


def parse_boxes(spark: SparkSession, text: str) -> DataFrame:
    """``name,lamin,lomin,lamax,lomax`` groups separated by a bar, blanks around parts ignored."""
    rows = []
    for group in text.split("|"):
        parts = [part.strip() for part in group.split(",")]
        if len(parts) != 5:
            raise ValueError(f"a box needs a name and four numbers, got {group!r}")
        rows.append((parts[0], *map(float, parts[1:])))
    return spark.createDataFrame(rows, BOXES)


class PlacedBoxes(NamedTuple):
    """Boxes on a grid of several levels; make it once where many batches meet the same boxes."""

    cells: DataFrame
    levels: tuple[int, ...]
    cell: float


def _cell_of(value: Column, level: Column, cell: float) -> Column:
    return F.floor(value / (F.lit(cell) * F.pow(F.lit(2.0), level))).cast("bigint")


def place_boxes(boxes: DataFrame, cell: float = 1.0) -> PlacedBoxes:
    """Put every box on the level whose cells are at least as long as its longer side.

    Level k has cells of ``cell`` * 2^k degrees, so a box touches about four cells whatever its size. A
    box whose western edge lies east of its eastern one runs over the date line: it is placed as two, which
    share no point. One whose southern edge lies north of its northern one contains nothing. One small job
    finds the levels in use.
    """
    over = boxes.filter(F.col("lomin") > F.col("lomax"))
    for edge, end in (("lomax", LONGITUDE_RANGE[1]), ("lomin", LONGITUDE_RANGE[0])):
        boxes = boxes.unionByName(over.withColumn(edge, F.lit(end)))
    side = F.greatest(F.col("lamax") - F.col("lamin"), F.col("lomax") - F.col("lomin"), F.lit(cell))
    level = F.ceil(F.log2(side / F.lit(cell))).cast("int")
    sound = boxes.filter((F.col("lamin") <= F.col("lamax")) & (F.col("lomin") <= F.col("lomax")))
    placed = sound.withColumn("__level", level)
    levels = tuple(sorted(row[0] for row in placed.select("__level").distinct().collect()))
    for name, low, high in (("__lat", "lamin", "lamax"), ("__lon", "lomin", "lomax")):
        touched = F.sequence(*(_cell_of(F.col(edge), F.col("__level"), cell) for edge in (low, high)))
        placed = placed.withColumn(name, F.explode(touched))
    return PlacedBoxes(placed, levels, cell)


def tag_regions(
    points: DataFrame,
    boxes: DataFrame | PlacedBoxes,
    latitude: str = "latitude",
    longitude: str = "longitude",
    cell: float = 1.0,
) -> DataFrame:
    """One row per point and box that contains it (edges included), with the box's ``region``.

    An equi-join on grid cells, then the exact comparison, so no pair of point and distant box is ever
    formed: a point looks up its cell on each level that has a box. Points in no box drop out.
    """
    if not isinstance(boxes, PlacedBoxes):
        boxes = place_boxes(boxes, cell)
    placed = points.withColumn("__level", F.explode(F.lit(list(boxes.levels)).cast("array<int>")))
    for name, value in (("__lat", latitude), ("__lon", longitude)):
        placed = placed.withColumn(name, _cell_of(F.col(value), F.col("__level"), boxes.cell))
    inside = F.col(latitude).between(F.col("lamin"), F.col("lamax")) & F.col(longitude).between(
        F.col("lomin"), F.col("lomax")
    )
    return lookup_join(placed, boxes.cells, ["__level", "__lat", "__lon"]).filter(inside).select("region", *points.columns)


def conform_country(df: DataFrame, mapping: DataFrame, country: str = "country") -> DataFrame:
    """Replace country names by the form given in ``mapping`` (alias, country).

    Unmapped values pass through. An alias listed twice takes its smallest country, so rows never
    multiply.
    """
    unique = mapping.groupBy(F.col("alias").alias(country)).agg(F.min("country").alias("__conformed"))
    joined = lookup_join(df, unique, [country], "left")
    conformed = F.coalesce("__conformed", F.col(country)).alias(country)
    return joined.select(*(conformed if name == country else F.col(name) for name in df.columns))


def unmapped_countries(df: DataFrame, mapping: DataFrame, country: str = "country") -> DataFrame:
    """Countries that ``mapping`` does not know, as alias or target, with their row counts.

    Rows are counted per country before the comparison, so only the distinct countries are joined.
    """
    counts = df.groupBy(country).agg(F.count(F.lit(1)).alias("row_count"))
    known = mapping.select(F.explode(F.array("alias", "country")).alias(country)).distinct()
    return counts.join(known, country, "left_anti")
