"""State payloads to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skyair.operators.joining import tag_regions
from skyair.operators.shaping import unpack_states
from skyair.schemas import FLIGHTS


def parse_states(
    payloads: DataFrame, boxes: DataFrame | None = None, payload: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Payload text to state records, for a stream as for a batch.

    With ``boxes`` a position gets one record per box that contains it and none outside all boxes;
    without, the region is whatever ``keep`` carries along from the source.
    """
    states = unpack_states(payloads, payload, keep)
    if boxes is None:
        return states
    extra = [name for name in keep if name not in FLIGHTS.names]
    return tag_regions(states, boxes).select(*extra, *FLIGHTS.names)
