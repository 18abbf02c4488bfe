"""Property type of a listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelstar.constants import API_PROPERTY_LABELS, UNKNOWN_TYPE


def type_from_bedrooms(bed: Column) -> Column:
    """No bedroom is a studio, up to four a single family home, five or more multi family.

    The first that holds counts. NULL and a fraction between four and five are unknown.
    """
    return (
        F.when(bed == 0, "studio")
        .when(bed <= 4, "single_family")
        .when(bed >= 5, "multi_family")
        .otherwise(UNKNOWN_TYPE)
    )


def type_from_label(label: Column) -> Column:
    """Exact label to type; any other label, or none, is unknown."""
    types = F.create_map(*[F.lit(text) for pair in API_PROPERTY_LABELS for text in pair])
    return F.coalesce(types[label], F.lit(UNKNOWN_TYPE))
