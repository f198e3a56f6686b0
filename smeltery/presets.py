"""Ready-made specs for the public brewery listing."""

from __future__ import annotations

from pyspark.sql import types as T

from smeltery.spec import CountSpec, TableSpec

# Table names, columns in published order, types and rules.
COLUMNS = (
    "id",
    "name",
    "brewery_type",
    "street",
    "address_2",
    "address_3",
    "city",
    "postal_code",
    "country",
    "longitude",
    "latitude",
    "phone",
    "website_url",
    "state",
)
BREWERIES = TableSpec(
    "silver_brewery_list",
    dict.fromkeys(COLUMNS, "string"),
    key=("id",),
    required=("state", "id", "brewery_type"),
    clean=("state",),
    partition_by=("state",),
    stamp="dt_ingestion",
)
BREWERIES_PER_STATE = CountSpec(
    "gold_brewery_list",
    keys=("state", "brewery_type"),
    quantity="brewery_quantity",
    quantity_type=T.IntegerType(),
    stamp="dt_ingestion",
)
