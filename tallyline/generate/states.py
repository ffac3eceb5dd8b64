"""Sales by state and a small table of categories per state, with repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.draws import below, digest, pick
from tallyline.generate.star import SEED, person_name

#: Rows of the category table, drawn with replacement.
CATEGORY_ROWS = 50

# The states.
STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa",
    "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan",
    "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire",
    "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio",
    "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota",
    "Tennessee", "Texas", "Utah", "Vermont", "Virginia", "Washington", "West Virginia",
    "Wisconsin", "Wyoming",
)


def state_sales(ids: DataFrame, seed: int = SEED) -> DataFrame:
    drawn = ids.select("id", digest(seed, "state sale", "id").alias("d"))
    return drawn.select(
        "id",
        person_name("d").alias("name"),
        pick("d", 17, 8, STATES).alias("state"),
        (below("d", 25, 8, 901) + 100).alias("sales"),
    )


def state_categories(ids: DataFrame, seed: int = SEED) -> DataFrame:
    drawn = ids.select("id", digest(seed, "state category", "id").alias("d"))
    return drawn.select(
        pick("d", 1, 8, STATES).alias("state"),
        (below("d", 9, 8, 5) + F.lit(1)).alias("category"),
    )
