"""Country to sales region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The countries named by each sales region.
REGION_COUNTRIES = {
    "North America": ("United States", "Canada", "Mexico"),
    "Europe": ("United Kingdom", "France", "Germany", "Italy", "Spain"),
    "Asia": ("India", "China", "Japan", "Singapore"),
}
OTHER_REGION = "Other"

# Countries customers live in, in the order of the nation keys 0 to 24.
COUNTRIES = (
    "United States", "Canada", "Mexico", "United Kingdom", "France",
    "Germany", "Italy", "Spain", "India", "China",
    "Japan", "Singapore", "Brazil", "Kenya", "Norway",
    "Peru", "Egypt", "Chile", "Ghana", "Poland",
    "Turkey", "Nepal", "Cuba", "Fiji", "Oman",
)


def region_of_country(country: str | Column) -> Column:
    """The sales region of a country; unnamed and NULL countries are ``Other``."""
    source = F.col(country) if isinstance(country, str) else country
    chosen = F.lit(OTHER_REGION)
    for region, countries in REGION_COUNTRIES.items():
        chosen = F.when(source.isin(*countries), region).otherwise(chosen)
    return chosen
