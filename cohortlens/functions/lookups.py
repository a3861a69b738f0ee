"""Small constant lookups (country code -> name / region) and a generic
lookup with default.

Constant maps are inlined as a literal ``map`` expression: no join and no
shuffle, the map travels with the plan.  A lookup whose mapping is itself a
DataFrame (e.g. nation -> region from the dimension tables) is a left join;
Spark broadcasts it when its size statistics are under
``autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's lookups) --------------------
# ISO-2 country code -> display name.
COUNTRY_NAMES: dict[str, str] = {
    "US": "United States", "GB": "United Kingdom", "DE": "Germany", "FR": "France",
    "CA": "Canada", "JP": "Japan", "AU": "Australia", "BR": "Brazil", "IN": "India",
    "MX": "Mexico", "IT": "Italy", "ES": "Spain", "NL": "Netherlands", "SE": "Sweden",
    "NO": "Norway", "DK": "Denmark", "CH": "Switzerland", "PL": "Poland", "PT": "Portugal",
    "BE": "Belgium", "AT": "Austria", "SG": "Singapore", "NZ": "New Zealand",
    "ZA": "South Africa", "AE": "United Arab Emirates", "TH": "Thailand",
    "MY": "Malaysia", "PH": "Philippines", "ID": "Indonesia", "KR": "South Korea",
    "TW": "Taiwan", "HK": "Hong Kong", "AR": "Argentina", "CL": "Chile",
    "CO": "Colombia", "NG": "Nigeria", "EG": "Egypt",
}
# ISO-2 country code -> region; codes not listed fall in "Other".
REGION_OF: dict[str, str] = {
    "US": "Americas", "CA": "Americas", "MX": "Americas", "BR": "Americas",
    "AR": "Americas", "CL": "Americas", "CO": "Americas",
    "GB": "Europe", "DE": "Europe", "FR": "Europe", "IT": "Europe", "ES": "Europe",
    "NL": "Europe", "SE": "Europe", "NO": "Europe", "DK": "Europe", "CH": "Europe",
    "PL": "Europe", "PT": "Europe", "BE": "Europe", "AT": "Europe",
    "JP": "APAC", "AU": "APAC", "IN": "APAC", "SG": "APAC", "NZ": "APAC",
    "TH": "APAC", "MY": "APAC", "PH": "APAC", "ID": "APAC", "KR": "APAC",
    "TW": "APAC", "HK": "APAC",
    "AE": "Middle East", "ZA": "Africa", "NG": "Africa", "EG": "Africa",
}
REGION_DEFAULT = "Other"
# ---------------------------------------------------------------------------


def map_column(mapping: dict, key) -> Column:
    """``mapping[key]`` as a native map lookup; NULL when the key is absent."""
    key = F.col(key) if isinstance(key, str) else key
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return literal[key]


def lookup(df: DataFrame, key: str, mapping: dict | DataFrame, out: str, default=None,
           default_to_key: bool = False) -> DataFrame:
    """Add ``out`` = mapping[key], else ``default`` (or the key itself).

    ``mapping`` is either a Python dict (inlined literal map) or a two-column
    DataFrame ``(key, out)`` joined on ``key``.
    """
    fallback = F.col(key) if default_to_key else F.lit(default)
    if isinstance(mapping, dict):
        return df.withColumn(out, F.coalesce(map_column(mapping, key), fallback))
    m = mapping.select(F.col(mapping.columns[0]).alias(key), F.col(mapping.columns[1]).alias("__lookup"))
    return (df.join(m, on=key, how="left")
              .withColumn(out, F.coalesce(F.col("__lookup"), fallback))
              .drop("__lookup"))
