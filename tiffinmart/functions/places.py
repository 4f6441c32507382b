"""Derivations of the location entity."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# State renamed on load, state codes, union territories, capital pairs, city tiers.
STATE_RENAMES = {"Delhi": "New Delhi"}
STATE_CODES = {
    "Delhi": "DL",
    "Maharashtra": "MH",
    "Uttar Pradesh": "UP",
    "Gujarat": "GJ",
    "Rajasthan": "RJ",
    "Kerala": "KL",
    "Punjab": "PB",
    "Karnataka": "KA",
    "Madhya Pradesh": "MP",
    "Odisha": "OR",
    "Chandigarh": "CH",
    "West Bengal": "WB",
    "Sikkim": "SK",
    "Andhra Pradesh": "AP",
    "Assam": "AS",
    "Jammu and Kashmir": "JK",
    "Puducherry": "PY",
    "Uttarakhand": "UK",
    "Himachal Pradesh": "HP",
    "Tamil Nadu": "TN",
    "Goa": "GA",
    "Telangana": "TG",
    "Chhattisgarh": "CG",
    "Jharkhand": "JH",
    "Bihar": "BR",
}
UNION_TERRITORIES = ("Delhi", "Chandigarh", "Puducherry", "Jammu and Kashmir")
CAPITALS = (("Delhi", "New Delhi"), ("Maharashtra", "Mumbai"))
TIER_1 = ("Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Kolkata", "Pune", "Ahmedabad")
TIER_2 = (
    "Jaipur", "Lucknow", "Kanpur", "Nagpur", "Indore", "Bhopal", "Patna", "Vadodara", "Coimbatore",
    "Ludhiana", "Agra", "Nashik", "Ranchi", "Meerut", "Raipur", "Guwahati", "Chandigarh",
)


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def state_name(state: Column) -> Column:
    renamed = state
    for old, new in STATE_RENAMES.items():
        renamed = F.when(state == old, new).otherwise(renamed)
    return renamed


def state_code(state: Column) -> Column:
    """Two-letter code of the raw state name, NULL when unknown. A literal map, so no join."""
    return F.try_element_at(_literal_map(STATE_CODES), state)


def is_union_territory(state: Column) -> Column:
    return F.coalesce(state.isin(*UNION_TERRITORIES), F.lit(False))


def is_capital_city(state: Column, city: Column) -> Column:
    hit = F.lit(False)
    for s, c in CAPITALS:
        hit = hit | ((state == s) & (city == c))
    return F.coalesce(hit, F.lit(False))


def city_tier(city: Column) -> Column:
    return F.when(city.isin(*TIER_1), "Tier-1").when(city.isin(*TIER_2), "Tier-2").otherwise("Tier-3")
