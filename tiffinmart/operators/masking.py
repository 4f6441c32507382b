"""Column masking, by explicit policy or by the classification tag of a column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.entities import Entity

TAG = "pii_policy_tag"

# Allowed tags and the text each policy shows ('** EAMIL **' is spelled so).
ALLOWED_TAGS = ("PII", "PRICE", "SENSITIVE", "EMAIL")
POLICIES = {"pii": "** PII **", "email": "** EAMIL **", "phone": "** Phone **"}
TAG_POLICIES = {"PII": "pii", "EMAIL": "email", "SENSITIVE": "phone"}


def mask_columns(df: DataFrame, policies: Mapping[str, str]) -> DataFrame:
    """Replace every value of the named columns, NULLs too, by the text of its policy."""
    return df.withColumns({c: F.lit(POLICIES[p]) for c, p in policies.items()})


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Record classification tags in the column metadata, where they travel with the schema."""
    for c, tag in tags.items():
        if tag not in ALLOWED_TAGS:
            raise ValueError(f"tag {tag!r} is not one of {ALLOWED_TAGS}")
        df = df.withMetadata(c, {**df.schema[c].metadata, TAG: tag})
    return df


def entity_tags(entity: Entity | str) -> dict[str, str]:
    return {f.name: f.tag for f in entities.get(entity).fields if f.tag}


def mask_by_tag(df: DataFrame) -> DataFrame:
    """Mask the columns whose tag has a policy; PRICE columns stay readable."""
    tagged = {f.name: f.metadata.get(TAG) for f in df.schema.fields}
    return mask_columns(df, {c: TAG_POLICIES[t] for c, t in tagged.items() if t in TAG_POLICIES})
