"""Campaign links: normalized parts, controlled vocabularies, query strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vocabularies of a campaign link (fixed values); vocabulary_of() reads those of a builder's own configuration.
VOCABULARY = {
    "source": ["twitter", "telegram", "linkedin", "facebook", "discord", "email", "community"],
    "medium": ["social", "paid_social", "email", "referral", "partner", "cpc", "banner", "push", "sms", "in_app"],
    "initiative": ["ubi", "builders", "governance", "general"],
    "goal": ["awareness", "acquisition", "activation", "retention", "revenue"],
}


def vocabulary_of(config: dict) -> dict[str, list[str]]:
    """Vocabularies of a configuration such as {"sources": [{"value": "email", "label": "Email"}], ...}."""
    return {k.removesuffix("s"): [v["value"] for v in values] for k, values in config.items() if isinstance(values, list)}


NAME = r"^[a-z0-9_]*$"


def slug(text: Column) -> Column:
    """Lower case, outer white space gone, inner white space as one underscore."""
    return F.regexp_replace(F.lower(F.trim(text)), r"\s+", "_")


def campaign(initiative: Column, goal: Column, day: Column, name: Column) -> Column:
    """initiative-goal-YYYY_MM-name."""
    return F.concat_ws("-", slug(initiative), slug(goal), F.date_format(day, "yyyy_MM"), slug(name))


def tagged_url(url: Column, source: Column, medium: Column, campaign_: Column, content: Column) -> Column:
    """The URL with its campaign parameters, after ? or & as it needs; null unless it is http or https. A fragment stays
    at the end."""
    base, tail = F.regexp_extract(url, r"^([^#]*)", 1), F.regexp_extract(url, r"(#.*)$", 1)
    pairs = F.concat_ws("&", *[F.when(F.length(v) > 0, F.concat(F.lit(f"utm_{k}="), F.url_encode(v))) for k, v in (("source", slug(source)), ("medium", slug(medium)), ("campaign", campaign_), ("content", slug(content)))])
    return F.when(F.lower(url).rlike(r"^https?://[^\s/]+"), F.concat(base, F.when(F.contains(base, F.lit("?")), "&").otherwise("?"), pairs, tail))


def campaign_link(url: Column, source: Column, medium: Column, initiative: Column, goal: Column, day: Column, name: Column, content: Column) -> Column:
    """The tagged URL of a campaign; null if a part but content is missing, the name isn't of a-z, 0-9 and _ after it is
    normalized, or the URL isn't http or https. Content that isn't of these characters is left out."""
    given = lambda c: F.length(F.coalesce(slug(c), F.lit(""))) > 0
    complete = given(source) & given(medium) & given(initiative) & given(goal) & given(name) & day.isNotNull() & slug(name).rlike(NAME)
    return F.when(complete, tagged_url(url, source, medium, campaign(initiative, goal, day, name), F.when(slug(content).rlike(NAME), content)))


def query_value(url: Column, key: str) -> Column:
    """The value of a parameter of a URL; null if the URL or the parameter isn't there."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(key))


def campaign_parts(campaign_: Column) -> Column:
    """initiative, goal, month and name of a campaign."""
    part = F.split(campaign_, "-", 4)
    return F.struct(*[F.try_element_at(part, F.lit(i + 1)).alias(n) for i, n in enumerate(("initiative", "goal", "month", "name"))])


def unknown_values(values: DataFrame, field: str, vocabulary: list[str] | None = None) -> DataFrame:
    """Rows whose normalized `field` isn't in its vocabulary (a small fixed list, so a literal set)."""
    return values.where(F.col(field).isNull() | ~slug(F.col(field)).isin(vocabulary or VOCABULARY[field]))
