"""Rules that choose between the owner's and the renter's statement."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANK = ""
# Codes and phrases of the declaration forms.
UNINFORMATIVE_ACTIVITIES = ("No Activity", "Unspecified")
NON_SCHEME_USE = "NON_SAF"
TEMPORARY_GRASS = "TGRS"
ROUGH_GRAZING = "RGR"


def coalesce_sides(owner: Column, user: Column) -> Column:
    """The side that is present, for rows that have one side only."""
    return F.coalesce(owner, user)


def choose_activity(owner: Column, user: Column) -> Column:
    """The renter knows best, unless the renter's entry is blank or says nothing."""
    vague = user.isin(*UNINFORMATIVE_ACTIVITIES) & (owner != BLANK)
    return (
        F.when(owner == BLANK, user)
        .when((user == BLANK) | vague, owner)
        .otherwise(user)
    )


def choose_status(owner: Column, user: Column) -> Column:
    """A status that mentions an action wins; otherwise the owner's."""
    return F.when(
        (owner != user) & ~owner.contains("Action") & user.contains("Action"), user
    ).otherwise(owner)


def effective_use(owner: Column, user: Column) -> Column:
    """The renter's land use unless missing or outside the scheme."""
    return F.when(user.isNull() | (user == NON_SCHEME_USE), owner).otherwise(user)


def collapse_prefix(code: Column, prefix: str = TEMPORARY_GRASS) -> Column:
    """All codes that start with the prefix count as one code."""
    return F.when(code.startswith(prefix), F.lit(prefix)).otherwise(code)
