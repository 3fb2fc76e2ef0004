"""Traffic-medium classification (treatment flag and channel grouping)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media that count as paid exposure, and the channel labels.
PAID_MEDIA = ("cpc", "cpm", "ppc", "paid")
CHANNELS = ("paid", "organic", "referral", "direct", "other")


def is_paid_medium(medium: Column | str) -> Column:
    """``medium IN (paid media)`` under three-valued logic (NULL stays NULL)."""
    m = F.col(medium) if isinstance(medium, str) else medium
    return m.isin(*PAID_MEDIA)


def channel_of(medium: Column | str) -> Column:
    """paid -> organic -> referral -> direct ('(none)' or NULL) -> other."""
    m = F.col(medium) if isinstance(medium, str) else medium
    return (F.when(m.isin(*PAID_MEDIA), "paid")
            .when(m == "organic", "organic")
            .when(m == "referral", "referral")
            .when((m == "(none)") | m.isNull(), "direct")
            .otherwise("other"))
