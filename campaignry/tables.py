"""The seven tables an operator works on, and the size-checked dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_ROWS = 200_000
SMALL_BYTES = 16 << 20


def if_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Broadcast hint only after measuring at most max_rows + 1 rows in bytes; otherwise Spark chooses the join."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    width = sum(text, F.lit(16 * len(df.columns)))  # a fixed-size value takes 16 bytes at most
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if seen["n"] <= max_rows and seen["bytes"] <= max_bytes else df


@dataclass
class Tables:
    products: DataFrame
    campaign_channels: DataFrame
    customers: DataFrame
    campaigns: DataFrame
    campaign_interactions: DataFrame
    campaign_conversions: DataFrame
    customer_products: DataFrame
    as_of: date
    folder: str | None = None
    _memo: dict = field(default_factory=dict, repr=False)  # views, features and models computed so far
    _dims: dict = field(default_factory=dict, repr=False)  # dimensions whose size has been checked

    @property
    def spark(self):
        return self.customers.sparkSession

    @property
    def today(self) -> Column:
        """Stands for the wall clock in every query that looks back in time."""
        return F.lit(self.as_of).cast("date")

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def _dim(self, name: str, build) -> DataFrame:
        if name not in self._dims:
            self._dims[name] = if_small(build())
        return self._dims[name]

    def channel_dim(self) -> DataFrame:
        return self._dim("channel", lambda: self.campaign_channels.select(
            "channel_id", "channel_name", "benchmark_ctr", "benchmark_cvr", "benchmark_cpa"))

    def product_dim(self) -> DataFrame:
        return self._dim("product", lambda: self.products.select(
            "product_id", "product_name", "product_category", "revenue_value"))

    def product_category(self) -> DataFrame:
        return self.product_dim().select("product_id", "product_category")

    def campaign_dim(self) -> DataFrame:
        """Campaign with its product and channel."""
        return self._dim("campaign", lambda: self.campaigns.join(self.product_dim(), "product_id").join(
            self.channel_dim(), "channel_id"))
