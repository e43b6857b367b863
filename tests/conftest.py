from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from campaignry import schema as S
from campaignry.session import local_frame, local_session
from campaignry.sources.star import star_tables
from campaignry.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    return star_tables(spark, SMALL)


def frame(spark, table: str, rows: list[dict]):
    """Rows given by a few columns; the others take a plain value of their type."""
    fill = {"integer": 1, "long": 1, "short": 1, "string": "x", "boolean": True, "date": date(2000, 1, 1), "decimal": Decimal("1.00")}
    schema = S.SCHEMAS[table]
    full = []
    for r in rows:
        unknown = set(r) - set(schema.names)
        assert not unknown, unknown
        full.append(tuple(r.get(f.name, None if f.nullable else fill[f.dataType.typeName()]) for f in schema))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return local_frame(spark, full, ddl)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


@pytest.fixture
def make(spark):
    """A complete table set from short row lists."""
    def build(**rows) -> Tables:
        base = {
            "products": [dict(product_id=1, product_code="P1", product_category="Credit Card", revenue_value=money(100), min_eligibility_age=18),
                         dict(product_id=2, product_code="P2", product_category="Home Loan", revenue_value=money(200), min_eligibility_age=18)],
            "campaign_channels": [dict(channel_id=1, channel_name="Email", benchmark_cvr=Decimal("12.00"), benchmark_cpa=money(30)),
                                  dict(channel_id=2, channel_name="SMS", benchmark_cvr=None, benchmark_cpa=None)],
            "customers": [dict(customer_id=i, customer_code=f"C{i}", customer_segment="Mass Market", is_dnc=False,
                               date_of_birth=date(1970, 1, 1)) for i in range(1, 6)],
            "campaigns": [dict(campaign_id=1, campaign_code="A", campaign_type="Upsell", product_id=1, channel_id=1, total_budget=money(100),
                               start_date=date(2001, 1, 10), end_date=date(2001, 2, 20), status="Completed")],
            "campaign_interactions": [], "campaign_conversions": [], "customer_products": [],
        }
        base.update(rows)
        return Tables(**{n: frame(spark, n, r) for n, r in base.items()}, as_of=date(2001, 8, 2))
    return build


def touch(i, customer, campaign=1, day=date(2001, 1, 15), outcome="No Response", kind="Sent", channel=1, variant=None, answered=None):
    return dict(interaction_id=i, customer_id=customer, campaign_id=campaign, interaction_date=day, interaction_outcome=outcome,
                interaction_type=kind, channel_id=channel, ab_variant=variant, response_date=answered)


def won(i, customer, campaign=1, product=1, day=date(2001, 1, 16), revenue=100, kind="New", channel=1, variant=None):
    return dict(conversion_id=i, interaction_id=i, customer_id=customer, campaign_id=campaign, product_id=product, conversion_date=day,
                revenue_attributed=money(revenue), conversion_type=kind, channel_id=channel, ab_variant=variant)


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
