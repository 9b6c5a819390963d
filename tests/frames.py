"""Hand-made raw frames for unit tests (schemas of acqlens.schemas)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql.types import StructField, StructType, TimestampNTZType

from acqlens.schemas import LOADED_AT, RAW_APPSFLYER, RAW_BACKEND, RAW_SINGULAR, RAW_SKAN
from acqlens.sources.fixtures import RawSources

STAMP = dt.datetime(2024, 3, 1)


def _rows(schema, rows):
    names = [f.name for f in schema.fields]
    return [tuple(r.get(n) for n in names) + (r.get(LOADED_AT, STAMP),) for r in rows]


def frame(spark, schema, rows):
    full = StructType(list(schema.fields) + [StructField(LOADED_AT, TimestampNTZType())])
    return spark.createDataFrame(_rows(schema, rows), full)


def install(dev, media="Meta", campaign="c1", t=dt.datetime(2024, 1, 1, 10, 0), country="SI", platform="ios", **kw):
    return dict(appsflyer_id=dev, media_source=media, campaign=campaign, install_time=t, event_name="install",
                country_code=country, platform=platform, **kw)


def mmp_event(dev, revenue, t, media="Meta", campaign="c1", name="af_purchase", install_t=dt.datetime(2024, 1, 1, 10, 0),
              country="SI", platform="ios"):
    return dict(appsflyer_id=dev, media_source=media, campaign=campaign, install_time=install_t, event_name=name,
                event_revenue=Decimal(str(revenue)) if revenue is not None else None, event_time=t,
                country_code=country, platform=platform)


def backend(user, revenue, t, event="purchase"):
    return dict(user_id=user, event=event, revenue=Decimal(str(revenue)) if revenue is not None else None,
                event_time=t)


def spend(day, source="Meta", campaign="c1", country="SI", cost="10.00", installs=1, impressions=100, clicks=10):
    return dict(date=day, source=source, campaign=campaign, country=country, impressions=impressions, clicks=clicks,
                installs=installs, cost=Decimal(cost) if cost is not None else None)


def postback(campaign="c1", cv=10, idx=0, redownload=0, network="n1"):
    return dict(ad_network_id=network, source_identifier=campaign, conversion_value=cv,
                postback_sequence_index=idx, redownload=redownload)


def sources(spark, appsflyer=(), backend_rows=(), spend_rows=(), postbacks=()):
    return RawSources(appsflyer=frame(spark, RAW_APPSFLYER, list(appsflyer)),
                      singular=frame(spark, RAW_SINGULAR, list(spend_rows)),
                      skan=frame(spark, RAW_SKAN, list(postbacks)),
                      backend=frame(spark, RAW_BACKEND, list(backend_rows)))
