"""Tiny in-memory feeds and dimensions for unit tests."""

from __future__ import annotations

import datetime as dt

from rollwise import schemas

D = dt.date


def cities(spark, rows=None):
    rows = rows if rows is not None else [
        ("t1", "Pune", "Pune", "Pune", "WEST"),
        ("t2", "Pune", "Pune", "Pune", "WEST-2"),
    ]
    return spark.createDataFrame(rows, schemas.CITY_MAPPING)


def sku(org, code, prid="P1", category="Cat", sub="Sub", brand="Br", cogs="10.5", taxes="18",
        margin=10.0, active=1, bisc="INT1"):
    return (org, code, code, code, prid, "IM-" + prid, bisc, category, sub, brand, cogs, taxes,
            margin, margin, margin, active, active, active)


def catalogue(spark, rows=None):
    rows = rows if rows is not None else [sku("t1", "A1"), sku("t2", "A1", prid="P2", margin=20.0)]
    return spark.createDataFrame(rows, schemas.CATALOGUE)


def feed(spark, mkt, kind, rows):
    return spark.createDataFrame(rows, schemas.FEEDS[(mkt, kind)])
