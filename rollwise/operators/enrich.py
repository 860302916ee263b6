"""Left joins of a feed to the city map and the SKU catalogue.

Both dimensions are tenant-scoped and carry one column per marketplace. They
are first narrowed to the marketplace's columns (so only those are read and
shipped), then joined on (key, tenant). Zepto compares SKU codes lower-cased:
the normalised key is computed once on each side and the join stays an
equi-join. The join strategy is Spark's choice, from the sizes it estimates and, with
adaptive execution, measures (``spark.sql.autoBroadcastJoinThreshold``): a dimension
that outgrows the threshold is joined by a shuffle without any change here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import PlatformSpec

# Prefix of every dimension column after enrichment (feed columns are camelCase).
CITY = "scm_"
SKU = "scd_"


class DuplicateDimensionKeys(ValueError):
    pass


def sku_key(col: Column, spec: PlatformSpec) -> Column:
    key = col.cast("string")
    return F.lower(key) if spec.lower_sku else key


def city_dim(cities: DataFrame, spec: PlatformSpec) -> DataFrame:
    return cities.select(
        F.col("organizationid").alias(CITY + "org"),
        F.col(spec.city_col).alias(CITY + "key"),
        F.col("brand_s_choice").alias(CITY + "brands_choice"),
    )


def catalogue_dim(catalogue: DataFrame, spec: PlatformSpec) -> DataFrame:
    return catalogue.select(
        F.col("organizationid").alias(SKU + "org"),
        sku_key(F.col(spec.sku_col), spec).alias(SKU + "key"),
        F.col(spec.productid_col).cast("string").alias(SKU + "productid"),
        F.col("category").alias(SKU + "category"),
        F.col("sub__category").alias(SKU + "subcategory"),
        F.col("brand").alias(SKU + "brand"),
        F.col("brand_internal_sku_code").alias(SKU + "brand_internal_sku_code"),
        F.col("cogs").alias(SKU + "cogs"),
        F.col("taxes").alias(SKU + "taxes"),
        F.col(spec.margin_col).cast("double").alias(SKU + "margin"),
        F.col(spec.active_col).alias(SKU + "active"),
    )


def assert_unique(dim: DataFrame, keys: list[str], what: str) -> None:
    """A duplicate dimension row would multiply every sum joined to it. Equal keys have equal hashes, so the keys themselves
    are only grouped where a hash comes twice."""
    hashes = dim.groupBy(F.xxhash64(*keys).alias("_h")).count().filter(F.col("count") > 1)
    if hashes.isEmpty():
        return
    dups = dim.groupBy(*keys).count().filter(F.col("count") > 1).limit(5).collect()
    if dups:
        raise DuplicateDimensionKeys(f"{what}: duplicate keys {[tuple(r)[:-1] for r in dups]}")


def check_dimensions(cities: DataFrame, catalogue: DataFrame, spec: PlatformSpec) -> None:
    assert_unique(city_dim(cities, spec), [CITY + "org", CITY + "key"], "static_city_mapping")
    assert_unique(catalogue_dim(catalogue, spec), [SKU + "org", SKU + "key"], "static_combined_data")


def _one_row_per_key(dim: DataFrame, key: str, org: str, what: str) -> DataFrame:
    """H14 inside the plan: the dimension's rows by (key, tenant); running into a second
    row of a key raises. Rows with a null in the key never match and are left out."""
    rest = [c for c in dim.columns if c not in (key, org)]
    rows = dim.filter(F.col(key).isNotNull() & F.col(org).isNotNull()).groupBy(key, org).agg(
        F.count("*").alias("_n"), F.min(F.struct(*rest)).alias("_row"))
    clash = F.raise_error(F.concat(F.lit(f"{what}: duplicate key "), F.concat_ws("/", F.col(key), F.col(org))))
    return rows.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(clash.cast("boolean"))).select(
        key, org, *[F.col("_row." + c).alias(c) for c in rest])


class Checked:
    """Dimensions whose keys have been found unique (``checked``): joined without looking again. ``nulls``: keys with a
    null were left out of the check (``checked_keys``)."""

    def __init__(self, rows: DataFrame, nulls: bool = False):
        self.rows, self.nulls = rows, nulls


def dimension_rows(dim: DataFrame | Checked) -> DataFrame:
    return dim.rows if isinstance(dim, Checked) else dim


def checked(cities: DataFrame | Checked, catalogue: DataFrame | Checked, spec: PlatformSpec) -> tuple[Checked, Checked]:
    """Both dimensions after ``check_dimensions``, for many plans over the same files (a stream's batches). What it has
    checked before it does not check again."""
    if all(isinstance(d, Checked) and not d.nulls for d in (cities, catalogue)):
        return cities, catalogue
    cities, catalogue = dimension_rows(cities), dimension_rows(catalogue)
    check_dimensions(cities, catalogue, spec)
    return Checked(cities), Checked(catalogue)


def checked_keys(cities: DataFrame, catalogue: DataFrame, spec: PlatformSpec) -> tuple[Checked, Checked]:
    """As ``checked``, but rows with a null in the key may repeat: they match no feed row."""
    for dim, key, org, what in ((city_dim(cities, spec), CITY + "key", CITY + "org", "static_city_mapping"),
                                (catalogue_dim(catalogue, spec), SKU + "key", SKU + "org", "static_combined_data")):
        assert_unique(dim.filter(F.col(key).isNotNull() & F.col(org).isNotNull()), [org, key], what)
    return Checked(cities, nulls=True), Checked(catalogue, nulls=True)


def enrich(feed: DataFrame, cities: DataFrame | Checked, catalogue: DataFrame | Checked, spec: PlatformSpec,
           city_col: str, item_col: str, org_col: str = "organizationId") -> DataFrame:
    """Feed rows with ``scm_*`` and ``scd_*`` columns; unmatched rows keep NULLs. A dimension that is not
    ``Checked`` and has two rows of one key fails when the rows are computed."""
    c = city_dim(cities.rows, spec) if isinstance(cities, Checked) else _one_row_per_key(
        city_dim(cities, spec), CITY + "key", CITY + "org", "static_city_mapping")
    s = catalogue_dim(catalogue.rows, spec) if isinstance(catalogue, Checked) else _one_row_per_key(
        catalogue_dim(catalogue, spec), SKU + "key", SKU + "org", "static_combined_data")
    f = feed.withColumn("_sku_key", sku_key(F.col(item_col), spec))
    out = f.join(c, (f[city_col] == c[CITY + "key"]) & (f[org_col] == c[CITY + "org"]), "left")
    out = out.join(s, (out["_sku_key"] == s[SKU + "key"]) & (out[org_col] == s[SKU + "org"]), "left")
    return out.drop(CITY + "key", CITY + "org", SKU + "key", SKU + "org")
