"""Scene health mart: one row per subgenre.

The artists are reduced to one row per ``(subgenre, formation year, country)`` with a codegen hash aggregate;
the totals, years, decades and countries of a scene are facets of that small table, stacked and reduced in
one chain, so no branch of it reads the artists again. The listener percentiles are exact and take two
passes over two columns. All passes aggregate before the shuffle, and no task ever merges a whole scene.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.numbers import decade, share_pct
from bandstand.functions.ordering import exact_percentiles
from bandstand.settings import DEFAULTS, Settings

SCENE, YEAR, DECADE, COUNTRY = "scene", "year", "decade", "country"
SHARES = {"median_listeners": 0.5, "p90_listeners": 0.9}
ADDED = ["artists", "listeners", "breakout", "underground", "rising"]


def scene_cells(artists: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Additive facts per subgenre, formation year and country."""
    n = F.col("listeners")
    return artists.groupBy("subgenre", "formed_year", "country").agg(
        F.count("*").alias("artists"),
        F.sum(n).alias("listeners"),
        F.max(n).alias("max_listeners"),
        F.count_if(n >= s.breakout_listeners).alias("breakout"),
        F.count_if(n < s.underground_listeners).alias("underground"),
        F.count_if((n >= s.underground_listeners) & (n < s.breakout_listeners)).alias("rising"),
    )


def scene_facets(cells: DataFrame) -> DataFrame:
    """One row per scene, and per year, decade and country of a scene; unknown values form no facet."""
    year, no_years, no_country = F.col("formed_year"), F.lit(None).cast("int"), F.lit(None).cast("string")

    def facet(name: str, years: Column, country: Column) -> Column:
        return F.struct(F.lit(name).alias("facet"), years.alias("in_years"), country.alias("in_country"))

    kinds = F.array(
        facet(SCENE, no_years, no_country),
        F.when(year.isNotNull(), facet(YEAR, year, no_country)),
        F.when(year.isNotNull(), facet(DECADE, decade(year), no_country)),
        F.when(F.col("country").isNotNull(), facet(COUNTRY, no_years, F.col("country"))),
    )
    extra = {
        "dated": F.when(year.isNotNull(), F.col("artists")).otherwise(0),
        "placed": F.when(F.col("country").isNotNull(), F.col("artists")).otherwise(0),
        "year_sum": year.cast("bigint") * F.col("artists"),
    }
    return (
        cells.withColumns({**extra, "f": F.explode(F.array_compact(kinds))})
        .groupBy("subgenre", "f.facet", "f.in_years", "f.in_country")
        .agg(
            *[F.sum(c).alias(c) for c in (*ADDED, *extra)],
            F.max("max_listeners").alias("max_listeners"),
            F.min("formed_year").alias("oldest"),
        )
    )


def _scene(column: str) -> Column:
    return F.max(F.when(F.col("facet") == SCENE, F.col(column)))


def _largest(facet: str, value: str, fields: list[str]) -> Column:
    """Facet with most listeners, the first by value on ties."""
    order = F.when(F.col("facet") == facet, F.struct(-F.col("listeners"), F.col(value)))
    return F.min_by(F.struct(value, *fields), order)


def _golden() -> Column:
    return _largest(DECADE, "in_years", ["listeners", "artists"]).alias("golden")


def _top() -> Column:
    return _largest(COUNTRY, "in_country", ["listeners"]).alias("top")


GOLDEN_COLUMNS = {
    "golden_era_decade": "golden.in_years",
    "golden_era_total_listeners": "golden.listeners",
    "golden_era_artist_count": "golden.artists",
}
TOP_COLUMNS = {"dominant_country": "top.in_country", "dominant_country_listeners": "top.listeners"}


def _named(columns: dict[str, str]) -> list[Column]:
    return [F.col(path).alias(name) for name, path in columns.items()]


def _stats() -> list[Column]:
    return [
        _scene("artists").alias("total_artists"),
        _scene("listeners").alias("total_listeners"),
        _scene("max_listeners").alias("max_listeners"),
        _scene("breakout").alias("breakout_artists"),
        _scene("underground").alias("underground_artists"),
        _scene("rising").alias("rising_artists"),
        _scene("year_sum").alias("_years"),
        _scene("oldest").alias("oldest_band_year"),
        _scene("dated").alias("artists_with_formed_year"),
        F.count_if(F.col("facet") == COUNTRY).alias("country_count"),
        _scene("placed").alias("artists_with_country"),
        F.array_sort(F.collect_list(F.when(F.col("facet") == YEAR, F.struct("in_years", "artists")))).alias("_by_year"),
    ]


def _median_year() -> Column:
    """Median of the years, each with its count: the first one at which half of the artists are reached.

    The list has an entry per calendar year at most.
    """
    rank = F.expr("(artists_with_formed_year + 1) div 2")
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("year"))

    def step(acc: Column, x: Column) -> Column:
        reached = F.when(acc["year"].isNull() & (acc["seen"] + x["artists"] >= rank), x["in_years"]).otherwise(acc["year"])
        return F.struct((acc["seen"] + x["artists"]).alias("seen"), reached.alias("year"))

    return F.aggregate("_by_year", start, step, lambda acc: acc["year"].cast("double"))


def _ratios(df: DataFrame) -> DataFrame:
    years = F.col("_years") / F.nullif(F.col("artists_with_formed_year"), F.lit(0))
    return df.withColumns(
        {
            "avg_listeners": F.col("total_listeners") / F.col("total_artists"),
            "breakout_pct": share_pct(F.col("breakout_artists"), F.col("total_artists")),
            "avg_formed_year": years,
            "median_formed_year": _median_year(),
        }
    ).drop("_years", "_by_year")


def scene_stats(facets: DataFrame) -> DataFrame:
    return _ratios(facets.groupBy("subgenre").agg(*_stats()))


def scene_quantiles(artists: DataFrame) -> DataFrame:
    return exact_percentiles(artists, "subgenre", "listeners", SHARES)


def decade_totals(facets: DataFrame) -> DataFrame:
    return facets.where(F.col("facet") == DECADE).select(
        "subgenre",
        F.col("in_years").alias("formation_decade"),
        F.col("listeners").alias("decade_total_listeners"),
        F.col("artists").alias("decade_artist_count"),
    )


def country_totals(facets: DataFrame) -> DataFrame:
    return facets.where(F.col("facet") == COUNTRY).select(
        "subgenre",
        F.col("in_country").alias("country"),
        F.col("listeners").alias("country_listeners"),
        F.col("artists").alias("country_artist_count"),
    )


def golden_era(facets: DataFrame) -> DataFrame:
    """The decade with most listeners per scene, the earlier one on ties."""
    dated = facets.where(F.col("facet") == DECADE)
    return dated.groupBy("subgenre").agg(_golden()).select("subgenre", *_named(GOLDEN_COLUMNS))


def top_country(facets: DataFrame) -> DataFrame:
    """The country with most listeners per scene, the first by name on ties."""
    placed = facets.where(F.col("facet") == COUNTRY)
    return placed.groupBy("subgenre").agg(_top()).select("subgenre", *_named(TOP_COLUMNS))


def subgenre_health(artists: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    facets = scene_facets(scene_cells(artists, s))
    per_scene = _ratios(facets.groupBy("subgenre").agg(*_stats(), _golden(), _top()))
    joined = per_scene.join(scene_quantiles(artists), "subgenre")
    golden, top = _named(GOLDEN_COLUMNS), _named(TOP_COLUMNS)
    return joined.select(
        "subgenre", "total_artists", "total_listeners", "avg_listeners", "median_listeners", "p90_listeners",
        "max_listeners", "breakout_artists", "rising_artists", "underground_artists", "breakout_pct",
        "avg_formed_year", "median_formed_year", "oldest_band_year", "artists_with_formed_year", *golden,
        "country_count", "artists_with_country", *top,
    )
