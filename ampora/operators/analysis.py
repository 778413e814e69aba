"""Analysis layer: slices, KPIs, series, scatter pairs, summary statistics and
correlation -- computed for every (region, metric) group in one job.

The original computes these for one UI selection in pandas; here the same
numbers come out of grouped aggregates, so one pass answers every selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampora.constants import DEFAULT_WEATHER_LABEL, MONTHLY_MEASURES, RELATIONSHIP_DEFAULT, UI_LABELS
from ampora.functions.columns import month_start, safe_pearson
from ampora.sources.config import Relationship, lookup

GROUP = ["region_name", "metric_type"]


def curated_extract(curated: DataFrame) -> DataFrame:
    """The 13-column extract with ``year_month`` as the first day of the month
    (DATE), totally ordered by region name, month, metric."""
    return (curated.select("region_slug", "region_name", "year_month", "group_type", "metric_type",
                           "value", "percentage", *MONTHLY_MEASURES)
            .withColumn("year_month", month_start(F.col("year_month")))
            .orderBy("region_name", "year_month", "metric_type"))


def with_relationship(df: DataFrame, relationships: list[Relationship], language: str = "en") -> DataFrame:
    """Attach group / weather column / label / scatter flag per metric, with
    the configured default for metrics not in the list.  A literal lookup per
    row: nothing is joined or shuffled."""
    g, wc, _, sc = RELATIONSHIP_DEFAULT
    default = {"relationship_group": g, "weather_column": wc,
               "weather_label": DEFAULT_WEATHER_LABEL[language], "show_scatter": sc}
    metric = F.col("metric_type")
    return df.withColumns({
        name: F.coalesce(lookup(metric, [(r[0], r[k]) for r in relationships]), F.lit(default[name]))
        for k, name in enumerate(default, 1)})


def weather_value(column_name: Column) -> Column:
    """Value of the weather measure named by ``column_name`` on each row."""
    expr = None
    for m in MONTHLY_MEASURES:
        expr = (F.when(column_name == m, F.col(m)) if expr is None
                else expr.when(column_name == m, F.col(m)))
    return expr


def with_weather_value(df: DataFrame, relationships: list[Relationship], language: str = "en") -> DataFrame:
    out = with_relationship(df, relationships, language)
    return out.withColumn("weather_value", weather_value(F.col("weather_column")))


def slice_filter(df: DataFrame, region_name: str, metric_type: str,
                 start_month, end_month) -> DataFrame:
    """One UI selection: region and metric equal, month in [start, end]."""
    return df.where((F.col("region_name") == region_name) & (F.col("metric_type") == metric_type)
                    & F.col("year_month").between(start_month, end_month))


def slice_kpis(df: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Distinct months, mean energy value, mean weather value per group, and
    the means as text with one decimal.  ``df`` must carry ``weather_value``
    (see ``with_weather_value``)."""
    means = df.groupBy(*group).agg(
        F.countDistinct("year_month").cast("long").alias("n_months"),
        F.avg("value").alias("avg_value"),
        F.avg("weather_value").alias("avg_weather"))
    return means.withColumns({f"{c}_text": F.format_number(c, 1) for c in ("avg_value", "avg_weather")})


def share_kpi(df: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Mean share per group, x100 when every |share| <= 1 (decided per group).
    Groups without any share produce no row."""
    a = (df.where(F.col("percentage").isNotNull()).groupBy(*group)
         .agg(F.avg("percentage").alias("_m"), F.max(F.abs("percentage")).alias("_mx")))
    pct = F.when(F.col("_mx") <= 1, F.col("_m") * 100).otherwise(F.col("_m"))
    return a.select(*group, pct.alias("share_pct"),
                    F.concat(F.format_number(pct, 1), F.lit("%")).alias("share_text"))


def summary_stats(df: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Mean / min / max / sample std of energy and weather: two rows per group."""
    a = df.groupBy(*group).agg(
        F.avg("value").alias("e_mean"), F.min("value").alias("e_min"),
        F.max("value").alias("e_max"), F.stddev_samp("value").alias("e_std"),
        F.avg("weather_value").alias("w_mean"), F.min("weather_value").alias("w_min"),
        F.max("weather_value").alias("w_max"), F.stddev_samp("weather_value").alias("w_std"))
    return a.selectExpr(
        *[f"`{g}`" for g in group],
        "stack(2, 'energy', e_mean, e_min, e_max, e_std, "
        "'weather', w_mean, w_min, w_max, w_std) as (series, mean, min, max, std)")


def energy_weather_corr(df: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Pairwise-complete Pearson correlation of value and weather per group.

    The weather column and label depend on the metric alone, so they are
    grouping keys rather than ``first()`` aggregates: every aggregate buffer
    stays numeric and the plan is a hash aggregate (a string ``first`` would
    force a sort-based aggregate over all rows).
    """
    both = F.col("value").isNotNull() & F.col("weather_value").isNotNull()
    keys = list(group) + [c for c in ("weather_column", "weather_label") if c not in group]
    return df.groupBy(*keys).agg(
        F.count(F.when(both, 1)).alias("n_pairs"),
        safe_pearson(F.col("value"), F.col("weather_value")).alias("pearson_correlation"))


def filter_options(df: DataFrame) -> DataFrame:
    """Distinct non-null region names, metrics and months, as (kind, option).

    One pass: each row emits its three options, then one distinct (combined
    map-side), instead of three scans of the input.
    """
    opts = F.array(*[F.struct(F.lit(kind).alias("option_kind"),
                              F.col(c).cast("string").alias("option_value"))
                     for kind, c in (("region", "region_name"), ("metric", "metric_type"),
                                     ("month", "year_month"))])
    return (df.select(F.inline(opts)).dropna().distinct()
            .orderBy("option_kind", "option_value"))


def period_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("year_month").alias("first_month"), F.max("year_month").alias("last_month"))


def metric_labels(df: DataFrame, labels: list[tuple[str, str]]) -> DataFrame:
    """Label per metric, falling back to the metric itself; NULL -> ''."""
    metric = F.col("metric_type")
    return df.withColumn("metric_label", F.coalesce(lookup(metric, labels), metric, F.lit("")))


def monthly_detail(df: DataFrame, labels: list[tuple[str, str]]) -> DataFrame:
    """Detail table: month text, region, metric label, energy, weather.
    ``df`` must carry ``weather_value``/``weather_label`` and a DATE month."""
    out = metric_labels(df, labels)
    return out.select(F.date_format("year_month", "yyyy-MM").alias("year_month"),
                      "region_name", "metric_label", "value",
                      "weather_label", "weather_value")


def series_long(df: DataFrame) -> DataFrame:
    """Energy and weather line series as one long table (one pass, ``stack``)."""
    return df.selectExpr("region_name", "metric_type", "year_month",
                         "stack(2, 'energy', value, 'weather', weather_value) as (series, y)")


def scatter_pairs(df: DataFrame) -> DataFrame:
    """(weather, energy) pairs for metrics whose relationship shows a scatter."""
    return df.where(F.col("show_scatter")).select(
        "region_name", "year_month", "metric_type", "weather_column",
        "weather_value", "value")


# ---------------------------------------------------------------------------
# Presentation: the same tables with the headers and row labels the original
# shows, per language.  Pure renames / literal maps, no extra work.


def present_detail(detail: DataFrame, language: str = "en") -> DataFrame:
    """``monthly_detail`` with localized headers; the weather measure keeps
    its per-metric label in ``weather_label`` (one header cannot name a
    different measure on every row of a grouped table)."""
    t = UI_LABELS[language]
    return detail.withColumnsRenamed({"year_month": t["year_month"], "region_name": t["region"],
                                      "metric_label": t["metric"], "value": t["energy_value"]})


def present_summary(stats: DataFrame, language: str = "en") -> DataFrame:
    """``summary_stats`` rows labelled like the original: the energy row is
    'Energy value', the weather row carries the weather label.  ``stats``
    must come from a frame with ``weather_label`` in the group."""
    t = UI_LABELS[language]
    label = F.when(F.col("series") == "energy", F.lit(t["energy_value"])).otherwise(F.col("weather_label"))
    return stats.withColumn("series", label).withColumnsRenamed(
        {"series": t["series"], "mean": t["mean"], "min": t["min"], "max": t["max"], "std": t["std"]})


def present_correlation(corr: DataFrame, language: str = "en") -> DataFrame:
    """``energy_weather_corr`` as the original's three-column table (plus the
    group columns)."""
    t = UI_LABELS[language]
    keep = [c for c in corr.columns if c not in ("weather_column", "weather_label", "n_pairs",
                                                  "pearson_correlation")]
    return corr.select(*keep, F.lit(t["energy_value"]).alias(t["energy_variable"]),
                       F.col("weather_label").alias(t["weather_variable"]),
                       F.col("pearson_correlation").alias(t["pearson"]))
