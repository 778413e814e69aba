"""Plan-shape guards for the scale design (see README, "Scale design")."""

import re

import __spark_entry__ as ent
from ampora.operators.flatten import flatten_balance, flatten_weather, weather_violations
from ampora.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_parsed_once(spark):
    for df in (flatten_balance(fx.balance_documents(spark, SF), "t"),
               flatten_weather(fx.weather_documents(spark, SF)),
               weather_violations(fx.weather_documents(spark, SF, broken_region_key=1))):
        assert plan(df).count("parseJson") == 1
        assert "SchemaOfVariant" not in plan(df)


def test_dedup_limits_on_both_sides_of_the_shuffle(spark):
    p = plan(ent.queries()["dedup_latest"](spark, SF))
    first_exchange = p.index("Exchange hashpartitioning(region_slug")
    assert p.count("WindowGroupLimit") == 2
    assert p.index("WindowGroupLimit", first_exchange) > first_exchange


def test_monthly_rollup_combines_before_shuffle(spark):
    p = plan(ent.queries()["monthly_weather"](spark, SF))
    assert "partial_avg" in p and "partial_sum" in p


def test_merges_parse_once_into_a_narrow_table(spark):
    from ampora.operators.flatten import weather_arrays
    from ampora.operators.merge import balance_records, merge_balance_years, merge_weather_years
    docs = fx.balance_documents(spark, SF)
    assert plan(balance_records(docs)).count("parseJson") == 1
    m = merge_balance_years(docs)
    m.collect()  # final adaptive plan: reused exchanges show as ReusedExchange
    p = plan(m)
    assert "isFinalPlan=true" in p and p.count("parseJson") == 0
    # windows run over the aggregated key rows, never over records
    assert p.index("Window [") < p.index("Aggregate")
    weather = fx.weather_documents(spark, SF)
    assert plan(weather_arrays(weather)).count("parseJson") == 1
    p = plan(merge_weather_years(weather))
    assert p.count("parseJson") == 0
    # the side that gives each region its envelope reads no series
    assert any("FileScan" in x and "temperature" not in x for x in p.splitlines())


def test_data_tests_scan_nothing(spark):
    from ampora.operators.quality import observed, observed_report
    df, obs = observed(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "m", ["a", "b"])
    df.write.format("noop").mode("overwrite").save()
    rows = observed_report(spark, {"m": obs}, [("m", ["a", "b"]), ("other", ["a"])]).collect()
    assert [tuple(r) for r in rows] == [("m", "a", 0, True), ("m", "b", 1, False)]


def test_scans_are_pruned(spark):
    p = plan(ent.queries()["mart_energy_weather"](spark, SF))
    orders = re.search(r"FileScan parquet \[([^\]]*o_custkey[^\]]*)\]", p).group(1)
    assert set(c.split("#")[0] for c in orders.split(",")) == {
        "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"}


def test_grid_is_a_generator_not_a_cross_join(spark):
    p = plan(ent.queries()["coverage_grid"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate explode(" in p


def test_grouped_statistics_use_hash_aggregates(spark):
    for name in ("energy_weather_corr", "summary_stats", "slice_kpis", "share_kpi"):
        p = plan(ent.queries()[name](spark, SF))
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p, name


def test_weather_dedup_exchange_serves_the_join(spark, tmp_dir):
    from ampora.operators.models import mart_energy_weather, stage_balance, stage_weather
    from ampora.plans import registry as rg
    from ampora.schemas import BALANCE_RAW, WEATHER_MONTHLY_RAW
    from ampora.sinks.writers import conform
    conform(fx.balance_flat(spark, SF), BALANCE_RAW).write.parquet(f"{tmp_dir}/b")
    conform(rg._monthly(spark, SF), WEATHER_MONTHLY_RAW).write.parquet(f"{tmp_dir}/w")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m = mart_energy_weather(stage_balance(spark.read.parquet(f"{tmp_dir}/b")),
                                stage_weather(spark.read.parquet(f"{tmp_dir}/w")))
        p = plan(m)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in p
    weather_branch = p[p.index("Window [row_number() windowspecdefinition(region_slug", p.index("Scan")):]
    assert weather_branch.count("Exchange hashpartitioning(") == 1
