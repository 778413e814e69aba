"""Landing, loads, rewrite and incremental ingestion."""

import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampora.constants import BALANCE_KEY
from ampora.schemas import BALANCE_RAW
from ampora.sinks import writers as wr
from ampora.sources.documents import scan_documents
from ampora.streaming.ingest import ingest_balance
from tests.test_flatten import balance_doc

V = [{"datetime": "2025-01-01T00:00:00.000+01:00", "value": 1.0}]


def _docs(spark, rows):
    return spark.createDataFrame([(s, json.dumps(d)) for s, d in rows], "region_slug string, doc string")


def test_landing_rerun_replaces_only_its_regions(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    wr.write_landing(_docs(spark, [("a", balance_doc(V)), ("b", balance_doc(V))]), root)
    wr.write_landing(_docs(spark, [("a", balance_doc(V, extracted_at="new"))]), root)
    d = scan_documents(spark, root)
    assert d.count() == 2
    a = d.where("region_slug = 'a'").first().doc
    assert '"new"' in a
    assert scan_documents(spark, root, ["b"]).count() == 1
    with pytest.raises(FileNotFoundError):
        scan_documents(spark, root, ["b", "zz"])


def test_append_dedup_rewrite(spark, tmp_dir):
    from ampora.operators.flatten import flatten_balance
    flat = flatten_balance(_docs(spark, [("a", balance_doc(V))]), "t")
    raw, dst = f"{tmp_dir}/raw", f"{tmp_dir}/raw2"
    assert wr.append_load(flat, raw, BALANCE_RAW) == 1
    later = flat.withColumn("ingestion_timestamp", F.lit("2030-01-01T00:00:00+00:00")) \
        .withColumn("value", F.lit(2.0)).withColumn("extra", F.lit("x"))
    wr.append_load(later, raw, BALANCE_RAW)
    grown = T.StructType([*BALANCE_RAW.fields, T.StructField("extra", T.StringType())])
    t = wr.read_table(spark, raw, grown)
    assert sorted(str(r.extra) for r in t.collect()) == ["None", "x"]  # new nullable column allowed
    with pytest.raises(ValueError):
        wr.dedup_rewrite(spark, raw, raw, BALANCE_KEY, grown)
    d = wr.dedup_rewrite(spark, raw, dst, BALANCE_KEY, grown)
    assert [r.value for r in d.collect()] == [2.0]


def test_stream_ingest_is_incremental(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    wr.write_landing(_docs(spark, [("a", balance_doc(V)), ("b", '{"included": 3}')]), landing)
    args = (spark, landing, f"{tmp_dir}/raw", f"{tmp_dir}/bad", f"{tmp_dir}/ck")
    for q in ingest_balance(*args, fallback_ts="t"):
        q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/raw").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/bad").count() == 1
    wr.write_landing(_docs(spark, [("c", balance_doc(V))]), landing)
    for q in ingest_balance(*args, fallback_ts="t"):
        q.awaitTermination(120)
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    assert raw.count() == 2 and dict(raw.dtypes)["datetime"] == "timestamp"


def test_daily_csv_roundtrip(spark, tmp_dir):
    from ampora.operators.flatten import flatten_weather
    from ampora.sources.documents import read_daily_csv
    from tests.test_flatten import weather_doc
    d = flatten_weather(spark.createDataFrame([(json.dumps(weather_doc()),)], "doc string"))
    wr.write_processed(d, f"{tmp_dir}/daily", fmt="csv")
    back = read_daily_csv(spark, f"{tmp_dir}/daily")
    assert sorted(back.collect()) == sorted(d.collect())


def test_batch_publishes_models(spark, tmp_dir):
    from ampora.plans.batch import publish_models, run_batch
    r = run_batch(spark, "/root/testdata/sf0.001", root=f"{tmp_dir}/p")
    publish_models(spark, r)
    n = spark.sql("select count(*) c from mart_energy_weather_monthly").first().c
    assert n == spark.sql("select count(*) c from stg_redata_balance_electrico").first().c
    cur = spark.sql("select distinct metric_type from mart_energy_weather_monthly_curated").collect()
    assert {x.metric_type for x in cur} == {"1-URGENT", "2-HIGH", "3-MEDIUM"}


def test_mart_slice_prunes_partitions(spark, tmp_dir):
    from ampora.operators.analysis import slice_filter
    from ampora.plans.batch import run_batch
    r = run_batch(spark, "/root/testdata/sf0.001", root=f"{tmp_dir}/p")
    s = slice_filter(r.curated, "NATION_7", "1-URGENT", "1996-01", "1996-12")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and "year_month" in plan
    assert "PushedFilters: [IsNotNull(region_name), IsNotNull(metric_type), EqualTo(region_name,NATION_7)" in plan
    assert s.count() == r.curated.where("region_name = 'NATION_7' and metric_type = '1-URGENT' "
                                        "and year_month between '1996-01' and '1996-12'").count()


def test_named_document_files(spark, tmp_dir):
    import os
    from ampora.operators.flatten import flatten_balance
    from ampora.sources.documents import (BALANCE_FILE_PATTERN, latest_document,
                                          scan_named_documents)
    os.makedirs(tmp_dir)
    for slug in ("madrid", "aragon"):
        with open(f"{tmp_dir}/redata_{slug}_monthly_sample.json", "w", encoding="utf-8") as f:
            json.dump(balance_doc(V, region_slug=slug), f, indent=2)
    all_docs = scan_named_documents(spark, tmp_dir, BALANCE_FILE_PATTERN)
    assert sorted(r.region_slug for r in all_docs.collect()) == ["aragon", "madrid"]
    one = scan_named_documents(spark, tmp_dir, BALANCE_FILE_PATTERN, ["madrid"])
    assert flatten_balance(one, "t").count() == 1
    named = scan_named_documents(spark, tmp_dir, BALANCE_FILE_PATTERN,
                                 file_name="redata_aragon_monthly_sample.json")
    assert [r.region_slug for r in named.collect()] == ["aragon"]
    assert latest_document(all_docs, "file_mtime", "file_name").count() == 1
    with pytest.raises(FileNotFoundError):
        scan_named_documents(spark, tmp_dir, BALANCE_FILE_PATTERN, ["madrid", "nowhere"])


def test_stream_weather_quarantines_bad_documents(spark, tmp_dir):
    from ampora.streaming.ingest import ingest_weather_daily
    from tests.test_flatten import weather_doc
    landing = f"{tmp_dir}/landing"
    good, short = weather_doc(), weather_doc(temperature_2m_min=[1.0])
    wr.write_landing(_docs(spark, [("a", good), ("b", short)]), landing)
    for q in ingest_weather_daily(spark, landing, f"{tmp_dir}/daily", f"{tmp_dir}/bad",
                                  f"{tmp_dir}/ck"):
        q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/daily").count() == 2
    bad = spark.read.parquet(f"{tmp_dir}/bad").collect()
    assert len(bad) == 1 and "temperature_2m_min' has 1 values" in bad[0].reason


def test_split_documents(spark):
    from ampora.sources.documents import split_documents
    d = spark.createDataFrame([(1, '{"a": 1}'), (2, "[1]"), (3, "{bad")], "id int, doc string")
    good, bad = split_documents(d)
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, r.reason) for r in bad.collect()) == [(2, "not_an_object"), (3, "invalid_json")]


def test_batch_csv_handover_equals_parquet(spark, tmp_dir):
    from ampora.plans.batch import run_batch
    a = run_batch(spark, "/root/testdata/sf0.001", root=f"{tmp_dir}/pq").curated
    b = run_batch(spark, "/root/testdata/sf0.001", root=f"{tmp_dir}/csv", processed_format="csv").curated
    cols = sorted(a.columns)
    assert a.count() > 0
    a, b = a.select(cols), b.select(cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_append_load_table_adds_fields(spark):
    from ampora.operators.flatten import flatten_balance
    flat = flatten_balance(_docs(spark, [("a", balance_doc(V))]), "t")
    assert wr.append_load_table(spark, flat, "balance_t", BALANCE_RAW, "raw_test") == 1
    more = flat.withColumn("extra", F.lit("x")).withColumn("value", F.lit(5.0))
    assert wr.append_load_table(spark, more, "balance_t", BALANCE_RAW, "raw_test") == 1
    t = spark.table("raw_test.balance_t")
    assert t.count() == 2 and "extra" in t.columns
    assert sorted(r.value for r in t.collect()) == [1.0, 5.0]
    assert t.where("extra is null").count() == 1


def _database(spark):
    from ampora.sinks import tables
    name = f"t_{uuid.uuid4().hex[:10]}"
    tables.create_database(spark, name)
    return name


def test_upsert_rewrites_only_touched_months(spark):
    import datetime as dt
    import glob
    import os

    from ampora.sinks import tables
    schema = ("region_slug string, metric_id string, datetime timestamp, year_month string, "
              "ingestion_timestamp timestamp, value double")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    keys = ["region_slug", "metric_id", "datetime"]
    jan, feb = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    name = f"{_database(spark)}.raw"

    def load(*rows, columns=schema):
        return wr.upsert_latest(spark, spark.createDataFrame(list(rows), columns), name, keys, wr.utc_month("datetime"))

    first = load(("r", "m", jan, "2024-01", t1, 1.0), ("r", "m", feb, "2024-02", t1, 2.0))
    path = tables.location(spark, f"{name}__data").removeprefix("file:")
    jan_files = sorted(glob.glob(f"{path}/load_part=2024-01/*/*.parquet"))
    jan_mtimes = [os.path.getmtime(f) for f in jan_files]
    load(("r", "m", feb, "2024-02", t2, 20.0), ("r", "m", feb, "2024-03", t1, 9.0))
    t = spark.table(name)
    assert sorted((r.year_month, r.value) for r in t.collect()) == [("2024-01", 1.0), ("2024-02", 20.0)]
    assert jan_files and sorted(glob.glob(f"{path}/load_part=2024-01/*/*.parquet")) == jan_files
    assert [os.path.getmtime(f) for f in jan_files] == jan_mtimes
    # a reader that was planned before the load sees the table as it was
    assert sorted(r.value for r in first.collect()) == [1.0, 2.0]
    # a new column, in a partition of its own
    load(("r", "m", dt.datetime(2024, 5, 1), "2024-05", t1, 5.0, "x"), columns=schema + ", extra string")
    assert sorted((r.value, r.extra) for r in spark.table(name).collect()) == [(1.0, None), (5.0, "x"), (20.0, None)]
    load()
    assert spark.table(name).count() == 3


def test_upsert_scans_only_touched_partitions(spark):
    import datetime as dt

    from tests.test_plans import plan
    name = f"{_database(spark)}.raw"
    rows = [("r", dt.datetime(2024, m, 1), dt.datetime(2025, 1, 1), float(m)) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "region_slug string, datetime timestamp, ingestion_timestamp timestamp, value double")
    wr.upsert_latest(spark, df, name, ["region_slug", "datetime"], wr.utc_month("datetime"))
    old = wr.touched_rows(spark, name, ["2024-02", "2024-03"])
    filters = next(x for x in plan(old).splitlines() if "PartitionFilters" in x)
    assert "load_part" in filters.split("PartitionFilters: [")[1].split("]")[0] and "2024-02" in filters
    assert len(old.inputFiles()) >= 2 and sorted(r.value for r in old.collect()) == [2.0, 3.0]
    assert old.select("value").where("load_part = '2024-02'").count() == 1
    files = spark.table(f"{name}__data").where("load_part in ('2024-02', '2024-03')").select(
        F.input_file_name().alias("f")).distinct().count()
    assert files == old.select(F.input_file_name().alias("f")).distinct().count() < len(spark.table(f"{name}__data").inputFiles())


def test_upsert_equals_rewrite_for_undated_and_shifted_rows(spark, tmp_dir):
    from ampora.constants import BALANCE_KEY
    from ampora.schemas import BALANCE_RAW
    cols = "region_slug string, metric_id string, datetime string, year_month string, ingestion_timestamp string, value double"
    early, late = "2024-01-01T00:00:00+00:00", "2024-02-01T00:00:00+00:00"
    loads = [[("r", "m", "2025-01-01T00:00:00+01:00", "2025-01", early, 1.0), ("r", "m", None, "", early, 2.0)],
             [("r", "m", "2024-12-31T23:00:00Z", "2024-12", late, 3.0), ("r", "m", None, "", late, 4.0)],
             [("r", "m", None, None, early, 5.0)]]
    up, app = f"{_database(spark)}.up", f"{tmp_dir}/app"
    for rows in loads:
        df = wr.conform(spark.createDataFrame(rows, cols), BALANCE_RAW)
        wr.upsert_latest(spark, df, up, BALANCE_KEY, wr.utc_month("datetime"))
        wr.append_load(df, app, BALANCE_RAW)
    rewritten = wr.dedup_rewrite(spark, app, f"{tmp_dir}/once", BALANCE_KEY, schema=BALANCE_RAW)
    assert sorted(r.value for r in spark.table(up).collect()) == [3.0, 4.0]
    assert sorted(r.value for r in rewritten.collect()) == [3.0, 4.0]


def test_a_failed_upsert_leaves_the_table_as_it_was(spark):
    import datetime as dt

    from ampora.sinks import tables
    name = f"{_database(spark)}.raw"
    columns = "k string, datetime timestamp, ingestion_timestamp timestamp, value double"
    jan = dt.datetime(2024, 1, 1)

    def load(value):
        df = spark.createDataFrame([("a", jan, jan + dt.timedelta(days=value), float(value))], columns)
        wr.upsert_latest(spark, df, name, ["k", "datetime"], wr.utc_month("datetime"))

    load(1)
    publish = wr._publish
    wr._publish = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError, match="lost"):
            load(2)
    finally:
        wr._publish = publish
    assert [r.value for r in spark.table(name).collect()] == [1.0]
    load(3)
    assert [r.value for r in spark.table(name).collect()] == [3.0] and tables.version(spark, name) == 2


def test_table_is_rewritten_under_its_name(spark):
    from ampora.sinks import tables
    db = _database(spark)
    name = f"{db}.raw"
    rows = [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)]
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("ingestion_timestamp", T.LongType()),
                           T.StructField("value", T.DoubleType())])
    for part in (rows[:1], rows[1:]):
        wr.append_load_table(spark, spark.createDataFrame(part, schema), "raw", schema, db)
    before, old = spark.table(name), tables.location(spark, name)
    first_row = before.toLocalIterator()
    next(first_row)                                       # a reader that is under way
    wr.dedup_table(spark, name, ["k"])
    assert sorted(r.value for r in spark.table(name).collect()) == [2.0, 3.0]
    assert len(list(first_row)) == 2 and before.count() == 3          # readers that began before the swap finish
    wr.append_load_table(spark, spark.createDataFrame([("b", 5, 9.0)], schema), "raw", schema, db)
    assert spark.table(name).count() == 3
    assert sorted(r.value for r in wr.dedup_table(spark, name, ["k"]).collect()) == [2.0, 9.0]
    assert tables.drop_old_versions(spark, name) == []                # younger than a day
    gone = tables.drop_old_versions(spark, name, older_than_hours=0)
    assert len(gone) == 2 and any(g.endswith(old.rsplit("/", 1)[1]) for g in gone)
    assert spark.table(name).count() == 2


def test_rewrite_notices_a_load_in_between(spark):
    from ampora.sinks import tables
    db = _database(spark)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("ingestion_timestamp", T.LongType())])
    df = spark.createDataFrame([("a", 1)], schema)
    wr.append_load_table(spark, df, "raw", schema, db)
    seen = tables.version(spark, f"{db}.raw")
    to = tables.fresh_location(spark, f"{db}.raw")
    spark.table(f"{db}.raw").write.parquet(to)
    wr.append_load_table(spark, df, "raw", schema, db)
    with pytest.raises(RuntimeError, match="was loaded or rewritten"):
        tables.swap(spark, f"{db}.raw", to, seen)
    assert spark.table(f"{db}.raw").count() == 2


def test_marts_and_staging_views_by_name(spark):
    import datetime as dt

    from ampora.operators.models import stage_balance
    from ampora.schemas import MART_COLUMNS
    from tests.test_plans import plan
    db = _database(spark)
    stamp = [dt.datetime(2024, 1, d) for d in (1, 2)]
    rows = [{"region_slug": "a", "metric_id": "m", "datetime": stamp[0], "ingestion_timestamp": s, "value": v, "metric_title": x}
            for s, v, x in ((stamp[0], 1.0, "x"), (stamp[1], 2.0, "y"), (stamp[1], 2.0, "z"))] + [{"region_slug": "b", "value": None}]
    raw = spark.createDataFrame([T.Row(**{f.name: r.get(f.name) for f in BALANCE_RAW.fields}) for r in rows], BALANCE_RAW)
    wr.append_load_table(spark, raw, "raw", BALANCE_RAW, db)
    view = wr.create_staging_view(spark, f"{db}.stg", f"{db}.raw", BALANCE_RAW, BALANCE_KEY)
    assert sorted(view.collect(), key=str) == sorted(stage_balance(spark.table(f"{db}.raw")).collect(), key=str)
    assert view.schema.simpleString() == BALANCE_RAW.simpleString()
    wr.append_load_table(spark, raw.where("region_slug = 'b'").withColumn("region_slug", F.lit("c")), "raw", BALANCE_RAW, db)
    assert spark.sql(f"select count(*) from {db}.stg").first()[0] == 3          # the view sees later loads

    def mart(n):
        return spark.range(n).select(*[(F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")) if c == "year_month"
                                        else F.lit(c) if i < 5 else F.col("id").cast("double")).alias(c) for i, c in enumerate(MART_COLUMNS)])

    saved = wr.save_mart(spark, mart(9), f"{db}.mart")
    assert saved.columns == MART_COLUMNS and saved.count() == 9
    early = spark.table(f"{db}.mart")
    wr.save_mart(spark, mart(30), f"{db}.mart")
    assert early.count() == 9 and spark.table(f"{db}.mart").count() == 30
    sliced = spark.sql(f"select * from {db}.mart where year_month = '2024-02' and region_name = 'region_name'")
    p = plan(sliced)
    assert sliced.count() == 10 and "year_month" in p.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(region_name" in p
    found = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {db}.mart").collect()}
    assert found["ampora.sorted_by"] == "region_name,metric_type"


def test_landing_files_are_bounded_by_bytes(spark, tmp_dir):
    import glob
    text = "x" * 2000
    docs = spark.range(6000, numPartitions=60).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), (F.col("id") % 5).cast("string"))).alias("region_slug"),
        F.concat(F.lit(text), F.sha2(F.col("id").cast("string"), 512)).alias("doc"))
    # a limit far below the hot region's size, so that it must be split
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        wr.write_landing(docs, tmp_dir)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = glob.glob(f"{tmp_dir.removeprefix('file:')}/region_slug=*/*.txt")
    hot = [f for f in files if "=hot" in f]
    # 60 tasks x 6 regions would be 360 files, and one file a region would put the hot one in one task
    assert 1 < len(hot) and len(files) <= 60
    assert scan_documents(spark, tmp_dir).count() == 6000


def test_routes_are_written_in_one_pass(spark, tmp_dir):
    from ampora.sources.documents import routed_documents
    from tests.test_plans import plan
    rows = [(1, '{"a": 1}'), (2, "[1]"), (3, "{bad"), (4, '{"errors": null}'), (5, None)]
    spark.createDataFrame(rows, "id int, doc string").write.parquet(f"{tmp_dir}/in")
    docs = spark.read.parquet(f"{tmp_dir}/in")
    routed = routed_documents(docs)
    assert plan(routed).count("parseJson") == 1 and plan(routed).count("FileScan") == 1
    r = wr.write_routes(routed, f"{tmp_dir}/out")
    assert [x.id for x in r.good.collect()] == [1] and (r.n_good, r.n_rejects) == (1, 4)
    assert sorted((x.id, x.reason) for x in r.rejects.collect()) == [
        (2, "not_an_object"), (3, "invalid_json"), (4, "errors_member"), (5, "invalid_json")]
    assert plan(r.good).count("parseJson") == 0 and "PartitionFilters: [isnotnull(route" in plan(r.good)
    none = wr.write_routes(routed.where("id > 9"), f"{tmp_dir}/none")
    assert (none.n_good, none.n_rejects, none.good.count(), none.rejects.count()) == (0, 0, 0, 0)


def test_stream_quarantines_badly_typed_measures(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    bad = [*V, {"datetime": "2025-02-01T00:00:00.000+01:00", "value": "abc"}]
    wr.write_landing(_docs(spark, [("a", balance_doc(bad))]), landing)
    for q in ingest_balance(spark, landing, f"{tmp_dir}/raw", f"{tmp_dir}/bad", f"{tmp_dir}/ck", fallback_ts="t"):
        q.awaitTermination(120)
    assert [r.value for r in spark.read.parquet(f"{tmp_dir}/raw").collect()] == [1.0]
    assert ["abc" in r.reason for r in spark.read.parquet(f"{tmp_dir}/bad").collect()] == [True]


def test_batch_upsert_mode_equals_rewrite(spark, tmp_dir):
    from ampora.plans.batch import run_batch
    a = run_batch(spark, "/root/testdata/sf0.001", root=f"{tmp_dir}/rw").curated
    b = run_batch(spark, "/root/testdata/sf0.001", root=f"{tmp_dir}/up", raw_mode="upsert").curated
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerun_keeps_no_duplicates(spark, tmp_dir):
    from ampora.plans import fixtures as fx
    from ampora.plans.batch import land_fixture_documents, run_from_landing
    for mode in ("rewrite", "upsert"):
        root = f"{tmp_dir}/{mode}"
        land_fixture_documents(spark, "/root/testdata/sf0.001", root)
        first = run_from_landing(spark, root, fx.FIXTURE_CURATED, raw_mode=mode).curated
        rows1 = first.collect()
        again = run_from_landing(spark, root, fx.FIXTURE_CURATED, raw_mode=mode)
        assert again.curated.count() == len(rows1)
        assert again.stg_balance.count() == again.stg_balance.dropDuplicates(
            ["region_slug", "metric_id", "datetime"]).count()
        # the raw table is deduplicated under its name
        assert spark.table(f"{again.database}.redata_balance_electrico").count() == again.stg_balance.count()


def test_scan_newest_first(spark, tmp_dir):
    import time as _t
    root = f"{tmp_dir}/landing"
    wr.write_landing(_docs(spark, [("a", balance_doc(V))]), root)
    _t.sleep(1.1)
    wr.write_landing(_docs(spark, [("b", balance_doc(V))]), root)
    order = [r.region_slug for r in scan_documents(spark, root, newest_first=True).collect()]
    assert order == ["b", "a"]
