"""Whole jobs, incremental runs and notification runs on small files."""

import json
import os
import time
from dataclasses import replace
from pathlib import Path

import pytest

from basketflow import schemas
from basketflow.plans import cleaning, curation, recommend, runner, runs
from basketflow.sources import catalog, predictions, readers
from basketflow.sources.zones import Zones
from basketflow.streaming.arrivals import on_notifications, refresh_table
from basketflow.streaming.incremental import incremental_clean

RAW = {
    "aisles": ["1,fresh", "2,dry"],
    "departments": ["1,food"],
    "products": ['10,"Jam, ""sour""",1,1', "11,Bread,2,1", "12,Tea,9,1", "13,Salt,2,8"],
    "orders": [
        "1,1,prior,1,0,8,",
        "2,1,prior,2,2,8,3.0",
        "3,1,train,3,2,8,3.0",
        "4,2,prior,1,6,8,",
        "5,2,test,2,1,8,9.0",
        "6,3,train,1,9,8,1.0",
    ],
    "order_products": ["1,10,1,0", "2,10,1,1", "2,11,2,0", "3,10,1,1", "4,11,1,0", "5,11,1,1", "77,10,1,0", "1,99,1,0", "2,12,1,5"],
}


def put(folder: Path, table: str, lines, name: str | None = None) -> Path:
    """A raw object: data/<table>.csv, or <name> in a folder of that name."""
    path = folder / "raw" / "data" / f"{table}.csv"
    if name:
        path = path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(schemas.columns(table)), *lines]) + "\n")
    return path


def raw_zones(folder: Path) -> Zones:
    for table, lines in RAW.items():
        put(folder, table, lines)
    return Zones.under(str(folder))


@pytest.fixture
def zones(tmp_path):
    return raw_zones(tmp_path)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Zones after both jobs, and what the cleaning counted."""
    done = raw_zones(tmp_path_factory.mktemp("lake"))
    return done, runner.run_all(spark, done)


def ids(df, column):
    return sorted(r[column] for r in df.collect())


def test_cleaning(spark, lake):
    zones, counts = lake
    assert counts["orders"] == {"kept": 5, "order_dow": 1}
    assert counts["order_products"] == {"kept": 8, "reordered": 1}

    products = readers.read_clean(spark, zones, "products")
    assert products.schema == schemas.typed_schema("products")
    assert 'Jam, "sour"' in ids(products, "product_name")
    report = {(r["table"], r.rule): r.bad_rows for r in cleaning.quality_report(spark, zones).collect()}
    assert report == {
        ("orders", "order_dow"): 1,
        ("order_products", "reordered"): 1,
        ("products", "orphan_aisle"): 1,
        ("products", "orphan_department"): 1,
        ("order_products", "orphan_product"): 1,
        ("order_products", "orphan_order"): 1,
    }
    assert readers.read_rejects(spark, zones, "orders").first().order_dow == "9"


def test_ml_splits(spark, lake):
    zones, _ = lake
    train, test = (readers.read_ml_split(spark, zones, name) for name in ("train", "test"))
    assert train.columns == schemas.ML_COLUMNS
    assert [(r.user_id, r.product_id, r.up_orders) for r in train.collect()] == [(1, 10, 2)]
    assert [(r.user_id, r.product_id, r.product_name) for r in test.collect()] == [(2, 11, "Bread")]


def test_catalog_views(spark, lake):
    zones, _ = lake
    assert "user_features" in catalog.register(spark, zones)
    assert spark.sql("SELECT count(*) FROM user_features").first()[0] == 2


def test_sql_job_reads_the_tables_whatever_views_there_are(spark, lake, conf, tmp_path):
    zones, _ = lake
    conf({"spark.sql.session.timeZone": "Asia/Tokyo"})
    before = {key: spark.conf.get(key) for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")}
    for name in ("user_features", "some_view"):
        spark.range(7).createOrReplaceTempView(name)
    try:
        query = "SELECT count(*) AS users, current_timezone() AS zone FROM user_features"
        catalog.write_result(spark, zones, query, str(tmp_path / "result"))
    finally:
        for name in ("user_features", "some_view"):
            spark.catalog.dropTempView(name)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "result")).collect()] == [(2, "Asia/Tokyo")]
    assert {key: spark.conf.get(key) for key in before} == before
    assert not [found for found in spark.catalog.listDatabases() if found.name.startswith("curated_")]


def test_train_and_score_jobs(spark, lake, tmp_path):
    zones, _ = lake
    model = str(tmp_path / "model")
    recommend.train_job(spark, zones, model)
    for _ in range(2):
        recommend.score_job(spark, zones, model)
    assert [(r.user_id, r.product_id) for r in predictions.read(spark, zones).collect()] == [("2", "11")]


def test_rerun_replaces(spark, zones):
    cleaning.clean_all(spark, zones)
    for _ in range(2):
        curation.write_features(spark, zones)
        assert readers.read_curated(spark, zones, "order_products_prior").count() == 5
    cleaning.clean_all(spark, zones)
    assert readers.read_clean(spark, zones, "orders").count() == 5


def test_sorted_table_is_in_order_over_files(spark, lake):
    zones, _ = lake
    files = sorted(Path(zones.curated_table("user_features")).glob("*.parquet"))
    users = [r.user_id for path in files for r in spark.read.parquet(str(path)).collect()]
    assert users == [1, 2]


def test_an_error_in_cleaning_stops_curation(spark, zones, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("bad raw file")

    monkeypatch.setattr(cleaning, "load_table", fail)
    with pytest.raises(RuntimeError, match="bad raw file"):
        runner.run_all(spark, zones)
    assert not (tmp_path / "curated").exists()


def test_a_run_is_resumed_after_its_last_finished_stage(spark, zones, monkeypatch):
    monkeypatch.setattr(curation, "write_features", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runner.run_all(spark, zones)
    monkeypatch.undo()
    monkeypatch.setattr(cleaning, "clean_all", lambda *_: pytest.fail("cleaned again"))
    assert runner.run_all(spark, zones, resume=True)["orders"] == {"kept": 5, "order_dow": 1}
    assert readers.read_ml_split(spark, zones, "train").count() == 1


def test_one_run_at_a_time(spark, tmp_path):
    zones, order = Zones.under(str(tmp_path)), []

    def second():
        with pytest.raises(RuntimeError, match="not ended"):
            runs.run(spark, zones, [("a", lambda: order.append("refused"))])

    def taken_over():
        runs.run(spark, zones, [("a", lambda: order.append("again")), ("b", lambda: order.append("b"))], resume=True)

    assert runs.run(spark, zones, [("a", lambda: 1), ("b", second)]) == {"a": 1, "b": None}
    with pytest.raises(RuntimeError, match="another run"):
        runs.run(spark, zones, [("a", lambda: 1), ("c", taken_over)])
    assert order == ["b"]
    assert runs.run(spark, zones, [("a", lambda: 2)], resume=True) == {"a": 2}


def test_fixed_rows_leave_no_stale_rejects(spark, zones, tmp_path):
    cleaning.clean_all(spark, zones)
    put(tmp_path, "orders", RAW["orders"][:5])
    cleaning.clean_all(spark, zones)
    assert readers.read_rejects(spark, zones, "orders").count() == 0


def test_catalog_database(spark, lake):
    zones, _ = lake
    catalog.register_database(spark, zones, "shop")
    try:
        assert spark.sql("SELECT count(*) FROM shop.ml_dataset").first()[0] == 2
    finally:
        spark.sql("DROP DATABASE shop CASCADE")


def test_command_line(zones):
    args = runner.parser().parse_args(["clean", "--root", "/lake/", "--clean", "/other/"])
    got = runner.zones_from(args)
    assert (got.raw, got.clean) == ("/lake/raw", "/other")
    with pytest.raises(SystemExit):
        runner.main(["curate", "--clean", "/lake/clean"])


def test_incremental_runs_equal_one_batch(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    checkpoint = str(tmp_path / "checkpoint")
    for n, part in enumerate([RAW["orders"][:2], RAW["orders"][2:4]]):
        put(tmp_path, "orders", part, f"part-{n}.csv")
    incremental_clean(spark, zones, "orders", checkpoint, max_files=1)
    assert ids(readers.read_clean(spark, zones, "orders"), "order_id") == [1, 2, 3, 4]

    incremental_clean(spark, zones, "orders", checkpoint)
    assert readers.read_clean(spark, zones, "orders").count() == 4

    put(tmp_path, "orders", RAW["orders"][4:], "part-2.csv")
    incremental_clean(spark, zones, "orders", checkpoint)
    assert ids(readers.read_clean(spark, zones, "orders"), "order_id") == [1, 2, 3, 4, 5]
    assert ids(readers.read_rejects(spark, zones, "orders"), "order_id") == ["6"]


def test_stream_refuses_a_wrong_header(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    path = put(tmp_path, "aisles", ["1,a"], "part-0.csv")
    path.write_text("aisle,aisle_id\nfresh,1\n")
    with pytest.raises(Exception, match="(?i)header|stream"):
        incremental_clean(spark, zones, "aisles", str(tmp_path / "checkpoint"))


def test_files_of_a_table_must_agree_on_the_header(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    put(tmp_path, "aisles", ["1,fresh"], "a.csv")
    put(tmp_path, "aisles", [], "b.csv").write_text("aisle,aisle_id\ndry,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_raw(spark, zones, "aisles").collect()


def test_columns_are_found_by_name(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    put(tmp_path, "aisles", []).write_text("aisle,aisle_id\ndry,2\n")
    assert tuple(readers.read_raw(spark, zones, "aisles").first()) == ("2", "dry")


def later(path: Path, seconds: int) -> None:
    moment = time.time() + seconds
    os.utime(path, (moment, moment))


def folders(zones, table):
    """The loads of a clean table and when each was last written."""
    return {path.name: path.stat().st_mtime_ns for path in Path(zones.clean_table(table)).glob("load=*")}


def test_a_changed_file_costs_its_own_rows(spark, tmp_path):
    zones = Zones.under(str(tmp_path))

    def refresh(removed=False):
        action = refresh_table(spark, zones, "orders", removed=removed)
        return action, ids(readers.read_clean(spark, zones, "orders"), "order_id")

    first = put(tmp_path, "orders", RAW["orders"][:2], "a {1} é.csv")
    later(first, -500)
    assert refresh() == ("rebuild", [1, 2])
    assert refresh() == ("none", [1, 2])

    # New files, one of them older than what is done.
    added = put(tmp_path, "orders", RAW["orders"][2:4], "b.csv")
    old = put(tmp_path, "orders", RAW["orders"][4:6], "sub/c.csv")
    later(old, -900)
    before = folders(zones, "orders")
    assert refresh() == ("append", [1, 2, 3, 4, 5])
    assert ids(readers.read_rejects(spark, zones, "orders"), "order_id") == ["6"]
    assert {name: folders(zones, "orders")[name] for name in before} == before

    before = folders(zones, "orders")
    put(tmp_path, "orders", RAW["orders"][1:2], "a {1} é.csv")
    later(first, -300)
    assert refresh() == ("rewrite", [2, 3, 4, 5])
    after = folders(zones, "orders")
    assert [name for name in after if after[name] != before[name]] == ["load=0"] and len(after) == 3

    # A file that has no good row any more, and one whose bad row is mended.
    put(tmp_path, "orders", ["9,1,prior,1,9,8,"], "b.csv")
    put(tmp_path, "orders", RAW["orders"][4:5], "sub/c.csv")
    later(added, 100), later(old, 100)
    assert refresh() == ("rewrite", [2, 5])
    assert ids(readers.read_rejects(spark, zones, "orders"), "order_id") == ["9"]

    old.unlink()
    assert refresh() == ("rewrite", [2])
    first.unlink()
    added.unlink()
    with pytest.raises(FileNotFoundError):
        refresh()
    assert ids(readers.read_clean(spark, zones, "orders"), "order_id") == [2]
    assert refresh(removed=True) == ("rewrite", [])
    assert refresh(removed=True) == ("none", [])
    put(tmp_path, "orders", RAW["orders"][:1], "d.csv")
    assert refresh() == ("append", [1])
    assert len(list(Path(zones.bookmark("orders")).glob("version=*"))) == 1


def test_a_failed_refresh_is_repeated(spark, tmp_path, monkeypatch):
    from basketflow.streaming import arrivals

    zones = Zones.under(str(tmp_path))
    later(put(tmp_path, "orders", RAW["orders"][:2], "a.csv"), -500)
    refresh_table(spark, zones, "orders")
    put(tmp_path, "orders", RAW["orders"][2:4], "b.csv")
    with monkeypatch.context() as broken:
        broken.setattr(arrivals, "_write_bookmark", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_table(spark, zones, "orders")
    assert refresh_table(spark, zones, "orders") == "append"
    assert ids(readers.read_clean(spark, zones, "orders"), "order_id") == [1, 2, 3, 4]


def test_notifications_refresh_only_named_tables(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    for table in ("orders", "aisles"):
        put(tmp_path, table, RAW[table])
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    runs = []

    def send(name, key, source="aws:s3"):
        # Keys are below the prefix of the zones.
        record = {
            "eventSource": source,
            "eventName": "ObjectCreated:Put",
            "s3": {"bucket": {"name": "raw"}, "object": {"key": key}},
        }
        (inbox / name).write_text(json.dumps({"Records": [record]}) + "\n")
        on_notifications(
            spark, zones, str(inbox), str(tmp_path / "checkpoint"), then=lambda *_: runs.append(name)
        )

    send("1.json", "data/orders.csv")
    assert ids(readers.read_clean(spark, zones, "orders"), "order_id") == [1, 2, 3, 4, 5]
    assert not Path(zones.clean_table("aisles")).exists()
    send("2.json", "data/aisles.csv", source="other")
    assert not Path(zones.clean_table("aisles")).exists()
    send("3.json", "data/orders.csv")
    assert runs == ["1.json"]


def test_shuffles_are_sized_by_the_files(spark, zones, conf, monkeypatch):
    from basketflow import session

    conf({"spark.sql.shuffle.partitions": "4"})
    with session.sized_shuffles(spark, zones.raw) as wanted:
        assert wanted == 4
    size = sum(path.stat().st_size for path in Path(zones.raw).rglob("*.csv"))
    monkeypatch.setattr(session, "INPUT_PER_TASK", 20)
    with session.sized_shuffles(spark, zones.raw) as wanted:
        assert wanted == -(-size // 20) > 4
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(wanted)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


@pytest.mark.parametrize("cleaned_before", [False, True])
def test_a_created_message_without_a_raw_file_leaves_the_table_alone(spark, tmp_path, cleaned_before):
    """The raw files lie in another folder than the zones say."""
    put(tmp_path, "orders", RAW["orders"])
    zones = Zones.under(str(tmp_path))
    cleaning.clean_all(spark, raw_zones(tmp_path))
    if cleaned_before:
        refresh_table(spark, zones, "orders")
    wrong = Zones.under(str(tmp_path), prefix="incoming/")
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    record = {
        "eventSource": "aws:s3",
        "eventName": "ObjectCreated:Put",
        "s3": {"bucket": {"name": "raw"}, "object": {"key": "incoming/orders.csv"}},
    }
    (inbox / "1.json").write_text(json.dumps({"Records": [record]}) + "\n")
    with pytest.raises(Exception, match="no raw file"):
        on_notifications(spark, wrong, str(inbox), str(tmp_path / "checkpoint"))
    assert readers.read_clean(spark, zones, "orders").count() == 5


def test_raw_files_are_parsed_once(spark, zones):
    """Each line of a table with rejects is read from its file one time."""
    from basketflow.plans.cleaning import load_table

    seen = spark.sparkContext.accumulator(0)
    raw = readers.read_raw(spark, zones, "orders")
    counted = raw.mapInPandas(lambda parts: (seen.add(len(p)) or p for p in parts), raw.schema)
    assert load_table(counted, zones, "orders")["order_dow"] == 1
    assert seen.value == len(RAW["orders"])


def test_scratch_ends(spark):
    from basketflow import session
    from basketflow.sources import files

    with session.scratch_scope(spark):
        frame = session.stored(spark.range(5), "short-lived")
        path = session._scratch[spark.sparkContext.applicationId][-1]
        assert frame.count() == 5 and files.exists(spark, path)
    assert not files.exists(spark, path)


def test_newest_model_scores(spark, lake, tmp_path):
    zones, _ = lake
    for n, name in enumerate(("b", "a")):
        recommend.train_job(spark, zones, str(tmp_path / "models" / name))
        for path in (tmp_path / "models" / name).rglob("*"):
            later(path, n * 100 - 500)
    assert recommend.newest_model(spark, str(tmp_path / "models")).endswith("/models/a")
    zones = replace(zones, consumption=str(tmp_path / "consumption"))
    recommend.score_job(spark, zones, None, models=str(tmp_path / "models"))
    assert predictions.read(spark, zones).count() == 1


def test_new_predictions_rewrite_the_buckets_of_their_users(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    schema = "user_id string, product_id string, predicted_probability double"
    old = spark.createDataFrame([(str(i), p, 0.5) for i in range(60) for p in "12"], schema)
    new = spark.createDataFrame([("3", "1", 0.75), ("99", "1", 0.25), ("3", "1", 0.125)], schema)
    assert predictions.upsert(spark, zones, old) == list(range(predictions.LEAST))

    def written():
        return {p: p.stat().st_mtime_ns for p in Path(zones.predictions()).glob("[!_]*/bucket=*/*.parquet")}

    def rows(frame):
        return {(r.user_id, r.product_id): r.predicted_probability for r in frame.collect()}

    before, expected = written(), {**rows(old), ("3", "1"): 0.75, ("99", "1"): 0.25}
    for _ in range(2):
        touched = predictions.upsert(spark, zones, new)
        assert 1 <= len(touched) <= 2
        assert rows(predictions.read(spark, zones)) == expected
    folders = {f"bucket={n}" for n in touched}
    same = {p for p in before if p in written() and before[p] == written()[p]}
    assert same == {p for p in before if p.parent.name not in folders}
    assert predictions.upsert(spark, zones, new.limit(0)) == []

    predictions.deal_anew(spark, zones, 3)
    assert rows(predictions.read(spark, zones)) == expected
    one = predictions.read(spark, zones, "3")
    assert rows(one) == {("3", "1"): 0.75, ("3", "2"): 0.5}
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_command_line_has_the_stream_jobs(spark, tmp_path):
    zones = Zones.under(str(tmp_path))
    put(tmp_path, "orders", RAW["orders"], "part-0.csv")
    runner.main(["stream", "--root", str(tmp_path), "--tables", "orders", "--checkpoint", str(tmp_path / "c")])
    assert readers.read_clean(spark, zones, "orders").count() == 5
    with pytest.raises(SystemExit):
        runner.main(["arrivals", "--root", str(tmp_path)])


def test_tasks_are_sized_for_the_basket_tables(spark, conf, monkeypatch, tmp_path):
    """Partitions grow with the files; scans and merged partitions are bounded."""
    from basketflow import session
    from basketflow.testbed import mapping

    conf({"spark.sql.shuffle.partitions": "2", "spark.sql.files.maxPartitionBytes": "128m"})
    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb"})
    monkeypatch.setattr(session, "INPUT_PER_TASK", 2000)
    monkeypatch.setattr(mapping, "once", lambda *_: {})
    made = []
    for folder, rows in (("small", 1), ("large", 10_000)):
        for table in ("orders", "part", "lineitem"):
            spark.range(rows).write.parquet(f"{tmp_path}/{folder}/{table}.parquet")
        mapping.tables(spark, f"{tmp_path}/{folder}")
        made.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert made[0] <= 3 and made[1] > 15
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 16 << 20
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "10kb"
