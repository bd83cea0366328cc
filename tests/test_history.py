"""History that grows by loads: merged sums, repeated and failing loads, and
all curated tables equal to those of one batch."""

import shutil
from pathlib import Path

import pytest
from test_jobs import RAW, later, put, raw_zones

from basketflow.operators import purchases
from basketflow.plans import cleaning, curation, history, runner
from basketflow.sources import catalog, readers, writers
from basketflow.sources.zones import Zones

FEATURES = ["user_features", "up_features", "product_features"]
CURATED = ["order_products_prior", *FEATURES, "ml_dataset"]
PARTS = ("order_id < 2", "order_id = 2", "order_id > 2")


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    done = raw_zones(tmp_path_factory.mktemp("batch"))
    runner.run_all(spark, done)
    return done


@pytest.fixture
def zones(tmp_path):
    return Zones.under(str(tmp_path))


def rows(spark, zones, table):
    frame = readers.read_curated(spark, zones, table)
    return sorted((tuple(r) for r in frame.select(sorted(frame.columns)).collect()), key=repr)


def same(spark, zones, batch, tables=CURATED):
    return all(rows(spark, zones, table) == rows(spark, batch, table) for table in tables)


def parts(spark, batch):
    lines, orders = (readers.read_clean(spark, batch, t) for t in ("order_products", "orders"))
    return [(lines.filter(part), orders.filter(part)) for part in PARTS]


def test_two_lowest_numbers_merge(spark):
    fields = "user_id long, product_id long, order_number long, lines long"
    first = [(1, 1, 1, 2), (1, 1, 3, 1), (1, 1, 9, 5), (2, 1, 4, 1)]
    second = [(1, 1, 1, 1), (1, 1, 2, 4), (2, 1, 4, 2), (3, 1, 7, 1)]
    a, b = (purchases.lowest_occasions(spark.createDataFrame(part, fields)) for part in (first, second))
    merged = purchases.merge_lowest(a.unionByName(b))
    assert sorted(map(tuple, merged.collect())) == [(1, 1, 1, 3), (1, 1, 2, 4), (2, 1, 4, 3), (3, 1, 7, 1)]


def test_sums_of_a_single_folder_are_not_merged_again(spark, zones, batch):
    add(spark, zones, batch, 0)
    for sums in (history.totals, history.lowest):
        plan = sums(spark, zones)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    add(spark, zones, batch, 1)
    for sums in (history.totals, history.lowest):
        assert "Exchange" in sums(spark, zones)._jdf.queryExecution().executedPlan().toString()


def add(spark, zones, batch, load):
    lines, orders = parts(spark, batch)[load]
    return history.add_load(spark, zones, purchases.prior_lines(lines, orders), load)


def test_loads_add_up_to_one_batch_though_one_came_twice(spark, zones, batch):
    for load in (0, 1, 1):
        assert add(spark, zones, batch, load)
    assert history.add_history(spark, zones, *parts(spark, batch)[2], 2)
    assert same(spark, zones, batch, CURATED[:4])
    assert len(list(Path(zones.curated_table("order_products_prior")).glob("part=*"))) == 3
    assert all(len(list(Path(zones.history_log(), kind).iterdir())) == 3 for kind in history.SUMS)


def test_a_load_that_fails_on_the_way_changes_nothing(spark, zones, batch, monkeypatch):
    for load in (0, 1):
        add(spark, zones, batch, load)
    before = sorted(map(tuple, history.totals(spark, zones).collect()))

    def lost(per_occasion):
        return per_occasion.selectExpr("*", "raise_error('lost') AS broken")

    for load in (2, 1):  # a new load, and one that is put in its place
        with monkeypatch.context() as broken:
            broken.setattr(purchases, "lowest_occasions", lost)
            with pytest.raises(Exception, match="lost"):
                add(spark, zones, batch, load)
        assert sorted(map(tuple, history.totals(spark, zones).collect())) == before
    add(spark, zones, batch, 2)
    history.write_features(spark, zones)
    assert same(spark, zones, batch, CURATED[:4])


def test_many_loads_are_folded_and_then_done(spark, zones, batch, monkeypatch):
    monkeypatch.setattr(history, "MOST_OPEN", 1)
    for load in range(3):
        add(spark, zones, batch, load)
    log = history.read_log(spark, zones)
    assert log.base and list(log.sums) == ["2"] and len(log.lines) == 3
    assert not add(spark, zones, batch, 0)
    history.write_features(spark, zones)
    assert same(spark, zones, batch, CURATED[:4])


def test_of_two_writers_one_succeeds(spark, zones):
    log = history.read_log(spark, zones)
    history._commit(spark, zones, log)
    with pytest.raises(RuntimeError, match="another run"):
        history._commit(spark, zones, log)


def grow(spark, folder, zones, load, orders, lines):
    """One more raw file each, cleaned as a load of its own."""
    for table, part in (("orders", orders), ("order_products", lines)):
        if part:
            put(folder, table, part, f"{load}.csv")
            raw = readers.read_raw(spark, zones, table, pathGlobFilter=f"{load}.csv")
            cleaning.load_table(raw, zones, table, load=load, replace=not load)


def first_tables(spark, folder, zones):
    for table in ("aisles", "departments", "products"):
        put(folder, table, RAW[table])
        cleaning.load_table(readers.read_raw(spark, zones, table), zones, table)


def test_all_curated_tables_grow_with_the_clean_zone(spark, tmp_path, zones, batch):
    """Lines come before their orders, with them, and after them."""
    orders, lines = RAW["orders"], RAW["order_products"]
    first_tables(spark, tmp_path, zones)
    done = []
    for load, (some, others) in enumerate([(orders[:1], lines[1:6]), (orders[1:3], lines[:1]), (orders[3:], lines[6:])]):
        grow(spark, tmp_path, zones, load, some, others)
        done.append(history.curate_new(spark, zones))
    assert done == ["rebuild", "append", "append"]
    assert same(spark, zones, batch)
    assert len(history.read_log(spark, zones).lines) == 3
    assert history.curate_new(spark, zones) == "none"
    runner.main(["curate-new", "--root", str(tmp_path)])

    catalog.register_database(spark, zones, "grown")
    try:
        assert spark.sql("SELECT count(*) FROM grown.order_products_prior").first()[0] == 5
    finally:
        spark.sql("DROP DATABASE grown CASCADE")


def test_a_run_that_failed_after_its_load_is_finished(spark, tmp_path, zones, batch, monkeypatch):
    first_tables(spark, tmp_path, zones)
    grow(spark, tmp_path, zones, 0, RAW["orders"][:2], RAW["order_products"][:2])
    history.curate_new(spark, zones)
    grow(spark, tmp_path, zones, 1, RAW["orders"][2:], RAW["order_products"][2:])
    with monkeypatch.context() as broken:
        broken.setattr(history, "write_ml_dataset", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history.curate_new(spark, zones)
    assert history.curate_new(spark, zones) == "append"
    assert len(history.read_log(spark, zones).lines) == 2
    assert same(spark, zones, batch)


def test_rewritten_loads_renamed_products_and_batches(spark, tmp_path, zones, batch):
    shutil.copytree(batch.clean, zones.clean)
    assert history.curate_new(spark, zones) == "rebuild"

    put(tmp_path, "products", [line.replace("Bread", "Loaf") for line in RAW["products"]])
    cleaning.load_table(readers.read_raw(spark, zones, "products"), zones, "products")
    later(Path(zones.clean_table("products")) / "load=0", 5)
    assert history.curate_new(spark, zones) == "append"
    assert [r.product_name for r in readers.read_ml_split(spark, zones, "test").collect()] == ["Loaf"]
    assert len(history.read_log(spark, zones).lines) == 1

    lines = readers.read_clean(spark, batch, "order_products")
    writers.write_clean(lines.filter("product_id = 10"), zones, "order_products")
    assert history.curate_new(spark, zones) == "rebuild"
    by_log = [rows(spark, zones, table) for table in CURATED]
    curation.curate_all(spark, zones)
    assert [rows(spark, zones, table) for table in CURATED] == by_log
    assert history.read_log(spark, zones) == history.Log()


NUMBERS = [
    # user, product, order number, reordered: pairs of one order number, of two, of three, and with a number twice
    (1, 10, 1, 0), (1, 10, 2, 1), (1, 20, 2, 0), (1, 20, 2, 0), (2, 10, 3, 0), (2, 10, 1, 0), (2, 10, 2, 1),
    (2, 30, 1, None), (3, 20, 1, 0), (3, 20, 1, 1), (3, 20, 4, 1), (4, 30, 5, 0), (4, 30, 6, 1), (4, 30, 6, None),
]


def numbered(spark, some):
    rows = [(i, user, product, number, again, i % 3 or None, float(i % 2) or None, i % 2) for i, user, product, number, again in some]
    fields = (
        "order_id long, user_id long, product_id long, order_number long, reordered long, "
        "add_to_cart_order long, days_since_prior_order double, is_weekend int"
    )
    return spark.createDataFrame(rows, fields)


@pytest.mark.parametrize("unknown", [[], [(5, 10, None, 1), (5, 10, 1, 0), (None, 10, 1, 0), (None, 10, 2, 1), (6, None, 1, 0)]])
def test_features_of_loads_are_those_of_all_lines(spark, zones, unknown):
    """Pairs with one order number in a load, or in all, and with null keys."""
    all_lines = [(i, *row) for i, row in enumerate([*NUMBERS, *unknown])]
    for load in range(3):
        history.add_load(spark, zones, numbered(spark, [row for row in all_lines if row[0] % 3 == load]), load)
    history.write_features(spark, zones)
    per_occasion = purchases.occasions(numbered(spark, all_lines))
    pairs = purchases.pair_totals(per_occasion)
    whole = {
        "user_features": purchases.user_features(pairs),
        "up_features": purchases.user_product_features(pairs),
        "product_features": purchases.product_features(pairs, per_occasion),
    }
    for table, frame in whole.items():
        expected = sorted((tuple(r) for r in frame.select(sorted(frame.columns)).collect()), key=repr)
        assert rows(spark, zones, table) == expected


def test_pairs_of_one_order_number_are_not_ranked(spark, zones, monkeypatch):
    """Of two loads, only the pairs that have several numbers in all are merged."""
    ranked = []
    merge = purchases.merge_lowest

    def seen(parts):
        ranked.extend(sorted((r.user_id, r.product_id) for r in parts.collect()))
        return merge(parts)

    lines = [(0, 1, 10, 1, 0), (1, 1, 20, 1, 0), (2, 2, 10, 1, 0)], [(3, 1, 10, 2, 1), (4, 3, 10, 1, 0)]
    for load, some in enumerate(lines):
        history.add_load(spark, zones, numbered(spark, some), load)
    monkeypatch.setattr(purchases, "merge_lowest", seen)
    history.write_features(spark, zones)
    assert ranked == [(1, 10), (1, 10)]
