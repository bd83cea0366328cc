"""Purchase history that grows by loads, and the curated tables that follow.

Each load writes, to folders of its own, its lines, its pair totals and the two
lowest order numbers of its pairs. All of these can be merged, so the features
of all history follow from the sums of the loads and old lines are not read.

Which folders count is said by a log: one small file per version, created
whole or not at all. A load counts from the moment its version stands. So a
load that fails on the way changes nothing, one that is run again replaces
itself, and the folders of the one before it go only afterwards. When many
loads have come, their sums are folded into one folder; such loads are done,
and running one of them again does nothing.

`curate_new` finds the loads by itself: it compares the loads of the clean
tables with those the log has seen. Lines and orders may come in any order, so
what is new in their join is new lines with all orders, and old lines with new
orders. If a clean load was rewritten or is gone, history is built anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from basketflow.operators import purchases
from basketflow.operators.purchases import PAIR
from basketflow.plans.curation import HISTORY, write_feature_tables, write_ml_dataset
from basketflow.session import scratch_scope, sized_shuffles, stored, tune
from basketflow.sources import files, readers, versions
from basketflow.sources.zones import Zones

# So many loads are read side by side before their sums are folded.
MOST_OPEN = 16
GROWING = ["orders", "order_products"]
SUMS = ["totals", "lowest"]


@dataclass(frozen=True)
class Log:
    """lines: the folder of each load's lines; sums: of those not yet folded;
    base: the folder of the folded ones' sums; taken: what was found of each
    clean load that is in the sums; written: the same, when the curated tables
    were last written from them."""

    version: int = -1
    lines: dict[str, str] = field(default_factory=dict)
    sums: dict[str, str] = field(default_factory=dict)
    base: str | None = None
    taken: dict[str, dict[str, list[int]]] = field(default_factory=dict)
    written: dict[str, dict[str, list[int]]] = field(default_factory=dict)

    def folders(self) -> list[str]:
        return [*self.sums.values(), *([self.base] if self.base else [])]


def read_log(spark: SparkSession, zones: Zones) -> Log:
    number, record = versions.newest(spark, f"{zones.history_log()}/log")
    return replace(Log(**record), version=number) if record else Log()


def _commit(spark: SparkSession, zones: Zones, log: Log) -> None:
    """Make `log` the newest version, then delete what it no longer names."""
    new = replace(log, version=log.version + 1)
    versions.commit(spark, f"{zones.history_log()}/log", new.version, asdict(new))
    named = {f"part={folder}" for folder in new.lines.values()}
    for name in files.names(spark, zones.curated_table(HISTORY)):
        if name not in named:
            files.delete(spark, f"{zones.curated_table(HISTORY)}/{name}")
    for kind in SUMS:
        for name in files.names(spark, f"{zones.history_log()}/{kind}"):
            if name not in new.folders():
                files.delete(spark, f"{zones.history_log()}/{kind}/{name}")


def _lines(zones: Zones, folder: str) -> str:
    return f"{zones.curated_table(HISTORY)}/part={folder}"


def _parts(spark: SparkSession, zones: Zones, kind: str) -> DataFrame:
    folders = read_log(spark, zones).folders()
    return spark.read.parquet(*(f"{zones.history_log()}/{kind}/{folder}" for folder in folders))


def _merged(spark: SparkSession, zones: Zones, kind: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sums of all loads; those of a single folder are merged as they lie."""
    parts = _parts(spark, zones, kind)
    return parts if len(read_log(spark, zones).folders()) == 1 else merge(parts)


def totals(spark: SparkSession, zones: Zones) -> DataFrame:
    """Pair totals of all loads."""
    return _merged(spark, zones, "totals", purchases.merge_totals)


def lowest(spark: SparkSession, zones: Zones) -> DataFrame:
    """The two lowest order numbers of each pair over all loads."""
    return _merged(spark, zones, "lowest", purchases.merge_lowest)


def _unknown(rows: DataFrame) -> bool:
    """Whether a key or an order number is null, as in no clean table. Files
    whose statistics count no nulls are not read for it."""
    return not rows.filter(" OR ".join(f"{name} IS NULL" for name in [*PAIR, "order_number"])).isEmpty()


def _occasions(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """What the lowest order numbers of a load follow from. Only pairs with
    several are ranked, so these are stored, for Spark to see how many they are."""
    if _unknown(lines):
        return purchases.occasions(lines).select(*PAIR, "order_number", "lines")
    return purchases.occasions_with_only(lines, pairs, stored(purchases.several_orders(pairs), "several-orders"))


def add_load(
    spark: SparkSession,
    zones: Zones,
    prior: DataFrame,
    load: int,
    anew: bool = False,
    taken: dict[str, dict[str, list[int]]] | None = None,
) -> bool:
    """Add the `prior` lines of a load to history, or put them in the place of
    those it brought before; `anew` drops all other loads. False if the load is
    folded already. Nothing counts until the new version of the log stands,
    which also notes the clean loads `taken`."""
    log, key, folder = read_log(spark, zones), str(load), uuid.uuid4().hex
    kept = replace(log, lines={}, sums={}, base=None) if anew else log
    if key in kept.lines and key not in kept.sums:
        return False
    prior.write.parquet(_lines(zones, folder))
    with scratch_scope(spark):
        lines = spark.read.parquet(_lines(zones, folder))
        # Totals are sums of lines, and need no occasions.
        sums = {kind: f"{zones.history_log()}/{kind}/{folder}" for kind in SUMS}
        purchases.pair_totals(purchases.each_line(lines)).write.parquet(sums["totals"])
        per_occasion = _occasions(lines, spark.read.parquet(sums["totals"]))
        purchases.lowest_occasions(per_occasion).write.parquet(sums["lowest"])
    new = replace(
        kept, lines={**kept.lines, key: folder}, sums={**kept.sums, key: folder}, taken=taken or kept.taken, written={}
    )
    _commit(spark, zones, new)
    if len(new.sums) > MOST_OPEN:
        fold(spark, zones)
    return True


def fold(spark: SparkSession, zones: Zones) -> None:
    """Merge the sums of all loads into one folder."""
    log, folder = read_log(spark, zones), uuid.uuid4().hex
    for kind, merged in zip(SUMS, (totals, lowest)):
        merged(spark, zones).write.parquet(f"{zones.history_log()}/{kind}/{folder}")
    _commit(spark, zones, replace(log, sums={}, base=folder))


def early_purchases(spark: SparkSession, zones: Zones, pairs: DataFrame) -> DataFrame:
    """Early purchases of all loads, of which `pairs` are the stored totals.
    Pairs with one order number are counted from there; the lowest occasions of
    the others are merged."""
    parts = _parts(spark, zones, "lowest")
    if _unknown(parts):
        return purchases.early_purchases(lowest(spark, zones))
    several = stored(purchases.several_orders(pairs), "several-orders")
    lowest_of_several = purchases.merge_lowest(parts.join(several, PAIR, "left_semi"))
    return purchases.early_with_single(pairs, lowest_of_several)


def write_features(spark: SparkSession, zones: Zones) -> None:
    """The three feature tables from the sums of all loads. The totals are read
    for each of them; of the lowest occasions, those of pairs with several."""
    with scratch_scope(spark):
        pairs = totals(spark, zones)
        if len(read_log(spark, zones).folders()) > 1:
            pairs = stored(pairs, "pair-totals")
        write_feature_tables(zones, pairs, early_purchases(spark, zones, pairs))


def add_history(spark: SparkSession, zones: Zones, lines: DataFrame, orders: DataFrame, load: int) -> bool:
    """Add a load of history, whose lines and orders belong together, and write
    the features anew. Loads that come this way are numbered by the caller."""
    tune(spark)
    added = add_load(spark, zones, purchases.prior_lines(lines, orders), load)
    write_features(spark, zones)
    return added


def clean_loads(spark: SparkSession, zones: Zones, table: str) -> dict[str, list[int]]:
    """What the file system says of each load of a clean table."""
    folder = zones.clean_table(table)
    loads = [name for name in files.names(spark, folder) if name.startswith("load=")]
    return {name.removeprefix("load="): files.summary(spark, f"{folder}/{name}") for name in loads}


def _new_prior(spark: SparkSession, zones: Zones, fresh: dict[str, list[int]], old: dict[str, list[int]]) -> DataFrame:
    """The rows by which the join of lines and orders has grown."""

    def read(table: str, loads: list[int]) -> DataFrame:
        return readers.read_clean(spark, zones, table, loads)

    every_order = read("orders", old["orders"] + fresh["orders"])
    grown = purchases.prior_lines(read("order_products", fresh["order_products"]), every_order)
    if old["order_products"] and fresh["orders"]:
        late = purchases.prior_lines(read("order_products", old["order_products"]), read("orders", fresh["orders"]))
        grown = grown.unionByName(late)
    return grown


def curate_new(spark: SparkSession, zones: Zones) -> str:
    """Bring all curated tables up to date with the clean zone; returns what it
    did: "none", "append" or "rebuild". Products are named in the ML set only,
    so a change of theirs adds no history.

    A run that failed is finished by the next: the log says which clean loads
    are in the sums, and which of them the tables were written from."""
    tune(spark)
    log = read_log(spark, zones)
    now = {table: clean_loads(spark, zones, table) for table in [*GROWING, "products"]}
    if log.written == now:
        return "none"
    with sized_shuffles(spark, *(zones.clean_table(table) for table in GROWING)):
        action = _take_new_loads(spark, zones, log, {table: now[table] for table in GROWING})
        write_features(spark, zones)
        write_ml_dataset(spark, zones)
    _commit(spark, zones, replace(read_log(spark, zones), written=now))
    return action


def _take_new_loads(spark: SparkSession, zones: Zones, log: Log, now: dict[str, dict[str, list[int]]]) -> str:
    if log.taken == now:
        return "append"
    changed = any(
        now[table].get(load) != found for table in GROWING for load, found in log.taken.get(table, {}).items()
    )
    anew = changed or not log.taken
    old = {table: [] if anew else [int(load) for load in log.taken[table]] for table in GROWING}
    fresh = {table: [int(load) for load in now[table] if int(load) not in old[table]] for table in GROWING}
    number = max(map(int, log.lines), default=-1) + 1
    add_load(spark, zones, _new_prior(spark, zones, fresh, old), number, anew, now)
    return "rebuild" if anew else "append"
