"""Published versions: a reader always has one whole set of tables, loads that
meet add each id once, and folders no version names go."""

from __future__ import annotations

import threading

import pytest

from tillroll import schemas as S
from tillroll.plans import etl
from tillroll.plans.etl import Draft, WarehousePaths, _read, _write, compact_loads, published, read_bronze_orders, write_load
from tillroll.sources import incremental as inc
from tillroll.sources import versions

ORDER = (10, "prior", 1, 1, 10, None)


def orders(spark, ids):
    return spark.createDataFrame([(i, *ORDER) for i in ids], S.BRONZE_ORDERS)


def load(spark, paths, run_id, ids, before=lambda: None):
    def run(draft):
        target = read_bronze_orders(spark, draft, exclude_load=run_id)
        write_load(inc.incremental_rows(orders(spark, ids), target, None), draft)
        before()

    return published(run, spark, paths, run_id)


def held(spark, paths):
    return sorted(r.order_id for r in read_bronze_orders(spark, paths).collect())


class Killed(BaseException):
    pass


def test_a_reader_has_whole_sets_wherever_the_writer_dies(spark, scratch, monkeypatch):
    """A, B and C are written as one set; the writer dies after each of its
    steps in turn: every table's write, the manifest's draft, its claim."""
    paths, names = WarehousePaths(str(scratch / "wh")), ("a", "b", "c")

    def build(value, steps):
        done = 0

        def step():
            nonlocal done
            done += 1
            if done > steps:
                raise Killed

        def run(draft):
            for name in names:
                _write(spark.range(2).selectExpr(f"{value} AS v"), draft, name)
                step()

        real = versions._claim

        def claim(*args):
            step()
            claimed = real(*args)
            step()
            return claimed

        monkeypatch.setattr(versions, "_claim", claim)
        try:
            published(run, spark, paths, f"run{value}")
        except Killed:
            pass
        finally:
            monkeypatch.setattr(versions, "_claim", real)

    def seen(place):
        return {r.v for name in names for r in _read(spark, place, name).collect()}

    build(0, 99)
    assert seen(paths) == {0}
    for steps in range(6):
        value = steps + 1
        pinned = paths.at(paths.published(spark).number)
        before = seen(pinned)
        build(value, steps)
        assert seen(paths) == ({value} if steps >= 4 else before)  # the claim is the fifth step's work
        assert seen(pinned) == before  # a pinned reader goes on reading its set
    assert versions.numbers(spark, paths.root) == [1, 2, 3]


def test_two_loads_at_once_add_each_id_once(spark, scratch):
    paths = WarehousePaths(str(scratch / "wh"))
    load(spark, paths, "first", [1, 2])
    both = threading.Barrier(2, timeout=60)
    passed = {"x": 0, "y": 0}

    def meet(name):
        def wait():
            passed[name] += 1
            if passed[name] == 1:  # both have compared their keys before either publishes
                both.wait()

        return wait

    threads = [
        threading.Thread(target=load, args=(spark, paths, name, ids, meet(name)))
        for name, ids in (("x", [2, 3, 4, 5]), ("y", [4, 5, 6, 1]))
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert held(spark, paths) == [1, 2, 3, 4, 5, 6]
    assert sorted(passed.values()) == [1, 2]  # one of them compared again
    assert versions.numbers(spark, paths.root) == [1, 2, 3]


def test_one_number_is_claimed_once(spark, scratch):
    root = str(scratch / "wh")
    version = versions.Version(1, {"t": versions.Stored("t/a")})
    taken = []
    threads = [threading.Thread(target=lambda: taken.append(versions._claim(spark, root, version))) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == [False] * 7 + [True]
    assert versions.read_version(spark, root) == version


def test_a_conflicting_table_is_refused_and_another_is_not(spark, scratch):
    paths = WarehousePaths(str(scratch / "wh"))
    slow, other = Draft(spark, paths, "slow"), Draft(spark, paths, "other")
    _write(spark.range(1), slow, "t")
    _write(spark.range(2), other, "u")
    other.publish()
    assert slow.publish().number == 2 and _read(spark, paths, "u").count() == 2
    late = Draft(spark, paths, "late")
    _write(spark.range(3), late, "t")
    _write(spark.range(4), paths, "t")
    with pytest.raises(versions.VersionConflict):
        late.publish()
    assert _read(spark, paths, "t").count() == 4


def test_compacted_loads_stay_known(spark, scratch):
    paths = WarehousePaths(str(scratch / "wh"))
    for n in range(4):
        load(spark, paths, f"l{n}", [10 * n, 10 * n + 1])
    compact_loads(spark, paths)
    assert len({s.folder for s in paths.published(spark).loads.values()}) == 1
    load(spark, paths, "l2", [20, 21])  # a replay after the compaction
    load(spark, paths, "l9", [21, 90])
    assert held(spark, paths) == [0, 1, 10, 11, 20, 21, 30, 31, 90]


def test_only_overlapping_loads_are_listed(spark, scratch):
    paths = WarehousePaths(str(scratch / "wh"))
    for n in range(3):
        load(spark, paths, f"l{n}", [10 * n, 10 * n + 1])
    some = read_bronze_orders(spark, paths, between=(9, 11))
    assert sorted(r.order_id for r in some.collect()) == [10, 11] and all("/l1-" in f for f in some.inputFiles())
    assert read_bronze_orders(spark, paths, between=(0, -1)).count() == 0


def test_expired_versions_and_their_folders_go(spark, scratch):
    paths = WarehousePaths(str(scratch / "wh"))
    for n in range(4):
        _write(spark.range(n + 1), paths, "t")
    _write(spark.range(9), paths, "u")
    gone = versions.expire(spark, paths.root, keep=2)
    assert len(gone) == 3 and versions.numbers(spark, paths.root) == [4, 5]
    assert _read(spark, paths, "t").count() == 4 and _read(spark, paths.at(4), "t").count() == 4
    with pytest.raises(FileNotFoundError):
        paths.at(1).published(spark)
    assert etl.read_version(spark, str(scratch / "none")).number == 0
