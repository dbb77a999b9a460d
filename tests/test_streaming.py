"""The incremental Bronze load as an availableNow file stream."""

import csv

from tillroll import schemas as S
from tillroll.plans.etl import WarehousePaths, read_bronze_orders
from tillroll.sources.runlog import read_log
from tillroll.streaming import start_orders_stream


def _drop(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        w = csv.writer(f)
        w.writerow([x.name for x in S.BRONZE_ORDERS])
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def test_stream_appends_only_new_ids(spark, scratch):
    landing = scratch / "landing"
    paths = WarehousePaths(str(scratch / "wh"))
    _drop(landing / "a.csv", [(1, 10, "prior", 1, 1, 10, None), (2, 10, "train", 2, 2, 11, 5.0), (3, 11, "prior", 1, 5, 12, None)])
    start_orders_stream(spark, str(landing), paths).awaitTermination()
    assert sorted(r.order_id for r in read_bronze_orders(spark, paths).collect()) == [1, 2, 3]

    # a late id (below the watermark), a duplicate and a new id arrive
    _drop(landing / "b.csv", [(0, 12, "prior", 1, 1, 9, None), (3, 11, "prior", 1, 5, 12, None), (4, 12, "prior", 1, 3, 8, None)])
    start_orders_stream(spark, str(landing), paths).awaitTermination()
    assert sorted(r.order_id for r in read_bronze_orders(spark, paths).collect()) == [1, 2, 3, 4]

    # nothing new: no batch, nothing appended
    start_orders_stream(spark, str(landing), paths).awaitTermination()
    assert read_bronze_orders(spark, paths).count() == 4
    log = read_log(spark, paths.log).orderBy("watermark_order_id").collect()
    assert [r.watermark_order_id for r in log] == [3, 4] and all(r.status == "SUCCESS" for r in log)


def test_failed_batch_is_replayed_without_duplicates(spark, scratch, monkeypatch):
    import tillroll.streaming.incremental as stream_mod

    landing = scratch / "landing"
    paths = WarehousePaths(str(scratch / "wh"))
    _drop(landing / "a.csv", [(1, 10, "prior", 1, 1, 10, None), (2, 10, "train", 2, 2, 11, 5.0)])

    real_append = stream_mod.append_log

    def failing_append(*args):
        raise RuntimeError("executor lost after the write")

    monkeypatch.setattr(stream_mod, "append_log", failing_append)
    q = start_orders_stream(spark, str(landing), paths)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert read_bronze_orders(spark, paths).count() == 2  # written, not yet committed

    monkeypatch.setattr(stream_mod, "append_log", real_append)
    start_orders_stream(spark, str(landing), paths).awaitTermination()  # replays the batch
    assert sorted(r.order_id for r in read_bronze_orders(spark, paths).collect()) == [1, 2]
    assert read_log(spark, paths.log).count() == 1


def test_batch_that_dies_after_its_log_row_keeps_its_rows(spark, scratch, monkeypatch):
    import tillroll.streaming.incremental as stream_mod

    landing = scratch / "landing"
    paths = WarehousePaths(str(scratch / "wh"))
    _drop(landing / "a.csv", [(1, 10, "prior", 1, 1, 10, None), (2, 10, "train", 2, 2, 11, 5.0)])
    real_append = stream_mod.append_log

    def append_then_die(*args):
        real_append(*args)
        raise RuntimeError("driver lost before the stream committed the batch")

    monkeypatch.setattr(stream_mod, "append_log", append_then_die)
    try:
        start_orders_stream(spark, str(landing), paths).awaitTermination()
    except Exception:
        pass
    assert read_log(spark, paths.log).count() == 1
    monkeypatch.setattr(stream_mod, "append_log", real_append)
    start_orders_stream(spark, str(landing), paths).awaitTermination()
    assert sorted(r.order_id for r in read_bronze_orders(spark, paths).collect()) == [1, 2]
    log = read_log(spark, paths.log).collect()
    assert [(r.rows_loaded, r.watermark_order_id) for r in log] == [(2, 2)]


def test_a_file_with_another_header_fails_the_batch(spark, scratch):
    landing = scratch / "landing"
    landing.mkdir(parents=True)
    names = [x.name for x in S.BRONZE_ORDERS]
    (landing / "a.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\n10,1,prior,1,1,10,\n")
    paths = WarehousePaths(str(scratch / "wh"))
    try:
        start_orders_stream(spark, str(landing), paths).awaitTermination()
    except Exception as exc:
        assert "header" in str(exc).lower()
    else:
        raise AssertionError("columns were read by position")
