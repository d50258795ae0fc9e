"""File readers, typed scans and the keyed log of the streams."""

import tempfile

import pytest
from pyspark.sql import types as T

from rateflow.schemas import RATING
from rateflow.sources import files, tables, text


def test_text_file_readers(spark):
    d = tempfile.mkdtemp(prefix="rf-text-")
    with open(f"{d}/products.txt", "w", encoding="utf-8") as f:
        f.write("7^ Mouse ^1,2^B00^http://img^a|b^x|y\n1^short\n")
    with open(f"{d}/ratings.txt", "w", encoding="utf-8") as f:
        f.write("1,7,4.5,1000\n2,7,oops,1001\n")
    good, bad = text.read_products_text(spark, f"{d}/products.txt")
    assert [tuple(r) for r in good.collect()] == [(7, "Mouse", "http://img", "a|b", "x|y")]
    assert [r.reason for r in bad.collect()] == ["short_row"]
    good, bad = text.read_ratings_text(spark, f"{d}/ratings.txt")
    assert [tuple(r) for r in good.collect()] == [(1, 7, 4.5, 1000)]
    assert bad.count() == 1


def test_typed_scan_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="rf-scan-")
    df = spark.createDataFrame([(1, 2, 3.0, 4, "extra")],
                               "userId long, productId long, score double, timestamp long, x string")
    tables.write_table(df, f"{d}/Rating")
    back = tables.read_ratings(spark, f"{d}/Rating")
    assert back.schema == RATING
    assert [tuple(r) for r in back.collect()] == [(1, 2, 3.0, 4)]


def test_product_scan(spark):
    from rateflow.schemas import PRODUCT
    d = tempfile.mkdtemp(prefix="rf-scan-")
    df = spark.createDataFrame([(7, "n", "", "c", "t", 1)],
                               "productId long, name string, imageUrl string, categories string, tags string, x int")
    tables.write_table(df, f"{d}/Product")
    back = tables.read_products(spark, f"{d}/Product")
    assert back.schema == PRODUCT and back.count() == 1


LOG = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.IntegerType())])


def _log(spark, batches=4):
    log = tables.KeyedLog(spark, tempfile.mkdtemp(prefix="rf-keyed-") + "/t", LOG)
    assert log.read().count() == 0
    for b in range(batches):
        log.append(spark.createDataFrame([(1, b), (2, 10 + b)], LOG), b)
    return log


def _values(log):
    return sorted(r.v for r in log.read().collect())


def _same(rows):
    return rows.select("k", "v")


def test_a_repeated_batch_replaces_its_rows(spark):
    log = _log(spark)
    log.append(spark.createDataFrame([(1, 99)], LOG), 3)
    assert _values(log) == [0, 1, 2, 10, 11, 12, 99]


def test_a_repeated_compaction_changes_nothing(spark):
    log = _log(spark)
    log.compact(_same, 1)
    before = files.names(spark, f"{log.path}/_snapshot")
    log.compact(_same, 1)
    log.compact(_same, 0)
    assert files.names(spark, f"{log.path}/_snapshot") == before
    assert log.marker() == 1 and _values(log) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_a_stop_before_the_marker_is_harmless(spark, monkeypatch):
    log = _log(spark)
    with monkeypatch.context() as m:
        def stop(*_):
            raise KeyboardInterrupt
        m.setattr(files, "create", stop)
        with pytest.raises(KeyboardInterrupt):
            log.compact(_same, 2)
    assert log.marker() is None and _values(log) == [0, 1, 2, 3, 10, 11, 12, 13]
    log.compact(_same, 2)
    assert log.marker() == 2 and _values(log) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_folded_batches_go_one_compaction_later(spark):
    log = _log(spark)
    log.compact(_same, 1)
    assert len([n for n in files.names(spark, log.path) if n.startswith("batch_id=")]) == 4
    listed = log.read()
    log.compact(_same, 2)
    assert sorted(n for n in files.names(spark, log.path) if n.startswith("batch_id=")) == ["batch_id=2", "batch_id=3"]
    assert len(listed.where("batch_id > 1").collect()) == 4       # a reader of before goes on
    log.compact(_same, 3)
    assert len(files.names(spark, f"{log.path}/_snapshot")) == 2 == len(files.names(spark, f"{log.path}/_marker"))
    assert _values(log) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_lost_markers_are_an_error_once_batches_are_gone(spark):
    log = _log(spark)
    log.compact(_same, 1)
    log.compact(_same, 2)
    files.remove(spark, f"{log.path}/_marker")
    with pytest.raises(RuntimeError):
        log.read()


def test_other_errors_are_not_taken_for_an_empty_table(spark):
    log = _log(spark)
    broken = tables.KeyedLog(spark, log.path, T.StructType([T.StructField("v", T.ArrayType(T.StringType()))]))
    with pytest.raises(Exception):
        broken.read().collect()
