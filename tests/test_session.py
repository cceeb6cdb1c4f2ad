import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfrisk import session as SS


def fake(master, setting=None):
    chosen = {}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: chosen.get("dir"),
                              setCheckpointDir=lambda folder: chosen.update(dir=folder))
    conf = SimpleNamespace(get=lambda key, default: setting if setting else default)
    return SimpleNamespace(sparkContext=context, conf=conf), chosen


def test_checkpoint_folder_comes_from_the_session():
    spark, chosen = fake("spark://host:7077", "hdfs:///shared/points")
    assert SS.checkpoint_dir(spark) == "hdfs:///shared/points" == chosen["dir"]
    with pytest.raises(ValueError):
        SS.checkpoint_dir(fake("yarn")[0])


def test_stored_tables_know_their_size(spark):
    table = SS.materialise(spark.range(10), even=F.count_if(F.col("id") % 2 == 0))
    assert (SS.row_count(table), SS.total_of(table, "even"), table.count()) == (10, 5, 10)
    assert SS.stored(table) is table
    assert SS.row_count(SS.materialise(table.filter("id > 99"))) == 0


def test_broadcast_needs_a_fitting_size(spark):
    table = SS.materialise(spark.range(1000))
    assert SS.fits_broadcast(table) and not SS.fits_broadcast(table, max_bytes=100)
    assert not SS.fits_broadcast(table, rows=10**9)
    assert SS.broadcast_if_small(table, max_bytes=100) is table


def test_broadcast_measures_long_values(spark):
    """20,000 rows of 5,000 characters are 100 MB, however few the columns."""
    texts = spark.range(20_000).select("id", F.repeat(F.lit("x"), 5000).alias("text"))
    assert not SS.fits_broadcast(texts, rows=20_000) and not SS.fits_broadcast(SS.materialise(texts.limit(20_000)))
    assert SS.fits_broadcast(texts.limit(100)) and SS.fits_broadcast(texts.drop("text"), rows=20_000)
    lists = spark.range(10).select(F.array_repeat(F.lit(1.5), 1000).alias("v"), F.create_map(F.lit("key"), F.lit("value")).alias("m"),
                                   F.struct(F.lit("abc").alias("s"), F.lit(1).alias("i")).alias("p"), F.lit(None).cast("string").alias("none"),
                                   F.array(F.array(F.lit("abcd"))).alias("deep"))
    for table in (lists, SS.materialise(lists)):
        assert 10 * 8000 < SS.table_bytes(table) < 10 * 8400
    assert SS.table_bytes(lists.limit(0)) == 0


def test_null_keys_match(spark):
    left = spark.createDataFrame([(None, 1), (2, 2), (3, 3)], "k int, v int")
    right = spark.createDataFrame([(None, "n"), (2, "t")], "k int, w string")
    assert {(r["k"], r["v"], r["w"]) for r in SS.attach(left, right, ["k"]).collect()} == {
        (None, 1, "n"), (2, 2, "t"), (3, 3, None)}


def test_release_deletes_stored_tables(spark):
    table = SS.materialise(spark.range(10))
    path = table.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    kept, SS._STORED[:] = SS._STORED[:-1], SS._STORED[-1:]
    assert SS.release(spark) == 1 and not os.path.exists(path)
    SS._STORED[:] = kept
