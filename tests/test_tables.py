"""Sinks and publication: round trips, one winner, stale versions."""

import datetime
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from campuslens.operators.relational import Tables
from campuslens.sources import tables as S

NAMES = list(Tables.__dataclass_fields__)


def one(spark, mark):
    return Tables(**{n: spark.range(3).select("id", F.lit(mark).alias("carga")) for n in NAMES})


def marks(tables):
    return {df.select("carga").distinct().collect()[0][0] for df in tables.named().values()}


def folders(root):
    return {p.name for p in root.iterdir() if p.name != S.MANIFEST}


def test_one_of_two_loads_wins(spark, tmp_path):
    root = str(tmp_path)
    S.publish(spark, one(spark, "first"), root)
    meet = Barrier(2)

    def load(mark):
        def wait(staged):
            meet.wait(120)  # both have staged on the same base
            return spark.createDataFrame([("c", 0, 0)], "control string, valor int, esperado int")
        try:
            S.publish(spark, one(spark, mark), root, wait)
            return mark
        except S.PublicationConflict:
            return None
    with ThreadPoolExecutor(2) as pool:
        won = [m for m in pool.map(load, ["a", "b"]) if m]
    assert len(won) == 1
    assert marks(S.published(spark, root)) == set(won)
    found = S.versions(spark, root)
    assert [n for n, _ in found] == [1, 2]
    assert folders(tmp_path) == {v for _, v in found}  # the loser left nothing


def test_failed_control_and_dead_claim(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="nothing is published"):
        S.published(spark, root)
    S.publish(spark, one(spark, "first"), root)
    bad = spark.createDataFrame([("c", 1, 0)], "control string, valor int, esperado int")
    with pytest.raises(ValueError):
        S.publish(spark, one(spark, "second"), root, lambda t: bad)
    assert marks(S.published(spark, root)) == {"first"} and len(folders(tmp_path)) == 1
    S.claim(spark, root, 2, "")  # a load that died between claim and content
    assert marks(S.published(spark, root)) == {"first"}
    S.publish(spark, one(spark, "third"), root)
    assert marks(S.published(spark, root)) == {"third"}
    with pytest.raises(S.PublicationConflict):
        S.publish(spark, one(spark, "late"), root, base=1)


def test_prune_keeps_the_latest(spark, tmp_path):
    root = str(tmp_path)
    for mark in ("a", "b", "c"):
        S.publish(spark, one(spark, mark), root)
    kept = [v for _, v in S.versions(spark, root)][-1]
    assert len(S.prune(spark, root, 1)) == 2 and S.prune(spark, root, 1) == []
    assert folders(tmp_path) == {kept} and marks(S.published(spark, root)) == {"c"}
    S.publish(spark, one(spark, "d"), root)
    assert [n for n, _ in S.versions(spark, root)] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        S.prune(spark, root, 0)


def test_csv_and_json_round_trips(spark, tmp_path):
    when = datetime.datetime(2006, 1, 5, 8, 30, 0, 250_123)
    rows = [(1, 'a "b", c\nd\\', 2.5, True, when, [("x", 1), (None, None)]), (2, None, None, None, None, []),
            (3, " é ", -0.125, False, when, None)]
    df = spark.createDataFrame(rows, "i bigint, s string, d double, b boolean, t timestamp_ntz, "
                                     "n array<struct<k:string,v:int>>")
    S.write_json(df, str(tmp_path / "j"))
    back = S.read_json(spark, str(tmp_path / "j"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    flat = df.drop("n")
    S.write_csv(flat, str(tmp_path / "c"))
    typed = S.read_csv(spark, str(tmp_path / "c"), flat.schema)
    assert sorted(typed.collect()) == sorted(flat.collect())
    with pytest.raises(Exception, match="(?i)malformed|cast|parse|header"):
        S.read_csv(spark, str(tmp_path / "c"), "i bigint, s int, d double, b boolean, t timestamp_ntz").collect()
