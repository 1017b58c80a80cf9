"""The versioned store: what a merge writes, what readers see, and landings that break off."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources.store import Store, land

SCHEMA = "source string, ticker string, date string, value double"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA).withColumn("date", F.to_date("date"))


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def content(df):
    return sorted((r.source, r.ticker, str(r.date), r.value) for r in df.collect())


MANY = [("s", f"{i:03d}", "2024-01-01", float(i)) for i in range(12)] + [("t", "001", "2024-01-01", 0.5), ("s", "a b/c=d", "2024-01-02", 1.5)]


def test_a_merge_writes_the_touched_partitions_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.read() is None and store.merge(rows(spark, *MANY)) == 1
    before = files(store.folder + "/data")
    assert store.merge(rows(spark, ("s", "001", "2024-01-02", 7.0), ("s", "001", "2024-01-01", 9.0))) == 2
    added = files(store.folder + "/data") - before
    assert before <= files(store.folder + "/data") and {f.split("/data/")[1].rsplit("/", 1)[0] for f in added} == {"v=2/source=s/ticker=001"}
    want = sorted([r for r in MANY if r[:2] != ("s", "001")] + [("s", "001", "2024-01-01", 9.0), ("s", "001", "2024-01-02", 7.0)])
    assert content(store.read()) == want and content(store.read(version=1)) == sorted(MANY)
    assert content(store.read("2024-01-02", "2024-01-02")) == [("s", "001", "2024-01-02", 7.0), ("s", "a b/c=d", "2024-01-02", 1.5)]


def test_a_reader_keeps_its_version_and_columns_may_come(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.merge(rows(spark, *MANY))
    reader = store.read()
    store.merge(rows(spark, ("s", "002", "2024-01-01", -1.0)).withColumn("note", F.lit("new")))
    assert content(reader) == sorted(MANY) and "note" not in reader.columns
    assert {(r.ticker, r.note) for r in store.read().where("source = 's' and note is not null").collect()} == {("002", "new")}


def test_half_a_merge_is_not_there_and_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    store.merge(rows(spark, *MANY))
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.merge(rows(spark, ("s", "003", "2024-01-01", 5.0), ("s", "new", "2024-01-01", 5.0)))
    assert content(store.read()) == sorted(MANY)
    assert store.merge(rows(spark, ("s", "004", "2024-01-01", 5.0))) == 2
    assert {r[1]: r[3] for r in content(store.read()) if r[0] == "s"}["003"] == 3.0
    with monkeypatch.context() as m:
        m.setattr(Store, "log", lambda self: [1])
        with pytest.raises(Exception, match="(?i)exist"):
            store.merge(rows(spark, ("s", "005", "2024-01-01", 5.0)))


def test_vacuum_keeps_what_the_newest_versions_need(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for i in range(3):
        store.merge(rows(spark, *(MANY if i == 0 else [("s", "001", "2024-01-01", float(i))])))
    want = content(store.read())
    assert store.vacuum(1) == [1, 2] and content(store.read()) == want and store.log() == [3]
    assert not os.path.exists(store.folder + "/data/v=2") and os.path.exists(store.folder + "/data/v=1")


def test_empty_rows_make_no_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.merge(rows(spark, *MANY)) == 1 and store.merge(rows(spark, *MANY).limit(0)) == 1


def test_landings_read_each_file_once_and_go_on_after_a_failure(spark, tmp_path):
    incoming, progress = str(tmp_path / "incoming"), str(tmp_path / "progress")
    os.makedirs(incoming)
    store, seen = Store(spark, str(tmp_path / "store")), []

    def put(name, *lines):
        (tmp_path / "incoming" / name).write_text("source,ticker,date,value\n" + "\n".join(lines) + "\n")

    def parse(df):
        seen.extend(r.value for r in df.collect())
        return df

    def run():
        return land(spark, incoming, store, progress, "source string, ticker string, date date, value double", parse, most_files=1, header=True)

    put("a.csv", "s,A,2024-01-01,1.0")
    put("b.csv", "s,B,2024-01-01,2.0")
    assert run() == 2 and run() == 0 and sorted(seen) == [1.0, 2.0]
    put("c.csv", "s,A,2024-01-01,3.0", "s,C,2024-01-01,4.0")
    real = store.merge
    store.merge = lambda *a, **k: (real(*a, **k), 1 / 0)  # the batch reaches the store, then the landing dies
    with pytest.raises(Exception):
        run()
    version = store.log()
    store.merge = real
    assert run() == 1 and store.log() == version
    assert content(store.read()) == [("s", "A", "2024-01-01", 3.0), ("s", "B", "2024-01-01", 2.0), ("s", "C", "2024-01-01", 4.0)]
