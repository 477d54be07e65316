"""Versions of tables: atomic publication, crashes at every step, replaced partitions."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight.sources import files, snapshots
from ledgerlight.sources.snapshots import Conflict, Snapshots


def _store(spark):
    return Snapshots(spark, tempfile.mkdtemp(prefix="ll-snap-"))


def _months(spark, tag, months):
    return spark.createDataFrame([(2024, m, f"{tag}{m}") for m in months], "ano int, mes int, v string")


def test_a_crash_at_any_step_leaves_the_old_table(spark, monkeypatch):
    store = _store(spark)
    store.publish({"t": store.write("t", _months(spark, "a", [1, 2]), ["ano"])})
    old = rows(store.read("t"))

    # 1. while the data is written
    with pytest.raises(Exception, match="broken"):
        store.write("t", _months(spark, "b", [1]).withColumn("v", F.raise_error(F.lit("broken"))))
    assert rows(store.read("t")) == old
    # 2. after the data, before the version
    written = store.write("t", _months(spark, "b", [1]), ["ano"])
    assert rows(store.read("t")) == old
    # 3. inside the version file: half of it arrives
    with open(f"{store.root}/versions/{2:012d}.json", "w") as fh:
        fh.write(json.dumps({"version": 2, "tables": {"t": written}})[:40])
    assert rows(store.read("t")) == old
    with pytest.raises(Conflict, match="being written"):
        store.publish({"t": written})
    monkeypatch.setattr(snapshots, "STALE_SECONDS", -1)             # the writer is given up
    version = store.publish({"t": written})
    assert version["version"] == 3 and rows(store.read("t")) == [(2024, 1, "b1")]
    # 4. after the version, before or during the clean-up
    monkeypatch.setattr(Snapshots, "_delete", lambda self, relative: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.vacuum(keep=1)
    assert rows(store.read("t")) == [(2024, 1, "b1")]
    monkeypatch.undo()
    store.vacuum(keep=1)
    assert rows(store.read("t")) == [(2024, 1, "b1")] and len(os.listdir(f"{store.root}/data")) == 1


def test_only_one_of_two_writers_publishes(spark):
    store = _store(spark)
    base = store.publish({"t": store.write("t", _months(spark, "a", [1]))})
    one, two = store.write("t", _months(spark, "b", [1])), store.write("t", _months(spark, "c", [1]))
    store.publish({"t": one}, base=base)
    with pytest.raises(Conflict):
        store.publish({"t": two}, base=base)
    assert [r[2] for r in rows(store.read("t"))] == ["b1"]
    assert [r[2] for r in rows(store.read("t", base))] == ["a1"]     # the older version can still be read


def test_replacing_partitions_leaves_the_other_folders(spark):
    store = _store(spark)
    base = store.publish({"t": store.write("t", _months(spark, "a", [1, 2, 3, 12]), ["ano", "mes"])})
    second = store.publish({"t": store.replace("t", _months(spark, "b", [2, 4]), [(2024, 2), (2024, 4)], base)}, base=base)
    assert [r[0] for r in rows(store.read("t"), "v")] == ["a1", "a12", "a3", "b2", "b4"]
    third = store.publish({"t": store.replace("t", _months(spark, "c", [3]), [(2024, 3), (2024, 4)], second)}, base=second)
    assert [r[0] for r in rows(store.read("t"), "v")] == ["a1", "a12", "b2", "c3"]
    assert third["tables"]["t"]["folders"][0]["path"] == base["tables"]["t"]["folders"][0]["path"]
    # a month's rows are read from its own folder only
    plan = store.read("t").filter("mes = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    store.vacuum(keep=1)
    assert [r[0] for r in rows(store.read("t"), "v")] == ["a1", "a12", "b2", "c3"]


def test_refresh_keeps_empty_tables_and_replaces_schemas(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ll-pq-"), "t")
    assert files.full_refresh(_months(spark, "a", []), path, ["ano", "mes"]).count() == 0
    assert files.read_table(spark, path).columns == ["ano", "mes", "v"]
    back = files.full_refresh(spark.range(3), path)
    assert back.columns == ["id"] and files.read_table(spark, path).count() == 3
