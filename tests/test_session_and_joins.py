"""Session sizing helpers and the broadcast size policy."""

import os
import tempfile

from ledgerlight import session
from ledgerlight.operators import joins


def test_size_shuffles_and_input_bytes(spark):
    d = tempfile.mkdtemp(prefix="ll-size-")
    with open(os.path.join(d, "a.bin"), "wb") as fh:
        fh.write(b"x" * 1000)
    assert session.input_bytes(spark, [d, os.path.join(d, "missing")]) == 1000
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 1000, total_cores=4) == 8                  # 2 per core
        assert session.size_shuffles(spark, 1000, total_cores=4, per_core=1) == 4
        big = session.size_shuffles(spark, 100 * (1 << 40), total_cores=8000)          # 100 TB
        assert big == 204801 and spark.conf.get("spark.sql.shuffle.partitions") == "204801"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_checkpoint_dir_keeps_the_session_setting(spark):
    assert session.checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_broadcast_limit_caps_bytes(spark):
    narrow = spark.createDataFrame([(1,)], "k int")
    wide = spark.createDataFrame([tuple("x" * 1 for _ in range(40))], ", ".join(f"c{i} string" for i in range(40)))
    assert joins.row_limit(narrow) == joins.DEFAULT_BROADCAST_ROWS
    assert joins.row_limit(wide) == joins.BROADCAST_BYTES // (40 * 32)
    assert joins.fits(narrow) and joins.fits(wide)
    assert not joins.fits(spark.range(20), max_rows=10)
    long = spark.range(70).selectExpr("repeat('x', 1000000) AS name")             # few rows, 70 MB
    assert not joins.fits(long) and joins.fits(long.limit(10))
