"""Tables replaced as a whole: what readers see while writers fail, race and are killed."""

import glob
import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gustledger.plans import domain as D
from gustledger.plans import medallion
from gustledger.sources import sinks, snapshots
from gustledger.sources.snapshots import Conflict, Store
from tests.test_rounds import _silver

ROOT = Path(__file__).resolve().parent.parent


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_tables_change_together_and_old_readers_go_on(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for name in ("a", "b"):
        store.write(spark.range(3), name)
    assert store.read() == {} and store.publish() == 1
    old = store.read()
    store.write(spark.range(5), "a")
    assert ids(Store(spark, str(tmp_path)).read()["a"]) == [0, 1, 2]  # written, not published
    store.write(spark.range(7), "b")
    assert store.publish() == 2
    assert (store.read()["a"].count(), store.read()["b"].count()) == (5, 7)
    assert (old["a"].count(), old["b"].count()) == (3, 3)
    assert store.read(1)["b"].count() == 3
    store.write(spark.range(1), "a")
    store.publish()
    assert store.read()["b"].count() == 7  # tables that weren't written stay
    assert store.vacuum(keep=1) == 3 and store.versions() == [3]
    assert (store.read()["a"].count(), store.read()["b"].count()) == (1, 7)


def test_a_failing_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    sinks.write_table(spark.range(4), path)
    broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 90, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        sinks.write_table(broken, path)
    assert ids(snapshots.read_table(spark, path)) == [0, 1, 2, 3]
    assert ids(sinks.write_table(spark.range(2), path)) == [0, 1]


def test_one_of_two_writers_publishes(spark, tmp_path):
    first, second = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    first.write(spark.range(1), "t")
    second.write(spark.range(2), "t")
    first.publish()
    with pytest.raises(Conflict, match="version 1"):
        second.publish()
    assert Store(spark, str(tmp_path)).read()["t"].count() == 1


def test_a_claim_blocks_until_it_is_stale(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write(spark.range(1), "t")
    os.makedirs(tmp_path / "_manifests", exist_ok=True)
    claim = tmp_path / "_manifests" / f"v{1:012d}.claim"
    claim.write_text("")
    with pytest.raises(Conflict, match="another writer"):
        store.publish()
    assert store.versions() == []
    long_ago = time.time() - snapshots.STALE_SECONDS - 60
    os.utime(claim, (long_ago, long_ago))
    assert store.publish() == 1 and store.read()["t"].count() == 1 and not claim.exists()


def test_a_killed_draft_is_no_version(spark, tmp_path):
    """A writer that dies before the rename leaves a claim and a half-written draft."""
    store = Store(spark, str(tmp_path))
    store.write(spark.range(2), "t")
    store.publish()
    (tmp_path / "_manifests" / ".draft").write_text('{"t": {"fol')
    (tmp_path / "_manifests" / f"v{2:012d}.claim").write_text("")
    assert Store(spark, str(tmp_path)).read()["t"].count() == 2


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from gustledger.session import local_session
from gustledger.plans import medallion
from gustledger.sources.snapshots import Store
from tests.test_rounds import _silver
spark = local_session(2, "1g")
whole, done = Store.write, []
def write(self, df, name, *how):
    if len(done) == 4:
        os._exit(9)  # four of six tables are written, and the process is gone
    done.append(name)
    return whole(self, df, name, *how)
Store.write = write
registry = spark.createDataFrame([(c, "P2", "1") for c in "abc"], "spe string, projeto string, ceg string")
medallion.gold_layer(_silver(spark, list("abc")), registry, {out!r})
"""


def test_a_killed_run_leaves_the_old_six(spark, tmp_path):
    out, registry = str(tmp_path), spark.createDataFrame([("a", "P", "1"), ("b", "P", "2")], "spe string, projeto string, ceg string")
    medallion.gold_layer(_silver(spark), registry, out)
    before = {n: sorted(map(str, df.collect())) for n, df in medallion.current(spark, out).items()}
    assert set(before) == set(D.GOLD_KEYS)
    folders = set(glob.glob(f"{out}/*/snapshot-*"))
    done = subprocess.run([sys.executable, "-c", KILLED.format(root=str(ROOT), out=out)], capture_output=True, text=True)
    assert done.returncode == 9, done.stderr[-2000:]
    assert len(set(glob.glob(f"{out}/*/snapshot-*")) - folders) == 4  # there, but named by no manifest
    assert {n: sorted(map(str, df.collect())) for n, df in medallion.current(spark, out).items()} == before
    three = spark.createDataFrame([(c, "P2", "1") for c in "abc"], "spe string, projeto string, ceg string")
    medallion.gold_layer(_silver(spark, list("abc")), three, out)
    assert medallion.current(spark, out)["dim_spe"].count() == 3


def test_named_tables_keep_rows_until_replaced(spark, rows):
    name = "snapshots_named"
    try:
        sinks.save_named(spark.range(3), name)
        held = spark.table(name)
        held.count()
        with pytest.raises(Exception, match="boom"):
            sinks.save_named(spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), name)
        assert spark.table(name).count() == 3
        assert rows(sinks.save_named(spark.range(2), name)) == [(0,), (1,)]
        assert held.count() == 3  # the old files are still there
        assert sinks.save_named(spark.range(1).toDF("other"), name).columns == ["other"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
