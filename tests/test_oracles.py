"""Registered queries against their SQL in DuckDB on the smallest test tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
from gustledger.operators import joins  # noqa: E402
from gustledger.queries import wind  # noqa: E402
from tools import check_oracles  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
OWN = {n: fn for n, fn in entry.queries().items() if not fn.__module__.startswith(("gustledger.llm", "corpus_pipeline"))}
NAMES = [n for n in OWN if n in SQL]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return check_oracles.duck(FOLDER)


@pytest.fixture(scope="module")
def shared_silver():
    """The wind queries repeat the same Silver steps; here each of them is done once."""
    done, patch = {}, pytest.MonkeyPatch()

    def once(name):
        make = getattr(wind, name)
        return lambda spark, d: done[name] if name in done else done.setdefault(name, make(spark, d))

    for name in ("_joined", "_treated", "_silver"):
        patch.setattr(wind, name, once(name))
    yield
    patch.undo()


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, shared_silver, name):
    result = check_oracles.compare(entry.queries()[name](spark, FOLDER), duck, SQL[name])
    assert result.startswith("ok"), result


BEYOND = ["regex_key_join", "semi_filter", "ci_left_join", "key_difference", "flag_limit", "generation_daily",
          "restrictions_project", "dup_clean_doc", "dup_quarantine_doc", "dup_clean_ref", "distribution",
          "silver_quarantine"]


@pytest.mark.parametrize("name", BEYOND)
def test_same_result_beyond_the_broadcast_limit(spark, duck, name, monkeypatch):
    """No lookup side fits a broadcast and every frequent key is hot."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = check_oracles.compare(entry.queries()[name](spark, FOLDER), duck, SQL[name])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert result.startswith("ok"), result


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())
    assert set(OWN) == set(NAMES)  # every query of the reference's operators has its SQL
