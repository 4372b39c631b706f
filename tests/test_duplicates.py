from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gustledger.operators import contract, duplicates, keys

SCHEMA = "k string, t int, v double, filename string"


def brute(data, policy, ignore):
    """(clean rows, quarantined rows) by the definitions, on plain lists."""
    def body(r):
        return r[2:3] if ignore else r[2:]

    groups = defaultdict(list)
    for r in data:
        groups[r[:2]].append(r)
    clean, quarantined = [], []
    for members in groups.values():
        copies = Counter(body(r) for r in members)
        if policy == duplicates.DOCUMENTED:
            if len(copies) == 1:
                clean.append(min(members, key=repr)[:3])
            else:
                quarantined += [r[:3] for r in members]
        elif len(members) == 1 or min(copies.values()) > 1:
            low = min(members, key=lambda r: [(x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r[2:]])
            clean.append(low[:3])
        else:
            quarantined += [r[:3] for r in members if copies[body(r)] == 1]
    return sorted(clean, key=repr), sorted(quarantined, key=repr)


def run(spark, rows, data, policy):
    df = spark.createDataFrame(data, SCHEMA)
    ignore = ("filename",) if policy == duplicates.DOCUMENTED else ()
    split = duplicates.split_duplicates(df, ["k", "t"], ignore, policy)
    return rows(split.clean, "k", "t", "v"), rows(split.quarantined, "k", "t", "v"), split.counts.first()


A, B = ("a", 1, 1.0, "f"), ("a", 1, 2.0, "f")
OTHER = ("z", 1, 5.0, "f")

CASES = {
    "AA": ([A, A], (1, 0), (1, 0)),
    "AB": ([A, B], (0, 2), (0, 2)),
    "AAB": ([A, A, B], (0, 3), (0, 1)),
    "AABB": ([A, A, B, B], (0, 4), (1, 0)),
    "files": ([A, ("a", 1, 1.0, "g")], (1, 0), (0, 2)),
    "null keys": ([(None, None, 1.0, "f"), (None, None, 2.0, "f")], (0, 2), (0, 2)),
    "null values": ([("a", 1, None, "f"), ("a", 1, None, "f")], (1, 0), (1, 0)),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("policy", [duplicates.DOCUMENTED, duplicates.REFERENCE])
def test_cases(spark, rows, name, policy):
    data, documented, reference = CASES[name]
    want = documented if policy == duplicates.DOCUMENTED else reference
    clean, quarantined, counts = run(spark, rows, [*data, OTHER], policy)
    assert (len(clean) - 1, len(quarantined)) == want
    assert (clean, quarantined) == brute([*data, OTHER], policy, policy == duplicates.DOCUMENTED)
    assert counts["conflicting"] == len(quarantined)
    if policy == duplicates.DOCUMENTED:  # nothing is lost
        assert len(clean) + len(quarantined) + counts["identical_removed"] == len(data) + 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]),
            st.sampled_from([1.0, 2.0, None]), st.sampled_from(["f", "g"]),
        ),
        min_size=1, max_size=30,
    )
)
@pytest.mark.parametrize("policy", [duplicates.DOCUMENTED, duplicates.REFERENCE])
def test_random_frames(spark, rows, policy, data):
    clean, quarantined, counts = run(spark, rows, data, policy)
    assert (clean, quarantined) == brute(data, policy, policy == duplicates.DOCUMENTED)
    if policy == duplicates.DOCUMENTED:
        assert len(clean) + len(quarantined) + counts["identical_removed"] == len(data)


def test_hot_key_keeps_every_row(spark):
    """A third of the rows share one key and differ; all of them are quarantined."""
    df = spark.range(9000, numPartitions=4).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) as k", "1 as t", "cast(id as double) as v", "'f' as filename"
    )
    split = duplicates.split_duplicates(df, ["k", "t"], ("filename",))
    assert (split.clean.count(), split.quarantined.count()) == (6000, 3000)


def test_first_rows_of_agreeing_keys_stay(spark, rows):
    """Of a key whose rows all have copies the earliest stays; conflicting rows keep their own place."""
    schema = "k string, v double, place struct<file: string, row: bigint>"
    data = [
        ("two", 9.0, ("a", 4)), ("two", 1.0, ("a", 7)), ("two", 9.0, ("b", 0)), ("two", 1.0, ("b", 1)),
        ("same", 5.0, ("b", 2)), ("same", 5.0, ("a", 9)), ("lone", 3.0, ("a", 0)),
        ("differ", 1.0, ("a", 2)), ("differ", 2.0, ("a", 1)),
        ("mixed", 1.0, ("a", 5)), ("mixed", 1.0, ("a", 3)), ("mixed", 8.0, ("a", 6)),
        (None, 7.0, ("c", 1)), (None, 6.0, ("c", 2)), (None, 6.0, ("c", 4)), (None, 7.0, ("c", 3)),
        ("unplaced", 2.0, None), ("unplaced", 2.0, None), ("unplaced", 4.0, ("c", 9)), ("unplaced", 4.0, None),
    ]
    for parts in (1, 5):
        df = spark.createDataFrame(data[::-1], schema).repartition(parts)
        split = duplicates.split_duplicates(df, ["k"], policy=duplicates.FIRST, address="place")
        assert split.clean.columns == df.columns
        assert rows(split.clean.select("k", "v", "place.file", "place.row")) == sorted(
            [("two", 9.0, "a", 4), ("same", 5.0, "a", 9), ("lone", 3.0, "a", 0), (None, 7.0, "c", 1), ("unplaced", 4.0, "c", 9)], key=repr
        )
        assert rows(split.quarantined.select("k", "v", "place.row")) == [("differ", 1.0, 2), ("differ", 2.0, 1), ("mixed", 8.0, 6)]
        assert tuple(split.counts.first()) == (3 + 1 + 3 + 3, 3)


def test_first_policy_and_address_belong_together(spark):
    df = spark.createDataFrame([A], SCHEMA)
    for options in ({"policy": duplicates.FIRST}, {"address": "filename"}):
        with pytest.raises(ValueError, match="address"):
            duplicates.split_duplicates(df, ["k"], **options)


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        duplicates.split_duplicates(spark.createDataFrame([A], SCHEMA), ["k"], policy="other")


RULES = [
    contract.Rule("a"),
    contract.Rule("b", ge=0),
    contract.Rule("c", nullable=True, in_range=(0, 40)),
    contract.Rule("d", nullable=True, isin=(0, 1)),
]


def test_contract_reports_every_failure(spark, rows):
    data = [
        (1, "x", 1.0, 40.0, 1.0), (2, None, None, None, None), (3, "x", -1.0, 41.0, 7.0), (4, "x", 0.0, 0.0, None),
    ]
    df = spark.createDataFrame(data, "n int, a string, b double, c double, d double")
    valid, rejected = contract.split(df, RULES, "motivo", "etapa", "contrato")
    assert rows(valid, "n") == [(1,), (4,)]
    assert rows(rejected, "n", "motivo", "etapa") == [
        (2, "a:not_nullable; b:not_nullable", "contrato"),
        (3, "b:greater_than_or_equal_to(0); c:in_range(0, 40); d:isin([0, 1])", "contrato"),
    ]
    assert valid.columns == df.columns


def test_key_violations_and_assertion(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(keys.key_violations(df, ["k"])) == sorted([(1, 2), (None, 1)], key=repr)
    assert keys.assert_key(df.filter("k = 2"), ["k"], "t").count() == 1
    with pytest.raises(keys.KeyViolation, match="dim_x.*'k': 1"):
        keys.assert_key(df.filter("k = 1"), ["k"], "dim_x")
