"""Marts brought up to date by a load's difference against marts built from all facts."""
import os
import random

import pytest

from strata.plans import mart_state as ms
from strata.plans import marts

FACT = ("drug_key string, condition_key string, effectiveness_score double, ease_of_use_score double, satisfaction_score double, "
        "review_count int, price double")


def facts(spark, seed, n, groups):
    rnd = random.Random(seed)
    return spark.createDataFrame([(f"d{rnd.randint(0, 9)}", f"g{rnd.choice(groups)}", rnd.choice([None, 1.5, 2.25, 3.1]), rnd.random(),
                                   rnd.random(), rnd.randint(0, 9), rnd.choice([None, 10.0, 77.7])) for _ in range(n)], FACT)


def items(spark, price):
    return spark.createDataFrame([(f"d{i}", f"drug {i}", "RX", "Tablet", price if i == 3 else 20.0 + i) for i in range(10)],
                                 "drug_key string, drug_name string, drug_type string, drug_form string, average_price double")


def as_rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("build", [marts.ranking, marts.summary])
def test_loads_and_retractions_equal_a_full_rebuild(spark, scratch, build):
    groups = spark.createDataFrame([(f"g{i}", f"group {i}", "Other") for i in range(12)], "condition_key string, condition_name string, condition_category string")
    state, mart = f"{scratch}/state", f"{scratch}/mart"
    a, b, c = facts(spark, 1, 300, range(12)), facts(spark, 2, 40, [2, 5]), facts(spark, 3, 30, [5, 7])

    def full(fact, dim):
        return as_rows(build(marts.base_of_fact(fact, dim, groups), from_base=True))

    def now(touched, dim):
        return as_rows(ms.refresh(spark, state, mart, dim, groups, touched, build))
    one = items(spark, 50.0)
    assert now(ms.put_load(a, state, "a"), one) == full(a, one)
    stamps = {f: os.stat(f).st_mtime_ns for d, _, names in os.walk(mart) for f in (os.path.join(d, n) for n in names)}
    assert now(ms.put_load(b, state, "b"), one) == full(a.unionByName(b), one)
    kept = [f for f, t in stamps.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == t and "slice=" in f]
    assert kept                                                   # slices of other groups are not rewritten
    assert now(ms.put_load(c, state, "b"), one) == full(a.unionByName(c), one)      # a corrected load replaces the first
    two = items(spark, 60.0)                                      # an item's price counts for its facts without one
    assert now(ms.groups_of_changed(spark, state, one, two, "drug_key"), two) == full(a.unionByName(c), two)
    assert now(ms.retract_load(spark, state, "b"), two) == full(a, two)
    assert now(ms.retract_load(spark, state, "a"), two) == []


def test_value_mart_comes_from_the_state(spark, scratch):
    groups = spark.createDataFrame([("g1", "one", "Other"), ("g2", "two", "Other")], "condition_key string, condition_name string, condition_category string")
    state, dim = f"{scratch}/state", items(spark, 50.0)
    a, b = facts(spark, 4, 60, [1]), facts(spark, 5, 60, [2])
    ms.put_load(a, state, "a")
    ms.put_load(b, state, "b")
    assert as_rows(marts.value(ms.base(spark, state, dim, groups), from_base=True)) == as_rows(
        marts.value(marts.base_of_fact(a.unionByName(b), dim, groups), from_base=True))
