"""Keyed state against whole upserts, and what a write touches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import ledger, reconcile
from tributary.operators.state import KeyedStore

NOW = dt.datetime(2024, 6, 1)
COLUMNS = "k int, v string, updated_at timestamp_ntz"


def folders(path):
    return {os.path.join(d, x) for d, names, _ in os.walk(path) for x in names if x.startswith("_bucket=")}


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "v", "updated_at").collect())


def many(spark, n, at=NOW):
    return spark.range(n).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit(at).cast("timestamp_ntz").alias("updated_at"))


def test_one_changed_key_rewrites_one_bucket(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], buckets=8)
    assert store.read() is None and store.manifest() is None
    store.write(many(spark, 200))
    before = folders(tmp_path)
    assert len(before) == 8
    one = spark.createDataFrame([(17, "new", NOW)], COLUMNS)
    made = store.write(one)
    assert len(folders(tmp_path) - before) == 1
    assert sorted(len(f) for f in made.files.values()) == [1] * 7 + [2]
    assert rows(store.read()) == rows(reconcile.upsert(many(spark, 200), one, ["k"]))
    keys = spark.createDataFrame([(17,)], "k int")
    (own,) = store.touched(keys, made)
    found = store.read(keys)
    assert rows(found.where("k = 17")) == [(17, "new", NOW)] and 0 < found.count() < 200
    assert all(f"_bucket={own}" in f for f in found.inputFiles())


@pytest.mark.parametrize("most_deltas", [1, 3, 100])
def test_any_order_of_writes_equals_upserts(spark, tmp_path, most_deltas):
    draw, whole = random.Random(5), None
    store = KeyedStore(spark, str(tmp_path), ["k"], buckets=3, most_deltas=most_deltas)
    for n in range(7):
        some = [(k, f"{n}.{k}", NOW + dt.timedelta(days=draw.randint(-1, 1))) for k in draw.sample(range(12), 5)]
        changes = spark.createDataFrame(some, COLUMNS)
        whole = changes if whole is None else reconcile.upsert(whole, changes, ["k"])
        store.write(changes)
    assert rows(store.read()) == rows(whole)
    assert max(map(len, store.manifest().files.values())) <= most_deltas + 1


def test_columns_are_added_and_old_files_go(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], buckets=2, most_deltas=1, keep=2)
    store.write(many(spark, 4))
    wider = spark.createDataFrame([(1, "w", "x", NOW), (9, "w", "y", NOW)], "k long, v string, more string, updated_at timestamp_ntz")
    store.write(wider)
    assert sorted((r.k, r.more) for r in store.read().collect()) == [(0, None), (1, "x"), (2, None), (3, None), (9, "y")]
    for _ in range(4):
        store.write(wider)
    assert [n for n in sorted(os.listdir(tmp_path)) if n.startswith("manifest")] == ["manifest-5.json", "manifest-6.json"]
    named = {f for v in (5, 6) for fs in store.manifest(v).files.values() for f in fs}
    assert {os.path.relpath(f, tmp_path) for f in folders(tmp_path)} == named  # empty folders of a write may stay
    assert sorted((r.k, r.more) for r in store.read().collect()) == [(0, None), (1, "x"), (2, None), (3, None), (9, "y")]


class Overtaken(KeyedStore):
    """A store for which another one writes just before its own first commit."""

    other = None

    def _commit(self, manifest):
        if self.other:
            write, self.other = self.other, None
            write()
        return super()._commit(manifest)


def test_writers_at_one_time_keep_each_others_rows(spark, tmp_path):
    first = KeyedStore(spark, str(tmp_path), ["k"], buckets=4, most_deltas=1)
    first.write(many(spark, 40))
    first.write(spark.createDataFrame([(3, "a", NOW)], COLUMNS))
    second = Overtaken(spark, str(tmp_path), ["k"], most_deltas=1)
    second.other = lambda: first.write(spark.createDataFrame([(3, "b", NOW + dt.timedelta(1)), (50, "b", NOW)], COLUMNS))
    made = second.write(spark.createDataFrame([(3, "c", NOW), (51, "c", NOW)], COLUMNS))
    assert made.version == 4 and made.buckets == 4
    found = {k: v for k, v, _ in rows(second.read())}
    assert (found[3], found[50], found[51], len(found)) == ("b", "b", "c", 42)


def test_a_write_from_an_overtaken_state_is_an_error(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], buckets=16)
    base = store.write(many(spark, 40))
    of = {k: store.touched(spark.createDataFrame([(k,)], "k int"), base)[0] for k in range(40)}
    same, other = 0, next(k for k in range(40) if of[k] != of[0])
    store.write(spark.createDataFrame([(same, "a", NOW)], COLUMNS))
    with pytest.raises(RuntimeError, match="another run"):
        store.write(spark.createDataFrame([(same, "b", NOW)], COLUMNS), base=base)
    store.write(spark.createDataFrame([(other, "b", NOW)], COLUMNS), base=base)
    found = {k: v for k, v, _ in rows(store.read())}
    assert (found[same], found[other]) == ("a", "b")


def test_a_marked_write_is_taken_once(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], buckets=2)
    for n, v in ((0, "a"), (1, "b"), (1, "c"), (0, "d")):
        store.write(spark.createDataFrame([(1, v, NOW)], COLUMNS), mark=("stream", n))
    store.write(spark.createDataFrame([(2, "x", NOW)], COLUMNS), mark=("other", 0))
    assert [(k, v) for k, v, _ in rows(store.read())] == [(1, "b"), (2, "x")] and store.manifest().marks == {"stream": 1, "other": 0}


def test_repeated_keys_in_one_write_and_empty_writes(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), ["k"], buckets=2)
    store.write(spark.createDataFrame([], COLUMNS))
    assert store.read().count() == 0
    store.write(spark.createDataFrame([(1, "old", NOW), (1, "new", NOW + dt.timedelta(1)), (1, "none", None)], COLUMNS))
    assert [(k, v) for k, v, _ in rows(store.read())] == [(1, "new")]


def test_ledger_states(spark):
    sent = spark.createDataFrame([("a", "s", "1"), ("a", "s", "2"), ("a", "s", "3"), ("b", "s", "2"), ("b", "s", "3"), ("b", "t", "1"), ("b", "t", "1")], "payload string, section string, key string")
    done = spark.createDataFrame([("a", "s", "1"), ("b", "s", "3"), ("b", "s", "9"), ("c", "s", "1")], "payload string, section string, key string")
    found = sorted(tuple(r) for r in ledger.states(sent, done).collect())
    assert found == [("a", "s", "1", "confirmed"), ("a", "s", "2", "superseded"), ("a", "s", "3", "superseded"), ("b", "s", "2", "open"), ("b", "s", "3", "confirmed"), ("b", "t", "1", "open")]
    assert "Exchange" in (plan := ledger.states(sent, done)._jdf.queryExecution().executedPlan().toString()) and plan.count("Exchange hashpartitioning(section") == 1 == plan.count("Exchange")
    row = spark.createDataFrame([(1, " x ", None)], "b int, a string, c string").select(ledger.key_text({c: F.col(c) for c in "bac"}).alias("k")).first()
    assert row.k == "a=x&b=1&c="
