"""Collections whose buckets split: before, during and after, replays and lost drivers included."""

import pytest
from pyspark.sql import functions as F

from quakeloom.sources import tables
from quakeloom.sources.tables import BUCKET, ORDER, Collection


@pytest.fixture
def store(spark, folder):
    return Collection(spark, folder, "id BIGINT, v BIGINT", ["id"], buckets=2, fill=20)


def rows(spark, low, high, add=0):
    return spark.range(low, high).select("id", (F.col("id") * 10 + add).alias("v"), F.col("id").alias(ORDER))


def held(store):
    return sorted(tuple(r) for r in store.current().select("id", "v").collect())


def placed(store):
    """Every document lies in the one bucket that its key names."""
    first, now = store.layout()
    base = store._read("base")
    assert base.filter(F.col(BUCKET) != store._address(first, now)).isEmpty()
    assert base.groupBy("id").count().filter("count > 1").isEmpty()
    return now


def test_addresses_split_one_bucket_each(spark, store):
    hashed = spark.range(3000).select("id", *[store._address(3, n).alias(f"n{n}") for n in range(3, 26)])
    for n in range(3, 25):
        moved = hashed.filter(F.col(f"n{n}") != F.col(f"n{n + 1}")).select(f"n{n}", f"n{n + 1}").distinct().collect()
        level = tables.doubled(3, n)
        assert [tuple(r) for r in moved] == [(n - level, n)]


def test_grows_and_replays(spark, store):
    want, sizes = {}, []
    for batch, (low, high) in enumerate([(0, 30), (20, 130), (100, 400), (390, 410)]):
        part = rows(spark, low, high, batch)
        want |= {i: i * 10 + batch for i in range(low, high)}
        for _ in range(2):
            store.upsert(part, batch)
            assert held(store) == sorted(want.items())
            store.compact()
            assert held(store) == sorted(want.items())
        sizes.append(placed(store))
    assert sizes == sorted(sizes) and sizes[0] >= 2 and sizes[-1] >= 20
    again = Collection(spark, store.path, "id BIGINT, v BIGINT", ["id"])  # opened without its figures
    assert again.layout() == store.layout()


@pytest.mark.parametrize("stop", ["_write", "delete"])
def test_a_split_cut_off(spark, store, monkeypatch, stop):
    store.upsert(rows(spark, 0, 40), 0)
    store.compact()
    before = store.layout()[1]
    store.upsert(rows(spark, 30, 200, 5), 1)
    want = held(store)

    def fail(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        if stop == "_write":  # staged, nothing replaced
            m.setattr(store, "_write", fail)
        else:  # replaced, nothing cleared: the first deletions run before the merge
            real = tables.delete
            m.setattr(tables, "delete", lambda s, p: fail() if p.endswith("_SUCCESS") else real(s, p))
        with pytest.raises(OSError):
            store.compact()
    assert store._staged() and held(store) == want
    assert store.layout()[1] > before
    store.upsert(rows(spark, 30, 200, 5), 1)
    assert held(store) == want
    store.compact()
    assert not store._staged() and held(store) == want and placed(store) > before


def test_a_bucket_left_empty_goes(spark, store):
    """All documents of a bucket move to its other half: nothing of them stays behind."""
    first = [r.id for r in spark.range(4000).filter((store._address(2, 2) == 0) & (store._address(2, 4) == 2)).limit(60).collect()]
    few = spark.createDataFrame([(i,) for i in first], "id BIGINT")
    part = few.select("id", F.col("id").alias("v"), F.lit(0).cast("long").alias(ORDER))
    part10 = part.limit(10)
    store.upsert(part10, 0)
    store.compact()
    store.upsert(part, 1)
    store.compact()
    assert store.layout()[1] >= 4 and held(store) == sorted((i, i) for i in first)
    placed(store)
