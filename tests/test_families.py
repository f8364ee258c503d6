"""The ranked merge in rounds against deciding one primary after the other."""

import random

import pytest
from pyspark.sql import functions as F

from headway.functions import columns as c
from headway.operators import families

PLAIN = "area_id string, words array<string>, main_station_signal int, signal boolean, generic boolean, technical boolean, base string, area_lat double, area_lon double, has_rail_service int, has_train int, search_priority_score long, merge_key string, place int"


def special(a, b):
    return (a.generic and b.generic and a.base != "" and a.base == b.base) or (a.technical and b.generic) or (a.generic and b.technical)


def fits(a, b):
    return bool((set(a.words) & set(b.words) or (a.main_station_signal and b.main_station_signal)) and a.signal and b.signal)


def outranks(a, b):
    return bool(a.has_rail_service and b.has_rail_service and ((a.has_train and not b.has_train) or a.search_priority_score >= b.search_priority_score))


def one_by_one(primaries, metres):
    """(head, area, distance), each decided with all before it known."""
    heads, of_key, out = [], {}, []
    for row in sorted(primaries, key=lambda r: r["rank"]):
        near = []
        for k, h in enumerate(heads):
            d = metres[h.area_id, row.area_id]
            if d is not None and d <= 2500 and fits(h, row) and (d <= 450 or (special(h, row) and outranks(h, row))):
                near.append((d, k))
        if near:
            d, k = min(near)
            out.append((heads[k].area_id, row.area_id, d))
            continue
        first = of_key.get(row.merge_key)
        if first is not None:
            d = metres[first.area_id, row.area_id]
            if fits(first, row) and special(first, row) and (d is None or d <= 5000) and outranks(first, row):
                out.append((first.area_id, row.area_id, 5000 if d is None else d))
                continue
        heads.append(row)
        out.append((row.area_id, row.area_id, None))
        if row.merge_key:
            of_key.setdefault(row.merge_key, row)
    return sorted(out, key=lambda x: x[1])


def some_primaries(spark, n, seed, spread):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        generic, technical = rng.random() < 0.6, rng.random() < 0.3
        base = rng.choice(["", "bergau", "seeheim"])
        key = rng.choice([base, "tannau"]) if generic or technical else ""
        lost = rng.random() < 0.15
        place = (None, None) if lost else (51.5 + rng.random() * spread, 7.5 + rng.random() * spread)
        rows.append((f"p{k:03}", rng.sample(["bergau", "seeheim", "markt"], rng.randrange(1, 3)), rng.randrange(2), rng.random() < 0.85, generic, technical, base, *place, int(rng.random() < 0.9), rng.randrange(2), rng.randrange(4), key, rng.randrange(n)))
    # ranks with ties but for the id
    return spark.createDataFrame(rows, PLAIN).withColumn("rank", F.struct(-F.col("has_train"), -F.col("search_priority_score"), F.col("place") % 7, "area_id")).drop("place")


@pytest.mark.parametrize(("n", "seed", "spread"), [(40, 1, 0.02), (60, 2, 0.05), (30, 3, 0.004)])
def test_rounds_decide_as_one_by_one(spark, n, seed, spread):
    primaries = families.graph.written(some_primaries(spark, n, seed, spread))
    all_ = primaries.select(F.col("area_id").alias("a"), F.col("area_lat").alias("ay"), F.col("area_lon").alias("ax")).crossJoin(primaries.select(F.col("area_id").alias("b"), F.col("area_lat").alias("by"), F.col("area_lon").alias("bx")))
    metres = {(r.a, r.b): r.d for r in all_.select("a", "b", c.metres(F.col("ay"), F.col("ax"), F.col("by"), F.col("bx")).alias("d")).collect()}
    got = families.settle(primaries, families.merge_links(primaries))
    want = one_by_one(primaries.collect(), metres)
    assert sorted(map(tuple, got.collect()), key=lambda x: x[1]) == want
    assert len({h for h, *_ in want}) not in (1, n)


def test_hot_key_and_chain(spark):
    """All share one key and lie apart: one round for the head and one for the rest; a chain of near ones is settled as well."""
    row = lambda k, y, key, generic: (f"p{k:03}", ["x"], 0, True, generic, False, "b", y, 7.5, 1, 1, 1, key, k)
    far = [row(k, 51.0 + k * 0.00001, "b", True) for k in range(60)]
    chain = [row(100 + k, 52.0 + k * 0.004, "", False) for k in range(6)]
    primaries = spark.createDataFrame(far + chain, PLAIN).withColumn("rank", F.struct("place", "area_id"))
    got = {a: h for h, a, _ in families.settle(primaries, families.merge_links(primaries)).collect()}
    assert {got[f"p{k:03}"] for k in range(60)} == {"p000"}
    assert [got[f"p{100 + k}"] for k in range(6)] == ["p100", "p100", "p102", "p102", "p104", "p104"]


def test_nothing_to_merge(spark):
    none = some_primaries(spark, 1, 1, 0.1).limit(0)
    assert families.settle(none, families.merge_links(none)).collect() == []


def test_crowd_is_not_paired(spark):
    """Hundreds of near primaries that share words are linked by their words and places, not pair by pair."""
    rows = [(f"p{k:03}", ["gleis", f"stadt{k % 3}", f"only{k}"], k % 2, True, True, False, f"b{k}", 51.5 + k % 5 * 0.001, 7.5, 1, 1, 1, f"b{k}", k) for k in range(400)]
    primaries = families.graph.written(spark.createDataFrame(rows, PLAIN).withColumn("rank", F.struct("place", "area_id")))
    links = families.merge_links(primaries)
    assert sum(x.count() for x in links) < 400 * 10
    got = {r.area_id: r.head for r in families.settle(primaries, links).collect()}
    assert len(got) == 400 and set(got.values()) == {"p000"}
