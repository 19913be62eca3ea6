import pytest
import datetime as dt
import random

from motionloom.operators import orphans

T = lambda d: dt.datetime(2025, 1, 1) + dt.timedelta(days=d)
PARENT = "ref_field string, key long, begins timestamp, ends timestamp"
REF = "ref_table string, ref_field string, key long, record_id long, at timestamp"


def kinds(df):
    return {r["record_id"]: r["kind"] for r in df.collect()}


def brute(refs, parents):
    out = {}
    for _, f, k, i, at in refs:
        mine = [(b, e) for pf, pk, b, e in parents if (pf, pk) == (f, k)]
        if any(b <= at and (e is None or at < e) for b, e in mine):
            continue
        out[i] = "missing" if not mine else "deleted" if any(e is not None and e <= at for _, e in mine) else "late"
    return out


def data(seed):
    r = random.Random(seed)
    parents = []
    for k in range(20):
        for _ in range(r.choice([1, 1, 2])):
            b = r.randrange(100)
            parents.append(("f", k, T(b), r.choice([None, T(b + r.randrange(0, 40))])))
    refs = [("t", "f", r.choice([1, 1, 1, r.randrange(25)]), i, T(r.randrange(130))) for i in range(400)]
    return refs, parents


@pytest.mark.parametrize("fold_rows", [3, 1000])
def test_probe_against_brute_force(spark, fold_rows):
    refs, parents = data(1)
    got = orphans.probe(spark.createDataFrame(refs, REF), spark.createDataFrame(parents, PARENT).distinct(), fold_rows=fold_rows)
    assert kinds(got) == brute(refs, parents)


def test_batches_give_the_same_as_one(spark):
    refs, parents = data(2)
    late_deletes = [p for p in parents if p[3] is not None]
    first = [(f, k, b, None) for f, k, b, _ in late_deletes] + [p for p in parents if p[3] is None][::2]
    first = list({p[:3]: p for p in first}.values())
    rest = [p for p in parents if p not in first]
    state = orphans.advance(None, spark.createDataFrame(refs[:150], REF), spark.createDataFrame(first, PARENT))
    state = orphans.advance(state, spark.createDataFrame(refs[150:300], REF), spark.createDataFrame(late_deletes, PARENT).distinct())
    state = orphans.advance(state, spark.createDataFrame(refs[300:], REF), spark.createDataFrame(rest, PARENT).distinct())
    final = list({(f, k, b, e): None for f, k, b, e in (tuple(r) for r in state.targets.collect())})
    assert kinds(state.pending) == brute(refs, final)


def test_bounds_ties_and_empty(spark):
    parents = spark.createDataFrame([("f", 1, T(1), T(3)), ("f", 2, T(5), T(5)), ("f", 3, None, None)], PARENT)
    refs = spark.createDataFrame([("t", "f", 1, 10, T(1)), ("t", "f", 1, 11, T(3)), ("t", "f", 1, 12, T(0)), ("t", "f", 2, 13, T(6)), ("t", "f", 3, 14, T(0)), ("t", "f", 9, 15, T(0))], REF)
    assert kinds(orphans.probe(refs, parents)) == {11: "deleted", 12: "late", 13: "deleted", 15: "missing"}
    assert set(kinds(orphans.probe(refs, parents.where("false"))).values()) == {"missing"}
    assert orphans.probe(refs.where("false"), parents).count() == 0


def test_references_skip_nulls_and_snapshots_balance(spark):
    rows = spark.createDataFrame([(1, 5, None, T(0)), (2, None, None, T(1)), (3, 6, 7, None)], "rid long, a long, b long, at timestamp")
    assert orphans.references(rows, "x", "rid", ("a", "b"), "at").count() == 1
    parents = spark.createDataFrame([("f", 1, T(40), None)], PARENT)
    refs = spark.createDataFrame([("t", "f", 1, i, T(2)) for i in range(3)] + [("t", "f", 2, 9, T(3))], REF)
    s = {r["month"].month: (r["late"], r["missing"], r["resolved"], r["pending"]) for r in orphans.snapshots(orphans.probe(refs, parents)).collect()}
    assert s == {1: (3, 1, 0, 4), 2: (0, 0, 3, 1)}
