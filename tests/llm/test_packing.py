import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dialoom.llm import packing as P


def filled(spark, sizes, capacity, **how):
    df = spark.createDataFrame([(n, s, "clash", 1) for n, s in enumerate(sizes)], "doc_id long, tokens long, sequence string, piece int")
    return P.pack(df.select("doc_id", "tokens", "sequence"), capacity, buckets=4, **how).collect()


@pytest.mark.parametrize("top_up", [True, False])
def test_whole_items_within_the_capacity(spark, top_up):
    rng = random.Random(1)
    sizes = [rng.choice([1, 3, 7, 7, 7, 20, 33, 64, 65, 150]) for _ in range(300)] + [0]
    rows = filled(spark, sizes, 64, top_up=top_up)
    own, load = {}, {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["tokens"]))
        load[r["sequence"]] = load.get(r["sequence"], 0) + r["tokens"]
    assert max(load.values()) <= 64 and sorted(load) == list(range(len(load)))
    for n, size in enumerate(sizes):
        pieces = sorted(own.get(n, []))
        assert [p for _, _, p in pieces] == [64] * (size // 64) + ([size % 64] if size % 64 else [])
        assert [s for _, s, _ in pieces] == [64 * k for k in range(len(pieces))]
    if top_up:
        assert len(load) <= -(-sum(sizes) // 64) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 14), min_size=1, max_size=40), st.integers(1, 4))
def test_bucket_bounds_leave_the_least_padding(lengths, buckets):
    counts = np.bincount(lengths, minlength=31)
    distinct = sorted(set(lengths))

    def padding(bounds):
        return sum(min(b for b in bounds if b >= x) - x for x in lengths)

    def best(k, bounds):
        if k == 0 or len(bounds) == len(distinct):
            return padding(bounds)
        return min([padding(bounds), *(best(k - 1, bounds | {d}) for d in distinct if d not in bounds)])

    bounds = P.best_buckets(counts, buckets)
    assert len(bounds) <= buckets and bounds[-1] == max(lengths)
    assert padding(bounds) == best(buckets - 1, {max(lengths)})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_every_item_has_one_place(lengths):
    counts = np.bincount(lengths, minlength=51) if lengths else np.zeros(51, dtype=np.int64)
    plan = P.make_plan(counts, 50, 4)
    for n in range(51):
        runs = sorted((int(a), int(b)) for size, a, b in zip(plan.length, plan.first, plan.last, strict=True) if size == n)
        assert [a for a, _ in runs] == [0, *(b for _, b in runs[:-1])][: len(runs)]
        assert (runs[-1][1] if runs else 0) == counts[n]


def test_sizes_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "腹痛"), (2, None), (3, "​ \n"), (4, ""), (5, "a " * 100_000)], "doc_id int, text string")
    sizes = {r["doc_id"]: r["tokens"] for r in P.token_sizes(docs).collect()}
    assert set(sizes) == {1, 5} and sizes[1] > 0 and sizes[5] > 4096
    assert P.pack(P.token_sizes(docs.limit(0))).count() == 0
    rows = P.pack(P.token_sizes(docs)).collect()
    assert sum(r["tokens"] for r in rows) == sum(sizes.values())


def crossing(plan, bounds):
    """Sequences whose items are not all between the same two bounds."""
    own = {}
    for size, a, b, sequence, each in zip(plan.length, plan.first, plan.last, plan.sequence, plan.each, strict=True):
        for k in range(int(b - a) // int(each)):
            own.setdefault(int(sequence) + k, set()).add(int(np.searchsorted(bounds, size)))
    assert len(own) == plan.sequences
    return sum(len(x) > 1 for x in own.values())


def test_batches_form_inside_the_buckets(monkeypatch):
    """The bounds of the dynamic programme decide which items come together, and cost next to no sequence."""
    rng = np.random.default_rng(4)
    counts = np.bincount(np.minimum(rng.lognormal(5.1, 0.9, 20_000).astype(int) + 1, 4096), minlength=4097)
    plan = P.make_plan(counts)
    least = -(-int((counts * np.arange(4097)).sum()) // 4096)
    assert plan.sequences <= least * 1.01
    bounds = plan.bounds
    inside = crossing(plan, bounds)
    monkeypatch.setattr(P, "best_buckets", lambda counts, buckets: [int(np.flatnonzero(counts)[-1])])
    assert inside < 0.85 * crossing(P.make_plan(counts), bounds)
