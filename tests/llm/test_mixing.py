"""Mixtures keep quotas, caps and blocks; the splitting tree gives every block once."""

from collections import Counter

import numpy as np
import pytest

from phasemill.llm import mixing
from phasemill.llm.mixing import SplittingTree, draw_good, mix_sources, plan_quotas

SCHEMA = "doc_id long, source string, n long, shard int, copy int, h string"


@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_tree(shards):
    blocks = (400, 0, 3, 97)
    leaves = np.array([SplittingTree(blocks, shards, 5).leaf(i) for i in range(shards)])
    assert (leaves.sum(0) == blocks).all() and (leaves >= 0).all()
    assert leaves.sum(1).max() - leaves.sum(1).min() <= np.ceil(np.log2(shards)) + 1
    assert (leaves == [SplittingTree(blocks, shards, 5).leaf(i) for i in range(shards)]).all()


def test_tree_is_hypergeometric():
    draws = np.array([SplittingTree((30, 70), 2, s).leaf(0)[0] for s in range(2000)])
    assert draws.mean() == pytest.approx(15, abs=0.3) and draws.var() == pytest.approx(50 * 0.3 * 0.7 * 50 / 99, rel=0.12)


@pytest.mark.parametrize("shards", [1, 7, 64])
def test_places_of_leaves_follow_each_other(shards):
    tree = SplittingTree((400, 0, 3, 97), shards, 5)
    upto = np.zeros(4, int)
    for i in range(shards):
        held, first = tree.placed(i)
        assert tuple(upto) == first
        upto += held


def test_tree_of_very_many_blocks():
    blocks = (4_000_000_000, 999_999_999, 1, 0)
    shards = 150_000_000
    tree = SplittingTree(blocks, shards, 5)
    first, last = tree.placed(0), tree.placed(shards - 1)
    assert first[1] == (0, 0, 0, 0) and tuple(a + b for a, b in zip(*last, strict=True)) == blocks
    held = np.array([tree.leaf(i) for i in range(70_000_000, 70_000_200)])
    assert held.sum(1).max() - held.sum(1).min() <= 30 and held[:, 0].mean() == pytest.approx(4e9 / shards, rel=0.05)
    a, b = tree.placed(70_000_000), tree.placed(70_000_001)
    assert tuple(x + y for x, y in zip(*a, strict=True)) == b[1]


def test_large_draws_are_hypergeometric(monkeypatch):
    monkeypatch.setattr(mixing, "NUMPY_MOST", 1)
    rng = np.random.default_rng(2)
    draws = np.array([draw_good(rng, 30, 70, 50) for _ in range(4000)])
    assert draws.min() >= 0 and draws.max() <= 30
    assert draws.mean() == pytest.approx(15, abs=0.15) and draws.var() == pytest.approx(50 * 0.3 * 0.7 * 50 / 99, rel=0.1)
    big = np.array([draw_good(rng, 3_000_000_000, 7_000_000_000, 5_000_000_000) for _ in range(60)])
    sd = (5e9 * 0.3 * 0.7 * 0.5) ** 0.5
    assert abs(big.mean() - 1.5e9) < 5 * sd / 60**0.5 and 0.6 < big.std() / sd < 1.5
    assert draw_good(rng, 5, 0, 3) == 3 and draw_good(rng, 0, 5, 3) == 0 and draw_good(rng, 5, 5, 0) == 0


def test_quotas():
    q = {x.source: x for x in plan_quotas([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 9)], {"a": 1000, "b": 100}, 64)}
    assert (q["a"].tokens, q["b"].tokens, q["c"].tokens) == (667, 400, 0)
    less = plan_quotas([("a", 0.5, 1), ("b", 0.5, 1)], {"a": 1000, "b": 1000}, 64, 100)
    assert [x.tokens for x in less] == [50, 50]
    assert plan_quotas([], {}, 64) == [] and plan_quotas([("a", 1.0, 1)], {}, 64)[0].tokens == 0


def corpus(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "big" if i % 3 else "mid", int(rng.integers(1, 90)), 1, 2, "x") for i in range(3000)]
    rows += [(10_000 + i, "small", int(rng.integers(1, 60)), 1, 2, "x") for i in range(40)]
    rows += [(20_000, "other", 50, 1, 2, "x"), (20_001, None, 50, 1, 2, "x"), (None, "big", 5, 1, 2, "x"), (20_002, "big", 0, 1, 2, "x"), (20_003, "big", None, 1, 2, "x"), *rows[:50]]
    return spark.createDataFrame(rows, SCHEMA), rows


TARGETS = [("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 3), ("none", 0.05, 5)]


def test_mixture(spark):
    sizes, rows = corpus(spark)
    targets = spark.createDataFrame([*TARGETS, (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mixture, shares = mix_sources(sizes, "doc_id", "source", "n", targets, shard_tokens=2000, block_tokens=100)
    got = mixture.collect()
    size = {r[0]: r[2] for r in rows}
    assert all(r["n_tokens"] == size[r["doc_id"]] for r in got)
    cap = {s: r for s, _, r in TARGETS}
    uses = Counter(r["doc_id"] for r in got)
    assert all(uses[r["doc_id"]] <= cap[r["source"]] for r in got) and len({(r["doc_id"], r["copy"]) for r in got}) == len(got)
    assert len({(r["shard"], r["position"]) for r in got}) == len(got)
    total = sum(r["n_tokens"] for r in got)
    report = {r["source"]: r for r in shares.collect()}
    for s, t, _ in TARGETS[:3]:
        own = sum(r["n_tokens"] for r in got if r["source"] == s)
        assert report[s]["used_tokens"] == own and report[s]["share"] == pytest.approx(own / total)
        assert own / total == pytest.approx(t / 0.95, abs=0.012)
    assert report["none"]["share"] == 0 and report["small"]["most_uses"] == 3 and set(report) == set(cap)
    # a copy again only once all of the source are used
    again = {r["source"] for r in got if r["copy"] == 1}
    for s in again:
        assert {r["doc_id"] for r in got if r["source"] == s and r["copy"] == 0} == {r[0] for r in rows if r[1] == s and r[0] is not None and (r[2] or 0) > 0}
    per = Counter()
    for r in got:
        per[r["shard"]] += r["n_tokens"]
    assert max(per.values()) < 1.5 * total / len(per)
    same, _ = mix_sources(sizes.repartition(5), "doc_id", "source", "n", targets, shard_tokens=2000, block_tokens=100)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, got))


def test_nothing_to_mix(spark):
    sizes, _ = corpus(spark)
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mixture, shares = mix_sources(sizes.limit(0), "doc_id", "source", "n", targets)
    assert mixture.count() == 0 and {r["share"] for r in shares.collect()} == {0.0}
    mixture, shares = mix_sources(sizes, "doc_id", "source", "n", targets.limit(0))
    assert mixture.count() == 0 and shares.count() == 0
