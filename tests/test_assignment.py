"""Exact assignment against brute force over permutations."""

from itertools import permutations

import numpy as np
import pytest

from campuslens.operators.identity import assign


def best_total(score):
    p, q = score.shape
    if p > q:
        return best_total(score.T)
    return max(sum(score[i, c[i]] for i in range(p)) for c in permutations(range(q), p))


@pytest.mark.parametrize("seed", range(60))
def test_assign_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    p, q = rng.integers(1, 6, 2)
    score = rng.integers(0, 15, (p, q))
    flow = assign(score, np.ones(p, int), np.ones(q, int))
    assert flow.min() >= 0 and flow.sum() == min(p, q)
    assert flow.sum(axis=0).max() <= 1 and flow.sum(axis=1).max() <= 1
    assert (flow * score).sum() == best_total(score)


@pytest.mark.parametrize("seed", range(40))
def test_assign_with_multiplicities(seed):
    rng = np.random.default_rng(1000 + seed)
    p, q = rng.integers(1, 4, 2)
    supply, demand = rng.integers(1, 3, p), rng.integers(1, 3, q)
    score = rng.integers(0, 15, (p, q))
    flow = assign(score, supply, demand)
    wide = np.repeat(np.repeat(score, supply, axis=0), demand, axis=1)
    assert flow.sum() == min(supply.sum(), demand.sum())
    assert (flow.sum(axis=1) <= supply).all() and (flow.sum(axis=0) <= demand).all()
    assert (flow * score).sum() == best_total(wide)


def test_optimum_is_not_mutual_best():
    flow = assign(np.array([[14, 13], [13, 0]]), np.array([1, 1]), np.array([1, 1]))
    assert flow.tolist() == [[0, 1], [1, 0]]
