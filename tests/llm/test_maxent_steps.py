"""One training step against the same step in plain arrays."""

from __future__ import annotations

import numpy as np

from shopstrata.llm import maxent


def test_rows_stored_as_items_are_the_rows():
    table = np.zeros((6, 3), dtype=np.float32)
    maxent._as_items(table)[np.array([4, 1])] = maxent._as_items(np.arange(6, dtype=np.float32).reshape(2, 3))
    assert table[4].tolist() == [0, 1, 2] and table[1].tolist() == [3, 4, 5] and table.sum() == 15


def test_an_update_is_a_step_of_adagrad():
    random = np.random.default_rng(3)
    shape = maxent.Shape(rows=1 << 4, slots=1 << 7, classes=4, singles=1)
    trees = maxent.grow(random.integers(1, 50, 20).astype(float), np.repeat([2, 3], 10))
    weights, bias = random.normal(size=(16, 4)).astype(np.float32), random.normal(size=4).astype(np.float32)
    inner = random.normal(size=128).astype(np.float32)
    rows = random.integers(0, 16, (40, 5)).astype(np.uint16)
    marks = random.integers(0, 1 << 32, (40, 3), dtype=np.uint64).astype(np.uint32)
    classes, leaves = random.integers(0, 4, 40), random.integers(-1, 20, 40)
    learner = maxent.Learner(weights, bias, inner, trees, shape)
    learner.update(rows, marks, classes, leaves)

    sums = bias + sum(weights[rows[:, k]] for k in range(5))
    error = np.exp(sums) / np.exp(sums).sum(axis=1, keepdims=True) - np.eye(4)[classes]
    wanted, squares = weights.astype(float), np.full(16, 0.1)
    for k in range(5):
        for row in np.unique(rows[:, k]):
            gradient = error[rows[:, k] == row].sum(axis=0)
            squares[row] += (gradient**2).mean()
            wanted[row] -= shape.rate * gradient / np.sqrt(squares[row])
    np.testing.assert_allclose(learner.weights, wanted, rtol=1e-4, atol=1e-5)

    owner, nodes, ones = trees.steps(leaves[leaves >= 0])
    slots = maxent.slots_of(marks[leaves >= 0].T, owner, trees.line[nodes], shape)
    off = 1 / (1 + np.exp(-(trees.offset[nodes] + sum(inner[own] for own in slots)))) - ones
    total = np.zeros(128)
    for own in slots:
        np.add.at(total, own, off)
    # Slots that one feature alone comes to are stepped once.
    once = np.flatnonzero(sum(np.isin(np.arange(128), own).astype(int) for own in slots) == 1)
    assert len(once) > 5
    stepped = inner - shape.node_rate * total / np.sqrt(0.1 + total**2)
    np.testing.assert_allclose(learner.inner[once], stepped[once], rtol=1e-4, atol=1e-5)
