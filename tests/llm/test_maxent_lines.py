"""Paths of the word trees taken line by line, and sums of the tokens of a weight row."""

from __future__ import annotations

import numpy as np
import pytest

from shopstrata.llm import maxent


def _trees(leaves: int) -> maxent.Trees:
    random = np.random.default_rng(8)
    return maxent.grow(random.integers(1, 1000, leaves).astype(float), random.integers(0, 3, leaves))


@pytest.mark.parametrize("leaves", [1, 4, 700])  # at first no leaf has a path
def test_lines_hold_the_nodes_of_the_paths(leaves):
    random, trees, shape = np.random.default_rng(9), _trees(leaves), maxent.Shape(slots=1 << 12)
    wanted = random.integers(0, leaves, 300)
    marks = random.integers(0, 1 << 32, (3, 300), dtype=np.uint64).astype(np.uint32)
    owner, nodes, ones = trees.steps(wanted)
    found = trees.lines(wanted)
    slots = maxent.slots_of(marks, owner, trees.line[nodes], shape)
    for own, also in zip(slots, found.slots(maxent.starts_of(marks, found.owner, found.first, shape))):
        assert (own == also).all()
    assert (found.ones == ones).all() and (found.offset == trees.offset[nodes]).all()
    assert (np.repeat(np.arange(300), found.steps) == owner).all()
    assert leaves < 700 or len(found.owner) < 0.6 * len(owner)


def test_only_errors_of_repeated_lines_go_through_the_table():
    random, trees, shape = np.random.default_rng(10), _trees(700), maxent.Shape(rows=1 << 4, slots=1 << 20, classes=4, singles=1)
    learner = maxent.Learner(np.zeros((16, 4)), np.zeros(4), np.zeros(1 << 20), trees, shape)
    marks = random.integers(0, 1 << 32, (3, 50), dtype=np.uint64).astype(np.uint32)
    marks[:, 25:30] = marks[:, :1]
    found = trees.lines(np.append(random.integers(0, 700, 25), np.repeat(random.integers(0, 700, 5), 5)))
    starts = maxent.starts_of(marks, found.owner, found.first, shape)
    slots, error = found.slots(starts), random.normal(size=len(found.place)).astype(np.float32)
    sums = np.zeros(1 << 20)
    for own in slots:
        np.add.at(sums, own, error)
    added = []
    learner._sum = _Counting.of(learner._sum, added)
    for own, got in zip(slots, learner._summed(starts, found.many, slots, error)):
        np.testing.assert_allclose(got, sums[own], rtol=1e-5, atol=1e-6)
    assert not np.any(learner._sum) and 0 < sum(added) < 0.6 * 3 * len(error)


class _Counting(np.ndarray):
    """An array that notes how many places are set by index."""

    @classmethod
    def of(cls, plain, added):
        made = plain.view(cls)
        made.added = added
        return made

    def __setitem__(self, place, value):
        self.added.append(len(place))
        super().__setitem__(place, value)


def test_rows_of_few_and_of_many_tokens_are_summed():
    random = np.random.default_rng(11)
    shape = maxent.Shape(rows=1 << 6, slots=1 << 7, classes=4, singles=1)
    rows = random.permutation(np.repeat(np.arange(30), np.arange(30))).astype(np.uint16)  # runs of 1 to 29
    learner = maxent.Learner(np.zeros((64, 4), dtype=np.float32), np.zeros(4, dtype=np.float32), np.zeros(128), _trees(4), shape)
    error = random.normal(size=(len(rows), 4)).astype(np.float32)
    learner._step(rows, error)
    for row in range(30):
        gradient = error[rows == row].sum(axis=0)
        step = shape.rate * gradient / np.sqrt(0.1 + (gradient**2).mean())
        np.testing.assert_allclose(learner.weights[row], -step, rtol=1e-4, atol=1e-5)


def test_packed_changes_come_back():
    change, seen = np.array([[0.5], [-0.02], [3.0], [0.25]], dtype=np.float32), np.array([1, 0, 8, 0.5], dtype=np.float32)
    ids, scale, changes, often = maxent._packed(change, seen)
    rows, got, how_often = maxent._unpacked(ids, scale, changes, often)
    assert rows.tolist() == [0, 2, 3] and how_often.tolist() == [1, 8, 0.5]
    np.testing.assert_allclose(got[:, 0], [0.5, 3, 0.25], rtol=0.03)
