"""Language-model scores from a hashed maximum-entropy model.

The probability of a token is factored: P(token | history) = P(class | history) * P(token | class, history).
The class part is a softmax over the sum of weight rows that the history's features hash
to: the last word, the last two and three words, and the second and third last word alone
(skips). The most frequent words and the end of the text are classes of their own; all
other words fall into classes by their last two bytes. The words of a class are the leaves of
a binary tree, a Huffman tree over their counts, and each node of a word's path is a
logistic choice by the same features (a hierarchical softmax). Every word of the head is a leaf;
the other words of a class share ``tails`` leaves by their hash, and within such a leaf a word has its
smoothed share of the leaf's training tokens, with one place for all unknown words, so
that every probability is normalised. A node without weights splits by the counts alone.

The number of weight rows and of the nodes' weights follows the counted distinct words, up to
``max_rows`` and ``max_slots``, which bound the memory of a task; beyond that, features share weights.

Training is distributed: in each round every task runs AdaGrad from the shared weights
over its own documents, and the weight changes are averaged row by row, each task weighted
by how often it saw the row. Every training document is used once. A task returns only the rows it
saw, averages are taken by blocks of rows in a tree of groups, and the model has a bounded size
(``max_rows`` * ``classes`` + ``max_slots``), so it can be broadcast.

Counts of words grow with the corpus and are never broadcast whole. Only the ``head`` most
frequent words are, a bound by parameter; a document's other words are joined with the table
of counts. Words are told apart by 64-bit hashes.

Edge cases: null and empty text have one token, the end. A null id counts as the empty
text when documents are held out. Rows that repeat id and text have equal scores. With no
training document all words are unknown and the model is uniform over its classes and their leaves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.scratch import written
from shopstrata.llm.wordhash import BLANK_WORDS, mix, words

SMOOTHING = 0.1
END = np.uint64(0xE4D)
START = np.uint64(0x57A127)
END_SUFFIX = 1 << 16
SQUARE = 0.1  # squared gradients before the first
_FIRST_BITS = 20


@dataclass(frozen=True)
class Shape:
    rows: int = 1 << 15  # at least; four a distinct word
    max_rows: int = 1 << 16
    slots: int = 1 << 18  # weights of the tree nodes, at least; 32 a distinct word
    max_slots: int = 1 << 22
    tails: int = 16  # leaves a class for the words outside the head
    classes: int = 32
    singles: int = 15  # words that are classes of their own, besides the end
    head: int = 1 << 18  # words whose counts are broadcast
    rounds: int = 2
    rate: float = 0.15
    node_rate: float = 0.22  # of the tree nodes, which have fewer features to share a step
    batch: int = 8192  # tokens an update

    def grown(self, distinct: int) -> Shape:
        """The shape with rows and slots for so many distinct words."""

        def size(least: int, wanted: int, most: int) -> int:
            return max(least, min(most, 1 << max(wanted - 1, 0).bit_length()))

        return replace(
            self, rows=size(self.rows, 4 * distinct, self.max_rows), slots=size(self.slots, 32 * distinct, self.max_slots)
        )


@dataclass(frozen=True)
class Tokens:
    """The tokens of some texts, one after the other: hash, suffix, place in the text, and tokens per text."""

    keys: np.ndarray
    suffix: np.ndarray
    at: np.ndarray
    sizes: np.ndarray


def tokens(texts: list[bytes]) -> Tokens:
    joined = b"\n".join(texts) + b"\n"
    hashes, starts, ends = words(joined, BLANK_WORDS)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    place = np.arange(len(hashes)) + text  # each earlier text has put in its end
    keys = np.full(len(hashes) + len(texts), END)
    suffix = np.full(len(keys), END_SUFFIX, dtype=np.int32)
    if len(hashes):
        data = np.frombuffer(joined, dtype=np.uint8)
        before, last = (BLANK_WORDS[data[ends - n]].astype(np.int32) for n in (2, 1))
        keys[place] = hashes
        suffix[place] = np.where(ends - starts > 1, before, 0) * 256 + last
    sizes = np.bincount(text, minlength=len(texts)) + 1
    return Tokens(keys, suffix, np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes), sizes)


def in_portions(batches: Iterator[pa.RecordBatch], size: int = 1 << 17) -> Iterator[tuple[pa.RecordBatch, Tokens]]:
    """Slices of the batches with their tokens; a slice ends where its texts reach ``size`` bytes."""
    for batch in batches:
        texts, held, first = [], 0, 0
        for i, text in enumerate(batch.column("text").cast(pa.large_binary())):
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= size or i == batch.num_rows - 1:
                yield batch.slice(first, len(texts)), tokens(texts)
                texts, held, first = [], 0, i + 1


# --- counts ---------------------------------------------------------------------


def _count(flush: int = 1 << 20):
    def merged(parts: list) -> list:
        keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        suffix = np.zeros(len(keys), dtype=np.int32)
        suffix[inverse] = np.concatenate([p[2] for p in parts])
        return [(keys, n, suffix)]

    def batch(part) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(part[0].view(np.int64)), pa.array(part[2]), pa.array(part[1])], names=["word", "suffix", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for _, found in in_portions(batches):
            parts.append((found.keys, np.ones(len(found.keys)), found.suffix))
            held += len(found.keys)
            if held > flush:
                parts = merged(parts)
                held = len(parts[0][0])
                if held > flush // 2:
                    yield batch(parts[0])
                    parts, held = [], 0
        if parts:
            yield batch(merged(parts)[0])

    return run


@dataclass(frozen=True)
class Trees:
    """A binary tree a class: the parent of each leaf and, from ``leaves`` on, of each node, -1 for a root."""

    leaves: int
    parent: np.ndarray
    side: np.ndarray  # whether a leaf or node is its parent's first side
    offset: np.ndarray  # log odds of each node's first side by the counts
    line: np.ndarray  # eight times the node where the up to three levels around each node begin, plus its place in them

    @cached_property
    def _paths(self) -> tuple[np.ndarray, ...]:
        """Where the path of each leaf starts among the nodes, and among the lines; the nodes with their log odds, and the
        lines. A node's number holds the node, its side and, in three bits, its place in the line; that of a line holds its
        first node and, in two bits, how many nodes of the path are in it."""
        many = np.zeros(self.leaves, dtype=np.int64)
        for leaf, _, _ in self._levels():
            many[leaf] += 1
        start = np.append(0, np.cumsum(many))
        path = np.empty(start[-1], dtype=[("odds", np.float32), ("step", np.uint32)])
        for level, (leaf, node, one) in enumerate(self._levels()):
            at = start[leaf] + level
            path["odds"][at] = self.offset[node]
            path["step"][at] = node * 16 + one * np.int32(8) + self.line[node] % 8
        # The nodes of a line follow one another on a path.
        line = self.line[path["step"] >> 4] >> 3
        new = np.ones(len(line), dtype=bool)
        new[1:] = line[1:] != line[:-1]
        new[start[:-1][many > 0]] = True
        first = np.flatnonzero(new)
        held = np.diff(np.append(first, len(line)))
        return start, np.searchsorted(first, start), path, (line[first] * 4 + held).astype(np.uint32)

    def _levels(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """From the leaves up: the leaves whose paths go on, and the next nodes and sides."""
        leaf = at = np.arange(self.leaves, dtype=np.int32)
        while len(leaf):
            above = self.parent[at]
            on = above >= 0
            leaf, side, at = leaf[on], self.side[at[on]], above[on]
            yield leaf, at - np.int32(self.leaves), side

    def __getstate__(self) -> dict:
        """Without the paths, which are far larger than the trees and are drawn anew in each task's process."""
        return {k: v for k, v in self.__dict__.items() if k != "_paths"}

    def steps(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each node on the paths of ``leaves``: which leaf of the list, the node, and the side."""
        start, _, path, _ = self._paths
        at, many = _runs(start, leaves)
        step = np.take(path, at)["step"]
        return np.repeat(np.arange(len(leaves)), many), (step >> 4).astype(np.int32), (step >> 3 & 1).astype(np.float32)

    def lines(self, leaves: np.ndarray) -> Lines:
        """The paths of ``leaves`` line by line."""
        start, line_start, path, lines = self._paths
        at, many_lines = _runs(line_start, leaves)
        inside, many = _runs(start, leaves)
        line, node = np.take(lines, at), np.take(path, inside)
        step = node["step"]
        return Lines(
            np.repeat(np.arange(len(leaves)), many_lines), line >> 2, (line & 3).astype(np.int64), many,
            node["odds"].copy(), (step & 7).astype(np.int64), (step >> 3 & 1).astype(np.float32),
        )


def _runs(start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in the runs ``which``, and how many each has; runs go from start to start."""
    first = np.take(start, which)
    many = np.take(start, which + 1) - first
    at = np.repeat(first - (np.cumsum(many) - many), many)
    at += np.arange(len(at))
    return at, many


@dataclass(frozen=True)
class Lines:
    """Paths of leaves by lines: for each line which leaf of the list, its first node, and how many nodes of the path;
    how many nodes each path has; for each node its log odds by the counts, its place in the line, and the side."""

    owner: np.ndarray
    first: np.ndarray
    many: np.ndarray
    steps: np.ndarray
    offset: np.ndarray
    place: np.ndarray
    ones: np.ndarray

    def slots(self, starts: np.ndarray) -> list[np.ndarray]:
        """Where the weights of the nodes are, for each feature, whose lines start at ``starts``."""
        return [np.repeat(own, self.many) ^ self.place for own in starts]


def grow(weights: np.ndarray, group: np.ndarray) -> Trees:
    """A Huffman tree over the leaves of each group."""
    count = len(weights)
    total = list(weights)
    parent = np.full(2 * count, -1, dtype=np.int32)
    side = np.zeros(2 * count, dtype=bool)
    offset: list[float] = []
    order = np.argsort(group, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if count else []:
        heap = [(total[i], i) for i in members.tolist()]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            made = len(total)
            parent[i] = parent[j] = made
            side[j] = True
            offset.append(math.log(b / a))
            total.append(a + b)
            heapq.heappush(heap, (a + b, made))
    parent, side = parent[: len(total)], side[: len(total)]
    line = np.zeros(len(offset), dtype=np.uint32)
    for node in range(len(offset) - 1, -1, -1):  # a parent is made after its sides
        above = int(parent[count + node]) - count
        if above >= 0 and line[above] % 8 < 3:
            line[node] = line[above] // 8 * 8 + 2 * (line[above] % 8) + 1 + side[count + node]
        else:
            line[node] = node * 8
    return Trees(count, parent, side, np.array(offset, dtype=np.float32), line)


@dataclass(frozen=True)
class Words:
    """What is known of the words: totals, the head with its counts, and the tree of each class."""

    total: int
    distinct: int
    head: np.ndarray  # sorted hashes
    head_n: np.ndarray
    single: np.ndarray  # class of a head word that is one, else -1
    leaf: np.ndarray  # leaf of a head word, -1 where it is a class
    tail_leaf: np.ndarray  # leaf per class and tail, -1 for classes of one word
    tail_mass: np.ndarray  # smoothed tokens per class and tail
    trees: Trees
    shape: Shape

    @property
    def base_log(self) -> float:
        return math.log10(self.total + SMOOTHING * (self.distinct + 1))

    @cached_property
    def _starts(self) -> np.ndarray:
        """Where in the head the hashes with the same first bits begin."""
        return np.searchsorted(self.head, np.arange(1 << _FIRST_BITS, dtype=np.uint64) << np.uint64(64 - _FIRST_BITS))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_starts"}

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the head, and whether the word is there at all."""
        if not len(self.head):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        last = len(self.head) - 1
        at = np.minimum(np.take(self._starts, (keys >> np.uint64(64 - _FIRST_BITS)).astype(np.int64)), last)
        held = np.take(self.head, at)
        late = np.flatnonzero((held < keys) & (at < last))
        while len(late):  # few hashes share their first bits
            at[late] += 1
            held[late] = self.head[at[late]]
            late = late[(held[late] < keys[late]) & (at[late] < last)]
        return at, held == keys

    def class_of(self, at: np.ndarray, inside: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        found = suffix_class(suffix, self.shape)
        if len(self.head):
            own = np.where(inside, self.single[at], -1)
            found = np.where(own >= 0, own, found)
        return np.where(suffix == END_SUFFIX, 0, found)

    def leaf_of(self, keys: np.ndarray, at: np.ndarray, inside: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The leaf of each token, -1 where its class has only one word."""
        found = self.tail_leaf[classes, tail_of(keys, self.shape)]
        if len(self.head):
            found = np.where(inside, self.leaf[at], found)
        return np.where(classes > self.shape.singles, found, -1)


def tail_of(keys: np.ndarray, shape: Shape) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(shape.tails)).astype(np.int64)


def suffix_class(suffix: np.ndarray, shape: Shape) -> np.ndarray:
    first = 1 + shape.singles
    return (first + mix(suffix.astype(np.uint64)) % np.uint64(shape.classes - first)).astype(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """``word, suffix, n`` over ``texts(text)``."""
    counted = texts.select("text").mapInArrow(_count(), "word long, suffix int, n long")
    return written(counted.groupBy("word").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n")), "words")


def describe(counts: DataFrame, shape: Shape) -> Words:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    shape = shape.grown(int(totals[1]))
    # Some hundred logarithmic bins tell down to which count the head can go.
    size = F.floor(8 * F.log2("n"))
    bins = sorted(((r["bin"], r["words"]) for r in counts.groupBy(size.alias("bin")).agg(
        F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    cut, room = None, shape.head
    for at, many in bins:
        if many > room:
            break
        cut, room = at, room - many
    if cut is None:
        head = pa.table({"word": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "suffix": pa.array([], pa.int32())})
    else:
        head = counts.where(size >= cut).select("word", "n", "suffix").toArrow()  # at most shape.head rows
    keys = np.asarray(head["word"]).astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, n = keys[order], np.asarray(head["n"]).astype(np.int64)[order]
    suffix = np.asarray(head["suffix"]).astype(np.int64)[order]
    single = np.full(len(keys), -1, dtype=np.int16)
    ranked = np.lexsort((keys, -n))
    ranked = ranked[suffix[ranked] != END_SUFFIX][: shape.singles]
    single[ranked] = 1 + np.arange(len(ranked))

    # The words outside the head, at most tails * 2 ** 16 rows.
    outside = counts if cut is None else counts.where(size < cut)
    tail = F.pmod(F.shiftrightunsigned("word", 32), F.lit(shape.tails)).alias("tail")
    by_tail = outside.where(F.col("suffix") != END_SUFFIX).groupBy("suffix", tail).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")
    ).toArrow()
    mass = np.full((shape.classes, shape.tails), SMOOTHING)
    place = suffix_class(np.asarray(by_tail["suffix"]).astype(np.int64), shape), np.asarray(by_tail["tail"]).astype(np.int64)
    np.add.at(mass, place, np.asarray(by_tail["n"]).astype(float) + SMOOTHING * np.asarray(by_tail["v"]).astype(float))

    worded = np.flatnonzero((single < 0) & (suffix != END_SUFFIX))
    leaf = np.full(len(keys), -1, dtype=np.int32)
    leaf[worded] = np.arange(len(worded))
    first = 1 + shape.singles
    tail_leaf = np.full((shape.classes, shape.tails), -1, dtype=np.int64)
    tail_leaf[first:] = len(worded) + np.arange((shape.classes - first) * shape.tails).reshape(-1, shape.tails)
    group = np.append(suffix_class(suffix[worded], shape), np.repeat(np.arange(first, shape.classes), shape.tails))
    trees = grow(np.append(n[worded] + SMOOTHING, mass[first:].ravel()), group)
    return Words(int(totals[0]), int(totals[1]), keys, n, single, leaf, tail_leaf, mass, trees, shape)


# --- the model -------------------------------------------------------------------


_NODE_FEATURES = [0, 1, 3]  # the last word, the last two, and the second last alone
_SHORT = 8


def features(found: Tokens, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Weight rows of each token's history, one column per feature, and 32 further bits of each feature."""

    def earlier(n: int) -> np.ndarray:
        keys = np.concatenate([np.full(n, START), found.keys])[: len(found.keys)]
        keys[found.at < n] = START
        return keys

    w1, w2, w3 = earlier(1), earlier(2), earlier(3)
    with np.errstate(over="ignore"):
        two = w1 * np.uint64(3) + mix(w2)
        raw = [w1, two, mix(two) + w3, w2, w3]
        mixed = [mix(x + np.uint64(0x1000 + k)) for k, x in enumerate(raw)]
        rows = np.stack([m.astype(np.uint32) for m in mixed]) & np.uint32(shape.rows - 1)
        marks = np.stack([(mixed[k] >> np.uint64(32)).astype(np.uint32) for k in _NODE_FEATURES])
        return (rows.astype(np.uint16) if shape.rows <= 1 << 16 else rows).T, marks.T  # a column's numbers lie together


def slots_of(marks: np.ndarray, owner: np.ndarray, line: np.ndarray, shape: Shape) -> np.ndarray:
    """Where the weights of features and tree nodes are: one row per feature, one column per node.

    The nodes of up to three levels of a path lie in eight neighbouring places, so that they come in one fetch."""
    return starts_of(marks, owner, line >> np.uint32(3), shape) ^ (line & np.uint32(7))


def starts_of(marks: np.ndarray, owner: np.ndarray, first: np.ndarray, shape: Shape) -> np.ndarray:
    """Where the line that begins at each node ``first`` is: one row per feature. The last three bits mix up the places in it."""
    mixed = np.stack([np.take(m, owner) for m in marks])
    mixed ^= first * np.uint32(0x9E3779B1)
    mixed *= np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0xC2B2AE35)
    mixed >>= np.uint32(33 - shape.slots.bit_length())
    return mixed.astype(np.int64)  # which numpy takes twice as fast


def logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.take(weights, rows[:, 0], axis=0)
    total += bias
    for k in range(1, rows.shape[1]):
        total += np.take(weights, rows[:, k], axis=0)
    return np.clip(total, -60, 60, out=total)  # so that exp() needs no shift


def node_logits(inner: np.ndarray, trees: Trees, slots: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    return added(inner, np.take(trees.offset, nodes), slots)


def added(inner: np.ndarray, offset: np.ndarray, slots: np.ndarray | list[np.ndarray]) -> np.ndarray:
    """The log odds of nodes: ``offset``, which becomes the sum, and each feature's weight."""
    for own in slots:
        offset += np.take(inner, own)
    return np.clip(offset, -60, 60, out=offset)


def _sent(model: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Half as large; what a task learns is added to the whole numbers on the driver."""
    return tuple(x.astype(np.float16) for x in model)


def _received(model: tuple[np.ndarray, ...]) -> Iterator[np.ndarray]:
    return (x.astype(np.float32) for x in model)


def _as_items(rows: np.ndarray) -> np.ndarray:
    """One item a row, which numpy stores whole instead of number by number."""
    return rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1])))[:, 0]


class Learner:
    """AdaGrad over the documents of one task, with one step size a weight row or node weight."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, inner: np.ndarray, trees: Trees, shape: Shape):
        self.weights, self.bias, self.shape = weights.copy(), bias.copy(), shape
        self.squares = np.full(len(weights), 0.1, dtype=np.float32)
        self.bias_square = 0.1
        self.seen = np.zeros(len(weights), dtype=np.float32)
        self.trees = trees
        # A node's weight (real part) and its squared gradients (imaginary part) lie together, to be fetched at once.
        self.nodes = (inner + np.complex64(SQUARE * 1j)).astype(np.complex64)
        self._sum = np.zeros(len(inner), dtype=np.float32)
        self._last = np.zeros((len(inner) + 7) // 8, dtype=np.int32)

    @property
    def inner(self) -> np.ndarray:
        return self.nodes.real

    @property
    def inner_seen(self) -> np.ndarray:
        """How much each node weight has learnt: its squared gradients."""
        return self.nodes.imag - np.float32(SQUARE)

    def update(self, rows: np.ndarray, marks: np.ndarray, classes: np.ndarray, leaves: np.ndarray) -> None:
        self._update_classes(rows, classes)
        self._update_words(marks, leaves)

    def _update_words(self, marks: np.ndarray, leaves: np.ndarray) -> None:
        inside = np.flatnonzero(leaves >= 0)
        found = self.trees.lines(leaves[inside])
        if not len(found.owner):
            return
        starts = starts_of(marks[inside].T, found.owner, found.first, self.shape)
        slots = found.slots(starts)
        held = [np.take(self.nodes, own) for own in slots]
        turns = found.offset
        for node in held:
            turns += node.real
        error = 1 / (1 + np.exp(-np.clip(turns, -60, 60, out=turns))) - found.ones
        # A slot that comes several times gets the same value each time.
        for own, node, gradient in zip(slots, held, self._summed(starts, found.many, slots, error)):
            squares = gradient * gradient
            squares += node.imag
            node.imag = squares
            gradient *= np.float32(self.shape.node_rate)
            gradient /= np.sqrt(squares, out=squares)
            node.real -= gradient
            self.nodes[own] = node

    def _summed(
        self, starts: np.ndarray, many: np.ndarray, slots: list[np.ndarray], error: np.ndarray
    ) -> list[np.ndarray]:
        """For each feature the sums of the errors by slot. Where a line comes once, its slots take their errors as they are."""
        lines = starts.ravel() >> 3
        at = np.arange(len(lines), dtype=np.int32)
        self._last[lines] = at
        last = np.take(self._last, lines)
        several = last != at
        several[last[several]] = True
        among = [np.flatnonzero(np.repeat(own, many)) for own in several.reshape(starts.shape)]
        repeated = [np.take(own, some) for own, some in zip(slots, among)]
        for own, some in zip(repeated, among):
            np.add.at(self._sum, own, np.take(error, some))
        sums = []
        for own, some in zip(repeated, among):
            sums.append(error.copy())
            sums[-1][some] = np.take(self._sum, own)
        for own in repeated:
            self._sum[own] = 0
        return sums

    def _update_classes(self, rows: np.ndarray, classes: np.ndarray) -> None:
        error = logits(self.weights, self.bias, rows)
        np.exp(error, out=error)
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(len(classes)), classes] -= 1
        total = error.sum(axis=0)
        self.bias_square += float((total**2).mean())
        self.bias -= self.shape.rate * total / np.float32(math.sqrt(self.bias_square))
        for k in range(rows.shape[1]):
            self._step(rows[:, k], error)
        self.seen += np.bincount(rows.T.ravel(), minlength=len(self.seen)).astype(np.float32)

    def _step(self, rows: np.ndarray, error: np.ndarray) -> None:
        """One feature's rows. A row of one token takes that token's error as it is; the others are summed."""
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        new = np.ones(len(ordered), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(ordered)))
        touched = ordered[first]
        gradient = np.take(error, order[first], axis=0)
        repeated = np.flatnonzero(many > 1)
        repeated = repeated[np.argsort(-many[repeated], kind="stable")]
        bounds = len(repeated) - np.searchsorted(many[repeated][::-1], np.arange(1, _SHORT + 1), side="right")
        longer, short = repeated[: bounds[-1]], repeated[bounds[-1] :]
        if len(longer):
            inside = np.repeat(many > _SHORT, many)
            counts = many[many > _SHORT]
            gradient[np.sort(longer)] = np.add.reduceat(
                np.take(error, order[inside], axis=0), np.cumsum(counts) - counts, axis=0
            )
        if len(short):  # place by place, because reduceat goes through every column of every row's tokens
            start = first[short]
            rest = np.take(error, order[start + 1], axis=0)
            for place, end in enumerate(bounds[1:-1] - len(longer), 2):
                rest[:end] += np.take(error, order[start[:end] + place], axis=0)
            gradient[short] += rest
        squares = self.squares[touched] + np.einsum("ij,ij->i", gradient, gradient) / np.float32(error.shape[1])
        self.squares[touched] = squares
        gradient *= (np.float32(self.shape.rate) / np.sqrt(squares))[:, None]
        np.subtract(np.take(self.weights, touched, axis=0), gradient, out=gradient)
        _as_items(self.weights)[touched] = _as_items(gradient)


_BLOCKS = 64
_CHANGES = "block int, part int, ids binary, scale double, change binary, seen binary"


# What each byte of a packed change and of how much was seen stands for.
_ROOTS = np.arange(256, dtype=np.uint8).view(np.int8).astype(np.float32) / 127
_CHANGE = np.sign(_ROOTS) * _ROOTS**2
_OFTEN = np.exp2((np.arange(256, dtype=np.float32) - 128) / 6)


def _packed(change: np.ndarray, seen: np.ndarray) -> tuple[bytes, float, bytes, bytes]:
    """The rows that were seen, a byte a number: which ones, the largest change, the roots of the changes as shares of
    its root, and the logarithms of how much was seen."""
    rows = seen > 0
    kept = change[rows]
    scale = float(np.abs(kept).max(initial=0)) or 1.0
    roots = np.sign(kept) * np.sqrt(np.abs(kept) / scale) * 127
    often = np.clip(np.round(6 * np.log2(seen[rows])) + 128, 0, 255)
    return np.packbits(rows).tobytes(), scale, np.round(roots).astype(np.int8).tobytes(), often.astype(np.uint8).tobytes()


def _unpacked(ids: bytes, scale: float, change: bytes, seen: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.flatnonzero(np.unpackbits(np.frombuffer(ids, dtype=np.uint8)).view(bool))
    change = np.take(_CHANGE, np.frombuffer(change, dtype=np.uint8)) * scale
    return rows, change.reshape(len(rows), -1) if len(rows) else np.zeros((0, 1)), np.take(_OFTEN, np.frombuffer(seen, dtype=np.uint8))


def _blocks(change: np.ndarray, seen: np.ndarray, first_block: int, part: int) -> pa.RecordBatch:
    packed = [_packed(c, n) for c, n in zip(np.array_split(change, _BLOCKS), np.array_split(seen, _BLOCKS))]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(first_block, first_block + _BLOCKS), pa.int32()), pa.array([part] * _BLOCKS, pa.int32()),
         *(pa.array(c, pa.float64() if n == 1 else pa.binary()) for n, c in enumerate(zip(*packed)))],
        names=["block", "part", "ids", "scale", "change", "seen"],
    )


def _train(shared, known, shape: Shape, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, inner = _received(shared.value)
        vocabulary = known.value
        learner = Learner(weights, bias, inner, vocabulary.trees, shape)
        waiting, held, total = [], 0, 0
        for _, found in in_portions(batches):
            at, inside = vocabulary.look_up(found.keys)
            classes = vocabulary.class_of(at, inside, found.suffix)
            waiting.append((*features(found, shape), classes, vocabulary.leaf_of(found.keys, at, inside, classes)))
            held += len(found.keys)
            while held >= shape.batch:
                columns = [np.concatenate(c) for c in zip(*waiting)]
                learner.update(*[c[: shape.batch] for c in columns])
                waiting = [tuple(c[shape.batch :] for c in columns)]
                held -= shape.batch
                total += shape.batch
        if held:
            learner.update(*[np.concatenate(c) for c in zip(*waiting)])
            total += held
        if not total:
            return
        # The bias is a row that every token sees.
        part = TaskContext.get().partitionId() % fan
        change = np.concatenate([learner.weights - weights, (learner.bias - bias)[None, :]])
        yield _blocks(change, np.append(learner.seen, np.float32(total)), 0, part)
        yield _blocks((learner.inner - inner)[:, None], learner.inner_seen, _BLOCKS, part)

    return run


def _block_rows(shape: Shape) -> list[int]:
    """Rows of each block: first those of the classes' weights and the bias, then those of the nodes' weights."""
    return [len(b) for size in (shape.rows + 1, shape.slots) for b in np.array_split(np.empty(size, np.int8), _BLOCKS)]


def _averaged(shape: Shape):
    sizes = _block_rows(shape)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        total = np.zeros((sizes[block], shape.classes if block < _BLOCKS else 1))
        often = np.zeros(sizes[block])
        for packed in zip(frame["ids"], frame["scale"], frame["change"], frame["seen"]):
            rows, change, seen = _unpacked(*packed)
            if len(rows):
                if total.shape[1] == 1:  # plain numbers, which numpy adds faster than rows of one
                    total[:, 0][rows] += change[:, 0] * seen
                else:
                    total[rows] += change * seen[:, None]
                often[rows] += seen
        first = frame.iloc[:1].copy()
        for name, value in zip(("ids", "scale", "change", "seen"), _packed(total / np.maximum(often, 1)[:, None], often)):
            first[name] = [value]
        return first

    return run


def train(texts: DataFrame, known, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, bias and node weights after ``shape.rounds`` rounds over ``texts(text, fold)``, each using one fold
    of the documents; ``known`` is the broadcast vocabulary."""
    context = texts.sparkSession.sparkContext
    weights = np.zeros((shape.rows, shape.classes), dtype=np.float32)
    bias = np.zeros(shape.classes, dtype=np.float32)
    inner = np.zeros(shape.slots, dtype=np.float32)
    ends = np.cumsum(_block_rows(shape))
    for fold in range(shape.rounds):
        shared = context.broadcast(_sent((weights, bias, inner)))
        mine = texts.where(F.col("fold") == fold).select("text")
        fan = max(1, math.isqrt(mine.rdd.getNumPartitions()))
        changes = mine.mapInArrow(_train(shared, known, shape, fan), _CHANGES)
        if fan > 1:
            changes = changes.groupBy("block", "part").applyInPandas(_averaged(shape), _CHANGES)
        whole = changes.groupBy("block").applyInPandas(_averaged(shape), _CHANGES)
        table, slots = np.concatenate([weights, bias[None, :]]), inner.copy()
        for r in whole.collect():  # a row a block
            block = r["block"]
            rows, change, _ = _unpacked(bytes(r["ids"]), r["scale"], bytes(r["change"]), bytes(r["seen"]))
            if not len(rows):
                continue
            rows = rows + (ends[block - 1] if block else 0)
            if block < _BLOCKS:
                table[rows] += change
            else:
                slots[rows - ends[_BLOCKS - 1]] += change[:, 0]
        weights, bias, inner = table[:-1], table[-1], slots
        shared.destroy()
    return weights, bias, inner


# --- scores ------------------------------------------------------------------------

_ROWS = (
    "doc_id long, text_key long, held_out boolean, word long, tf long, first boolean, n_tokens long, known long,"
    " base double, model double"
)


def _score(shared, known, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, inner = _received(shared.value)
        vocabulary = known.value
        for batch, found in in_portions(batches):
            yield scored(batch, found, weights, bias, inner, vocabulary)

    def scored(batch, found, weights, bias, inner, vocabulary) -> pa.RecordBatch:
        at, inside = vocabulary.look_up(found.keys)
        classes = vocabulary.class_of(at, inside, found.suffix)
        leaves = vocabulary.leaf_of(found.keys, at, inside, classes)
        rows, marks = features(found, shape)
        model = np.empty(len(classes))
        for i in range(0, len(classes), shape.batch):
            part = classes[i : i + shape.batch]
            sums = logits(weights, bias, rows[i : i + shape.batch])
            own = sums[np.arange(len(part)), part].astype(np.float64)
            model[i : i + shape.batch] = own - np.log(np.exp(sums, out=sums).sum(axis=1))
            worded = np.flatnonzero(leaves[i : i + shape.batch] >= 0)
            lines = vocabulary.trees.lines(leaves[i + worded])
            slots = lines.slots(starts_of(marks[i + worded].T, lines.owner, lines.first, shape))
            turns = added(inner, lines.offset, slots)
            turns *= 1 - 2 * lines.ones
            lost = np.maximum(turns, 0) + np.log(1 + np.exp(-np.abs(turns)))  # log(1 + exp(turns))
            model[i + worded] -= np.bincount(np.repeat(np.arange(len(worded)), lines.steps), lost, len(worded))
        model /= math.log(10)
        counts = np.zeros(len(classes))
        counts[inside] = np.log10(vocabulary.head_n[at[inside]] + SMOOTHING)
        tail = np.flatnonzero((leaves >= 0) & ~inside)
        model[tail] -= np.log10(vocabulary.tail_mass[classes[tail], tail_of(found.keys[tail], shape)])
        base = counts - vocabulary.base_log
        text = np.repeat(np.arange(len(found.sizes)), found.sizes)
        many = len(found.sizes)
        values = [
            found.sizes.astype(np.int64), np.bincount(text, inside, many).astype(np.int64),
            np.bincount(text, base, many), np.bincount(text, model, many),
        ]
        # The words outside the head, each once per text; a text without any gets a row that counts for nothing.
        outside = np.flatnonzero(~inside)
        order = np.lexsort((found.keys[outside], text[outside]))
        owner, word = text[outside][order], found.keys[outside][order]
        new = np.ones(len(word), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])
        start = np.flatnonzero(new)
        tf = np.diff(np.append(start, len(word)))
        none = np.setdiff1d(np.arange(many), owner[start])
        owner, word = np.append(owner[start], none), np.append(word[start], np.full(len(none), END))
        tf = np.append(tf, np.zeros(len(none), dtype=np.int64))
        order = np.argsort(owner, kind="stable")
        owner, word, tf = owner[order], word[order], tf[order]
        first = np.ones(len(owner), dtype=bool)
        first[1:] = owner[1:] != owner[:-1]
        index = pa.array(owner)
        arrays = [batch.column(c).take(index) for c in ("doc_id", "text_key", "held_out")]
        arrays += [pa.array(word.view(np.int64)), pa.array(tf), pa.array(first)]
        for value in values:
            column = np.zeros(len(first), dtype=value.dtype)
            column[first] = value
            arrays.append(pa.array(column))
        return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _ROWS.split(", ")])

    return run


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 10, shape: Shape | None = None
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; scores are
    log10 probabilities of the whole text."""
    shape = shape or Shape()
    context = docs.sparkSession.sparkContext
    text = F.coalesce(F.col(text_col), F.lit(""))
    remainder = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(held_out_mod))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"),
        (remainder == 0).alias("held_out"),
        F.pmod(F.xxhash64(text, F.lit(1)), F.lit(shape.rounds)).alias("fold"),
    )
    training = texts.where(~F.col("held_out"))
    counts = count_words(training)
    vocabulary = describe(counts, shape)
    shape = vocabulary.shape
    known = context.broadcast(vocabulary)
    shared = context.broadcast(_sent(train(training, known, shape)))
    rows = texts.select("doc_id", "text_key", "held_out", "text").mapInArrow(_score(shared, known, shape), _ROWS)
    # The counts of a document's rarer words come by a join; no such word is frequent, so no key is hot.
    joined = rows.join(counts.select(F.col("word").alias("_word"), "n"), F.col("word") == F.col("_word"), "left")
    rare = F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))
    summed = joined.groupBy("doc_id", "text_key").agg(
        F.first("held_out").alias("held_out"), F.count_if("first").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(F.lit(0))).alias("n_known"),
        F.sum(F.col("base") + rare).alias("base"), F.sum(F.col("model") + rare).alias("model"),
    )
    one = summed.select(
        "doc_id", "held_out",
        (F.col("n_tokens") / F.col("copies")).cast("bigint").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("bigint").alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("model") / F.col("copies")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    )
    return one.drop("_copy")
