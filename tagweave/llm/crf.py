"""Linear-chain conditional random fields over many sequences at once.

Sequences are laid out by position: step t of the forward and backward recursions treats the t-th element of all sequences that are
that long, so the cost is a few array operations for each position of the longest sequence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Layout:
    """Places of the elements of sequences when ordered by (position, longest sequence first)."""

    place: np.ndarray
    levels: np.ndarray


def layout(lengths: np.ndarray) -> Layout:
    """The layout of sequences that follow each other, ``lengths`` elements each."""
    lengths = np.asarray(lengths, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(lengths), dtype=np.int64)
    rank[order] = np.arange(len(lengths))
    longest = int(lengths.max()) if len(lengths) else 0
    # How many sequences have an element at each position, and where the position's elements begin.
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    levels = np.concatenate(([0], np.cumsum(active)))
    position = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return Layout(levels[position] + np.repeat(rank, lengths), levels)


@dataclass
class Chain:
    """Scores of a label after another, and of a first label."""

    transitions: np.ndarray
    start: np.ndarray


def marginals(scores: np.ndarray, form: Layout, chain: Chain, expected: bool = False):
    """Label probabilities of every element by forward-backward; with ``expected`` also the log-likelihood's normaliser
    and the expected counts of transitions and first labels.
    """
    n, labels = scores.shape
    if not n:
        empty = np.zeros((0, labels))
        return (empty, 0.0, np.zeros((labels, labels)), np.zeros(labels)) if expected else empty
    top = scores.max(axis=1)
    local = np.empty_like(scores)
    local[form.place] = np.exp(scores - top[:, None])
    step = np.exp(chain.transitions)
    forward, norm = np.empty_like(local), np.empty(n)
    levels = form.levels.tolist()
    for t in range(len(levels) - 1):
        here = slice(levels[t], levels[t + 1])
        width = levels[t + 1] - levels[t]
        before = np.exp(chain.start) if t == 0 else forward[levels[t - 1] : levels[t - 1] + width] @ step
        values = before * local[here]
        norm[here] = total = values.sum(axis=1)
        forward[here] = values / total[:, None]
    backward = np.ones_like(local)
    pairs = np.zeros((labels, labels))
    for t in range(len(levels) - 2, 0, -1):
        here = slice(levels[t], levels[t + 1])
        width = levels[t + 1] - levels[t]
        coming = local[here] * backward[here] / norm[here, None]
        before = slice(levels[t - 1], levels[t - 1] + width)
        backward[before] = coming @ step.T
        if expected:
            pairs += forward[before].T @ coming
    chances = forward * backward
    chances /= chances.sum(axis=1, keepdims=True)
    ordered = chances[form.place]
    if not expected:
        return ordered
    return ordered, float(np.log(norm).sum() + top.sum()), pairs * step, chances[: levels[1]].sum(axis=0)


class Ascent:
    """Adagrad steps on several arrays, with a pull towards zero."""

    def __init__(self, rate: float, pull: float):
        self.rate, self.pull, self.seen = rate, pull, {}

    def step(self, name: str, values: np.ndarray, gradient: np.ndarray) -> None:
        """Move ``values`` up the gradient, in place."""
        gradient = gradient - self.pull * values
        seen = self.seen.setdefault(name, np.full(values.shape, 1e-8))
        seen += gradient * gradient
        values += self.rate * gradient / np.sqrt(seen)
