"""Forward-backward against a sum over all labellings."""

from itertools import product

import numpy as np

from tagweave.llm.crf import Chain, layout, marginals


def test_marginals_and_counts():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 5, 2])
    labels = 3
    scores = rng.normal(size=(lengths.sum(), labels)) * 3
    chain = Chain(rng.normal(size=(labels, labels)), rng.normal(size=labels))
    got, norm, pairs, start = marginals(scores, layout(lengths), chain, expected=True)
    assert np.allclose(got, marginals(scores, layout(lengths), chain))
    want, log_norm = np.zeros_like(scores), 0.0
    want_pairs, want_start = np.zeros((labels, labels)), np.zeros(labels)
    begin = 0
    for n in lengths.tolist():
        weights = {}
        for path in product(range(labels), repeat=n):
            total = chain.start[path[0]] + sum(scores[begin + i, k] for i, k in enumerate(path))
            weights[path] = np.exp(total + sum(chain.transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
        whole = sum(weights.values())
        log_norm += np.log(whole)
        for path, w in weights.items():
            want_start[path[0]] += w / whole
            for i, k in enumerate(path):
                want[begin + i, k] += w / whole
            for a, b in zip(path, path[1:], strict=False):
                want_pairs[a, b] += w / whole
        begin += n
    assert np.allclose(got, want) and np.isclose(norm, log_norm)
    assert np.allclose(pairs, want_pairs) and np.allclose(start, want_start)


def test_no_elements():
    chain = Chain(np.zeros((2, 2)), np.zeros(2))
    assert marginals(np.zeros((0, 2)), layout(np.zeros(0, dtype=int)), chain).shape == (0, 2)
