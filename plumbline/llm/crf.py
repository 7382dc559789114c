"""A linear-chain conditional random field with two labels, fitted by maximum likelihood, decoded by Viterbi."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: One step of a chain: the names of its features, and which of two kinds of border lies before it.
Step = tuple[Sequence[str], int]


class Chain:
    """``weight``: log-odds of label 1 by feature; ``moves``: scores of (kind of border, label before, label)."""

    def __init__(self, weight: dict[str, float], moves: np.ndarray):
        self.weight, self.moves = weight, moves

    def decode(self, odds: Sequence[float], kinds: Sequence[int]) -> list[int]:
        """The labels of the best path for the log-odds of each step; equal paths take label 0."""
        if not len(odds):
            return []
        m = self.moves.tolist()
        zero, one, back = 0.0, float(odds[0]), []
        for k in range(1, len(odds)):
            (a, b), (c, d) = m[kinds[k]]
            from_one, to_one = one + c > zero + a, one + d > zero + b
            back.append((from_one, to_one))
            zero, one = (one + c if from_one else zero + a), (one + d if to_one else zero + b) + odds[k]
        label = int(one > zero)
        path = [label]
        for step in reversed(back):
            label = int(step[label])
            path.append(label)
        return path[::-1]

    def odds(self, features: Sequence[str]) -> float:
        return sum(self.weight.get(f, 0.0) for f in features)


def fit(chains: Sequence[tuple[Sequence[Step], Sequence[int]]], rounds: int = 120, prior: float = 0.02, rate: float = 0.15) -> Chain:
    """Maximum likelihood with a Gaussian prior, by Adam on all chains at once.

    Chains are laid side by side, so the forward and backward sums are one array step for each position.
    """
    chains = sorted((c for c in chains if c[1]), key=lambda c: -len(c[1]))
    names = {f: i for i, f in enumerate(sorted({f for steps, _ in chains for fs, _ in steps for f in fs}))}
    if not chains:
        return Chain({}, np.zeros((2, 2, 2)))
    longest, n = len(chains[0][1]), len(chains)
    truth, kind, there = (np.zeros((longest, n), t) for t in (np.int64, np.int64, bool))
    cell, feature = [], []
    for c, (steps, labels) in enumerate(chains):
        for t, ((fs, k), y) in enumerate(zip(steps, labels, strict=True)):
            truth[t, c], kind[t, c], there[t, c] = y, k, True
            cell += [t * n + c] * len(fs)
            feature += [names[f] for f in fs]
    cell, feature = np.array(cell), np.array(feature)
    live = [int(x) for x in there.sum(1)]  # chains are sorted by length: the first ``live[t]`` reach step t
    before = np.where(there[1:], truth[:-1], 0)
    seen_moves = np.zeros((2, 2, 2))
    np.add.at(seen_moves, (kind[1:][there[1:]], before[there[1:]], truth[1:][there[1:]]), 1)
    seen = np.bincount(feature, weights=truth.reshape(-1)[cell], minlength=len(names))

    w, moves = np.zeros(len(names)), np.zeros((2, 2, 2))
    state = [np.zeros_like(x) for x in (w, w, moves, moves)]
    for r in range(1, rounds + 1):
        odds = np.bincount(cell, weights=w[feature], minlength=longest * n).reshape(longest, n)
        forward, backward = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
        forward[0, :, 1] = odds[0]
        for t in range(1, longest):
            u = live[t]
            forward[t, :u] = np.logaddexp.reduce(forward[t - 1, :u, :, None] + moves[kind[t, :u]], axis=1)
            forward[t, :u, 1] += odds[t, :u]
        for t in range(longest - 2, -1, -1):
            u = live[t + 1]
            ahead = backward[t + 1, :u].copy()
            ahead[:, 1] += odds[t + 1, :u]
            backward[t, :u] = np.logaddexp.reduce(moves[kind[t + 1, :u]] + ahead[:, None, :], axis=2)
        total = np.logaddexp.reduce(forward + backward, axis=2)
        share = np.where(there, np.exp(forward[:, :, 1] + backward[:, :, 1] - total), 0)
        slope = np.bincount(feature, weights=share.reshape(-1)[cell], minlength=len(names)) - seen + prior * w
        slope_moves = prior * moves - seen_moves
        for t in range(1, longest):
            u = live[t]
            ahead = backward[t, :u].copy()
            ahead[:, 1] += odds[t, :u]
            pair = np.exp(forward[t - 1, :u, :, None] + moves[kind[t, :u]] + ahead[:, None, :] - total[t, :u, None, None])
            for k in (0, 1):
                slope_moves[k] += pair[kind[t, :u] == k].sum(0)
        for x, g, first, second in ((w, slope, state[0], state[1]), (moves, slope_moves, state[2], state[3])):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            x -= rate * (first / (1 - 0.9 ** r)) / (np.sqrt(second / (1 - 0.99 ** r)) + 1e-8)
    return Chain({f: float(w[i]) for f, i in names.items()}, moves)
