"""A semi-Markov conditional random field over token segments, in numpy.

A segment of type 0 is one token outside any entity; entities have up to LONGEST
tokens. A labelling's score is the sum of its segments' feature weights and of
the weights between neighbouring types. Training maximises the likelihood by the
exact forward-backward recursion; decoding is the Viterbi recursion.
"""

from __future__ import annotations

import re

import numpy as np

LONGEST, TYPES = 15, 5
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_CLASS = {"@": 5, ".": 6, "-": 7, "+": 8, "(": 9, ")": 10, "[": 9, "]": 10}
#: Values of each feature.
SIZES = (24, 24, 16, 12, 64, 16, 12 * 12, 12, 12, 512, 512, 8, 4, 16, 24 * 16, 8, 16 * 12)
OFFSETS = np.cumsum((0, *SIZES[:-1]))
WEIGHTS = sum(SIZES)


def _word_hash(word: str) -> int:
    h = 0
    for c in word.lower()[:24]:
        h = (h * 131 + ord(c)) % 511
    return h + 1


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def segments(text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First tokens, end tokens and feature numbers of all segments that may occur.

    Segments of two or more tokens hold a digit or an @ and no line end, and
    neither begin nor end with a sign other than + and brackets.
    """
    n = len(spans)
    words = [text[a:b] for a, b in spans]
    kind = np.array([1 if w[0].isdigit() else _CLASS.get(w, 11) if not (w[0].isalpha()) else (2 if w.islower() else 3 if w.istitle() else 4) for w in words])
    gap = np.array([spans[i][0] - spans[i - 1][1] if i else 1 for i in range(n)] + [1])
    digits = np.array([b - a if k == 1 else 0 for (a, b), k in zip(spans, kind)])
    letters = np.array([b - a if 2 <= k <= 4 else 0 for (a, b), k in zip(spans, kind)])
    newline = np.array([0] + [int("\n" in text[spans[i - 1][1] : spans[i][0]]) for i in range(1, n)])
    small = np.array([int(k == 1 and b - a <= 3 and int(w) <= 255) if w.isascii() else 0 for (a, b), k, w in zip(spans, kind, words)])
    hashes = np.array([0] + [_word_hash(w) for w in words] + [0])
    sums = {name: np.r_[0, np.cumsum(v)] for name, v in {"digits": digits, "letters": letters, "at": kind == 5, "dot": kind == 6, "dash": kind == 7, "bracket": (kind == 9) | (kind == 10), "gap": gap[:-1] > 0, "line": newline, "number": kind == 1, "small": small, "other": kind == 11}.items()}
    first = np.repeat(np.arange(n), LONGEST)
    end = first + np.tile(np.arange(1, LONGEST + 1), n)
    keep = end <= n
    first, end = first[keep], end[keep]
    of = lambda name, a=first, b=end: sums[name][b] - sums[name][a]
    edge_ok = (kind[first] <= 4) | (kind[first] == 8) | (kind[first] == 9)
    last_ok = (kind[end - 1] <= 4) | (kind[end - 1] == 10)
    inner_lines = sums["line"][end] - sums["line"][first + 1]
    keep = (end == first + 1) | (edge_ok & last_ok & (inner_lines == 0) & (of("digits") + of("at") > 0))
    first, end = first[keep], end[keep]
    digit, number, small_n, gaps = of("digits", first, end), of("number", first, end), of("small", first, end), sums["gap"][end] - sums["gap"][first + 1]
    padded = np.r_[0, kind, 0]
    valid = np.zeros(len(first), np.int64)
    for i in np.flatnonzero((digit >= 13) & (digit <= 19)):
        joined = "".join(w for w in words[first[i] : end[i]] if w.isdigit() and w.isascii())
        valid[i] = 1 + int(len(joined) > 12 and luhn(joined))
    length = end - first
    clean = (gap[first] > 0) * 1 + (gap[end] > 0) * 2
    dots, dashes = of("dot", first, end), of("dash", first, end)
    columns = [
        np.minimum(digit, 23), np.minimum(of("letters", first, end), 23), length,
        np.minimum(of("at", first, end), 2) * 4 + (dots > 0) * 2 + (of("letters", first, end) > 0),
        np.minimum(dots, 7) * 8 + np.minimum(number, 7),
        np.minimum(dashes, 3) * 4 + np.minimum(of("bracket", first, end), 3),
        kind[first] * 12 + kind[end - 1], padded[first], padded[end + 1], hashes[first], hashes[end + 1],
        (small_n == number) * 4 + (number == 4) * 2 + (dots == 3), valid, np.minimum(gaps, 15),
        np.minimum(digit, 23) * 16 + length, clean * 2 + (of("other", first, end) > 0), length * 12 + kind[first],
    ]
    return first, end, np.stack(columns, axis=1) + OFFSETS


def _best(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Lattice:
    """Scores of all segments of one token run under a model, and its recursions."""

    def __init__(self, model: dict, n: int, first: np.ndarray, end: np.ndarray, features: np.ndarray):
        self.n, self.first, self.end, self.between = n, first, end, model["between"]
        self.scores = model["weights"][features].sum(axis=1)
        self.scores[end - first > 1, 0] = -1e9
        self.by_end = np.argsort(end, kind="stable")
        self.end_at = np.searchsorted(end[self.by_end], np.arange(n + 2))
        self.first_at = np.searchsorted(first, np.arange(n + 2))

    def forward(self) -> np.ndarray:
        alpha = np.full((self.n + 1, TYPES), -1e9)
        alpha[0, 0] = 0.0
        into = np.empty((self.n + 1, TYPES))
        into[0] = _best(alpha[0][:, None] + self.between, 0)
        for j in range(1, self.n + 1):
            s = self.by_end[self.end_at[j] : self.end_at[j + 1]]
            alpha[j] = _best(into[self.first[s]] + self.scores[s], 0)
            into[j] = _best(alpha[j][:, None] + self.between, 0)
        self.into = into
        return alpha

    def backward(self) -> np.ndarray:
        beta = np.zeros((self.n + 1, TYPES))
        for i in range(self.n - 1, -1, -1):
            s = slice(self.first_at[i], self.first_at[i + 1])
            beta[i] = _best(self.between + _best(self.scores[s] + beta[self.end[s]], 0), 1)
        return beta

    def marginals(self) -> np.ndarray:
        """Probability of every segment and type."""
        alpha, beta = self.forward(), self.backward()
        return np.exp(np.minimum(self.into[self.first] + self.scores + beta[self.end] - _best(alpha[self.n], 0), 0.0))

    def decode(self) -> list[tuple[int, int]]:
        """The best labelling as segment numbers and types, entities only."""
        best = np.full((self.n + 1, TYPES), -1e18)
        best[0, 0] = 0.0
        from_seg = np.zeros((self.n + 1, TYPES), np.int64)
        into, from_type = np.empty((self.n + 1, TYPES)), np.zeros((self.n + 1, TYPES), np.int64)
        for j in range(self.n + 1):
            if j:
                s = self.by_end[self.end_at[j] : self.end_at[j + 1]]
                value = into[self.first[s]] + self.scores[s]
                pick = value.argmax(axis=0)
                best[j], from_seg[j] = value[pick, np.arange(TYPES)], s[pick]
            step = best[j][:, None] + self.between
            from_type[j] = step.argmax(axis=0)
            into[j] = step.max(axis=0)
        out, j, y = [], self.n, int(best[self.n].argmax())
        while j:
            s = int(from_seg[j, y])
            if y:
                out.append((s, y))
            j, y = int(self.first[s]), int(from_type[self.first[s], y])
        return out[::-1]


def train(examples: list[tuple], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4, seed: int = 4) -> dict:
    """Weights by Adagrad on the log-likelihood. An example: token count, first, end, features and the true (segment, type) pairs."""
    model = {"weights": np.zeros((WEIGHTS, TYPES)), "between": np.zeros((TYPES, TYPES))}
    squares = {k: np.full(v.shape, 1e-2) for k, v in model.items()}
    order = np.random.Generator(np.random.PCG64(seed))
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            n, first, end, features, truth = examples[k]
            lattice = Lattice(model, n, first, end, features)
            expected = lattice.marginals()
            gold = np.zeros_like(expected)
            previous, moves = 0, np.zeros((TYPES, TYPES))
            for s, y in truth:
                gold[s, y] = 1.0
                moves[previous, y] += 1
                previous = y
            beta, alpha = lattice.backward(), lattice.forward()
            total = _best(alpha[n], 0)
            for i in range(n):
                s = slice(lattice.first_at[i], lattice.first_at[i + 1])
                onward = _best(lattice.scores[s] + beta[lattice.end[s]], 0)
                moves -= np.exp(np.minimum(alpha[i][:, None] + model["between"] + onward - total, 0.0))
            step = gold - expected
            touched = np.unique(features)
            gradient = np.zeros((len(touched), TYPES))
            np.add.at(gradient, np.searchsorted(touched, features).ravel(), np.repeat(step, features.shape[1], axis=0))
            gradient -= decay * model["weights"][touched]
            squares["weights"][touched] += gradient**2
            model["weights"][touched] += rate * gradient / np.sqrt(squares["weights"][touched])
            squares["between"] += moves**2
            model["between"] += rate * moves / np.sqrt(squares["between"])
    return model
