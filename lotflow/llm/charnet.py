"""A small convolutional network over characters, in numpy.

Characters are embedded, convolved over five places, cut at zero and pooled to
their maximum before, within and after the candidate; a hidden layer and a
logistic output follow.
"""

from __future__ import annotations

import numpy as np

BEFORE, INSIDE, AFTER = 32, 48, 16
WIDTH = BEFORE + INSIDE + AFTER
ALPHABET, EMBED, KERNEL, FILTERS, HIDDEN = 98, 8, 5, 24, 24
_REGIONS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, WIDTH))


def windows(text: str, start: int, end: int) -> list[str]:
    """The candidate in pieces of INSIDE characters, each with what stands before and after the whole candidate."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    after = text[end : end + AFTER].ljust(AFTER, "\0")
    return [before + text[i : min(i + INSIDE, end)].ljust(INSIDE, "\0") + after for i in range(start, end, INSIDE)]


def codes(values: list[str]) -> np.ndarray:
    """Windows as symbol numbers: 0 for nothing, printable ASCII, one for white space, one for all else."""
    points = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WIDTH)
    out = np.where((points >= 33) & (points < 127), points - 32, np.where((points == 32) | ((points >= 9) & (points < 14)), 96, 97))
    return np.where(points == 0, 0, out).astype(np.int16)


def start_weights(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(seed)).standard_normal
    wide, pooled = KERNEL * EMBED, 3 * FILTERS
    return {
        "embed": draw((ALPHABET, EMBED)) * 0.5,
        "conv": draw((wide, FILTERS)) * (2 / wide) ** 0.5,
        "conv_b": np.zeros(FILTERS),
        "hidden": draw((pooled, HIDDEN)) * (2 / pooled) ** 0.5,
        "hidden_b": np.zeros(HIDDEN),
        "out": draw((HIDDEN, 1)) * (1 / HIDDEN) ** 0.5,
        "out_b": np.zeros(1),
    }


def _forward(w: dict, x: np.ndarray) -> dict:
    embedded = w["embed"][x]
    padded = np.pad(embedded, ((0, 0), (KERNEL // 2, KERNEL // 2), (0, 0)))
    columns = np.concatenate([padded[:, k : k + WIDTH] for k in range(KERNEL)], axis=2)
    maps = np.maximum(columns @ w["conv"] + w["conv_b"], 0)
    at = np.stack([maps[:, a:b].argmax(axis=1) + a for a, b in _REGIONS], axis=1)
    pooled = np.take_along_axis(maps, at, axis=1).reshape(len(x), -1)
    hidden = np.maximum(pooled @ w["hidden"] + w["hidden_b"], 0)
    return {"columns": columns, "at": at, "pooled": pooled, "hidden": hidden, "logit": (hidden @ w["out"] + w["out_b"])[:, 0]}


def logits(w: dict, x: np.ndarray, step: int = 512) -> np.ndarray:
    return np.concatenate([_forward(w, x[i : i + step])["logit"] for i in range(0, len(x), step)]) if len(x) else np.zeros(0)


def _gradients(w: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    f = _forward(w, x)
    n = len(x)
    error = ((1 / (1 + np.exp(-f["logit"])) - y) * weight / n)[:, None]
    g = {"out": f["hidden"].T @ error, "out_b": error.sum(0)}
    back = (error @ w["out"].T) * (f["hidden"] > 0)
    g |= {"hidden": f["pooled"].T @ back, "hidden_b": back.sum(0)}
    pooled = ((back @ w["hidden"].T) * (f["pooled"] > 0)).reshape(n, 3, FILTERS)
    # Only the place of each maximum passes the error on.
    rows = np.arange(n)[:, None, None]
    picked = f["columns"][rows, f["at"]]
    g |= {"conv": np.einsum("nrfk,nrf->kf", picked, pooled), "conv_b": pooled.sum((0, 1))}
    wide = np.einsum("nrf,kf->nrfk", pooled, w["conv"]).reshape(n, 3, FILTERS, KERNEL, EMBED)
    places = f["at"][..., None] + np.arange(KERNEL) - KERNEL // 2
    inside = (places >= 0) & (places < WIDTH)
    symbols = np.where(inside, x[rows[..., None], np.clip(places, 0, WIDTH - 1)], 0)
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"], symbols, wide * inside[..., None])
    return g


def start_state(seed: int = 5) -> list[dict]:
    """Weights and the two moments of Adam."""
    w = start_weights(seed)
    return [w, {k: 0 * v for k, v in w.items()}, {k: 0 * v for k, v in w.items()}]


def flat(state: list[dict]) -> np.ndarray:
    return np.concatenate([v.ravel() for part in state for v in part.values()])


def shaped(values: np.ndarray) -> list[dict]:
    """The state that ``flat`` made one row of numbers."""
    state, at = start_state(), 0
    for part in state:
        for k, v in part.items():
            part[k] = values[at : at + v.size].reshape(v.shape)
            at += v.size
    return state


def epoch(state: list[dict], x: np.ndarray, y: np.ndarray, share: float, turn: int, batch: int = 128, rate: float = 0.004, seed: int = 6) -> list[dict]:
    """The state after one pass of Adam over the rows; ``share`` of all rows are findings, and both classes weigh the same in sum."""
    w, first, second = ({k: v.copy() for k, v in part.items()} for part in state)
    weight = np.where(y > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    shuffled = np.random.Generator(np.random.PCG64([seed, turn])).permutation(len(x))
    t = turn * -(-len(x) // batch)
    for i in range(0, len(x), batch):
        pick, t = shuffled[i : i + batch], t + 1
        for k, g in _gradients(w, x[pick], y[pick], weight[pick]).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return [w, first, second]


def calibrate(scores: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and shift of the logistic curve that turns logits into probabilities; ``n`` rows have a score and label."""
    a, b = 1.0, 0.0
    # Targets kept off 0 and 1, as few findings do not prove certainty.
    positive, negative = n[y > 0].sum(), n[y <= 0].sum()
    goal = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
        slope = (p * (1 - p) + 1e-6) * n
        gradient = np.array([((p - goal) * n * scores).sum(), ((p - goal) * n).sum()])
        hessian = np.array([[(slope * scores**2).sum() + 1e-3, (slope * scores).sum()], [(slope * scores).sum(), slope.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-7:
            break
    return float(a), float(b)
