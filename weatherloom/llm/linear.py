"""Logistic regression on sparse rows, for bounded training samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_logistic(index: np.ndarray, value: np.ndarray, row: np.ndarray, label: np.ndarray, size: int, rounds: int = 60, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, bias) by full-batch Adam; classes weigh the same. ``row`` is the row of each entry."""
    weights, bias = np.zeros(size), 0.0
    moment, square = np.zeros(size + 1), np.zeros(size + 1)
    share = np.where(label > 0, 0.5 / max((label > 0).sum(), 1), 0.5 / max((label <= 0).sum(), 1))
    for step in range(1, rounds + 1):
        score = bias + np.bincount(row, value * weights[index], len(label))
        error = (sigmoid(score) - (label > 0)) * share
        slope = np.append(np.bincount(index, value * error[row], size) + decay * weights, error.sum())
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, bias


def fit_platt(score: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is a probability; targets are smoothed, so separable rows stay finite."""
    positive, negative = (label > 0).sum(), (label <= 0).sum()
    target = np.where(label > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    design = np.stack([score, np.ones_like(score)], axis=1)
    for _ in range(rounds):
        p = sigmoid(design @ [a, b])
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, design.T @ (p - target))
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(a), float(b)
