"""Best label path with one penalty for every switch, over many texts at once."""

from __future__ import annotations

import numpy as np

CHUNK = 64


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The label of each word: most score, less ``penalty`` per switch inside a text.

    ``scores`` is words by labels, all texts one after another; ``first`` marks each
    text's first word, where a switch is free.  Chunks run side by side for every
    label they may start from; one pass over the chunks then picks those labels.
    """
    n, labels = scores.shape
    if n == 0:
        return np.empty(0, np.int64)
    chunks = -(-n // CHUNK)
    s = np.zeros((chunks * CHUNK, labels))
    s[:n] = scores
    s = s.reshape(chunks, CHUNK, labels)
    cost = np.full(chunks * CHUNK, penalty)
    cost[:n][first] = 0
    cost = cost.reshape(chunks, CHUNK)

    gain = np.broadcast_to(np.where(np.eye(labels, dtype=bool), 0.0, -np.inf), (chunks, labels, labels))
    for t in range(CHUNK):
        switch = gain.max(axis=2) - cost[:, t, None]
        gain = np.maximum(gain, switch[:, :, None]) + s[:, t, None, :]
    total, came = np.zeros(labels), np.empty((chunks, labels), np.int64)
    for k in range(chunks):
        through = total[:, None] + gain[k]
        came[k] = through.argmax(axis=0)
        total = through.max(axis=0)
        total -= total.max()
    starts, ends = np.empty(chunks, np.int64), np.empty(chunks, np.int64)
    label = int(total.argmax())
    for k in range(chunks - 1, -1, -1):
        ends[k] = label
        label = starts[k] = came[k, label]

    every, own = np.arange(chunks), np.arange(labels)
    total = np.where(own == starts[:, None], 0.0, -np.inf)
    back = np.empty((CHUNK, chunks, labels), np.int16)
    for t in range(CHUNK):
        best = total.argmax(axis=1)
        switch = total[every, best] - cost[:, t]
        back[t] = np.where(total >= switch[:, None], own, best[:, None])
        total = np.maximum(total, switch[:, None]) + s[:, t]
    path = np.empty((chunks, CHUNK), np.int64)
    label = ends
    for t in range(CHUNK - 1, -1, -1):
        path[:, t] = label
        label = back[t][every, label]
    return path.reshape(-1)[:n]
