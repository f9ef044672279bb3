"""Front coding of sorted strings, and merging of front-coded runs by a loser tree that knows prefixes."""

from __future__ import annotations

import numpy as np


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row of a byte matrix shares with the row before; 0 for the first."""
    n, width = rows.shape
    out = np.zeros(n, np.uint8)
    step = 1 << 16
    for i in range(1, n, step):
        last = min(n, i + step)
        other = rows[i:last] != rows[i - 1 : last - 1]
        out[i:last] = np.where(other.any(1), other.argmax(1), width)
    return out


def front_code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared prefix lengths of sorted rows, and the bytes after them, one row after the other."""
    shared = common_prefixes(rows)
    return shared, rows[np.arange(rows.shape[1]) >= shared[:, None]]


def front_decode(shared: np.ndarray, tails: np.ndarray, width: int) -> np.ndarray:
    """The rows that ``front_code`` was given."""
    n = len(shared)
    rows = np.zeros((n, width), np.uint8)
    columns = np.arange(width)
    own = columns >= shared[:, None]
    rows[own] = tails
    number = np.arange(n)
    for c in range(width):
        source = np.maximum.accumulate(np.where(own[:, c], number, 0))
        rows[:, c] = rows[source, c]
    return rows


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs of equally wide rows, each with its shared prefix lengths.

    Returns the order, as numbers of the rows with the runs laid end to end, and the length of the
    prefix that each row shares with the one put out before. Every candidate and every stored loser
    keeps its shared length with the last winner that passed: the longer one wins unseen, and only
    equal lengths are compared, from there on.
    """
    runs_in = [r for r in runs if len(r[0])]
    total = sum(len(r[0]) for r in runs_in)
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    width = runs_in[0][0].shape[1]
    k = 1
    while k < len(runs_in):
        k *= 2
    keys: list[list[int]] = []
    shares: list[list[int]] = []
    bases, base = [], 0
    last = 1 << (8 * width + 1)  # above every row
    offsets = {id(r[0]): o for r, o in zip(runs, np.cumsum([0] + [len(r[0]) for r in runs])[:-1].tolist())}
    for rows, shared in runs_in:
        flat = rows.tobytes()
        keys.append([int.from_bytes(flat[i : i + width], "big") for i in range(0, len(flat), width)] + [last])
        shares.append([*shared.tolist(), -1])
        bases.append(offsets[id(rows)])
        base += len(rows)
    for _ in range(k - len(runs_in)):
        keys.append([last])
        shares.append([-1])
        bases.append(0)

    at = [0] * k
    loser, lost_at = [0] * k, [0] * k  # by tree node: the run that lost there and its shared length

    def build(node: int) -> tuple[int, int]:
        if node >= k:
            run = node - k
            return run, (0 if keys[run][0] != last else -1)
        a, ha = build(2 * node)
        b, hb = build(2 * node + 1)
        if ha == hb:
            x, y = keys[a][0], keys[b][0]
            h = ha if ha < 0 else width - ((x ^ y).bit_length() + 7) // 8
            if y < x:
                a, b = b, a
            hb = h
        elif ha < hb:
            a, ha, b, hb = b, hb, a, ha
        loser[node], lost_at[node] = b, hb
        return a, ha

    winner, h = build(1) if k > 1 else (0, 0)
    order, shared_out = np.empty(total, np.int64), np.empty(total, np.uint8)
    for out in range(total):
        position = at[winner]
        order[out] = bases[winner] + position
        shared_out[out] = h
        position += 1
        at[winner] = position
        h = shares[winner][position]
        node = (winner + k) >> 1
        while node:
            other = lost_at[node]
            if other > h:
                winner, loser[node] = loser[node], winner
                lost_at[node], h = h, other
            elif other == h and h >= 0:
                rival = loser[node]
                x, y = keys[winner][at[winner]], keys[rival][at[rival]]
                lost_at[node] = width - ((x ^ y).bit_length() + 7) // 8
                if y < x:
                    loser[node] = winner
                    winner = rival
            node >>= 1
    shared_out[0] = 0
    return order, shared_out
