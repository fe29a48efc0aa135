"""Configuration linear program over a length histogram.

A configuration is a multiset of lengths that fits one sequence; the program
minimises how many configurations cover the histogram. Multiplicative weights
solve it approximately: every length has a weight, the dearest configuration
under the weights per piece is found by an unbounded-knapsack dynamic program,
is taken in a step that uses up at most a share ``step`` of any of its
lengths, and the lengths it served lose weight. The amounts, scaled to serve
no length more than fully, are rounded down, and what remains is packed best
fit, by length classes. All of this sees only the histogram, which has at most
``capacity`` entries however many pieces there are.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np


def dearest(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of highest price; ``prices[l]`` for lengths 1..capacity, -inf where absent."""
    value = np.zeros(capacity + 1)
    back = np.zeros(capacity + 1)  # value, reversed: a window of it lines up with the prices
    choice = np.zeros(capacity + 1, dtype=np.int64)
    for w in range(1, capacity + 1):
        got = prices[1 : w + 1] + back[capacity - w + 1 :]
        l = int(got.argmax())
        if got[l] > value[w - 1]:
            value[w], choice[w] = got[l], l + 1
        else:
            value[w] = value[w - 1]
        back[capacity - w] = value[w]
    out: Counter[int] = Counter()
    w = capacity
    while w > 0:
        if choice[w]:
            out[int(choice[w])] += 1
            w -= int(choice[w])
        else:
            w -= 1
    return dict(out)


def fractional(hist: dict[int, int], capacity: int, rounds: int, step: float, rate: float) -> list[tuple[dict[int, int], float]]:
    """Configurations and amounts that serve no length more than fully."""
    lengths = np.array(sorted(hist))
    count = np.array([hist[l] for l in lengths], dtype=float)
    place = {int(l): i for i, l in enumerate(lengths)}
    weight = lengths * count  # prices start as the lengths themselves
    served = np.zeros(len(lengths))
    amounts: dict[tuple, float] = {}
    for _ in range(rounds):
        prices = np.full(capacity + 1, -np.inf)
        prices[lengths] = weight / count
        config = dearest(prices, capacity)
        at = np.array([place[l] for l in config])
        copies = np.array(list(config.values()), dtype=float)
        amount = step * float((count[at] / copies).min())
        served[at] += amount * copies
        weight[at] *= np.exp(-rate * amount * copies / count[at] / step)
        key = tuple(sorted(config.items()))
        amounts[key] = amounts.get(key, 0.0) + amount
    scale = max(1.0, float((served / count).max(initial=0.0)))
    return [(dict(k), x / scale) for k, x in amounts.items()]


def best_fit(left: Counter, capacity: int) -> Counter:
    """Best-fit decreasing of a histogram, by classes of equal bins: configuration -> bins."""
    bins: dict[int, Counter] = {}  # room left -> configurations -> number of bins
    rooms: list[int] = []

    def put(room: int, config: tuple, n: int) -> None:
        if room not in bins:
            bins[room] = Counter()
            insort(rooms, room)
        bins[room][config] += n

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = min(capacity // length, todo)
                n = todo // each
                put(capacity - each * length, ((length, each),), n)
                todo -= n * each
                continue
            room = rooms[i]
            config, there = next(iter(bins[room].items()))
            n = min(there, todo)
            if there == n:
                del bins[room][config]
                if not bins[room]:
                    del bins[room]
                    rooms.pop(i)
            else:
                bins[room][config] -= n
            merged = Counter(dict(config))
            merged[length] += 1
            put(room - length, tuple(sorted(merged.items())), n)
            todo -= n
    out: Counter = Counter()
    for configs in bins.values():
        out.update(configs)
    return out


def plan(hist: dict[int, int], capacity: int, rounds: int = 400, step: float = 0.34, rate: float = 0.5) -> Counter:
    """Configurations (sorted (length, copies) pairs) -> sequences; serves the histogram exactly."""
    left = Counter({l: n for l, n in hist.items() if n > 0})
    out: Counter = Counter()
    if left[capacity]:  # full sequences need no partners
        out[((capacity, 1),)] = left.pop(capacity)
    left = +left
    if left and rounds:
        for config, amount in fractional(dict(left), capacity, rounds, step, rate):
            n = min([int(amount + 1e-9)] + [left[l] // c for l, c in config.items()])
            if n:
                out[tuple(sorted(config.items()))] += n
                for l, c in config.items():
                    left[l] -= n * c
    out.update(best_fit(+left, capacity))
    return out
