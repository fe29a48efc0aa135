"""A bidirectional LSTM over a page's blocks, in numpy.

Every block becomes a vector of its element path, of its hashed words and of a
few measures; one LSTM reads the blocks of the page forwards, one backwards,
and a logistic unit over both states and the vector labels each block as main
text or not, so that every decision sees the whole page.
"""

from __future__ import annotations

import math
import zlib

import numpy as np

from slotwise.llm.html_blocks import Block, Element

PATH, NEAR, WORDS, MEASURES = 48, 40, 64, 12
NAMED = PATH + 2 * NEAR  #: the whole path, the innermost element, the one around it
WIDTH = NAMED + WORDS + MEASURES
STATES = 24  #: of each direction
CELLS = 32_768  #: blocks in one batch of pages
WORDS_HIDDEN, PATHS_HIDDEN = 0.3, 0.04  #: shares of blocks and of pages trained without these, so that none decides alone
SPAN = 8192  #: blocks of a longer page read at a time; the states go on


def _signed(word: str, size: int) -> np.ndarray:
    """A fixed vector of random signs for a word."""
    seed = zlib.crc32(word.encode("utf-8", "replace"))
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0], np.float32), size) / math.sqrt(size)


class Features:
    """Blocks to vectors; words and paths met before are kept, up to a bound."""

    def __init__(self, most: int = 100_000):
        self.most, self.names, self.buckets = most, {}, {}

    def _name(self, word: str, size: int) -> np.ndarray:
        key = (word, size)
        if key not in self.names:
            if len(self.names) > self.most:
                self.names.clear()
            self.names[key] = _signed(word, size)
        return self.names[key]

    def _named(self, e: Element, size: int) -> np.ndarray:
        words = sum((self._name("." + w, size) for w in e.words), np.zeros(size, np.float32))
        return self._name("<" + e.tag, size) + words / max(1.0, math.sqrt(len(e.words)))

    def path(self, e: Element) -> np.ndarray:
        """The sum over all elements on the path, outer ones fading, beside the innermost and the one around it."""
        todo = []
        while e.vector is None and e.parent is not None:
            todo.append(e)
            e = e.parent
        vector = e.vector if e.vector is not None else np.zeros(NAMED, np.float32)
        for e in reversed(todo):
            vector = e.vector = np.concatenate([self._named(e, PATH) + 0.8 * vector[:PATH], self._named(e, NEAR), vector[PATH : PATH + NEAR]])
        return vector

    def _bucket(self, word: str) -> int:
        found = self.buckets.get(word)
        if found is None:
            if len(self.buckets) > self.most:
                self.buckets.clear()
            found = self.buckets[word] = zlib.crc32(word.lower().strip(".,:;!?()\"'").encode("utf-8", "replace")) % (2 * WORDS)
        return found

    def of(self, blocks: list[Block], first: int, total: int) -> np.ndarray:
        """Vectors of blocks, the first of which is number ``first`` of its page's ``total``."""
        out = np.zeros((len(blocks), WIDTH), np.float32)
        for row, (n, b) in zip(out, enumerate(blocks, first), strict=True):
            row[: NAMED] = self.path(b.element)
            words = b.text.split()
            hits = np.bincount([self._bucket(w) for w in words], minlength=2 * WORDS)
            hits = hits[:WORDS] - hits[WORDS:]
            row[NAMED : -MEASURES] = 2 * hits / math.sqrt(max(1, hits @ hits))
            size = len(b.text)
            signs = sum(map(b.text.count, ".,;:!?"))
            row[-MEASURES:] = (
                1, math.log1p(len(words)) / 4, math.log1p(size) / 6, b.linked / size, min(1, signs / len(words)), b.text[-1] in ".!?…",
                len(words) < 4, min(3, size / len(words) / 6), b.text[0].isupper(), "©" in b.text or "|" in b.text,
                n / total, 1 / (1 + total - n))
        return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights(rng) -> dict[str, np.ndarray]:
    h = STATES
    draw = lambda *shape: rng.normal(0, 1 / math.sqrt(shape[-2]), shape).astype(np.float32)
    bias = np.zeros((2, 4 * h), np.float32)
    bias[:, h : 2 * h] = 1  # states are kept at first
    return {"x": draw(2, WIDTH, 4 * h), "h": draw(2, h, 4 * h), "b": bias, "out": draw(1, 2 * h, 1)[0, :, 0], "skip": np.zeros(WIDTH, np.float32), "bias": np.zeros(1, np.float32)}


def _steps(w, way, x, h, c, tape=None):
    """States after every step of x (steps, pages, WIDTH) in one direction, and the last h and c."""
    n = STATES
    drive = x @ w["x"][way] + w["b"][way]
    out = np.empty((*x.shape[:2], n), np.float32)
    for t in range(len(x)):
        z = drive[t] + h @ w["h"][way]
        gates, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        before = c
        c = f * before + i * g
        squashed = np.tanh(c)
        if tape is not None:
            tape.append((h, before, i, f, o, g, squashed))
        h = out[t] = o * squashed
    return out, h, c


def _back(w, way, x, tape, dout, grads):
    """Adds the gradients of one direction from those of its states."""
    n = STATES
    dz = np.empty((*x.shape[:2], 4 * n), np.float32)
    dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
    for t in reversed(range(len(x))):
        h, before, i, f, o, g, squashed = tape[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        grads["h"][way] += h.T @ dz[t]
        dh, dc = dz[t] @ w["h"][way].T, dc * f
    grads["x"][way] += np.tensordot(x, dz, ([0, 1], [0, 1]))
    grads["b"][way] += dz.sum((0, 1))


def _turned(x, sizes):
    """Every page's steps in reverse, padding left at the end."""
    out = x.copy()
    for p, n in enumerate(sizes):
        out[:n, p] = x[:n, p][::-1]
    return out


def _padded(pages: list[np.ndarray]):
    sizes = [len(p) for p in pages]
    x = np.zeros((max(sizes), len(pages), WIDTH), np.float32)
    for p, rows in enumerate(pages):
        x[: len(rows), p] = rows
    return x, sizes


def _start(n: int):
    return np.zeros((n, STATES), np.float32), np.zeros((n, STATES), np.float32)


def train(pages: list[np.ndarray], labels: list[np.ndarray], seed: int, epochs: int, batch: int = 48, rate: float = 0.01) -> dict:
    """Weights fitted to labelled pages by Adam on the blocks' log loss; each page counts alike."""
    rng = np.random.default_rng(seed)
    w = new_weights(rng)
    mean, var = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order = sorted(range(len(pages)), key=lambda p: len(pages[p]))
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    step, steps = 0, epochs * len(groups)
    for _ in range(epochs):
        for group in rng.permutation(len(groups)):
            x, sizes = _padded([pages[p] for p in groups[group]])
            x[:, :, NAMED : -MEASURES] *= rng.random((*x.shape[:2], 1)) >= WORDS_HIDDEN
            x[:, :, : NAMED] *= rng.random((1, len(sizes), 1)) >= PATHS_HIDDEN
            y, weight = np.zeros(x.shape[:2], np.float32), np.zeros(x.shape[:2], np.float32)
            for p, n in enumerate(sizes):
                y[:n, p], weight[:n, p] = labels[groups[group][p]], 1 / (n * len(sizes))
            turned = _turned(x, sizes)
            tapes: list[list] = [[], []]
            ahead, _, _ = _steps(w, 0, x, *_start(len(sizes)), tapes[0])
            back, _, _ = _steps(w, 1, turned, *_start(len(sizes)), tapes[1])
            states = np.concatenate([ahead, _turned(back, sizes)], axis=2)
            error = (_sigmoid(states @ w["out"] + x @ w["skip"] + w["bias"][0]) - y) * weight
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            grads["out"] += np.tensordot(error, states, ([0, 1], [0, 1]))
            grads["skip"] += np.tensordot(error, x, ([0, 1], [0, 1]))
            grads["bias"] += error.sum()
            dstates = error[:, :, None] * w["out"]
            _back(w, 0, x, tapes[0], dstates[:, :, :STATES], grads)
            _back(w, 1, turned, tapes[1], _turned(dstates[:, :, STATES:], sizes), grads)
            step += 1
            size = math.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            pace = rate * 0.5 * (1 + math.cos(math.pi * step / steps)) + 1e-4
            for k, g in grads.items():
                g *= min(1, 1 / (size + 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.99 * var[k] + 0.01 * g * g
                w[k] = w[k] - pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.99**step)) + 1e-7)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _long_page(w, features: Features, blocks: list[Block]) -> np.ndarray:
    """Scores of one page in spans of ``SPAN`` blocks; only the states are carried."""
    score = np.zeros(len(blocks), np.float32)
    spans = range(0, len(blocks), SPAN)
    for way, part in ((0, w["out"][:STATES]), (1, w["out"][STATES:])):
        h, c = _start(1)
        for lo in reversed(spans) if way else spans:
            x = features.of(blocks[lo : lo + SPAN], lo, len(blocks))
            if not way:
                score[lo : lo + SPAN] += x @ w["skip"] + w["bias"][0]
            run = x[::-1] if way else x
            states, h, c = _steps(w, way, run[:, None], h, c)
            score[lo : lo + SPAN] += (states[::-1] if way else states)[:, 0] @ part
    return _sigmoid(score)


def label(w: dict, features: Features, pages: list[list[Block]]) -> list[np.ndarray]:
    """Per page the blocks' probabilities of being main text."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((p for p in range(len(pages)) if pages[p]), key=lambda p: len(pages[p]))
    while order:
        if len(pages[order[-1]]) > SPAN:
            p = order.pop()
            out[p] = _long_page(w, features, pages[p])
            continue
        most = max(1, CELLS // len(pages[order[-1]]))
        group, order = order[-most:], order[:-most]
        x, sizes = _padded([features.of(pages[p], 0, len(pages[p])) for p in group])
        ahead, _, _ = _steps(w, 0, x, *_start(len(group)))
        back, _, _ = _steps(w, 1, _turned(x, sizes), *_start(len(group)))
        scores = _sigmoid(ahead @ w["out"][:STATES] + _turned(back, sizes) @ w["out"][STATES:] + x @ w["skip"] + w["bias"][0])
        for i, p in enumerate(group):
            out[p] = scores[: sizes[i], i]
    return out
