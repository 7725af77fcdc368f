"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word is the sum of two inputs: a vector of its own, if it is in the vocabulary of the
training words, and what a bidirectional recurrent layer reads from its characters. A second
such layer reads a window of words; attention pools its states into one logit. Windows overlap:
one starts at every word. Neighbouring windows read the same projected words, so a step of all
of them at once is a slice of the text.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np

WINDOW = 8
PIECE_CHARS = 16
CHARS, CHAR_DIM, CHAR_UNITS = 256, 8, 8
WORD_DIM, WORD_UNITS = 8, 8
VOCABULARY = 4000

# Rows that go through a layer at a time, and windows of a text.
ROWS = 2048
STARTS = 8192

PIECES = re.compile(rf"\S{{1,{PIECE_CHARS}}}").findall
MARKS = ".,;:!?\"'()[]{}<>«»“”„…-*_"


def words_of(text: str | None) -> list[str]:
    """Lower-cased words between white space; a longer one gives several pieces."""
    return PIECES((text or "").lower())


def bare(word: str) -> str:
    return word.strip(MARKS) or word


def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def start_weights(vocabulary: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def some(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    inputs = WORD_DIM + 2 * CHAR_UNITS
    weights = {"chars": some(CHARS, CHAR_DIM) * 3, "words": some(vocabulary + 1, WORD_DIM) * 3, "see": some(2 * WORD_UNITS), "out": some(2 * WORD_UNITS), "bias": np.zeros(1, np.float32)}
    for name, dim, units in (("cf", CHAR_DIM, CHAR_UNITS), ("cb", CHAR_DIM, CHAR_UNITS), ("wf", inputs, WORD_UNITS), ("wb", inputs, WORD_UNITS)):
        weights |= {f"{name}W": some(dim, 3 * units), f"{name}U": some(units, 3 * units), f"{name}b": np.zeros(3 * units, np.float32)}
    return weights


def gru_states(x: np.ndarray, mask: np.ndarray, U: np.ndarray) -> np.ndarray:
    """The states of :func:`gru`, with nothing kept for a backward pass.

    Inside, units come before rows, so that every gate is one contiguous block.
    """
    units = U.shape[0]
    turned = np.ascontiguousarray(U.T)
    states = np.empty((len(x), units, x.shape[1]), np.float32)
    h = np.zeros((units, x.shape[1]), np.float32)
    for t in range(len(x)):
        now, below = np.ascontiguousarray(x[t].T), turned @ h
        gates, new = now[: 2 * units], now[2 * units :]
        gates += below[: 2 * units]
        gates *= 0.5
        np.tanh(gates, out=gates)
        z, r, below = gates[:units], gates[units:], below[2 * units :]
        r += 1
        below *= r
        below *= 0.5
        new += below
        np.tanh(new, out=new)
        new -= h
        z -= 1
        z *= -0.5
        new *= z
        if not mask[t].all():
            new *= mask[t]
        h = np.add(h, new, out=states[t])
    return states.transpose(0, 2, 1)


def gru(x: np.ndarray, mask: np.ndarray, U: np.ndarray) -> tuple[np.ndarray, list]:
    """States of a gated recurrent layer for inputs (time, rows, 3 units) already projected."""
    units = U.shape[0]
    h = np.zeros((x.shape[1], units), np.float32)
    states, kept = np.empty((*x.shape[:2], units), np.float32), []
    for t in range(len(x)):
        gates = sigmoid(x[t, :, : 2 * units] + h @ U[:, : 2 * units])
        z, r = gates[:, :units], gates[:, units:]
        below = h @ U[:, 2 * units :]
        new = np.tanh(x[t, :, 2 * units :] + r * below)
        m = mask[t][:, None]
        kept.append((h, z, r, below, new, m))
        h = h + m * (1 - z) * (new - h)
        states[t] = h
    return states, kept


def gru_back(d: np.ndarray, kept: list, U: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``U``, from those of the states."""
    units = U.shape[0]
    dU, dx = np.zeros_like(U), np.empty((*d.shape[:2], 3 * units), np.float32)
    carry = np.zeros_like(d[0])
    for t in range(len(d) - 1, -1, -1):
        h, z, r, below, new, m = kept[t]
        g = d[t] + carry
        step = g * m
        dnew = step * (1 - z) * (1 - new * new)
        dz = step * (h - new) * z * (1 - z)
        dr = dnew * below * r * (1 - r)
        dbelow = dnew * r
        gates = np.concatenate([dz, dr], axis=1)
        dx[t, :, : 2 * units], dx[t, :, 2 * units :] = gates, dnew
        dU[:, : 2 * units] += h.T @ gates
        dU[:, 2 * units :] += h.T @ dbelow
        carry = g - step * (1 - z) + gates @ U[:, : 2 * units].T + dbelow @ U[:, 2 * units :].T
    return dx, dU


class Network:
    """The network and its vocabulary; forward passes over words and windows."""

    def __init__(self, weights: dict[str, np.ndarray], vocabulary: dict[str, int]):
        self.w, self.vocabulary = weights, vocabulary

    def spell(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Character numbers (time, rows), their mask, and vocabulary numbers of words."""
        words = [bare(w) for w in words]
        n = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        flat = np.where(flat < CHARS, flat, flat * 2654435761 % (CHARS - 32) + 32)
        longest = int(n.max(initial=1))
        chars = np.zeros((longest, len(words)), np.int64)
        row = np.repeat(np.arange(len(words)), n)
        chars[np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n), row] = flat
        mask = (np.arange(longest)[:, None] < n[None, :]).astype(np.float32)
        return chars, mask, np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))

    def word_inputs(self, words: list[str], kept: list | None = None) -> np.ndarray:
        chars, mask, number = self.spell(words)
        w = self.w
        ahead, back = (w["chars"] @ w["cfW"] + w["cfb"])[chars], (w["chars"] @ w["cbW"] + w["cbb"])[chars[::-1]]
        if kept is None:
            forward, backward = gru_states(ahead, mask, w["cfU"]), gru_states(back, mask[::-1], w["cbU"])
        else:
            forward, a = gru(ahead, mask, w["cfU"])
            backward, b = gru(back, mask[::-1], w["cbU"])
            kept.append((chars, number, a, b))
        return np.concatenate([w["words"][number], forward[-1], backward[-1]], axis=1)

    def projected(self, words: list[str]) -> np.ndarray:
        """What both directions of the word layer take from each word; words of like length together."""
        w = self.w
        W, b = np.concatenate([w["wfW"], w["wbW"]], axis=1), np.concatenate([w["wfb"], w["wbb"]])
        out = np.empty((len(words), len(b)), np.float32)
        order = np.argsort([len(x) for x in words], kind="stable")
        for i in range(0, len(words), ROWS):
            some = order[i : i + ROWS]
            out[some] = self.word_inputs([words[j] for j in some.tolist()]) @ W + b
        return out

    def logits(self, table: np.ndarray, windows: np.ndarray, mask: np.ndarray, kept: list | None = None) -> np.ndarray:
        """A logit per window; ``windows`` (rows, time) holds places in ``table`` of projections."""
        w, half = self.w, 3 * WORD_UNITS
        index, m = windows.T, mask.T
        both = table[index]
        ahead, back = both[:, :, :half], both[::-1, :, half:]
        if kept is None:
            forward, backward = gru_states(ahead, m, w["wfU"]), gru_states(back, m[::-1], w["wbU"])
        else:
            forward, a = gru(ahead, m, w["wfU"])
            backward, b = gru(back, m[::-1], w["wbU"])
        states = np.concatenate([forward, backward[::-1]], axis=2)
        seen = states @ w["see"] - (1 - m) * 1e4
        share = np.exp(seen - seen.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", share, states)
        if kept is not None:
            kept.append((states, share, pooled, a, b, index))
        return pooled @ w["out"] + w["bias"][0]

    def sliding_logits(self, table: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """A logit for the window that starts at each place of ``flat`` and lies whole in it.

        The logit is the mean of ``out . state``, weighted by the softmax of ``see . state``, so
        only these two products of each state are kept.
        """
        w, half, units = self.w, 3 * WORD_UNITS, WORD_UNITS
        found = np.empty(max(0, len(flat) - WINDOW + 1), np.float32)
        for first in range(0, len(found), STARTS):
            m = min(STARTS, len(found) - first)
            inputs = np.ascontiguousarray(table[flat[first : first + m + WINDOW - 1]].T)
            seen, given = np.zeros((WINDOW, m), np.float32), np.zeros((WINDOW, m), np.float32)
            for name, x, part, order in (("wf", inputs[:half], slice(0, units), range(WINDOW)), ("wb", inputs[half:], slice(units, None), range(WINDOW - 1, -1, -1))):
                turned = np.ascontiguousarray(w[f"{name}U"].T)
                heads = np.stack([w["see"][part], w["out"][part]])
                h = np.zeros((units, m), np.float32)
                for t in order:
                    now, below = x[:, t : t + m], turned @ h
                    gates = now[: 2 * units] + below[: 2 * units]
                    gates *= 0.5
                    np.tanh(gates, out=gates)
                    z, r, new = gates[:units], gates[units:], below[2 * units :]
                    r += 1
                    new *= r
                    new *= 0.5
                    new += now[2 * units :]
                    np.tanh(new, out=new)
                    new -= h
                    z -= 1
                    z *= -0.5
                    new *= z
                    h += new
                    both = heads @ h
                    seen[t] += both[0]
                    given[t] += both[1]
            seen -= seen.max(axis=0)
            np.exp(seen, out=seen)
            given *= seen
            found[first : first + m] = given.sum(axis=0) / seen.sum(axis=0) + w["bias"][0]
        return found

    def highest(self, table: np.ndarray, flat: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logits of all windows of texts of ``n`` words in ``flat``, in the order of
        :func:`window_places`, and the highest of each text."""
        base, count = np.cumsum(n) - n, np.maximum(0, n - WINDOW) + 1
        starts = np.cumsum(count) - count
        logit = np.empty(int(count.sum()), np.float32)
        sliding = self.sliding_logits(table, flat)
        text, first, span = window_places(n)
        whole = span == WINDOW
        logit[whole] = sliding[base[text[whole]] + first[whole]]
        short = np.flatnonzero(~whole)
        for i in range(0, len(short), ROWS):
            some = short[i : i + ROWS]
            logit[some] = self.logits(table, *gathered(flat, base[text[some]], span[some]))
        return logit, np.maximum.reduceat(logit, starts)

    def gradients(self, words: list[str], windows: np.ndarray, mask: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss of some windows over the distinct ``words``."""
        w, half, kept = self.w, 3 * WORD_UNITS, []
        x = self.word_inputs(words, kept)
        table = np.concatenate([x @ w["wfW"] + w["wfb"], x @ w["wbW"] + w["wbb"]], axis=1)
        logit = self.logits(table, windows, mask, kept)
        (chars, number, ca, cb), (states, share, pooled, wa, wb, index) = kept
        d = ((sigmoid(logit) - labels) * weight).astype(np.float32)
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpooled = d[:, None] * w["out"]
        dshare = np.einsum("bh,tbh->tb", dpooled, states)
        dseen = share * (dshare - (share * dshare).sum(axis=0))
        g["see"] = np.einsum("tb,tbh->h", dseen, states)
        dstates = share[:, :, None] * dpooled + dseen[:, :, None] * w["see"]
        dtable = np.zeros_like(table)
        for name, part, states_back, places, steps in (("wf", slice(0, half), dstates[:, :, :WORD_UNITS], index, wa), ("wb", slice(half, None), dstates[::-1, :, WORD_UNITS:], index[::-1], wb)):
            dx, g[f"{name}U"] = gru_back(states_back, steps, w[f"{name}U"])
            summed = np.zeros((len(table), half), np.float32)
            np.add.at(summed, places.ravel(), dx.reshape(-1, half))
            dtable[:, part] = summed
            g[f"{name}W"], g[f"{name}b"] = x.T @ summed, summed.sum(axis=0)
        dx = dtable[:, :half] @ w["wfW"].T + dtable[:, half:] @ w["wbW"].T
        g["words"] = np.zeros_like(w["words"])
        np.add.at(g["words"], number, dx[:, :WORD_DIM])
        g["chars"] = np.zeros_like(w["chars"])
        for name, part, places, steps in (("cf", slice(WORD_DIM, WORD_DIM + CHAR_UNITS), chars, ca), ("cb", slice(WORD_DIM + CHAR_UNITS, None), chars[::-1], cb)):
            back = np.zeros((len(chars), len(words), CHAR_UNITS), np.float32)
            back[-1] = dx[:, part]
            dp, g[f"{name}U"] = gru_back(back, steps, w[f"{name}U"])
            summed = np.zeros((CHARS, 3 * CHAR_UNITS), np.float32)
            np.add.at(summed, places.ravel(), dp.reshape(-1, 3 * CHAR_UNITS))
            g[f"{name}W"], g[f"{name}b"] = w["chars"].T @ summed, summed.sum(axis=0)
            g["chars"] += summed @ w[f"{name}W"].T
        return g


def window_places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word and words of all overlapping windows of texts of ``n`` words.

    A window starts at every word from which it fits. A text shorter than a window, or empty,
    has one of all its words.
    """
    count = np.maximum(0, n - WINDOW) + 1
    text = np.repeat(np.arange(len(n)), count)
    first = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, first, np.minimum(WINDOW, n[text])


def gathered(flat: np.ndarray, begin: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows (rows, time) of a flat row of places, and their mask."""
    span = np.arange(WINDOW)
    mask = span[None, :] < words[:, None]
    return np.where(mask, flat[np.minimum(begin[:, None] + span, max(0, len(flat) - 1))] if len(flat) else 0, 0), mask.astype(np.float32)


def train(texts: list[str], labels: np.ndarray, prior: float, seed: int = 7, epochs: int = 8) -> dict:
    """Weights, vocabulary and calibration, learnt from labelled texts.

    A text is as toxic as its most toxic window. The first epochs learn from random windows
    under their text's label; later ones from the two windows of each text that score highest.
    At the end, a logistic curve turns a text's highest logit into a probability, with the
    classes weighted to the share ``prior``.
    """
    rng = np.random.default_rng(seed)
    tokens = [words_of(t) for t in texts]
    seen = Counter(w for row in tokens for w in {bare(x) for x in row})
    frequent = [w for w, n in sorted(seen.items(), key=lambda p: (-p[1], p[0]))[:VOCABULARY] if n >= 3]
    net = Network(start_weights(VOCABULARY, rng), {w: i + 1 for i, w in enumerate(frequent)})
    distinct = {w: i for i, w in enumerate(dict.fromkeys(w for row in tokens for w in row))}
    words = list(distinct) or [""]
    flat = np.fromiter((distinct[w] for row in tokens for w in row), np.int64)
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    base = np.cumsum(n) - n
    text, first, span = window_places(n)
    edges = np.searchsorted(text, np.arange(len(n) + 1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    steps = 0

    def scan() -> tuple[np.ndarray, np.ndarray]:
        return net.highest(net.projected(words), flat, n)

    for epoch in range(epochs):
        value = rng.random(len(text)) if epoch < 3 else scan()[0]
        order = np.lexsort((-value, text))
        place = np.arange(len(text)) - edges[text[order]]
        chosen = order[place < (6 if epoch < 3 else 2)]
        rng.shuffle(chosen)
        rate = 0.01 if epoch < epochs - 2 else 0.003
        for i in range(0, len(chosen), 128):
            some = chosen[i : i + 128]
            windows, mask = gathered(flat, base[text[some]] + first[some], span[some])
            used, index = np.unique(windows, return_inverse=True)
            grads = net.gradients([words[j] for j in used], index.reshape(len(some), WINDOW), mask, labels[text[some]].astype(np.float32), np.full(len(some), 1 / len(some), np.float32))
            steps += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g / max(1.0, norm)
                a, b = moments[k]
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                net.w[k] -= (rate * (a / (1 - 0.9**steps)) / (np.sqrt(b / (1 - 0.99**steps)) + 1e-7)).astype(np.float32)
    highest = scan()[1].astype(float)
    return {"weights": net.w, "vocabulary": net.vocabulary, "curve": calibrate(highest, labels.astype(float), prior)}


def calibrate(logit: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on a lightly ridged log loss."""
    share = labels.mean()
    weight = np.where(labels > 0.5, prior / share, (1 - prior) / (1 - share))
    x = np.stack([logit, np.ones_like(logit)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(np.clip(x @ beta, -30, 30))
        slope = x.T @ (weight * (p - labels)) + 1e-2 * (beta - [1.0, 0.0])
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.linalg.solve(bend, slope)
    return float(max(beta[0], 1e-3)), float(beta[1])


class Scorer:
    """Scores texts; keeps the projections of the words it has met, up to a bound."""

    HELD = 100_000

    def __init__(self, model: dict):
        self.net, self.curve = Network(model["weights"], model["vocabulary"]), model["curve"]
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.table = np.zeros((0, 6 * WORD_UNITS), np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The probability of each text: that of its highest window among all of them."""
        if not texts:
            return np.zeros(0)
        tokens = [words_of(t) for t in texts]
        if len(self.places) > self.HELD:  # frequent words come early; the later half goes
            half = self.HELD // 2
            self.places = dict(list(self.places.items())[:half])
            self.table = self.table[:half].copy()
        new = sorted(set(chain.from_iterable(tokens)).difference(self.places)) or ([""] if not self.places else [])
        if new:
            base = len(self.places)
            self.places.update((w, base + i) for i, w in enumerate(new))
            self.table = np.concatenate([self.table, self.net.projected(new)])
        place = self.places.__getitem__
        n = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter(map(place, chain.from_iterable(tokens)), np.int64, int(n.sum()))
        highest = self.net.highest(self.table, flat, n)[1].astype(float)
        return sigmoid(np.clip(self.curve[0] * highest + self.curve[1], -40, 40))
