"""A convolutional network over bytes, in numpy.

Bytes are embedded, filters slide byte by byte over overlapping chunks that cover the whole text, and
each filter's highest response in a chunk is kept.  A document has the highest of these over all its
chunks, and beside it their mean, so that one marked chunk in a long text shows and so does what
marks all of them; both together are combined into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHUNK = 512
OVERLAP = 64
EMBED = 8
WIDTH = 8
FILTERS = 24
EPOCHS = 12
_BLOCK = 64  # chunks in one product


@dataclass
class ByteNet:
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    shift: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS: of the document's maxima, then of its means
    bias: float

    @classmethod
    def fresh(cls, seed: int, prior: float) -> ByteNet:
        draw = np.random.default_rng(seed)
        scale = (WIDTH * EMBED) ** -0.5
        return cls(
            draw.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            draw.normal(0, scale, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            float(np.log(prior / (1 - prior))),
        )

    def strongest(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest response of each filter in each chunk, before its threshold, and its place."""
        high = np.full((len(chunks), FILTERS), -np.inf, np.float32)
        place = np.zeros((len(chunks), FILTERS), np.int64)
        for start in range(0, len(chunks), _BLOCK):
            part = slice(start, start + _BLOCK)
            embedded = self.embed[chunks[part]]
            for phase in range(WIDTH):  # windows that begin WIDTH apart do not overlap: a view
                count = (chunks.shape[1] - phase) // WIDTH
                windows = embedded[:, phase : phase + count * WIDTH].reshape(len(embedded), count, WIDTH * EMBED)
                found = windows @ self.filters
                best = found.argmax(1)
                value = np.take_along_axis(found, best[:, None], 1)[:, 0]
                better = value > high[part]
                high[part] = np.where(better, value, high[part])
                place[part] = np.where(better, best * WIDTH + phase, place[part])
        return high + self.shift, place

    def combine(self, pooled: np.ndarray) -> np.ndarray:
        logits = pooled.astype(np.float64) @ self.weights.astype(np.float64) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500)))


def chunk_starts(size: int) -> range:
    """Where the chunks of a text begin; even an empty text has one."""
    return range(0, max(1, size - OVERLAP), CHUNK - OVERLAP)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Chunks from given starts, filled up with zeros at the end of their text."""
    places = starts[:, None] + np.arange(CHUNK)
    inside = places < ends[:, None]
    if not len(data):
        return np.zeros(places.shape, np.uint8)
    return np.where(inside, data[np.minimum(places, len(data) - 1)], 0).astype(np.uint8)


def score(net: ByteNet, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The probability of each text."""
    n = len(at) - 1
    counts = np.array([len(chunk_starts(int(s))) for s in np.diff(at)], np.int64)
    row = np.repeat(np.arange(n), counts)
    starts = at[row] + (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * (CHUNK - OVERLAP)
    pooled = np.zeros((n, 2 * FILTERS), np.float32)
    for block in range(0, len(row), 16 * _BLOCK):
        part = slice(block, block + 16 * _BLOCK)
        active = np.maximum(net.strongest(cut(data, starts[part], at[row[part] + 1]))[0], 0)
        np.maximum.at(pooled[:, :FILTERS], row[part], active)
        np.add.at(pooled[:, FILTERS:], row[part], active / counts[row[part], None].astype(np.float32))
    return net.combine(pooled)


def gradients(net: ByteNet, chunks: np.ndarray, row: np.ndarray, labels: np.ndarray) -> dict:
    """Slopes of the mean log loss of documents, each given by its chunks (``row``, sorted)."""
    share = (1.0 / np.bincount(row))[row].astype(np.float32)
    highest, place = net.strongest(chunks)
    active = np.maximum(highest, 0)
    begin = np.searchsorted(row, np.arange(len(labels)))
    maxima = np.maximum.reduceat(active, begin)
    pooled = np.concatenate([maxima, np.add.reduceat(active * share[:, None], begin)], 1)
    error = ((net.combine(pooled) - labels) / len(labels)).astype(np.float32)
    # a document's maximum passes its error on to the chunks that have it, in equal parts
    top = (active == maxima[row]).astype(np.float32)
    top /= np.add.reduceat(top, begin)[row]
    back = error[row][:, None] * (top * net.weights[:FILTERS] + share[:, None] * net.weights[FILTERS:])
    back *= highest > 0
    read = chunks[np.arange(len(chunks))[:, None, None], place[:, :, None] + np.arange(WIDTH)]
    best = net.embed[read].reshape(len(chunks), FILTERS, WIDTH * EMBED)
    into = (back[:, :, None] * net.filters.T[None]).reshape(-1, EMBED)
    embed = [np.bincount(read.reshape(-1), into[:, k], minlength=256) for k in range(EMBED)]
    return {
        "embed": np.stack(embed, 1).astype(np.float32),
        "filters": np.einsum("cf,cfw->wf", back, best),
        "shift": back.sum(0),
        "weights": pooled.T @ error + 1e-4 * net.weights,
        "bias": float(error.sum()),
    }


def fit(chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 32, seed: int = 7) -> ByteNet:
    """Learn from documents, each given by its chunks (sorted by ``owner``), by Adam on the log loss."""
    labels = labels.astype(np.float64)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    net = ByteNet.fresh(seed, prior)
    if len(np.unique(labels)) < 2:
        net.weights[:] = 0
        return net
    draw = np.random.default_rng(seed)
    begins = np.searchsorted(owner, np.arange(len(labels) + 1))
    names = ("embed", "filters", "shift", "weights")
    first = {k: np.zeros_like(getattr(net, k)) for k in names} | {"bias": 0.0}
    second = {k: np.zeros_like(getattr(net, k)) for k in names} | {"bias": 0.0}
    turn = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for docs in np.array_split(draw.permutation(len(labels)), -(-len(labels) // batch)):
            picked = np.concatenate([np.arange(begins[d], begins[d + 1]) for d in docs])
            row = np.repeat(np.arange(len(docs)), begins[docs + 1] - begins[docs])
            grads = gradients(net, chunks[picked], row, labels[docs])
            turn += 1
            for name, grad in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                step = rate * (first[name] / (1 - 0.9**turn)) / (np.sqrt(second[name] / (1 - 0.999**turn)) + 1e-8)
                setattr(net, name, getattr(net, name) - step)
    return net
