"""A small causal self-attention model over ids, in numpy.

Queries, keys and values are projections of the embeddings of the ids read so far;
attention reaches over overlapping windows: the ids of one block attend to that block
up to themselves and to the whole block before. Each id is scored once. The output
layer predicts one of ``CLASSES`` classes of ids; inside a class, ids follow their
counts in the training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import pairwise

import numpy as np

WIDTH, CLASSES = 16, 48
NAMES = ("embedding", "query", "key", "value", "distance", "direct", "context", "bias")
#: Attention scores stay below, so that their exponentials need no shift.
HIGHEST = np.float32(40)


@dataclass
class Vocabulary:
    """Class of every id, and log probability of the id inside its class."""

    of_class: np.ndarray
    inside: np.ndarray

    @property
    def size(self) -> int:
        return len(self.of_class)


def _clustered(rows: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Cluster of every row by k-means on the sphere, started from the heaviest rows."""
    k = max(1, min(k, len(rows)))
    centres = rows[np.argsort(-weight, kind="stable")[:k]].copy()
    own = np.zeros(len(rows), np.int64)
    for _ in range(12):
        own = np.argmax(rows @ centres.T, axis=1)
        for c in range(k):
            members = own == c
            if members.any():
                centres[c] = (rows[members] * np.sqrt(weight[members])[:, None]).sum(0)
                centres[c] /= np.linalg.norm(centres[c]) + 1e-12
    return own


def vocabulary(counts: np.ndarray, followers: np.ndarray) -> Vocabulary:
    """Classes by what ids follow; ids never seen share the last class, and none has probability 0.

    ``followers[i, g]`` is how often id i came behind group g.
    """
    of_class = np.full(len(counts), CLASSES - 1)
    seen = np.flatnonzero(counts > 0)
    if len(seen):
        rows = np.sqrt(followers[seen] + 1e-9)
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        of_class[seen] = _clustered(rows, counts[seen], CLASSES - 1)
    smooth = counts + 0.1
    mass = np.bincount(of_class, smooth, CLASSES)
    return Vocabulary(of_class, np.log(smooth / mass[of_class]).astype(np.float32))


def start(words: Vocabulary, counts: np.ndarray, block: int, seed: int = 1) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    normal = lambda *shape: draw.normal(0, 0.3, shape).astype(np.float32)
    share = np.bincount(words.of_class, counts, CLASSES) + 1
    return {
        "embedding": normal(words.size, WIDTH),
        "query": normal(WIDTH, WIDTH),
        "key": normal(WIDTH, WIDTH),
        "value": normal(WIDTH, WIDTH),
        "distance": np.zeros(2 * block, np.float32),
        "direct": np.zeros((WIDTH, CLASSES), np.float32),
        "context": np.zeros((WIDTH, CLASSES), np.float32),
        "bias": np.log(share / share.sum()).astype(np.float32),
    }


def _exponential(scores: np.ndarray) -> None:
    if scores.size and scores.max() > HIGHEST:
        np.minimum(scores, HIGHEST, out=scores)
    np.exp(scores, out=scores)


@cache
def _kept(block: int, chunk: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``span`` keys a place sees, by the first key that its sequence leaves open and its place in the chunk; distance of the keys."""
    key, place = np.arange(span), np.arange(chunk) + span - chunk
    seen = (key[None, None, :] >= key[:, None, None]) & (key[None, None, :] <= place[None, :, None])
    return seen.astype(np.float32), np.clip(place[:, None] - key[None, :], 0, 2 * block - 1)


@dataclass
class Step:
    """Places of a step in chunks of ``chunk``, which attend to ``span`` keys: themselves, and the chunk before where a sequence is longer.

    ``place`` tells where the ids of the step stand. ``row`` is the place's row in the
    table of ``_kept``, ``goal`` the place of its class in a table of classes by places;
    places that hold no id are not ``real``.
    """

    ids: slice
    place: np.ndarray
    read: np.ndarray
    goal: np.ndarray
    real: np.ndarray
    row: np.ndarray
    chunk: int
    span: int


def _packed(lengths: list[int], room: int) -> tuple[list[int], int]:
    """Where sequences stand so that none reaches over a multiple of ``room``, and the end."""
    out, at = [], 0
    for n in lengths:
        left = -at % room
        if n > left:
            at += left
        out.append(at)
        at += n
    return out, at


def steps_of(classes: np.ndarray, sequences: np.ndarray, lengths: np.ndarray, begins: np.ndarray, block: int, tokens: int) -> Iterator[Step]:
    """Whole sequences in steps of about ``tokens`` ids; an id attends to its block up to itself and to the block before."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shifted = np.empty(total, np.int64)
    shifted[1:] = sequences[:-1]
    shifted[(ends - lengths)[lengths > 0]] = begins[lengths > 0]
    at = np.arange(total) - np.repeat(ends - lengths, lengths)
    goals, backward = classes[sequences], at - np.maximum(at // block - 1, 0) * block
    cuts = np.searchsorted(ends, np.arange(tokens, total + tokens, tokens))
    for low, high in pairwise([0, *np.unique(np.minimum(cuts + 1, len(lengths)))]):
        some = lengths[low:high]
        ids = slice(int(ends[low] - lengths[low]), int(ends[high - 1]))
        if ids.start == ids.stop:
            continue
        n = ids.stop - ids.start
        blocks = -(-some // block) * block
        if some.max() <= 2 * block:
            chunk = span = 2 * block
            first, n = _packed(some.tolist(), chunk)
        elif blocks.sum() <= 1.5 * n:
            chunk, span = block, 2 * block
            first, n = np.cumsum(blocks) - blocks, int(blocks.sum())
        else:  # mostly short ones: without gaps, in chunks that reach back far enough
            chunk, span = 2 * block, 4 * block
            first = np.cumsum(some) - some
        n = -(-n // chunk) * chunk
        place = np.repeat(first, some) + at[ids]
        read, goal, real, open_ = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.float32), np.zeros(n, np.int64)
        read[place], goal[place], real[place], open_[place] = shifted[ids], goals[ids], 1, backward[ids]
        here = np.arange(n) % chunk
        yield Step(ids, place, read, goal * n + np.arange(n), real, (here + span - chunk - open_) * chunk + here, chunk, span)


def _chunks(table: np.ndarray, low: int, high: int, chunk: int, span: int, skip: int = 0) -> np.ndarray:
    """Rows ``low`` to ``high`` by chunk of the columns from ``skip`` on, each chunk with the columns before it that make up ``span``."""
    columns = table.shape[1]
    shape = ((columns - skip - span) // chunk + 1, high - low, span)
    return np.ndarray(shape, np.float32, table, 4 * (low * columns + skip), (4 * chunk, 4 * columns, 4))


@dataclass
class Attended:
    """What ``_attended`` made of a step; tables have a column a place.

    Queries, keys, values and a one stand below each other: the one's row gives the sums
    of the attention. ``z`` holds what the classes are told from: the embedding, the
    context and a one.
    """

    x: np.ndarray
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    weights: np.ndarray
    total: np.ndarray
    z: np.ndarray
    inner: np.ndarray
    outer: np.ndarray


def _attended(params: dict, step: Step, block: int) -> Attended:
    n, chunk, span, w = len(step.read), step.chunk, step.span, WIDTH
    seen, distance = _kept(block, chunk, span)
    near = (seen * np.exp(params["distance"])[distance]).reshape(-1, span)
    inner = np.concatenate([params["query"].T * np.float32(1 / np.sqrt(w)), params["key"].T, params["value"].T])
    outer = np.concatenate([params["direct"], params["context"], params["bias"][None]])
    x = np.take(params["embedding"], step.read, 0)
    side = np.empty((3 * w + 1, span - chunk + n), np.float32)
    side[:, : span - chunk] = 0
    side[3 * w] = 1
    np.matmul(inner, x.T, out=side[: 3 * w, span - chunk :])
    q = _chunks(side, 0, w, chunk, chunk, span - chunk)
    k, v = _chunks(side, w, 2 * w, chunk, span), _chunks(side, 2 * w, 3 * w + 1, chunk, span)
    weights = q.transpose(0, 2, 1) @ k
    _exponential(weights)
    weights *= np.take(near, step.row, 0).reshape(weights.shape)
    context = np.empty((w + 1, n), np.float32)
    np.matmul(v, weights.transpose(0, 2, 1), out=_chunks(context, 0, w + 1, chunk, chunk))
    total = np.float32(1) / np.maximum(context[w], np.float32(1e-30))
    z = np.empty((2 * w + 1, n), np.float32)
    z[:w] = x.T
    np.multiply(context[:w], total, out=z[w : 2 * w])
    z[2 * w] = 1
    return Attended(x, q, k, v, weights, total, z, inner, outer)


def log_probabilities(params: dict, words: Vocabulary, sequences: np.ndarray, lengths: np.ndarray, begins: np.ndarray, block: int, tokens: int = 1500) -> np.ndarray:
    """Natural log probability of every id of concatenated sequences, each read behind its ``begins`` id.

    Long sequences are read in parts, each with the block before it again.
    """
    out = np.empty(len(sequences), np.float32)
    if not len(sequences):
        return out
    long = tokens // block * block
    parts = np.maximum(1, -(-lengths // long))
    of = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = (np.cumsum(lengths) - lengths)[of]
    low = np.maximum(number * long - block, 0)
    sizes = np.minimum(lengths[of], (number + 1) * long) - low
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(start + low, sizes) + inside
    before = begins[of]
    before[number > 0] = sequences[(start + low - 1)[number > 0]]
    fresh = inside >= np.repeat(np.where(number > 0, block, 0), sizes)
    ones = np.ones(CLASSES, np.float32)
    for step in steps_of(words.of_class, sequences[at], sizes, before, block, tokens):
        made = _attended(params, step, block)
        logits = made.outer.T @ made.z
        np.minimum(logits, HIGHEST, out=logits)
        picked = logits.ravel()[step.goal[step.place]]
        np.exp(logits, out=logits)
        logs = picked - np.log(ones @ logits)[step.place]
        out[at[step.ids][fresh[step.ids]]] = logs[fresh[step.ids]]
    return out + words.inside[sequences]


def _gradients(params: dict, step: Step, block: int) -> tuple[dict, np.ndarray]:
    """Gradients of the summed class loss over real places; gradients of the embedding rows of ``step.read`` apart."""
    n, chunk, span, w = len(step.read), step.chunk, step.span, WIDTH
    made = _attended(params, step, block)
    x, q, k, v, weights, z, inner, outer = made.x, made.q, made.k, made.v, made.weights, made.z, made.inner, made.outer
    back = np.empty((CLASSES + 3 * w, n), np.float32)  # gradients of classes, then of queries, keys and values
    d, dside = back[:CLASSES], back[CLASSES:]
    np.matmul(outer.T, z, out=d)
    _exponential(d)
    d *= step.real / (np.ones(CLASSES, np.float32) @ d)
    back.ravel()[step.goal] -= step.real
    slopes = (d @ z.T).T
    dcontext = np.empty((w + 1, n), np.float32)
    np.multiply(outer[w : 2 * w] @ d, made.total, out=dcontext[:w])  # the one's row takes the sums off
    np.negative((dcontext[:w] * z[w : 2 * w]).sum(0), out=dcontext[w])
    dcontext = _chunks(dcontext, 0, w + 1, chunk, chunk)
    dscores = dcontext.transpose(0, 2, 1) @ v
    dscores *= weights
    np.matmul(k, dscores.transpose(0, 2, 1), out=_chunks(dside, 0, w, chunk, chunk))
    for at, left, right in ((w, q, dscores), (2 * w, dcontext[:, :w], weights)):
        own = _chunks(dside, at, at + w, chunk, chunk)
        if span == chunk:
            np.matmul(left, right, out=own)
        else:
            part = left @ right
            own[...] = part[:, :, chunk:]
            own[:-1] += part[1:, :, :chunk]
    dinner = x.T @ dside.T
    apart = np.ones(len(dscores), np.float32) @ dscores.reshape(len(dscores), -1)
    out = {
        "direct": slopes[:w],
        "context": slopes[w : 2 * w],
        "bias": slopes[2 * w],
        "distance": np.bincount(_kept(block, chunk, span)[1].ravel(), apart, 2 * block).astype(np.float32),
        "query": dinner[:, :w] * np.float32(1 / np.sqrt(w)),
        "key": dinner[:, w : 2 * w],
        "value": dinner[:, 2 * w :],
    }
    return out, back.T @ np.concatenate([outer[:w].T, inner])


def train(params: dict, words: Vocabulary, sequences: np.ndarray, lengths: np.ndarray, begins: np.ndarray, block: int, rate: float, tokens: int = 1500, memory: dict | None = None) -> dict:
    """One pass of Adagrad over the concatenated sequences, about ``tokens`` ids a step; a copy of ``params`` further on.

    ``memory`` holds the sums of squares; given again, the next pass goes on from them.
    """
    params = {n: p.copy() for n, p in params.items()}
    memory = {} if memory is None else memory
    memory |= {} if memory else {n: np.full(p.shape if n != "embedding" else (len(p), 1), 0.1, np.float32) for n, p in params.items()}
    small = np.uint16 if len(params["embedding"]) <= 1 << 16 else np.int64
    for step in steps_of(words.of_class, sequences, lengths, begins, block, tokens):
        out, dx = _gradients(params, step, block)
        weight = np.float32(1 / max(step.real.sum(), 1) ** 0.5)
        for name, slope in out.items():
            slope = slope * weight
            memory[name] += slope * slope
            params[name] -= rate * 0.3 * slope / np.sqrt(memory[name])
        order = np.argsort(step.read.astype(small), kind="stable")
        read = step.read[order]
        first = np.flatnonzero(np.concatenate([[True], read[1:] != read[:-1]]))
        ids = read[first]
        slope = np.add.reduceat(np.take(dx, order, 0), first, axis=0) * weight
        squares = memory["embedding"][ids] + (slope * slope).mean(1, keepdims=True)
        memory["embedding"][ids] = squares
        params["embedding"][ids] -= rate * slope / np.sqrt(squares)
    return params
