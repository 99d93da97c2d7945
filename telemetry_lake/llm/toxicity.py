"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a hashed embedding of itself and the mean of hashed embeddings of its characters:
their trigrams and the word's beginnings. Two gated recurrent layers read a window of words in both directions, attention weighs their
states, and a logistic unit scores the window. A text is scored by its worst window; windows that overlap
by half count, over the whole text. Training knows only which texts are toxic, not where: of a toxic
text the window that scores highest is the positive example, of others the one that comes closest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import Words, mix64, text_blocks

#: Words of a window, and from one window to the next. Windows share 16 words, so that every passage
#: of up to WIDTH - STRIDE + 1 = 17 words lies whole in one.
WIDTH, STRIDE = 32, 16
WORD_ROWS, CHAR_ROWS, EMBEDDED, HIDDEN = 1 << 14, 1 << 15, 8, 8
#: Lengths, in bytes, of the beginnings of a word that enter beside its trigrams.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Labelled texts of any length that fit the network, the first by a hash of their id: toxic ones and
#: others. A text with more windows than MAX_WINDOWS trains with so many, drawn from all of it.
MAX_TOXIC, MAX_OTHER = 2000, 4000
MAX_WINDOWS = 128
EPOCHS, BATCH, RATE = 10, 64, 0.01
PREDICTED = 0.3
#: Windows scored at once.
ROWS_AT_ONCE = 1024
#: Bytes of training text read at once.
BLOCK_BYTES = 1 << 20


def word_inputs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a block: number of each word's own; their hashed row; their trigrams' rows and owners.

    A-Z are read in lower case and other characters than letters at a word's ends are left out.
    """
    h = words.hashes()
    _, at, number = np.unique(h, return_index=True, return_inverse=True)
    data = words.data
    letter = ((data >= 0x61) & (data <= 0x7A)) | (data >= 0x80)
    s, e = words.starts[at].copy(), words.ends[at].copy()
    for _ in range(4):
        s += (s < e) & ~letter[np.minimum(s, len(data) - 1)]
        e -= (s < e) & ~letter[np.maximum(e - 1, 0)]
    stripped = Words.__new__(Words)
    stripped.data, stripped.starts, stripped.ends = data, s, e
    row = (stripped.hashes() % np.uint64(WORD_ROWS)).astype(np.int64) if len(at) else np.zeros(0, np.int64)
    n = np.maximum(e - s - 2, 1)
    owner = np.repeat(np.arange(len(at)), n)
    first = np.repeat(s, n) + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    byte = lambda k: data[np.minimum(first + k, len(data) - 1)].astype(np.uint64)
    grams = (mix64(byte(0) << np.uint64(16) | byte(1) << np.uint64(8) | byte(2)) % np.uint64(CHAR_ROWS)).astype(np.int64)
    # Beginnings, told apart by whether the word goes on.
    for k in BEGINNINGS:
        size = np.minimum(e - s, k)
        stripped.ends = s + size
        h = stripped.hashes() if len(at) else np.zeros(0, np.uint64)
        grams = np.concatenate([grams, (mix64(h + (2 * k + (e - s > k)).astype(np.uint64)) % np.uint64(CHAR_ROWS)).astype(np.int64)])
        owner = np.concatenate([owner, np.arange(len(at))])
    order = np.argsort(owner, kind="stable")
    return number, row, grams[order], owner[order]


class Network:
    """Parameters in ``p``; ``d`` of the two directions share shapes."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        size = 2 * EMBEDDED
        self.p = {"word": r.normal(0, 0.1, (WORD_ROWS, EMBEDDED)), "char": r.normal(0, 0.1, (CHAR_ROWS, EMBEDDED))}
        for d in "fb":
            self.p["W" + d] = r.normal(0, 1 / math.sqrt(size), (size, 3 * HIDDEN))
            self.p["U" + d] = r.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
            self.p["c" + d] = np.zeros(3 * HIDDEN)
        self.p["attend"] = np.zeros(2 * HIDDEN)
        self.p["out"] = r.normal(0, 0.3, 2 * HIDDEN)
        self.p["bias"] = np.array([-1.0])
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, row: np.ndarray, grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Input vectors of distinct words, and one of zeros for the room after a text's end."""
        n = np.bincount(owner, minlength=len(row)).clip(1)[:, None]
        chars = np.zeros((len(row), EMBEDDED), np.float32)
        if len(row):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            chars = np.add.reduceat(self.p["char"][grams], starts, axis=0) / n
        x = np.concatenate([self.p["word"][row], chars], axis=1).astype(np.float32)
        return np.concatenate([x, np.zeros((1, 2 * EMBEDDED), np.float32)])

    def _run(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States of one direction. ``gates`` (time, row, 3 * HIDDEN) are the inputs' part."""
        u = self.p["U" + d]
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        states, kept = [None] * len(gates), [None] * len(gates)
        full = mask.all(axis=1)
        for t in range(len(gates)) if d == "f" else range(len(gates) - 1, -1, -1):
            zr = np.tanh((gates[t][:, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            rh = r * h
            new = np.tanh(gates[t][:, 2 * HIDDEN :] + rh @ u[:, 2 * HIDDEN :])
            step = (1 - z) * (new - h)
            if not full[t]:
                step *= mask[t][:, None]
            if keep:
                kept[t] = (h, z, r, new)
            h = h + step
            states[t] = h
        return np.stack(states), kept

    def logits(self, x: np.ndarray, words: np.ndarray, keep: bool = False):
        """Windows ``words`` (row, time) of numbers into ``x``, whose last row is no word."""
        words = words.T
        mask = (words < len(x) - 1).astype(np.float32)
        states, kept = [], {}
        for d in "fb":
            gates = (x @ self.p["W" + d] + self.p["c" + d])[words]
            s, kept[d] = self._run(gates, mask, d, keep)
            states.append(s)
        h = np.concatenate(states, axis=2)
        a = h @ self.p["attend"] + np.where(mask > 0, 0, -30).astype(np.float32)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[:, :, None] * h).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (words, mask, kept, h, a, pooled)) if keep else logit

    def gradients(self, x: np.ndarray, words: np.ndarray, y: np.ndarray, parts: tuple) -> tuple[float, dict]:
        """Mean log loss of windows with labels ``y``, and its gradients."""
        logit, (words, mask, kept, h, a, pooled) = self.logits(x, words, keep=True)
        row, grams, owner = parts
        p = 1 / (1 + np.exp(-logit))
        loss = float(-np.mean(np.where(y > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9))))
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        dl = ((p - y) / len(y)).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ dl, np.array([dl.sum()], np.float32)
        dpool = dl[:, None] * self.p["out"]
        da = (h * dpool).sum(axis=2)
        da = a * (da - (a * da).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", da, h)
        dh = a[:, :, None] * dpool + da[:, :, None] * self.p["attend"]
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u = self.p["U" + d]
            own = dh[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            back = np.zeros_like(own[0])
            dgates = np.zeros((*words.shape, 3 * HIDDEN), np.float32)
            for t in range(len(words) - 1, -1, -1) if d == "f" else range(len(words)):
                back = back + own[t]
                prev, z, r, new = kept[d][t]
                m = mask[t][:, None]
                step = m * back
                dnew = step * (1 - z) * (1 - new**2)
                dz = -step * (new - prev) * z * (1 - z)
                drh = dnew @ u[:, 2 * HIDDEN :].T
                dr = drh * prev * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                dgates[t] = np.concatenate([dzr, dnew], axis=1)
                g["U" + d][:, : 2 * HIDDEN] += prev.T @ dzr
                g["U" + d][:, 2 * HIDDEN :] += (r * prev).T @ dnew
                back = back - step * (1 - z) + drh * r + dzr @ u[:, : 2 * HIDDEN].T
            flat = dgates.reshape(-1, 3 * HIDDEN)
            per_word = np.zeros((len(x), 3 * HIDDEN), np.float32)
            np.add.at(per_word, words.reshape(-1), flat)
            g["c" + d] = flat.sum(axis=0)
            g["W" + d] = x.T @ per_word
            dx += per_word @ self.p["W" + d].T
        dx = dx[:-1]
        np.add.at(g["word"], row, dx[:, :EMBEDDED])
        n = np.bincount(owner, minlength=len(row)).clip(1)[:, None]
        np.add.at(g["char"], grams, (dx[:, EMBEDDED:] / n)[owner])
        return loss, g


def windows_of(firsts: np.ndarray, number: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of all texts: their words' numbers, and their text."""
    n = np.diff(firsts)
    count = np.where(n > 0, np.maximum(1, -(-(n - WIDTH) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = k[:, None] * STRIDE + np.arange(WIDTH)
    inside = at < n[text][:, None]
    place = np.minimum(firsts[text][:, None] + at, max(len(number) - 1, 0))
    return np.where(inside, number[place] if len(number) else none, none), text


def all_logits(network: Network, x: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Logits of many windows, some at a time; only these windows' own words take part."""
    out = np.zeros(len(windows), np.float32)
    for at in range(0, len(windows), ROWS_AT_ONCE):
        some = windows[at : at + ROWS_AT_ONCE]
        used = np.unique(np.append(some, len(x) - 1))
        out[at : at + ROWS_AT_ONCE] = network.logits(x[used], np.searchsorted(used, some))
    return out


def score_texts(network: Network, texts: list[bytes]) -> np.ndarray:
    """The chance that each text is toxic, by its worst window; 0 without words."""
    words = Words(texts, lower=True)
    number, row, grams, owner = word_inputs(words)
    x = network.inputs(row, grams, owner)
    windows, text = windows_of(words.firsts, number, len(x) - 1)
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, text, all_logits(network, x, windows).astype(float))
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-best))


def drawn(texts: list[bytes]) -> list[list[bytes]]:
    """Each text as the pieces that train: itself, or one window from each of MAX_WINDOWS equal stretches."""
    words = Words(texts)
    out = []
    for k, (a, b) in enumerate(zip(words.firsts[:-1].tolist(), words.firsts[1:].tolist())):
        starts = b - a - WIDTH + 1
        if starts <= MAX_WINDOWS * STRIDE:
            out.append([texts[k]])
            continue
        edges = np.arange(MAX_WINDOWS + 1) * starts // MAX_WINDOWS
        at = a + np.random.default_rng(b - a).integers(edges[:-1], edges[1:])
        out.append([words.data[words.starts[w] : words.ends[w + WIDTH - 1]].tobytes() for w in at])
    return out


def numbered(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """First word of each piece, and the number of words; numbers of all words; the distinct words in
    lower case, by their hashes. Looks at a block of pieces at a time, as hashes take much room."""
    known: dict[int, bytes] = {}
    hashes, counts, at = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    ends = np.cumsum([len(p) for p in pieces])
    while at < len(pieces):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
        words = Words(pieces[at:end], lower=True)
        h = words.hashes()
        for word, k in zip(*(x.tolist() for x in np.unique(h, return_index=True))):
            if word not in known:
                known[word] = words.data[words.starts[k] : words.ends[k]].tobytes()
        hashes.append(h)
        counts.append(np.diff(words.firsts))
        at = end
    order, number = np.unique(np.concatenate(hashes), return_inverse=True)
    return np.cumsum(np.concatenate(counts)), number.astype(np.int32), [known[word] for word in order.tolist()]


def train(texts: list[list[bytes]], labels: list[int], seed: int = 5, epochs: int = EPOCHS) -> Network:
    """Fit a network to texts in pieces (:func:`drawn`). Without both kinds of labels it stays as it starts."""
    network = Network(seed)
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return network
    rng = np.random.default_rng(seed)
    firsts, number, distinct = numbered([piece for pieces in texts for piece in pieces])
    _, row, grams, owner = word_inputs(Words([b" ".join(distinct)]))
    windows, piece = windows_of(firsts, number, len(row))
    text = np.repeat(np.arange(len(texts)), [len(pieces) for pieces in texts])[piece]
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    able = np.flatnonzero(np.diff(edges) > 0)
    owned = np.searchsorted(owner, np.arange(len(row) + 1))
    m = {k: np.zeros_like(v) for k, v in network.p.items()}
    v = {k: np.zeros_like(v) for k, v in network.p.items()}
    steps = 0
    toxic, other = able[y[able] == 1], able[y[able] == 0]
    for epoch in range(epochs):
        if epoch % 2:
            x = network.inputs(row, grams, owner)
            logit = all_logits(network, x, windows)
        pick = lambda t: edges[t] + (int(np.argmax(logit[edges[t] : edges[t + 1]])) if epoch else rng.integers(edges[t + 1] - edges[t]))
        examples = [(pick(t), y[t]) for t in able]
        # Of the other texts also a window at random.
        examples += [(edges[t] + rng.integers(edges[t + 1] - edges[t]), 0.0) for t in other]
        if epoch:
            examples += [(pick(t), 1.0) for t in toxic]
        rng.shuffle(examples)
        for at in range(0, len(examples), BATCH):
            chosen = np.array([int(e[0]) for e in examples[at : at + BATCH]])
            wanted = np.array([e[1] for e in examples[at : at + BATCH]], np.float32)
            # Only the batch's own words take part.
            used, local = np.unique(windows[chosen], return_inverse=True)
            used = used[used < len(row)]
            spans = np.concatenate([np.arange(owned[w], owned[w + 1]) for w in used]) if len(used) else np.zeros(0, np.int64)
            parts = (row[used], grams[spans], np.repeat(np.arange(len(used)), owned[used + 1] - owned[used]))
            x = network.inputs(*parts)
            _, g = network.gradients(x, np.minimum(local.reshape(len(chosen), WIDTH), len(used)), wanted, parts)
            steps += 1
            for k, gradient in g.items():
                gradient = np.clip(gradient, -1, 1)
                m[k] += 0.1 * (gradient - m[k])
                v[k] += 0.001 * (gradient**2 - v[k])
                network.p[k] -= (RATE * (m[k] / (1 - 0.9**steps)) / (np.sqrt(v[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return network


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, texts in text_blocks(batches):
        pieces = pa.array(drawn(texts), pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("doc_id", "h", "toxic")), pieces], names=["doc_id", "h", "toxic", "pieces"])


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic`` and ``pieces`` of a bounded sample of the labelled texts that are not held out.

    Only labels that have a text with words count; of equal rows one does.
    """
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out()).select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).filter(F.col("text").rlike(r"[^ \t-\r]"))
    known = texts.select("doc_id", "h").join(rows, "doc_id").distinct()
    in_order = [F.xxhash64("doc_id"), "doc_id", "h"]
    some = lambda kind, n: known.filter(F.col("toxic") == kind).orderBy(*in_order).limit(n)
    # At most MAX_TOXIC + MAX_OTHER rows of three numbers.
    sample = F.broadcast(some(1, MAX_TOXIC).unionByName(some(0, MAX_OTHER)))
    found = texts.join(sample, ["doc_id", "h"]).groupBy("doc_id", "h", "toxic").agg(F.first("text").alias("text"))
    pieces = found.mapInArrow(_draw, "doc_id long, h long, toxic int, pieces array<binary>")
    return pieces.orderBy(*in_order, "toxic").select("toxic", "pieces")


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on :func:`training_texts`."""
    found = training_texts(docs, labels).collect()
    return train([[bytes(p) for p in r["pieces"]] for r in found], [r["toxic"] for r in found])


def _score(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in text_blocks(batches):
            scores = score_texts(network, texts)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= PREDICTED).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Held out are rows with crc32(id as text) mod 4 = 2; their labels are not read. Null and blank
    texts score 0; rows without an id are scored and not held out; of repeated ids each row is
    scored; further columns are ignored; an empty table gives an empty result. Without labels of both
    kinds the scores come from an untrained network.
    """
    network = fit(docs, labels)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return rows.mapInArrow(_score(network), "doc_id long, held_out boolean, score double, predicted int")
