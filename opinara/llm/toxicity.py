"""Toxicity of texts by a small recurrent network over words and their characters.

Input of a word: the evidence of the word itself, and the largest and mean evidence of its character n-grams (3 to 5
signs, ends marked). Evidence is the lower bound of a log ratio of document frequencies, toxic against other training
texts, in hashed tables; training texts are encoded by tables of the other half, so a word that only one text has
carries nothing. A bidirectional gated recurrent network reads windows of words, attention pools its states, a logistic
unit scores the pool. All overlapping windows of a text are scored; the text has the score of its worst window.
The network is trained in numpy by back propagation, on the worst window of each text as it stands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches, mixed, texts_of

WINDOW, STRIDE = 40, 30
HIDDEN, INPUTS, ATTENTION = 8, 4, 6
SLOTS = 1 << 18
_SPACE = bytes(32 if b < 48 and b != 39 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 128 else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_SPACE).split()


def grams_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all character n-grams of the words, and the number of the word each belongs to."""
    data = np.frombuffer(b"".join([b"\x02%b\x03" % w for w in words]), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    number = np.repeat(np.arange(len(words)), sizes)
    slots, owners = [], []
    rolling = data.copy()
    for n in range(2, 6):
        if len(data) < n:
            break
        rolling = rolling[:len(data) - n + 1] * np.uint64(257) + data[n - 1:]
        if n >= 3:
            whole = number[:len(data) - n + 1] == number[n - 1:]
            slots.append(mixed(rolling[whole] + np.uint64(n << 60)) % np.uint64(SLOTS))
            owners.append(number[:len(data) - n + 1][whole])
    if not slots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slots, owners = np.concatenate(slots).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return slots[order], owners[order]


def word_slots(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) % SLOTS for w in words], np.int64)


@dataclass
class Evidence:
    """Tables of words and of n-grams; two of fixed size."""

    words: np.ndarray
    grams: np.ndarray

    @classmethod
    def of(cls, texts: list[list[bytes]], toxic: np.ndarray) -> Evidence:
        counts = np.zeros((2, 2, SLOTS), np.float32)  # word or n-gram, label
        for words, label in zip(texts, toxic):
            own = list(set(words))
            counts[0, int(label), np.unique(word_slots(own))] += 1
            if own:
                counts[1, int(label), np.unique(grams_of(own)[0])] += 1
        n = np.array([(toxic == 0).sum(), (toxic == 1).sum()], np.float32)
        with_, without = counts[:, 1], counts[:, 0]
        ratio = np.log((with_ + 0.5) / (n[1] + 1)) - np.log((without + 0.5) / (n[0] + 1))
        spread = np.sqrt(1 / (with_ + 0.5) + 1 / (without + 0.5))
        lower = np.where(with_ >= 2, np.maximum(0, ratio - 1.5 * spread), 0)
        return cls(*lower.astype(np.float32))

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """The input of each word."""
        out = np.zeros((len(words), INPUTS), np.float32)
        if words:
            out[:, 0] = self.words[word_slots(words)]
            slots, owners = grams_of(words)
            starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
            value = self.grams[slots]
            out[owners[starts], 1] = np.maximum.reduceat(value, starts)
            out[owners[starts], 2] = np.add.reduceat(value, starts) / np.diff(np.append(starts, len(owners)))
            out[:, 3] = np.minimum([len(w) for w in words], 20)
            out *= np.array([0.5, 0.5, 0.5, 0.1], np.float32)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Gated recurrent units in both directions, attention pooling, a logistic unit."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * (0.6 / np.sqrt(s[0]))).astype(np.float32)
        self.p = {}
        for d in ("f", "b"):
            self.p |= {f"w{d}": draw(INPUTS, 3 * HIDDEN), f"u{d}": draw(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": draw(2 * HIDDEN, ATTENTION), "v": draw(ATTENTION, 1), "o": draw(2 * HIDDEN, 1), "k": np.zeros(1, np.float32)}

    def _run(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction. x: steps, windows, inputs."""
        steps, n, _ = x.shape
        w, u, c = (self.p[k + d] for k in "wuc")
        h, out = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            own = x[t] @ w
            own += c
            rest = h @ u
            gates = _sigmoid(own[:, :2 * HIDDEN] + rest[:, :2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(own[:, 2 * HIDDEN:] + r * rest[:, 2 * HIDDEN:])
            if keep is not None:
                keep.append((t, h, z, r, new, rest[:, 2 * HIDDEN:]))
            h = new + z * (h - new)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log odds of each window. x: steps, windows, inputs; real: which steps hold a word."""
        runs = {d: [] if keep is not None else None for d in "fb"}
        h = np.concatenate([self._run(x, d, runs[d]) for d in "fb"], axis=2)
        e = np.tanh(h @ self.p["a"])
        weight = np.where(real, (e @ self.p["v"])[:, :, 0], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pool = np.einsum("tn,tnh->nh", weight, h)
        if keep is not None:
            keep.update(h=h, e=e, weight=weight, pool=pool, runs=runs)
        return (pool @ self.p["o"])[:, 0] + self.p["k"][0]

    def gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean logistic loss of windows with labels y, and its gradients."""
        k: dict = {}
        odds = self.forward(x, real, k)
        p, n = _sigmoid(odds), len(y)
        loss = float(-(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)).mean())
        back = ((p - y) / n).astype(np.float32)[:, None]
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        g["o"], g["k"] = k["pool"].T @ back, back.sum(axis=0)
        d_pool = back @ self.p["o"].T
        share = np.einsum("nh,tnh->tn", d_pool, k["h"])
        d_weight = k["weight"] * (share - (k["weight"] * share).sum(axis=0))
        d_e = d_weight[:, :, None] * self.p["v"][:, 0] * (1 - k["e"] ** 2)
        g["v"] = np.einsum("tna,tn->a", k["e"], d_weight)[:, None]
        g["a"] = np.einsum("tnh,tna->ha", k["h"], d_e)
        d_h = k["weight"][:, :, None] * d_pool + d_e @ self.p["a"].T
        for i, d in enumerate("fb"):
            u = self.p["u" + d]
            carry = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, new, rest in reversed(k["runs"][d]):
                dh = d_h[t, :, i * HIDDEN:(i + 1) * HIDDEN] + carry
                d_new = dh * (1 - z) * (1 - new ** 2)
                d_z = dh * (h - new) * z * (1 - z)
                d_r = d_new * rest * r * (1 - r)
                own = np.concatenate([d_z, d_r, d_new], axis=1)
                inner = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g["w" + d] += x[t].T @ own
                g["c" + d] += own.sum(axis=0)
                g["u" + d] += h.T @ inner
                carry = dh * z + inner @ u.T
        return loss, g


def windows_of(inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over the inputs of a text's words: steps, windows, inputs; and which steps hold a word."""
    n = max(1, -(-max(0, len(inputs) - WINDOW) // STRIDE) + 1)
    at = np.arange(n) * STRIDE + np.arange(WINDOW)[:, None]
    real = at < max(1, len(inputs))
    held = np.vstack([inputs, np.zeros((1, INPUTS), np.float32)])
    return held[np.where(at < len(inputs), at, len(inputs))], real


@dataclass
class Model:
    evidence: Evidence
    network: Network

    def score(self, texts: list[bytes], group: int = 300) -> Iterator[float]:
        """Probability for each text: the largest over its windows."""
        for at in range(0, len(texts), group):
            split = [words_of(t) for t in texts[at:at + group]]
            known = {w: i for i, w in enumerate(set().union(*split))}
            table = self.evidence.inputs(list(known))
            # Words as row numbers; the row behind the last is padding.
            ids = [np.fromiter(map(known.__getitem__, w), np.int32, len(w)) for w in split]
            counts = [max(1, -(-max(0, len(i) - WINDOW) // STRIDE) + 1) for i in ids]
            flat = np.full(sum((c - 1) * STRIDE + WINDOW for c in counts), len(known), np.int32)
            starts, offset = [], 0
            for i, c in zip(ids, counts):
                flat[offset:offset + len(i)] = i
                starts.append(offset + np.arange(c) * STRIDE)
                offset += (c - 1) * STRIDE + WINDOW
            table = np.vstack([table, np.zeros((1, INPUTS), np.float32)])
            places = np.concatenate(starts)
            odds = np.empty(len(places), np.float32)
            for k in range(0, len(places), 4096):
                index = flat[places[k:k + 4096] + np.arange(WINDOW)[:, None]]
                real = index != len(known)
                real[0] = True
                odds[k:k + 4096] = self.network.forward(table[index], real)
            worst = np.maximum.reduceat(odds, np.concatenate([[0], np.cumsum(counts)[:-1]]))
            yield from _sigmoid(worst.astype(np.float64)).tolist()


def train(texts: list[bytes], labels: list[int], epochs: int = 14, seed: int = 5) -> Model:
    """Fit tables and network; repeated texts count once."""
    unique = dict(zip(texts, labels))
    split, y = [words_of(t) for t in unique], np.array(list(unique.values()), np.float32)
    network = Network(seed)
    evidence = Evidence.of(split, y)
    if len(y) < 10 or y.min() == y.max():
        network.p = {k: np.zeros_like(v) for k, v in network.p.items()}
        network.p["k"] += np.float32(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return Model(evidence, network)
    half = np.array([zlib.crc32(t) & 1 for t in unique])
    tables = [Evidence.of([w for w, h in zip(split, half) if h != k], y[half != k]) for k in (0, 1)]
    held = [windows_of(tables[h].inputs(w)) for w, h in zip(split, half)]
    x, real = (np.concatenate([h[i] for h in held], axis=1) for i in (0, 1))
    begin = np.concatenate([[0], np.cumsum([h[0].shape[1] for h in held])])
    rng = np.random.default_rng(seed)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.p.items()}
    step = 0
    for epoch in range(epochs):
        # The worst window of each text: by the evidence at first, then by the network.
        odds = x[:, :, :3].max(axis=(0, 2)) if not epoch else np.concatenate(
            [network.forward(x[:, k:k + 4096], real[:, k:k + 4096]) for k in range(0, x.shape[1], 4096)])
        worst = np.array([a + odds[a:b].argmax() for a, b in zip(begin, begin[1:])])
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
            _, g = network.gradients(x[:, worst[rows]], real[:, worst[rows]], y[rows])
            step += 1
            for k, v in g.items():
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                network.p[k] = network.p[k] - np.float32(0.02) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return Model(evidence, network)


def learn(docs: DataFrame, labels: DataFrame, most: int = 2500, longest: int = 20_000) -> Model:
    """Train on a bounded sample: of each label about `most` documents of up to `longest` bytes, those with the smallest
    hash of doc_id. labels: doc_id, label (0 or 1)."""
    known = labels.where("doc_id is not null and label in (0, 1)")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    spread = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 32)) / float(1 << 32)
    share = F.coalesce(*[F.when(F.col("label") == k, most / n) for k, n in counts.items()], F.lit(0.0))
    picked = F.broadcast(known.where(spread < share).select("doc_id", "label"))
    rows = texts_of(docs).where(F.octet_length("text") <= longest).join(picked, "doc_id").select("doc_id", "text", "label").collect()
    rows.sort()
    model = train([bytes(r.text) for r in rows], [int(r.label) for r in rows])
    toxic = sum(int(r.label) for r in rows)
    if 0 < toxic < len(rows):  # the sample has toxic texts more often than the corpus
        model.network.p["k"] += np.float32(np.log(counts[1] / counts[0]) - np.log(toxic / (len(rows) - toxic)))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row.

    docs: doc_id, text; other columns are ignored. Null or empty texts are one window without words. Repeated rows give
    repeated results; a null doc_id stays null; an empty table gives an empty result. The model has a fixed size.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(parts):
        def rows():
            for batch in parts:
                for doc_id, p in zip(batch["doc_id"].to_pylist(), held.value.score(batch["text"].to_pylist())):
                    yield {"doc_id": doc_id, "score": p}
        yield from batches(rows(), pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))

    return texts_of(docs).mapInArrow(score, "doc_id long, score double")
