"""Quality of texts by a sparse ensemble of rules.

Statistics of each text (shares of kinds of signs, repetition, lengths) go through small boosted trees. Every path from
a root to a node is a rule: a conjunction of thresholds. A logistic model with a lasso penalty keeps few of them. The
kept rules and their weights are compiled to one Spark column expression over the statistics.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.common import unused_name
from opinara.llm.token_ids import forget

STATISTICS = ["n_words", "word_bytes", "upper_share", "digit_share", "stop_share", "exclaim_share", "bar_share",
              "sign_share", "line_bytes", "distinct_share", "top_share", "repeat_share", "line_repeat_share", "short_share",
              "signed_words", "capital_words"]
_UPPER, _LOWER, _DIGIT = range(65, 91), range(97, 123), range(48, 58)
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,!|'-"]


def statistics_of(text: bytes) -> list[float]:
    """Numbers that do not depend on language; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    ink = float(len(text) - size[32] - size[9:14].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    upper, lower = float(size[65:91].sum()), float(size[97:123].sum())
    return [float(n), ink / n, upper / max(1.0, upper + lower), size[48:58].sum() / ink, (size[46] + size[44]) / n,
            size[33] / n, size[124] / n, float(size[_SIGNS].sum()) / n, ink / max(1, len(lines)), len(counts) / n,
            max(counts.values()) / n, sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)),
            sum(map((3).__ge__, map(len, words))) / n, sum(map(_SIGNED.__contains__, [w[-1] for w in words])) / n,
            sum(map(str.isupper, [chr(w[0]) for w in words])) / n]


_SIGNED = frozenset(_SIGNS) | {33, 124}


def with_statistics(docs: DataFrame, name: str = "stats") -> DataFrame:
    """`docs` (with a text column) and the column `name`, an array of STATISTICS; a null text counts as empty."""
    def compute(parts):
        forget()
        for batch in parts:
            stats = [statistics_of((t or "").encode()) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(stats, pa.list_(pa.float64()))],
                                             [*batch.schema.names, name])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(compute, schema)


#: A rule: (statistic, threshold, above) for each condition.
Rule = tuple[tuple[int, float, bool], ...]


@dataclass
class Rules:
    """Log odds = bias + weights of the rules that hold."""

    bias: float
    weights: list[float]
    rules: list[Rule]

    def score(self, stats: Column) -> Column:
        """The compiled model: probability of label 1."""
        odds = F.lit(float(self.bias))
        for weight, rule in zip(self.weights, self.rules):
            holds = F.lit(True)
            for k, cut, above in rule:
                holds = holds & ((stats[k] > cut) if above else (stats[k] <= cut))
            odds = odds + F.when(holds, F.lit(float(weight))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, cut, above in rule:
        out &= (x[:, k] > cut) == above
    return out


def _tree(x: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, depth: int, least: int):
    """Rules of all nodes of one regression tree, and its prediction."""
    rules: list[Rule] = []
    fit = np.zeros(len(x))

    def grow(rows: np.ndarray, rule: Rule, level: int) -> None:
        if rule:
            rules.append(rule)
        fit[rows] = target[rows].mean()
        if level == depth or len(rows) < 2 * least:
            return
        best, total, n = (1e-9, None, 0.0), target[rows].sum(), len(rows)
        for k in range(x.shape[1]):
            side = np.searchsorted(cuts[k], x[rows, k], side="left")  # 0..c: how many cuts lie below
            size = np.cumsum(np.bincount(side, minlength=len(cuts[k]) + 1))[:-1]
            part = np.cumsum(np.bincount(side, target[rows], len(cuts[k]) + 1))[:-1]
            ok = (size >= least) & (n - size >= least)
            gain = np.where(ok, part ** 2 / np.maximum(size, 1) + (total - part) ** 2 / np.maximum(n - size, 1) - total ** 2 / n, 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), k, cuts[k][gain.argmax()])
        if best[1] is not None:
            _, k, cut = best
            below = x[rows, k] <= cut
            grow(rows[below], (*rule, (k, float(cut), False)), level + 1)
            grow(rows[~below], (*rule, (k, float(cut), True)), level + 1)

    grow(np.arange(len(x)), (), 0)
    return rules, fit


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> Rules:
    """Rules from boosted trees on half samples, weighted by a lasso logistic model (proximal gradient)."""
    prior = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(prior / (1 - prior)))
    if len(y) < 20 or y.min() == y.max():
        return Rules(bias, [], [])
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, 40))) for k in range(x.shape[1])]
    odds, rules = np.full(len(y), bias), {}
    for _ in range(trees):
        rows = rng.permutation(len(y))[:max(20, len(y) // 2)]
        found, _ = _tree(x[rows], cuts, (y - 1 / (1 + np.exp(-odds)))[rows], depth, max(3, len(rows) // 400))
        for rule in found:
            rules.setdefault(tuple(sorted(rule)))
        leaves = np.zeros(len(y))
        for rule in (r for r in found if not any(set(r) < set(o) for o in found)):
            held = _holds(x, rule)
            if held.any():
                p = 1 / (1 + np.exp(-odds[held]))
                leaves[held] = (y[held] - p).sum() / ((p * (1 - p)).sum() + 1)
        odds += 0.3 * leaves
    names = list(rules)
    held = np.stack([_holds(x, r) for r in names], axis=1).astype(np.float64)
    mean, scale = held.mean(axis=0), held.std(axis=0)
    z = (held - mean) / np.maximum(scale, 1e-9)
    w, b = _lasso(z[:, scale > 1e-9], y, penalty)
    weights = np.zeros(len(names))
    weights[scale > 1e-9] = w / scale[scale > 1e-9]
    kept = np.flatnonzero(weights)
    return Rules(float(b - weights @ mean), weights[kept].tolist(), [names[k] for k in kept])


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 800) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps."""
    n = len(y)
    v = np.ones(z.shape[1])
    for _ in range(20):  # largest eigenvalue
        v = z.T @ (z @ v) / n
        v /= np.linalg.norm(v) + 1e-12
    rate = 4 / (np.linalg.norm(z @ v) ** 2 / n + 1)
    w = near = np.zeros(z.shape[1])
    b = near_b = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    t = 1.0
    for _ in range(steps):
        miss = 1 / (1 + np.exp(-(z @ near + near_b))) - y
        after = near - rate * (z.T @ miss) / n
        after = np.sign(after) * np.maximum(np.abs(after) - rate * penalty, 0)
        after_b = near_b - rate * miss.mean()
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        near, near_b = after + (old - 1) / t * (after - w), after_b + (old - 1) / t * (after_b - b)
        w, b = after, after_b
    return w, b


def bounded_sample(labels: DataFrame, most: int) -> DataFrame:
    """doc_id and label of about `most` rows of `labels` (doc_id, label): those with the smallest hash of doc_id."""
    known = labels.where("doc_id is not null and label is not null")
    n = known.count()
    spread = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 32)) / float(1 << 32)
    return known.where(spread < min(1.0, most / n) if n else F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, most: int = 12_000) -> Rules:
    """Fit on a sample of about `most` labelled documents. labels: doc_id, label (0 or 1)."""
    picked = F.broadcast(bounded_sample(labels, most))
    rows = with_statistics(docs.select("doc_id", "text").join(picked, "doc_id").select("text", "label")) \
        .select("stats", F.col("label").cast("int")).collect()
    rows.sort()
    return fit(np.array([r[0] for r in rows], np.float64).reshape(-1, len(STATISTICS)), np.array([r[1] for r in rows], np.float64))


def scored(docs: DataFrame, model: Rules) -> DataFrame:
    """doc_id and score of every row.

    docs: doc_id, text; other columns are ignored. A null or empty text is scored by statistics that are all 0. Repeated
    rows get equal scores; a null doc_id stays null; an empty table gives an empty result.
    """
    return with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))) \
        .select("doc_id", model.score(F.col("stats")).alias("score"))


def accepted(docs: DataFrame, model: Rules, least: float) -> DataFrame:
    """Rows of `docs` that score at least `least`, all columns unchanged."""
    name = unused_name(docs, "stats")
    return with_statistics(docs, name).where(model.score(F.col(name)) >= least).select(*[F.col(f"`{c}`") for c in docs.columns])
