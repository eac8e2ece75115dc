"""Quality classifier without labels: overlapping heuristics vote, expectation-maximisation weighs them, a scorer learns.

Each labeller says good, bad or nothing about a text. Their votes over all documents are counted by pattern (at most 3 to the number of
labellers); expectation-maximisation on these counts estimates how often each labeller is right for good and for bad texts.
The posterior of a text's pattern is its training label for a logistic scorer on hashed character trigrams and word pairs.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import map_texts, mixed, uniform, word_hashes

FEATURES = 1 << 13
SYMBOL = re.compile(r"[#*$%&|<>]")
LETTER = re.compile(r"[^\W\d_]")
# Fixed values: (bad below, good from, good to, bad above) of each labeller's measure; between them it says nothing.
LIMITS = {
    "words": (20, 50, 1e9, 1e9),
    "commonest_word": (-1, 0, 0.15, 0.3),
    "symbols_per_word": (-1, 0, 0.05, 0.3),
    "repeated_lines": (-1, 0, 0.1, 0.3),
    "word_length": (2, 3, 9, 12),
    "ended_lines": (0.1, 0.5, 1e9, 1e9),
    "distinct_words": (0.1, 0.3, 1e9, 1e9),
    "letters": (0.7, 0.85, 1e9, 1e9),
}
LABELLERS = tuple(LIMITS)


def measures(text: str) -> list[float]:
    """The labellers' measures of a text, in the order of LABELLERS."""
    words = text.split()
    n = max(len(words), 1)
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    shown = sum(map(len, words))
    return [
        len(words), max(counts.values(), default=0) / n, len(SYMBOL.findall(text)) / n, 1 - len(set(lines)) / max(len(lines), 1),
        shown / n, sum(line[-1] in ".!?\"'”»)" for line in lines) / max(len(lines), 1), len(counts) / n,
        len(LETTER.findall(text)) / max(shown, 1),
    ]


def votes(text: str | None) -> str:
    """One letter per labeller: g (good), b (bad) or n (nothing). A null or wordless text: only its length votes, bad."""
    if not text or not text.split():
        return "b" + "n" * (len(LABELLERS) - 1)
    given = []
    for value, (low, good, best, high) in zip(measures(text), LIMITS.values()):
        given.append("b" if value < low or value > high else "g" if good <= value <= best else "n")
    return "".join(given)


def estimate(patterns: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """The posterior that a text is good, by vote pattern, from all patterns' counts.

    Votes are taken as independent given the class. Starts from the majority of the votes, and keeps a small count of agreeing votes so
    that the classes cannot change places.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    count = np.array([patterns[p] for p in names], float)
    shown = np.array([[[v == c for c in "gbn"] for v in p] for p in names], float)
    margin = shown[:, :, 0].sum(1) - 2 * shown[:, :, 1].sum(1)
    good = 1 / (1 + np.exp(-margin))
    prior = np.array([[3.0, 1.0, 2.0], [1.0, 3.0, 2.0]]) * max(1.0, 0.001 * count.sum())
    for _ in range(rounds):
        share = np.clip((count * good).sum() / count.sum(), 0.01, 0.99)
        tables = []
        for weight, start in zip((count * good, count * (1 - good)), prior):
            seen = np.einsum("p,plc->lc", weight, shown) + start
            tables.append(np.log(seen / seen.sum(1, keepdims=True)))
        log_odds = np.log(share / (1 - share)) + np.einsum("plc,lc->p", shown, tables[0] - tables[1])
        good = 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))
    return dict(zip(names, good.tolist()))


def features(texts: list) -> np.ndarray:
    """Hashed character trigrams and adjacent word pairs, as roots of counts, scaled to length 1. Equal neighbours share one pair."""
    texts = [t or "" for t in texts]
    lengths = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    codes = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = owner[:-2] == owner[2:]
    grams = mixed((codes[:-2] << np.uint64(42)) ^ (codes[1:-1] << np.uint64(21)) ^ codes[2:])[inside]
    words, at = word_hashes(texts, lower=True)
    pair_owner = np.repeat(np.arange(len(texts)), np.diff(at))
    pairs = mixed(words[:-1] ^ words[1:])[pair_owner[:-1] == pair_owner[1:]] if len(words) else words
    pair_at = pair_owner[:-1][pair_owner[:-1] == pair_owner[1:]] if len(words) else pair_owner
    own = np.concatenate((owner[:-2][inside], pair_at)) * FEATURES
    hashed = np.concatenate((grams, pairs)) >> np.uint64(64 - (FEATURES.bit_length() - 1))
    table = np.bincount(own + hashed.astype(np.int64), minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)
    table = np.sqrt(table, dtype=np.float32)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-6)


def fit(rows: np.ndarray, target: np.ndarray, steps: int = 200, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer for soft labels, both classes weighing the same, by accelerated gradient steps."""
    weights, bias = np.zeros(rows.shape[1], np.float32), 0.0
    momentum, push = np.zeros_like(weights), 0.0
    mass = np.array([(1 - target).sum(), target.sum()]) + 1e-9
    share = (target / mass[1] + (1 - target) / mass[0]) / 2
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights + bias, -30, 30)))
        slope = share * (chance - target)
        momentum = 0.9 * momentum - 8.0 * (rows.T @ slope.astype(np.float32) + ridge * weights)
        push = 0.9 * push - 2.0 * float(slope.sum())
        weights, bias = weights + momentum, bias + push
    return weights, float(bias)


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bound: int = 3000) -> dict:
    """Posteriors from the votes of all documents, and a scorer fitted on at most ``bound`` texts drawn by a hash of their id.

    Half of the sample is drawn from texts whose posterior says bad, half from the others (fewer if there are fewer). What reaches the driver
    is the count of each pattern and FEATURES small numbers for each drawn text.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    voted = map_texts(rows, ["text"], lambda texts: [[votes(t) for t in texts]], "pattern string")
    patterns = {r[0]: r[1] for r in voted.groupBy("pattern").count().collect()}
    posterior = estimate(patterns)
    bad = {p for p, g in posterior.items() if g < 0.5}
    seen = [sum(n for p, n in patterns.items() if (p in bad) == side) for side in (True, False)]
    shares = [min(1.0, 0.5 * bound / max(n, 1)) for n in seen]
    draw = uniform("doc_id", salt="quality")
    shared = docs.sparkSession.sparkContext.broadcast(posterior)
    maybe = rows.withColumn("draw", F.coalesce(draw, F.lit(1.0))).where(F.col("draw") < max(shares))

    def described(draws: list, texts: list) -> list:
        own = [(d, t, shared.value.get(votes(t), 0.5)) for d, t in zip(draws, texts)]
        own = [(d, t, g) for d, t, g in own if d < shares[0 if g < 0.5 else 1]]
        if not own:
            return [[], [], []]
        packed = np.round(features([t for _, t, _ in own]) * 255).astype(np.uint8)
        return [[d for d, _, _ in own], [g for _, _, g in own], [r.tobytes() for r in packed]]

    found = map_texts(maybe, ["draw", "text"], described, "draw double, good double, bits binary", 128)
    sample = found.orderBy("draw", "good", "bits").limit(bound).collect()
    if not sample:
        return {"posterior": posterior, "weights": np.zeros(FEATURES, np.float32), "bias": 0.0}
    table = np.frombuffer(b"".join(bytes(r["bits"]) for r in sample), np.uint8).reshape(len(sample), FEATURES).astype(np.float32) / 255
    weights, bias = fit(table, np.array([r["good"] for r in sample]))
    return {"posterior": posterior, "weights": weights, "bias": bias}


def classify(docs: DataFrame, model: dict, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score every whole text: id, votes, posterior, score (0 to 1, higher is better), kept (score >= ``threshold``).

    A text without words gets score 0. A pattern that training has not seen has posterior 0.5. One row per row, repeated
    rows and null ids too; other columns are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(ids: list, texts: list) -> list:
        own = shared.value
        given = [votes(t) for t in texts]
        chance = 1 / (1 + np.exp(-np.clip(features(texts) @ own["weights"] + own["bias"], -30, 30).astype(float)))
        chance = [float(c) if t and t.split() else 0.0 for c, t in zip(chance, texts)]
        return [ids, given, [own["posterior"].get(v, 0.5) for v in given], chance, [c >= threshold for c in chance]]

    columns = [docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")]
    found = map_texts(docs, columns, rate, "doc_id long, votes string, posterior double, score double, kept boolean", 128)
    return found.withColumnRenamed("doc_id", id_column)
