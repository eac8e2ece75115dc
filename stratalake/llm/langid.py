"""Language identification with string kernels.

The kernel of two texts is the number of distinct character n-grams (n = 1 to ``ORDERS``, the blended spectrum) that
both hold, divided by the root of the product of their own numbers. Training maps a bounded labelled sample to its
kernels with landmark texts (Nyström) and solves one ridge regression per language against the rest. A text's score
is a product of its kernels with the landmarks and the coefficients. The landmarks' n-gram matrix times the
coefficients is the same for every text, so it is multiplied once and each batch of texts takes one matrix product.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import map_texts, may_learn, held_out, stratified, uniform

ORDERS = 3
# n-grams are hashed to this many features.
FEATURES = 1 << 15
# A longer text is hashed in segments, which overlap so that no n-gram is lost.
SEGMENT = 1 << 20
UNKNOWN = "und"
_SEEDS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)
_ASCII = np.full(128, 32, np.uint32)
_ASCII[97:123] = np.arange(97, 123)
_LATIN_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_LATIN_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: which features its n-grams hit. Case, and which ASCII non-letter stands where, do not count."""
    found = np.zeros((len(texts), FEATURES), bool)
    flat = found.reshape(-1)
    segments, owners = [], []
    for row, text in enumerate(texts):
        text = text.lower()
        for start in range(0, max(1, len(text)), SEGMENT):
            segments.append(f" {text[start : start + SEGMENT + ORDERS - 1]} ")
            owners.append(row)
    codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    codes = np.where(codes < 128, _ASCII[np.minimum(codes, 127)], codes)
    owner = np.repeat(np.arange(len(segments), dtype=np.int32), lengths)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep], owner[keep]
    base = np.asarray(owners, np.int64)[owner] * FEATURES
    shift = np.uint32(32 - (FEATURES.bit_length() - 1))
    value = np.full(len(codes), 0x165667B1, np.uint32)
    for n in range(1, ORDERS + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        value = (value[:size] ^ codes[n - 1 :]) * _SEEDS[0]
        value ^= value >> np.uint32(15)
        inside = owner[:size] == owner[n - 1 :]
        feature = ((value * _SEEDS[n]) >> shift).astype(np.int64)
        flat[(base[:size] + feature)[inside]] = True
    return found


def fit(bits: list[bytes], labels: list[str], landmarks: int = 192, ridge: float = 1e-2) -> dict:
    """Coefficients (features by languages), the languages in order, and the sharpness of probabilities."""
    languages = sorted(set(labels))
    if not languages:
        return {"languages": [], "weights": np.zeros((FEATURES, 0), np.float32), "sharpness": 1.0}
    rows = [np.unpackbits(np.frombuffer(b, np.uint8)).astype(np.float32) for b in bits[:landmarks]]
    chosen = np.stack([r / np.sqrt(max(r.sum(), 1)) for r in rows])
    kernels = []
    for start in range(0, len(bits), 128):
        part = np.stack([np.unpackbits(np.frombuffer(b, np.uint8)) for b in bits[start : start + 128]]).astype(np.float32)
        kernels.append((part @ chosen.T) / np.sqrt(np.maximum(part.sum(1, keepdims=True), 1)))
    kernel = np.concatenate(kernels).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[: len(rows)])
    good = values > 1e-6 * values.max()
    project = vectors[:, good] / np.sqrt(values[good])
    mapped = kernel @ project
    target = np.where(np.array(labels)[:, None] == np.array(languages), 1.0, -1.0)
    solved = np.linalg.solve(mapped.T @ mapped + ridge * len(bits) * np.eye(mapped.shape[1]), mapped.T @ target)
    scores = mapped @ solved
    own = np.argmax(target, 1)
    loss = {s: -np.log(softmax(s * scores)[np.arange(len(own)), own] + 1e-12).mean() for s in (1.0, 2.0, 4.0, 8.0, 16.0)}
    weights = chosen.T @ (project @ solved).astype(np.float32)
    return {"languages": languages, "weights": weights.astype(np.float32), "sharpness": min(loss, key=loss.get)}


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, label: str = "lang", id_column: str = "doc_id", text_column: str = "text", per_label: int = 400, bound: int = 2000) -> dict:
    """Fit on at most ``bound`` rows with a label that are not held out, and on one row of every label at least.

    Each label gets an equal share of the bound, at most ``per_label`` rows, drawn by a hash of their id, so reruns agree. Rows
    whose text has no letter are no samples; a label without others is not learned. What reaches the driver is one row of FEATURES
    bits each: more than ``bound`` only if there are more labels.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[label].cast("string").alias("label"), docs[text_column].cast("string").alias("text"))
    rows = rows.where(F.col("label").isNotNull() & may_learn())
    labels = rows.agg(F.count_distinct("label")).first()[0]
    share = max(1, min(per_label, bound // max(1, labels)))
    lettered = rows.where(F.col("text").rlike(r"\p{L}"))
    # Ids are drawn without their texts. They are no more than the sample, so sending them to all tasks is bounded as that is.
    drawn = stratified(lettered.select("label", "doc_id"), "label", share, "doc_id", salt="langid").distinct()
    found = lettered.join(F.broadcast(drawn), ["label", "doc_id"], "left_semi")
    sample = stratified(found, "label", share, "doc_id", "text", salt="langid")

    def features(ids: list, labels: list, texts: list) -> list:
        return [ids, labels, [np.packbits(r).tobytes() for r in presence([t or "" for t in texts])]]

    found = map_texts(sample, ["doc_id", "label", "text"], features, "doc_id long, label string, bits binary", 128)
    best = found.orderBy(uniform("doc_id", salt="order"), "doc_id", "label", "bits").collect()
    return fit([r["bits"] for r in best], [r["label"] for r in best])


def identify(docs: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Predict the language of every whole text: id, held_out, lang_pred, score (its probability).

    ``und`` and 0 for a null text, a text without a letter, or a model without languages. Equal scores go to the
    language first in order. One row per row; null ids are not held out; other columns are not read.
    No shuffle. The model's arrays (FEATURES by languages) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(ids: list, held: list, texts: list) -> list:
        own = shared.value
        chosen = [i for i, t in enumerate(texts) if own["languages"] and has_letter(t)]
        best, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if chosen:
            hits = presence([texts[i] for i in chosen]).astype(np.float32)
            scores = (hits @ own["weights"]) / np.sqrt(np.maximum(hits.sum(1, keepdims=True), 1))
            chance = softmax(own["sharpness"] * scores.astype(np.float64))
            for i, row in zip(chosen, chance):
                k = int(row.argmax())
                best[i], score[i] = own["languages"][k], float(row[k])
        return [ids, held, best, score]

    columns = [docs[id_column].cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), docs[text_column].cast("string").alias("text")]
    found = map_texts(docs, columns, predict, "doc_id long, held_out boolean, lang_pred string, score double", 128)
    return found.withColumnRenamed("doc_id", id_column)
