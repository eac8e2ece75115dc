"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence's chance of being toxic is logistic in the known words and beginnings of words it holds; a document's is noisy-or, one minus the
product of its sentences' chances of being clean. The weights are fitted to document labels through that product, so
the gradient reaches a sentence in the measure in which it explains its document.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import drawn, label_fractions, map_texts, may_learn, held_out, uniform

SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+\Z")
TERM = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.3
# Beginnings of longer words that are terms of their own, marked with a star.
BEGINNINGS = (4, 5)


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence; together they cover the text."""
    return [m.span() for m in SENTENCE.finditer(text)]


def terms(sentence: str) -> set[str]:
    """The distinct words of a sentence in lower case, and their starred beginnings."""
    words = set(TERM.findall(sentence.lower()))
    for n in BEGINNINGS:
        words |= {f"{w[:n]}*" for w in words if len(w) > n and w[-1] != "*"}
    return words


def fit(samples: Iterable[tuple[list[str], int]], stands_for: tuple[float, float] | None = None, min_docs: int = 4, epochs: int = 60, sparsity: float = 2e-4) -> dict:
    """Term weights and bias from (sentences as space-separated distinct terms, label), by proximal Adam steps on noisy-or.

    Each row is coded as it comes, so only numbers and one copy of each term are held. ``stands_for``: how many documents a
    row of label 0 and one of label 1 stand for.
    """
    index: dict[str, int] = {}
    seen, flat, ends, owner, labels = array("i"), array("i"), array("q"), array("i"), []
    for text_sentences, label in samples:
        in_doc = set()
        for sentence in text_sentences:
            for term in sentence.split():
                number = index.setdefault(term, len(index))
                if number == len(seen):
                    seen.append(0)
                flat.append(number)
                in_doc.add(number)
            ends.append(len(flat))
            owner.append(len(labels))
        for number in in_doc:
            seen[number] += 1
        labels.append(label)
    known = np.array(seen, np.int64) >= min_docs
    if not known.any() or len(set(labels)) < 2:
        return {"weights": {}, "bias": -12.0}
    words = sorted(w for w, i in index.items() if known[i])
    place = np.zeros(len(known), np.int32)
    place[[index[w] for w in words]] = np.arange(len(words))
    flat_ids = np.frombuffer(flat, np.int32)
    is_known = known[flat_ids]
    flat_ids = place[flat_ids[is_known]]
    instance = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(np.frombuffer(ends, np.int64), prepend=0))[is_known]
    # Sentences without a known term are clean and drop out; the others, in order already, are numbered anew.
    starts = np.diff(instance, prepend=-1) > 0
    owner_ids = np.frombuffer(owner, np.int32)[instance[starts]]
    instance, count = np.cumsum(starts, dtype=np.int32) - np.int32(1), len(owner_ids)
    del flat, is_known, starts
    amounts = [labels.count(y) * (stands_for[y] if stands_for else 1.0) for y in (0, 1)]
    prior = min(max(amounts[1] / sum(amounts), 0.02), 0.98)
    target = np.array(labels, float)
    share = np.where(target == 1, prior / max(target.sum(), 1), (1 - prior) / max((1 - target).sum(), 1))
    weights, bias = np.zeros(len(words)), -5.0
    first, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, epochs + 1):
        z = bias + np.bincount(instance, weights[flat_ids], count)
        clean = np.bincount(owner_ids, -np.logaddexp(0, z), len(labels))
        chance = np.clip(-np.expm1(clean), 1e-9, 1.0)
        # d loss / d log(clean) of a document, then through -log(1 + e^z) to its sentences.
        outer = share * np.where(target == 1, np.exp(clean) / chance, -1.0)
        slope = -outer[owner_ids] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(flat_ids, slope[instance], len(words)), slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-4)
        weights = weights - move[:-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - 0.3 * sparsity / (np.sqrt(second[:-1] / (1 - 0.99**step)) + 1e-4), 0)
        bias -= move[-1]
    kept = {w: float(x) for w, x in zip(words, weights) if abs(x) > 1e-3}
    return {"weights": kept, "bias": float(bias)}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text", per_label: int = 2500, bound: int = 5000, max_words: int = 20_000) -> dict:
    """Fit on at most ``bound`` labelled rows that are not held out, about ``per_label`` of each label.

    Rows are drawn by a hash of their id. A text of more than ``max_words`` words in all its sentences is not drawn, which bounds
    what reaches the driver; scoring reads every text whole. Several different labels of one id: it is toxic if any says so.
    """
    marks = labels.select(labels[id_column].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & may_learn()).groupBy("doc_id").agg(F.max("label").alias("label"))
    fractions = label_fractions(marks, "label", per_label, 2)
    chosen = drawn(marks, "label", fractions, "doc_id", salt="toxicity")
    chosen = chosen.orderBy(uniform("doc_id", salt="order"), "doc_id").limit(bound)
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    # The drawn ids are at most ``bound`` rows, so they may be broadcast.
    joined = texts.join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())

    def listed(ids: list, marked: list, own: list) -> list:
        return [ids, marked, [[" ".join(sorted(terms(t[a:b]))) for a, b in sentences(t)] for t in own]]

    found = map_texts(joined, ["doc_id", "label", "text"], listed, "doc_id long, label int, sentences array<string>")
    size = F.aggregate("sentences", F.lit(0), lambda a, s: a + F.length(s))
    found = found.where(size <= 20 * max_words).orderBy(uniform("doc_id", salt="order"), "doc_id", "label", "sentences").limit(bound)
    stands_for = tuple(1 / max(fractions.get(label, 1.0), 1e-12) for label in (0, 1))
    return fit(((r["sentences"], r["label"]) for r in found.toLocalIterator()), stands_for)


def rated(text: str | None, model: dict, sentence_threshold: float = 0.2) -> tuple[float, int, list[str]]:
    """A text's score, its number of sentences, and start:end of the offending ones."""
    weights, bias = model["weights"], model["bias"]
    clean, found, n = 0.0, [], 0
    for n, (start, end) in enumerate(sentences(text or ""), 1):
        known = weights.keys() & terms(text[start:end])
        if known:
            z = bias + sum(weights[w] for w in sorted(known))
            if z > -30:
                clean -= float(np.logaddexp(0.0, z))
                chance = float(1 / (1 + np.exp(-z)))
                if chance >= sentence_threshold:
                    found.append((-chance, start, end))
    return float(min(1.0, max(0.0, -np.expm1(clean)))), n, [f"{a}:{b}" for _, a, b in sorted(found)]


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD, sentence_threshold: float = 0.2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score every whole text: id, held_out, score, predicted (1 from ``threshold`` on), n_sentences, offending.

    ``offending`` lists start:end (code points) of the sentences whose own chance reaches ``sentence_threshold``, worst
    first, ties by place. A sentence without a known word is clean; null, empty and wordless texts score 0.
    One row per row; null ids are not held out; other columns are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(ids: list, held: list, texts: list) -> list:
        found = [rated(t, shared.value, sentence_threshold) for t in texts]
        return [ids, held, [f[0] for f in found], [int(f[0] >= threshold) for f in found], [f[1] for f in found], [f[2] for f in found]]

    columns = [docs[id_column].cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), docs[text_column].cast("string").alias("text")]
    schema = "doc_id long, held_out boolean, score double, predicted int, n_sentences int, offending array<string>"
    return map_texts(docs, columns, rate, schema).withColumnRenamed("doc_id", id_column)


def clean_documents(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text scores below ``threshold``; null texts stay. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def kept(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(at).to_pylist()
                yield part.filter(pa.array([rated(t, shared.value)[0] < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
