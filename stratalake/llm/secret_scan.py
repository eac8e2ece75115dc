"""Secret scan: fixed patterns, and a small character convolutional network over every other candidate.

A candidate is a run of 16 or more CANDIDATE characters that no pattern found. The network sees it with the text around it as a window
of characters; a candidate longer than a window's inside is seen by overlapping windows and scores their maximum.

Labelled findings come from the texts themselves. Secret are the patterns' matches, and values of published key formats (``planted_secret``) put
at places of the texts without a telling word. Clean are candidates that a hand-written rule knows (``known_clean``: prose, joined words, card and phone
numbers, dates, addresses, uuids), and such values put at places too (``planted_clean``). Candidates that no rule knows are not
labelled. A second copy of every finding has its surroundings blanked. Scores are calibrated on findings kept aside; the threshold
finds a set share of the secrets among these, and recall and false findings there are part of the model.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import map_texts, stratified, uniform

KINDS = ("assign", "access", "hex", "model")
# The base patterns of the contract. A run that is too short fails as a whole, so its length can stand in the pattern.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")

BEFORE, INSIDE, AFTER = 24, 40, 16
WIDTH = BEFORE + INSIDE + AFTER
OTHER, FOREIGN, PAD = 94, 95, 96
CODES, DEPTH, FILTERS, SPAN = 97, 8, 24, 5


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' matches, in order."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidate runs that no base span overlaps."""
    found, at = [], 0
    spans = sorted((s, e) for s, _, e in base)
    for m in CANDIDATE.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        if at == len(spans) or spans[at][0] >= m.end():
            found.append(m.span())
    return found


_CODE = np.full(128, OTHER, np.uint8)
_CODE[33:127] = np.arange(94)


def window(text: str, start: int, end: int) -> bytes:
    """Character codes around a run of at most INSIDE characters: the text before, the run, the text after."""
    return _codes(text[max(0, start - BEFORE) : start], BEFORE, True) + _codes(text[start:end], INSIDE, False) + _codes(text[end : end + AFTER], AFTER, False)


def windows(text: str, start: int, end: int) -> list[bytes]:
    """The windows of a candidate: one, or if it is longer than INSIDE several that overlap by half and cover it."""
    if end - start <= INSIDE:
        return [window(text, start, end)]
    return [window(text, a, a + INSIDE) for a in (*range(start, end - INSIDE, INSIDE // 2), end - INSIDE)]


_PROSE = re.compile(r"(?:[a-z]+|[A-Z][a-z]*|[A-Z]+)?(?:[+/_.=-]+(?:[a-z]+|[A-Z][a-z]*|[A-Z]+)?)*")
_DIGITS = re.compile(r"[0-9+/_.=-]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")


def known_clean(text: str, start: int, end: int) -> bool:
    """Whether a rule knows a candidate as clean: words, numbers and dates, uuids, parts of mail and web addresses."""
    value = text[start:end]
    if any(p.fullmatch(value) for p in (_PROSE, _DIGITS, _UUID)):
        return True
    near = text[max(0, start - 12) : start]
    return near.endswith("@") or text[end : end + 1] == "@" or "://" in near or value.startswith(("www.", "//"))


_LOWER, _UPPER, _NUMBERS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Beginnings of published key formats.
KEY_BEGINNINGS = ("ghp_", "sk_live_", "xoxb-", "glpat-", "AIza", "SG.", "npm_")


def _drawn(draw: np.random.Generator, letters: str, least: int, most: int) -> str:
    return "".join(np.array(list(letters))[draw.integers(0, len(letters), int(draw.integers(least, most + 1)))])


def planted_secret(draw: np.random.Generator) -> str:
    """A value of a published key format that no pattern finds, by its form or by its length."""
    mixed = _LOWER + _UPPER + _NUMBERS
    form = int(draw.integers(5))
    if form == 0:
        return KEY_BEGINNINGS[int(draw.integers(len(KEY_BEGINNINGS)))] + _drawn(draw, mixed, 16, 40)
    if form == 1:
        return _drawn(draw, mixed, 20, 64)
    if form == 2:
        return _drawn(draw, mixed + "+/", 24, 88) + "=" * int(draw.integers(3))
    if form == 3:
        return "eyJ" + ".".join(_drawn(draw, mixed + "_-", 16, 40) for _ in range(3))
    return _drawn(draw, _LOWER + _NUMBERS, 24, 40)


def planted_clean(draw: np.random.Generator) -> str:
    """A long value that is no secret: uuid, date with time, file name, version, path, dashed number, order number."""
    word = lambda: _drawn(draw, _LOWER, 2, 9)
    number = lambda n: _drawn(draw, _NUMBERS, n, n)
    form = int(draw.integers(7))
    if form == 0:
        return "-".join(_drawn(draw, "abcdef" + _NUMBERS, n, n) for n in (8, 4, 4, 4, 12))
    if form == 1:
        return f"20{number(2)}-0{draw.integers(1, 10)}-1{number(1)}T1{number(1)}.0{number(1)}.0{number(1)}.{number(3)}Z"
    if form == 2:
        return f"{word()}_{word()}_20{number(2)}_{number(2)}.tar.gz"
    if form == 3:
        return f"{word()}-{word()}-{number(1)}.{number(2)}.{number(1)}-{word()}"
    if form == 4:
        return "/".join(word() for _ in range(3)) + f"/{word()}{number(1)}.html"
    if form == 5:
        return "-".join(number(4) for _ in range(4))
    return f"{word().upper()}-20{number(2)}-{number(8)}"


def _codes(part: str, width: int, right: bool) -> bytes:
    points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < 128, _CODE[np.minimum(points, 127)], FOREIGN).astype(np.uint8)
    filled = np.full(width, PAD, np.uint8)
    if len(codes):
        filled[width - len(codes) if right else 0 : width if right else len(codes)] = codes
    return filled.tobytes()


class Network:
    """Character embedding, one convolution with ReLU, the maximum over places, a linear output."""

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.parts = {
            "embed": draw.normal(0, 0.5, (CODES, DEPTH)), "filters": draw.normal(0, 0.3, (SPAN, DEPTH, FILTERS)),
            "shift": np.zeros(FILTERS), "out": draw.normal(0, 0.3, FILTERS), "bias": np.zeros(1),
        }
        self.parts = {k: v.astype(np.float32) for k, v in self.parts.items()}

    def logits(self, codes: np.ndarray) -> np.ndarray:
        p = self.parts
        tables = np.einsum("cd,sdf->scf", p["embed"], p["filters"])
        places = codes.shape[1] - SPAN + 1
        found = np.empty(len(codes), np.float32)
        for start in range(0, len(codes), 256):
            part = codes[start : start + 256]
            total = sum(tables[s][part[:, s : s + places]] for s in range(SPAN)) + p["shift"]
            found[start : start + 256] = np.maximum(total, 0).max(1) @ p["out"] + p["bias"]
        return found

    def train(self, codes: np.ndarray, target: np.ndarray, epochs: int = 16, batch: int = 128, rate: float = 0.01, seed: int = 5) -> None:
        draw = np.random.default_rng(seed)
        weight = np.where(target == 1, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6)).astype(np.float32)
        first, second = ({k: np.zeros_like(v) for k, v in self.parts.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(codes))
            for start in range(0, len(order), batch):
                own = order[start : start + batch]
                step += 1
                for k, g in self._gradients(codes[own], target[own], weight[own]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.parts[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def _gradients(self, codes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
        p = self.parts
        places = codes.shape[1] - SPAN + 1
        embedded = p["embed"][codes]
        total = sum(embedded[:, s : s + places] @ p["filters"][s] for s in range(SPAN)) + p["shift"]
        best = total.argmax(1)
        top = np.maximum(np.take_along_axis(total, best[:, None], 1)[:, 0], 0)
        slope = ((1 / (1 + np.exp(-(top @ p["out"] + p["bias"]))) - target) * weight / len(codes)).astype(np.float32)
        back = slope[:, None] * p["out"] * (top > 0)
        rows = np.arange(len(codes))[:, None]
        gradients = {"bias": slope.sum(keepdims=True), "out": top.T @ slope, "shift": back.sum(0), "filters": np.zeros_like(p["filters"]), "embed": np.zeros_like(p["embed"])}
        for s in range(SPAN):
            hit = codes[rows, best + s]
            gradients["filters"][s] = np.einsum("nfd,nf->df", p["embed"][hit], back)
            np.add.at(gradients["embed"], hit, back[:, :, None] * p["filters"][s].T)
        return gradients


def fit(windows: list[bytes], labels: list[int], recall: float = 0.98, least: float = 0.5) -> dict | None:
    """A trained network with its calibration and threshold; None if either label is missing.

    The threshold finds the share ``recall`` of the secrets kept aside; it is ``least``, or in the middle of what separates them from the
    highest clean one below, where that is more and the share is still found. ``recall`` and ``false`` of the model are measured aside.
    """
    codes = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)
    target = np.array(labels, np.float32)
    # Equal windows go to the same side.
    aside = np.array([zlib.crc32(w) % 4 == 0 for w in windows], bool)
    if not all(((target == y) & (aside == s)).any() for y in (0, 1) for s in (False, True)):
        return None
    blank = codes.copy()
    blank[:, :BEFORE] = PAD
    blank[:, BEFORE + INSIDE :] = PAD
    network = Network()
    network.train(np.concatenate((codes[~aside], blank[~aside])), np.concatenate((target[~aside], target[~aside])))
    held, truth = network.logits(codes[aside]).astype(float), target[aside].astype(float)
    scale, shift = _calibrate(held, truth)
    chance = 1 / (1 + np.exp(-(scale * held + shift)))
    own = np.sort(chance[truth == 1])
    highest = float(own[int(np.floor((1 - recall) * len(own)))])
    below = chance[(truth == 0) & (chance < highest)]
    middle = (highest + (float(below.max()) if len(below) else 0.0)) / 2
    threshold = min(highest, max(least, middle))
    measured = {"recall": float((own >= threshold).mean()), "false": float((chance[truth == 0] >= threshold).mean())}
    return {"network": network, "scale": scale, "shift": shift, "threshold": threshold, **measured}


def _calibrate(score: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic in the score, with smoothed targets and a weak pull to the given scores, by Newton steps of bounded length."""
    n1, n0 = truth.sum(), (1 - truth).sum()
    wanted = np.where(truth == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    rows, found = np.stack((score, np.ones_like(score)), 1), np.array([1.0, 0.0])
    for _ in range(60):
        chance = 1 / (1 + np.exp(-np.clip(rows @ found, -30, 30)))
        gradient = rows.T @ (chance - wanted) + 0.1 * (found - [1, 0])
        step = np.linalg.solve((rows * (chance * (1 - chance))[:, None]).T @ rows + 0.1 * np.eye(2), gradient)
        found = found - step * min(1.0, 0.5 / max(np.abs(step).max(), 1e-9))
    return float(max(found[0], 1e-3)), float(found[1])


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", documents: int = 12_000, findings: int = 3000) -> dict | None:
    """Fit on the findings of about ``documents`` texts drawn by a hash of their id.

    Of each of four kinds (known clean, found by patterns, planted clean, planted secret) at most half of ``findings`` are drawn by a hash of their
    window; a text gives one planted window of each label. Both are bounds of the training sample only. The windows that reach the
    driver have WIDTH bytes each. A finding longer than a window is learned by its first and last.
    """
    rows = docs.select(docs[id_column].cast("string").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    share = documents / max(rows.select("doc_id").count(), 1)
    sample = rows.where(F.col("text").isNotNull() & (uniform("doc_id", salt="secrets") < share))

    def label(texts: list) -> list:
        marked = []
        for text in texts:
            base = base_spans(text)
            spans = [(1, ASSIGN.match(text, a).start(2) if kind == 0 else a, b) for a, kind, b in base]
            spans += [(0, a, b) for a, b in candidates(text, base) if known_clean(text, a, b)]
            marked += [(kind, w) for kind, a, b in spans for w in dict.fromkeys(windows(text, a, b)[:: max(1, len(windows(text, a, b)) - 1)])]
            draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
            spaces = [m.start() for m in re.finditer(" ", text[: 1 << 16])]
            for kind, value in ((2, planted_clean(draw)), (3, planted_secret(draw))) if spaces else ():
                at = spaces[int(draw.integers(len(spaces)))]
                before, after = text[max(0, at - BEFORE) : at + 1], text[at : at + AFTER]
                shown = windows(before + value + after, len(before), len(before) + len(value))
                marked += [(kind, shown[int(draw.integers(len(shown)))])]
        return [[y for y, _ in marked], [w for _, w in marked]]

    found = map_texts(sample, ["text"], label, "label int, window binary")
    drawn = stratified(found, "label", findings // 2, "window", salt="secrets").orderBy("label", "window").collect()
    return fit([bytes(r["window"]) for r in drawn], [r["label"] % 2 for r in drawn]) if drawn else None


def find(texts: list, model: dict | None) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind number, end) of each text, in order: the base ones, and candidates the network accepts.

    What a rule knows as clean is not among them, as a network that must find nearly all secrets accepts some of it.
    """
    spans = [base_spans(t or "") for t in texts]
    if model is None:
        return spans
    asked = [(i, a, b, w) for i, t in enumerate(texts) if t for a, b in candidates(t, spans[i]) for w in windows(t, a, b)]
    if asked:
        codes = np.frombuffer(b"".join([w for *_, w in asked]), np.uint8).reshape(-1, WIDTH)
        chance = 1 / (1 + np.exp(-(model["scale"] * model["network"].logits(codes).astype(float) + model["shift"])))
        accepted = {own[:3] for own, c in zip(asked, chance) if c >= model["threshold"] and not known_clean(texts[own[0]], *own[1:3])}
        for i, a, b in accepted:
            spans[i].append((a, 3, b))
    return [sorted(s) for s in spans]


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, model: dict | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Secrets of every whole text: id, n_assign, n_access, n_hex, base_sha256, spans.

    A span is kind:start:end of the whole match, in code points, end exclusive; lists are ordered by start, then kind. The hash is of the base
    spans' list, which is empty for a null, empty or clean text. Kind ``model`` marks what the network adds. One
    row per row, repeated rows and null ids too; other columns are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def listed(ids: list, texts: list) -> list:
        spans = find(texts, shared.value)
        base = [[s for s in own if s[1] < 3] for own in spans]
        counts = [[sum(k == kind for _, k, _ in own) for own in base] for kind in range(3)]
        hashes = [hashlib.sha256(_text_of(own).encode()).hexdigest() for own in base]
        return [ids, *counts, hashes, [_text_of(own) for own in spans]]

    columns = [docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")]
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(docs, columns, listed, schema).withColumnRenamed("doc_id", id_column)


def redact(docs: DataFrame, model: dict | None, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span (overlapping ones together) replaced by ``mark``; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def replaced(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(at).to_pylist()
                made = [t if not own else _cut(t, own, mark) for t, own in zip(texts, find(texts, shared.value))]
                yield part.set_column(at, part.schema.field(at), pa.array(made, part.schema.field(at).type))

    return docs.mapInArrow(replaced, docs.schema)


def _cut(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    pieces, at = [], 0
    for start, _, end in spans:
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]])
