"""What several of the text operators share: Arrow batches in bounded slices, the hold-out rule, word hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The characters that separate words: space and the five ASCII controls from tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Text of one slice of a batch; a single longer text makes a slice of its own.
SLICE_CHARS = 1 << 21


def map_texts(
    df: DataFrame, columns: list, function: Callable[[list], list], schema: str, slice_rows: int = 512
) -> DataFrame:
    """Apply ``function`` to slices of rows in the workers, over Arrow.

    Only ``columns`` (the text last) are sent. ``function`` gets one list per column and returns one list or
    array per column of ``schema``. A slice ends after ``slice_rows`` rows or about ``SLICE_CHARS`` characters.
    """
    names = [field.split()[0] for field in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            start = size = 0
            for end, text in enumerate(texts, 1):
                size += len(text) if text else 1
                if end == len(texts) or end - start >= slice_rows or size >= SLICE_CHARS:
                    part = batch.slice(start, end - start)
                    given = [part.column(i).to_pylist() for i in range(batch.num_columns - 1)] + [texts[start:end]]
                    made = function(*given)
                    yield pa.RecordBatch.from_pydict(
                        dict(zip(names, made, strict=True)), schema=types
                    )
                    start, size = end, 0

    types = pa.schema([(n, _arrow(t)) for n, t in (f.split(maxsplit=1) for f in schema.split(", "))])
    return df.select(*columns).mapInArrow(run, schema)


def shuffle_join(left: DataFrame, right: DataFrame, on: str | list | Column, how: str = "inner") -> DataFrame:
    """A join that is never a broadcast, whatever size Spark expects.

    For tables with a row per text or more. Before a shuffle is measured, Spark takes a table that an explode or a worker's function makes
    for about as large as what it is made from, arrays for one value each, and files for their compressed size; a broadcast by such a
    size goes through the driver. Sort-merge joins spill, and skewed ones can still be split.
    """
    return left.join(right.hint("merge"), on, how)


def _arrow(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow(name[6:-1]))
    return {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
        "binary": pa.binary(), "float": pa.float32(),
    }[name.strip()]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from every training: its id's crc32 leaves 2 on division by 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def may_learn(doc_id: str = "doc_id") -> Column:
    """Rows that training may see: not held out, and with an id."""
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def uniform(*columns: str, salt: str) -> Column:
    """A number in [0, 1) that depends only on the values, for samples that rerun alike."""
    return (F.xxhash64(F.lit(salt), *columns) % (1 << 30) + (1 << 30)) % (1 << 30) / float(1 << 30)


def stratified(df: DataFrame, label: str, per_label: int, *keys: str, salt: str) -> DataFrame:
    """Of each label the ``per_label`` rows that a hash of ``keys`` puts first; a label with fewer rows keeps all.

    Every map task keeps so many rows a label before the shuffle, so that a frequent label is no hot group.
    """
    order = Window.partitionBy(label).orderBy(uniform(*keys, salt=salt), *keys)
    return df.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= per_label).drop("_place")


def label_fractions(df: DataFrame, label: str, per_label: int, max_labels: int) -> dict:
    """For the ``max_labels`` most frequent labels, the share of rows of which about ``per_label`` are drawn."""
    counts = df.groupBy(label).count().orderBy(F.desc("count"), label).limit(max_labels).collect()
    return {r[0]: min(1.0, per_label / r[1]) for r in counts if r[0] is not None}


def drawn(df: DataFrame, label: str, fractions: dict, *keys: str, salt: str) -> DataFrame:
    """The rows whose draw falls under the fraction of their label."""
    if not fractions:
        return df.limit(0)
    pairs = [F.lit(x) for item in fractions.items() for x in item]
    return df.where(uniform(*keys, salt=salt) < F.coalesce(F.create_map(*pairs)[F.col(label)], F.lit(0.0)))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE.encode())] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        found = np.full(max(n, 1 << 22), _MIX, np.uint64)
        found[0] = 1
        _POWERS = np.multiply.accumulate(found)
    return _POWERS[:n]


# Bytes of a word above which its hash is not a polynomial.
LONG_WORD = 256


def word_hashes(texts: list, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and per text where its words start (one more entry at the end).

    Words are runs of anything but the six separators. Each is hashed as a polynomial of its bytes; prefix sums
    give the polynomial of every word at once, and multiplying by the power of its distance to the end of the
    buffer makes equal words equal wherever they stand. Words of over ``LONG_WORD`` bytes are hashed by BLAKE2b instead: such polynomials
    modulo 2^64 have known collisions from 1,024 bytes on, whatever the base.
    """
    parts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    if lower:
        raw = _LOW[raw]
    space = _IS_SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    at = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.empty(0, np.uint64), at
    power = _powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * power, dtype=np.uint64)))
    value = (sums[ends] - sums[starts]) * power[len(raw) - 1 - starts]
    found = mixed(value * _inverse(len(raw) - 1))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        found[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return found, at


def _inverse(n: int) -> np.uint64:
    """The inverse of the n-th power modulo 2^64, so that hashes do not depend on the buffer's length."""
    return np.uint64(pow(int(_MIX), -n, 1 << 64)) if n else np.uint64(1)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * _ODD + words[i : i + n]
    return mixed(total)
