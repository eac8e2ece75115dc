"""Best-fit decreasing packing of documents into token windows, in groups of bounded size."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import map_texts
from stratalake.llm.word_tokens import encoder
from stratalake.session import work_folder

# Rest pieces that one task packs together; a group holds about 40 bytes for each.
GROUP_PIECES = 8192


class OpenWindows:
    """A segment tree over remaining capacities: leaf c counts the open windows with c free tokens."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the tightest open window with at least ``need`` free tokens."""
        node = need + self.size
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._add(capacity, -1)
        return capacity, self.windows[capacity].pop()

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.size
        while node:
            self.tree[node] += change
            node >>= 1


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each length (1 to ``window``), longest first, ties by position."""
    number, offset = [0] * len(lengths), [0] * len(lengths)
    open_windows, made = OpenWindows(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_windows.take(lengths[i])
        if found is None:
            capacity, number[i] = window, made
            made += 1
        else:
            capacity, number[i] = found
        offset[i] = window - capacity
        if capacity > lengths[i]:
            open_windows.put(capacity - lengths[i], number[i])
    return number, offset


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    window: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    A document's tokens are those of its whole text and ``end_id``. It is cut into full windows, each a sequence of
    its own, and a rest; rests are packed best-fit decreasing, in groups of about ``group_pieces`` of them. Returns per piece:
    id, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset. Pieces
    of a sequence lie one after another from offset 0.

    A null or empty text is the one token ``end_id``. Every row counts, repeated rows and null ids too; ties in
    length go by the order of rows in the written piece table. No rows give no rows; other columns are not read.

    The text is encoded once, without a shuffle; only the pieces' numbers are written to the work folder, and the
    rests' shuffled. Groups are by a row number's hash, so neither a source nor a repeated id makes a group large.
    """
    spark = docs.sparkSession
    final = int(end_id).to_bytes(4, "little")

    def cut(ids: list, texts: list) -> list:
        rows: list[tuple] = []
        for doc_id, tokens in zip(ids, encoder(vocabulary_path).encode(texts)):
            tokens += final
            total = len(tokens) // 4
            for start in range(0, total, window):
                piece = tokens[4 * start : 4 * (start + window)]
                rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
        return [list(column) for column in zip(*rows)]

    columns = [docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text")]
    folder = work_folder(spark, "pack")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    map_texts(docs, columns, cut, schema).withColumn("piece", F.monotonically_increasing_id()).write.parquet(folder)
    pieces = spark.read.schema(f"{schema}, piece long").parquet(folder)
    full = pieces.where(F.col("length") == window).select(
        "*", (F.col("piece") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < window)
    groups = max(1, round(rest.count() / group_pieces))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece")
        number, offset = best_fit_decreasing(rows["length"].tolist(), window)
        group = int(rows["group"].iloc[0])
        rows["sequence_id"] = (np.array(number, np.int64) + (group << 32)) * 2 + 1
        rows["offset"] = np.array(offset, np.int64)
        return rows.drop(columns="group")

    placed = (
        rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(place, f"{schema}, piece long, sequence_id long, offset long")
    )
    return full.unionByName(placed).drop("piece").withColumnRenamed("doc_id", id_column)
