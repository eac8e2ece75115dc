"""Quality rules: measures of each text, and lines that too many documents of a host share."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import SPACE, WORD, map_texts, window_hashes, word_hashes
from stratalake.session import work_folder

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE.encode())] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_DIGITS = str.maketrans("123456789", "000000000")


def normalised(line: str) -> str:
    """A line for comparison across documents: lower case, one space between words, every digit 0."""
    return " ".join(line.lower().translate(_DIGITS).split())


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def repeated_words(words: np.ndarray, width: int = 3) -> int:
    """How many words lie in a window of ``width`` words that occurs twice or more, its first occurrence included."""
    if len(words) <= width:
        return 0
    _, place, count = np.unique(window_hashes(words, width), return_inverse=True, return_counts=True)
    often = np.flatnonzero(count[place] > 1)
    marked = np.zeros(len(words), bool)
    for i in range(width):
        marked[often + i] = True
    return int(marked.sum())


def _measured(ids: list, hosts: list, texts: list) -> list:
    texts = [t or "" for t in texts]
    hashes, at = word_hashes(texts, lower=False)
    result: list[list] = [[] for _ in range(7)]
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        shown = ~_IS_SPACE[raw] & ((raw & 0xC0) != 0x80)
        seen: set[str] = set()
        again, lines = 0, {}
        for line in text.split("\n"):
            n = len(WORDS.findall(line))
            if n:
                again += line in seen
                seen.add(line)
                key = _hash(normalised(line))
                lines[key] = lines.get(key, 0) + n
        for column, value in zip(result, (int(at[i + 1] - at[i]), int(shown.sum()), int(_IS_SYMBOL[raw].sum()), again, repeated_words(hashes[at[i] : at[i + 1]]), list(lines), list(lines.values()))):
            column.append(value)
    return [ids, hosts, [_hash(t) for t in texts], *result]


def quality_rules(
    docs: DataFrame, id_column: str = "doc_id", host_column: str = "source", text_column: str = "text", min_words: int = 50,
    max_repeat_percent: int = 50, line_docs: int = 25, left_percent: int = 30,
) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words.

    A line is over the limit if more than ``line_docs`` distinct documents of a host, and more than the square root of that host's documents, hold it
    (normalised): the limit grows with a host, its share of the host falls. Documents with equal text count once, as their copies are for
    deduplication to judge. Lines over the limit are removed; a document is depleted if less than ``left_percent`` of its words or, where
    lines were removed, fewer than ``min_words`` words are left. kept is false for depleted documents and for base failures: fewer than ``min_words`` words, or
    more than ``max_repeat_percent`` of the words in repeated windows.

    A null text is one without words, and fails. A null host is a host. Repeated rows are judged each; null ids stay.
    Other columns are not read. Lines are hashed to 64 bits and counted by (host, line) with partial sums, after distinct (host, line, text):
    a host or a line with a third of all rows is one row per task. Line counts join back by (host, line).
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "rules")
    columns = [docs[id_column].cast("long").alias("doc_id"), docs[host_column].cast("string").alias("host"), docs[text_column].cast("string").alias("text")]
    schema = "doc_id long, host string, content long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>"
    measured = map_texts(docs, columns, _measured, schema).withColumn("row", F.monotonically_increasing_id())
    measured.write.parquet(folder)
    rows = spark.read.schema(measured.schema).parquet(folder).withColumn("host", F.struct("host"))
    lines = rows.select("row", "host", "content", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("row", "host", "content", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    hosts = rows.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    often = lines.select("host", "line", "content").distinct().groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > line_docs)
    often = often.join(hosts, "host").where(F.col("docs") * F.col("docs") > F.col("host_docs")).select("host", "line")
    removed = lines.join(often, ["host", "line"]).groupBy("row").agg(F.sum("words").alias("removed"))
    judged = rows.join(removed, "row", "left").withColumn("removed_words", F.coalesce("removed", F.lit(0)))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left * 100 < F.col("n_words") * left_percent) | (left < min_words)
    return judged.select(
        F.col("doc_id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "removed_words",
    )
