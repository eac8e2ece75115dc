"""Exact top-k inner products by term-at-a-time accumulation over blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import work_folder

BLOCK = 2048
# Query blocks that one pass over the candidates takes; the bound of what is broadcast is PASS_BLOCKS * BLOCK vectors.
PASS_BLOCKS = 16
LONG = 1 << 63
BINARIES = ("ids", "rows", "lengths", "vals")
# A score is high * 2^62 + low, so that sums beyond 64 bits are ordered right.
LOW = (1 << 62) - 1
SCORED = ("query_row", "query_id", "vec_id", "row", "high", "low")


def _quantised(vector: F.Column, vec_id: F.Column) -> F.Column:
    """floor(256 * x) of every component; one that is no 64-bit number is an error that names the row."""
    too_large = F.raise_error(F.concat(F.lit("a component of vector "), vec_id.cast("string"), F.lit(" is too large"))).cast("long")
    return F.transform(vector, lambda x: F.when(F.abs(x.cast("double")) * 256 < float(LONG), F.floor(x.cast("double") * 256)).otherwise(too_large))


def postings(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per term (component) with a weight: the rows that have it, and their weights; whole numbers of any size stay exact."""
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    rows = np.repeat(np.arange(len(vectors)), lengths)
    terms = np.concatenate([np.arange(n) for n in lengths]) if len(vectors) else rows
    weights = np.concatenate(vectors) if len(vectors) else rows
    rows, terms, weights = rows[weights != 0], terms[weights != 0], weights[weights != 0]
    order = np.argsort(terms, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    cuts = np.flatnonzero(np.diff(terms)) + 1
    return {int(t[0]): (r, w) for t, r, w in zip(np.split(terms, cuts), np.split(rows, cuts), np.split(weights, cuts)) if len(t)}


def largest(vectors: list[np.ndarray]) -> int:
    return max((int(np.abs(v.astype(object)).max()) if v.dtype == object or (v == -LONG).any() else int(np.abs(v).max()) for v in vectors if len(v)), default=0)


def block_top(rows: np.ndarray, queries: list[np.ndarray], own: np.ndarray, ids: np.ndarray, block: dict, k: int, exact: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query row the places of the k best of one candidate block, and their scores.

    The posting lists of the query's terms are scattered into a dense row of scores. With ``exact`` the scores are Python's
    integers, for blocks whose sums could leave 64 bits.
    """
    for row, vector in zip(rows.tolist(), queries):
        scores = np.zeros(len(ids), object if exact else np.int64)
        for term in np.flatnonzero(vector).tolist():
            if term in block:
                places, weights = block[term]
                gained = (weights.astype(object) if exact else weights) * int(vector[term])
                if len(places) == len(ids):
                    scores += gained
                else:
                    scores[places] += gained
        others = np.flatnonzero(own != row)
        mine = scores[others]
        if len(mine) > k and not exact:
            # Everything above the k-th score, and of those equal to it the smallest ids.
            limit = np.partition(mine, len(mine) - k)[len(mine) - k]
            others = others[mine >= limit]
        best = sorted(others.tolist(), key=lambda i: (-scores[i], ids[i], own[i]))[:k] if exact else others[np.lexsort((own[others], ids[others], -scores[others]))][:k]
        yield row, np.asarray(best, np.int64), scores[best] if len(best) else np.zeros(0, np.int64)


def exact_top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products of every query with all other rows: query_id, rank, vec_id, score.

    Components become floor(256 * x). Sums that could leave 64 bits are added up in Python's integers; a component or a
    returned score that is no 64-bit number is an error. Queries are the rows whose id is divisible by ``query_every``.
    Ties go to the smaller id; a query with fewer other rows gets all of them. Rows with a null id, or a vector that
    is null or holds null or non-finite components, take no part. Rows that share an id are rows of their own: each is a candidate of
    the others, and a query if its id is one. Missing components of a shorter (or empty) vector are 0. Other columns are not read.

    Vectors are packed into blocks of BLOCK rows in the work folder. Every pass broadcasts at most PASS_BLOCKS query
    blocks, scores them against each candidate block where it lies, and keeps k per query and block for the merge.
    """
    spark = vectors.sparkSession
    quantised = vectors.select(vectors[id_column].cast("long").alias("vec_id"), vectors[vector_column].alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    )
    numbered = quantised.select("vec_id", F.monotonically_increasing_id().alias("row"), _quantised(F.col("v"), F.col("vec_id")).alias("v"))

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kinds = [[], []], [False, True]

        def flush(kind: int) -> pa.RecordBatch:
            ids, rows, vectors = zip(*held[kind])
            values = np.concatenate([np.asarray(v, "<i8") for v in vectors])
            # Small numbers, the rule, take half the space; a reader tells by the length.
            small = not len(values) or (values.min() >= -(1 << 31) and values.max() < 1 << 31)
            parts = [np.array(ids, "<i8"), np.array(rows, "<i8"), np.array([len(v) for v in vectors], "<i4"), values.astype("<i4") if small else values]
            held[kind] = []
            return pa.RecordBatch.from_arrays([pa.array([kinds[kind]]), *[pa.array([x.tobytes()], pa.binary()) for x in parts]], names=["is_query", *BINARIES])

        for batch in batches:
            for vec_id, row, vector in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for kind in (0, 1) if vec_id % query_every == 0 else (0,):
                    held[kind].append((vec_id, row, vector))
                    if len(held[kind]) == BLOCK:
                        yield flush(kind)
        yield from (flush(kind) for kind in (0, 1) if held[kind])

    folder = work_folder(spark, "topk")
    binaries = ", ".join(f"{name} binary" for name in BINARIES)
    blocks = numbered.mapInArrow(packed, "is_query boolean, " + binaries).withColumn("block", F.monotonically_increasing_id())
    blocks.write.partitionBy("is_query").parquet(folder + "/blocks")
    stored = spark.read.schema(binaries + ", block long, is_query boolean").parquet(folder + "/blocks")
    sizes = stored.where("is_query").select("block", (F.length("ids") / 8).cast("int").alias("n")).orderBy("block")
    passes, filled = [[]], 0
    # One number per query block comes to the driver.
    for block, n in sizes.toLocalIterator():
        if filled + n > PASS_BLOCKS * BLOCK:
            passes.append([])
            filled = 0
        passes[-1].append(block)
        filled += n
    candidates = stored.where("not is_query").select(*BINARIES)
    for number, chosen in enumerate(passes):
        rows = stored.where(F.col("is_query") & F.col("block").isin(chosen)).select(*BINARIES).collect() if chosen else []
        shared = spark.sparkContext.broadcast([tuple(map(bytes, r)) for r in rows])

        def scored(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    ids, own, vectors = _block(*block)
                    terms, top = postings(vectors), largest(vectors)
                    for query in shared.value:
                        query_ids, query_rows, queries = _block(*query)
                        longest = max((len(q) for q in queries), default=0)
                        exact = top * largest(queries) * longest >= LONG
                        id_of = dict(zip(query_rows.tolist(), query_ids.tolist()))
                        found = list(block_top(query_rows, queries, own, ids, terms, k, exact))
                        best, scores = np.concatenate([b for _, b, _ in found]), np.concatenate([s for _, _, s in found])
                        asked = np.repeat([r for r, _, _ in found], [len(b) for _, b, _ in found]).astype(np.int64)
                        low = (scores & LOW).astype(np.int64)
                        columns = [asked, np.array([id_of[r] for r in asked.tolist()], np.int64), ids[best], own[best], (scores >> 62).astype(np.int64), low]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(SCORED))

        partial = candidates.mapInArrow(scored, ", ".join(f"{name} long" for name in SCORED))
        ranked = Window.partitionBy("query_row").orderBy(F.desc("high"), F.desc("low"), "vec_id", "row")
        merged = partial.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        whole = F.when(F.col("high").between(-2, 1), F.shiftleft("high", 62).bitwiseOR(F.col("low"))).otherwise(F.raise_error(F.lit("a score is no 64-bit number")).cast("long"))
        merged.select("query_id", "rank", "vec_id", whole.alias("score")).write.parquet(f"{folder}/top/pass={number}")
    return spark.read.schema("query_id long, rank int, vec_id long, score long, pass int").parquet(folder + "/top").drop("pass")


def _block(ids: bytes, rows: bytes, lengths: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    sizes = np.frombuffer(lengths, "<i4")
    flat = np.frombuffer(values, "<i8" if len(values) > 4 * sizes.sum() else "<i4").astype(np.int64)
    return np.frombuffer(ids, "<i8"), np.frombuffer(rows, "<i8"), np.split(flat, np.cumsum(sizes)[:-1])
