"""Source divergence audit: how the words of each source differ from those of the other sources of its language."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations_with_replacement
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.session import work_folder

SCALE, SMOOTHING = 10**9, 5
# Postings that a block holds before it is spilled (about 150 bytes each), terms of one stored piece of a run.
BLOCK_POSTINGS = 400_000
PIECE_TERMS = 2048
# A text is cut into words in segments of about so many bytes.
SEGMENT = 1 << 20
# Sources of one tile of pairs, and of all tiles that one pass over the frequencies takes (this bounds the broadcast).
TILE, PASS_SOURCES = 1024, 8192
SLICE_TERMS = 1024

# Bytes outside terms become blanks: everything in ASCII but letters. All bytes of longer characters belong to terms.
_TERM_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))

RUN_SCHEMA = "shard int, lang string, first binary, terms binary, docs binary, sizes binary, names array<string>, sources binary, counts binary"
_RUN_ARROW = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary()), ("names", pa.list_(pa.string())), ("sources", pa.binary()), ("counts", pa.binary())])
FREQUENCY_SCHEMA = "lang string, term string, docs long, total long, sources array<string>, counts array<long>"
_FREQUENCY_ARROW = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("total", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_FOUND_SCHEMA = "part string, lang string, a int, b int, item string, value long"
_FOUND_ARROW = pa.schema([("part", pa.string()), ("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("item", pa.string()), ("value", pa.int64())])


def segments(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded stretch at a time; no term is cut."""
    if len(text) <= SEGMENT:
        yield text.translate(_TERM_BYTES).split()
        return
    spread, start = text.translate(_TERM_BYTES), 0
    while start < len(spread):
        end = spread.find(b" ", start + SEGMENT)
        end = len(spread) if end < 0 else end
        yield spread[start:end].split()
        start = end


class Block:
    """An index in memory: postings (term, source, count) and document counts of the rows since the last spill."""

    def __init__(self):
        self.counts: dict[str, dict[str, Counter]] = {}
        self.docs: dict[str, Counter] = {}
        self.postings = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        docs = self.docs.setdefault(lang, Counter())
        before = len(counts) + len(docs)
        seen: set[bytes] = set()
        for terms in segments(text):
            counts.update(terms)
            seen.update(terms)
        docs.update(seen)
        self.postings += len(counts) + len(docs) - before

    def run(self, shards: int) -> Iterator[tuple]:
        """The block as a term-sorted run, cut into pieces of one shard, one language and at most PIECE_TERMS terms."""
        for lang, docs in self.docs.items():
            terms = sorted(docs)
            place = dict(zip(terms, range(len(terms))))
            names = list(self.counts[lang])
            rows = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in self.counts[lang].values()])
            sources = np.repeat(np.arange(len(names), dtype="<i4"), [len(c) for c in self.counts[lang].values()])
            counts = np.concatenate([np.fromiter(c.values(), "<i8", len(c)) for c in self.counts[lang].values()])
            order = np.argsort(rows, kind="stable")
            sources, counts = sources[order], counts[order]
            sizes = np.bincount(rows, minlength=len(terms)).astype("<i4")
            starts = np.concatenate(([0], np.cumsum(sizes)))
            seen = np.fromiter(map(docs.__getitem__, terms), "<i8", len(terms))
            shard_of = np.fromiter((zlib.crc32(t) % shards for t in terms), np.int32, len(terms))
            by_shard = np.argsort(shard_of, kind="stable")
            for own in np.split(by_shard, np.flatnonzero(np.diff(shard_of[by_shard])) + 1):
                for at in range(0, len(own), PIECE_TERMS):
                    part = own[at : at + PIECE_TERMS]
                    taken = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in part])
                    held = [terms[i] for i in part]
                    yield (int(shard_of[part[0]]), lang, held[0], b" ".join(held), seen[part].tobytes(), sizes[part].tobytes(), names, sources[taken].tobytes(), counts[taken].tobytes())


def _runs(shards: int, block_postings: int):
    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()

        def spilled() -> Iterator[pa.RecordBatch]:
            pieces: list[tuple] = []
            size = 0
            for piece in block.run(shards):
                pieces.append(piece)
                size += len(piece[3]) + len(piece[8])
                if size > 1 << 24 or len(pieces) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pieces), _RUN_ARROW)], schema=_RUN_ARROW)
                    pieces, size = [], 0
            if pieces:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pieces), _RUN_ARROW)], schema=_RUN_ARROW)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for lang, source, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    block.add(lang, source, text)
                    if block.postings >= block_postings:
                        yield from spilled()
                        block = Block()
        yield from spilled()

    return index


def merged(pieces: Iterable[tuple]) -> Iterator[tuple[bytes, int, dict[str, int]]]:
    """(term, docs, counts by source) in term order, from pieces of one language in the order of their first terms.

    A heap holds the next term of every open piece. Terms below the first term of the next piece are complete, so a run
    has one piece open at a time.
    """
    heap: list[tuple] = []

    def below(limit: bytes | None) -> Iterator[tuple[bytes, int, dict[str, int]]]:
        while heap and (limit is None or heap[0][0] < limit):
            term, docs, counts = heap[0][0], 0, {}
            while heap and heap[0][0] == term:
                _, number, i, at, piece = heap[0]
                terms, seen, sizes, names, sources, own = piece
                docs += seen[i]
                end = at + sizes[i]
                for j in range(at, end):
                    name = names[sources[j]]
                    counts[name] = counts.get(name, 0) + own[j]
                if i + 1 < len(terms):
                    heapq.heapreplace(heap, (terms[i + 1], number, i + 1, end, piece))
                else:
                    heapq.heappop(heap)
            yield term, docs, counts

    for number, (first, terms, docs, sizes, names, sources, counts) in enumerate(pieces):
        yield from below(first)
        opened = (terms.split(b" "), np.frombuffer(docs, "<i8").tolist(), np.frombuffer(sizes, "<i4").tolist(), names, np.frombuffer(sources, "<i4").tolist(), np.frombuffer(counts, "<i8").tolist())
        heapq.heappush(heap, (first, number, 0, 0, opened))
    yield from below(None)


def _merge(min_docs: int):
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    yield from zip(*(part.column(i).to_pylist() for i in range(9)))

        def batched(kept: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), _FREQUENCY_ARROW)], schema=_FREQUENCY_ARROW)

        kept: list[tuple] = []
        postings = 0
        following = rows()
        piece = next(following, None)
        while piece is not None:
            own = piece[:2]

            def same(first=piece, own=own) -> Iterator[tuple]:
                nonlocal piece
                piece = first
                while piece is not None and piece[:2] == own:
                    yield piece[2:]
                    piece = next(following, None)

            for term, docs, counts in merged(same()):
                if docs >= min_docs:
                    kept.append((own[1], term.decode("utf-8", "replace"), docs, sum(counts.values()), list(counts), list(counts.values())))
                    postings += len(counts)
                    if postings > 200_000:
                        yield batched(kept)
                        kept, postings = [], 0
        if kept:
            yield batched(kept)

    return merge


def frequencies(docs: DataFrame, min_docs: int = 30, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """lang, term, docs, total, and counts by source, of every term that ``min_docs`` documents of its language hold.

    ``docs`` has lang, source (not null) and text as bytes. Each task indexes its rows once into blocks in memory; a full block is
    spilled as a term-sorted run, whose pieces are shuffled by the hash of the term. Each shard gets the pieces in the order
    of their first terms and merges them with a heap. A term is one entry of a run, however often it occurs.
    """
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.mapInArrow(_runs(shards, block_postings), RUN_SCHEMA)
    sharded = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang", "first")
    return sharded.mapInArrow(_merge(min_docs), FREQUENCY_SCHEMA)


def probability(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / total), exactly, in 64 bits for totals up to 9 * 10^15."""
    whole, rest = np.divmod(counts + SMOOTHING, total)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + step
    return whole + 1


class Tile(NamedTuple):
    """Sources of a language: their first number, and their p-totals (N + SMOOTHING * V)."""

    first: int
    totals: np.ndarray

    def dense(self, rows: np.ndarray, sources: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        made = np.zeros((n, len(self.totals)), np.int64)
        own = (sources >= self.first) & (sources < self.first + len(self.totals))
        made[rows[own], sources[own] - self.first] = counts[own]
        return made


def corrections(a: Tile, b: Tile, in_a: np.ndarray, in_b: np.ndarray) -> np.ndarray:
    """Sum over terms of |p - q| less its value for a term that neither source has; rows are sources of a, columns of b.

    Only terms that one of the two has are looked at: those of each source of a, then of each source of b those that a lacks.
    """
    p, q = probability(in_a, a.totals), probability(in_b, b.totals)
    zero_p, zero_q = probability(np.zeros_like(a.totals), a.totals), probability(np.zeros_like(b.totals), b.totals)
    found = np.zeros((len(a.totals), len(b.totals)), np.int64)
    for i in range(len(a.totals)):
        rows = np.flatnonzero(in_a[:, i])
        if len(rows):
            found[i] += (np.abs(p[rows, i, None] - q[rows]) - np.abs(zero_p[i] - zero_q)).sum(axis=0)
    for j in range(len(b.totals)):
        rows = np.flatnonzero(in_b[:, j])
        if len(rows):
            change = np.abs(q[rows, j, None] - p[rows]) - np.abs(zero_q[j] - zero_p)
            found[:, j] += np.where(in_a[rows] == 0, change, 0).sum(axis=0)
    return found


def _stream(shared, top: int):
    """Streams the frequencies once: adds up the corrections of every tile pair and keeps each source's top terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        sums: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            lang_of = np.array(langs, object)
            lists = batch.column(3)
            offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            flat = lists.flatten().dictionary_encode()
            values = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            totals, terms = batch.column(2).to_numpy(), batch.column(1).to_pylist()
            for lang in set(langs) & set(plan):
                numbers, lang_total, tiles, pairs = plan[lang]
                number_of = np.array([numbers.get(s, -1) for s in flat.dictionary.to_pylist()], np.int64)
                own = np.flatnonzero(lang_of == lang)
                for at in range(0, len(own), SLICE_TERMS):
                    part = own[at : at + SLICE_TERMS]
                    places = np.concatenate([np.arange(offsets[i], offsets[i + 1]) for i in part])
                    rows = np.repeat(np.arange(len(part)), [offsets[i + 1] - offsets[i] for i in part])
                    sources, counts = number_of[flat.indices.to_numpy()[places]], values[places]
                    dense = {k: tile.dense(rows, sources, counts, len(part)) for k, tile in tiles.items()}
                    for k, m in pairs:
                        found = corrections(tiles[k], tiles[m], dense[k], dense[m])
                        sums[lang, k, m] = sums[lang, k, m] + found if (lang, k, m) in sums else found
                    wide = probability(totals[part], np.int64(lang_total))
                    for k in {k for k, m in pairs if k == m}:
                        yield from _tops(lang, tiles[k], dense[k], wide, [terms[i] for i in part], top)
        for (lang, k, m), found in sums.items():
            first, second = plan[lang][2][k].first, plan[lang][2][m].first
            for start in range(0, len(found), 64):
                i, j = np.nonzero(found[start : start + 64])
                i = i + start
                keep = first + i < second + j
                i, j = i[keep], j[keep]
                n = len(i)
                yield pa.RecordBatch.from_arrays([pa.array(["pair"] * n, pa.string()), pa.array([lang] * n, pa.string()), pa.array(first + i, pa.int32()), pa.array(second + j, pa.int32()), pa.nulls(n, pa.string()), pa.array(found[i, j], pa.int64())], schema=_FOUND_ARROW)

    return run


def _tops(lang: str, tile: Tile, counts: np.ndarray, wide: np.ndarray, terms: list[str], top: int) -> Iterator[pa.RecordBatch]:
    """Of one slice of terms, each source's ``top`` terms whose p exceeds that of the language."""
    over = np.where(counts > 0, probability(counts, tile.totals) - wide[:, None], 0)
    encoded = [t.encode() for t in terms]
    for i in range(over.shape[1]):
        rows = np.flatnonzero(over[:, i] > 0).tolist()
        if not rows:
            continue
        own = over[:, i].tolist()
        best = heapq.nsmallest(top, rows, key=lambda r: (-own[r], encoded[r]))
        n = len(best)
        yield pa.RecordBatch.from_arrays([pa.array(["term"] * n), pa.array([lang] * n), pa.array([tile.first + i] * n, pa.int32()), pa.nulls(n, pa.int32()), pa.array([terms[r] for r in best]), pa.array([own[r] for r in best], pa.int64())], schema=_FOUND_ARROW)


def _passes(langs: list[tuple[str, int]], tile: int, pass_sources: int) -> Iterator[list[tuple[str, int, int]]]:
    """Tile pairs (lang, a, b) with a <= b, gathered while their sources number at most ``pass_sources``."""
    chosen: list[tuple[str, int, int]] = []
    held = 0
    for lang, n in langs:
        for a, b in combinations_with_replacement(range(-(-n // tile)), 2):
            size = min(n, 2 * tile)
            if chosen and held + size > pass_sources:
                yield chosen
                chosen, held = [], 0
            chosen.append((lang, a, b))
            held += size
    if chosen:
        yield chosen


def _plan(groups: DataFrame, chosen: list[tuple[str, int, int]], tile: int) -> dict[str, tuple]:
    """What one pass needs of each language: numbers of the sources, the language's p-total, the tiles and the tile pairs."""
    plan = {}
    for lang in dict.fromkeys(x for x, _, _ in chosen):
        pairs = [(a, b) for x, a, b in chosen if x == lang]
        held: dict[int, list] = {k: [] for k in sorted({k for pair in pairs for k in pair})}
        number = F.floor(F.col("no") / tile)
        for row in groups.where((F.col("lang") == lang) & number.isin(*held)).orderBy("no").collect():
            held[row["no"] // tile].append(row)
        tiles = {k: Tile(rows[0]["no"], np.array([r["n"] + SMOOTHING * r["v"] for r in rows], np.int64)) for k, rows in held.items()}
        every = [r for rows in held.values() for r in rows]
        plan[lang] = ({r["source"]: r["no"] for r in every}, every[0]["lang_n"] + SMOOTHING * every[0]["v"], tiles, pairs)
    return plan


def _base(total: Column) -> Column:
    """p of a term that the source lacks."""
    return F.call_function("div", F.lit(SCALE * SMOOTHING).cast("long"), total) + 1


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, block_postings: int = BLOCK_POSTINGS, tile: int = TILE, pass_sources: int = PASS_SOURCES) -> DataFrame:
    """Distances between the sources of a language and the terms that mark each: lang, source, part, item, value, rank.

    Part ``pair`` has, for each source, all other sources of its language by the sum of |p - q| over the language's terms;
    part ``term`` the ``top`` terms with p above that of the whole language. p is 1 + floor(10^9 * (count + 5) / (N + 5 * V)) in whole numbers.
    Ranks go by falling value, ties by the bytes of the item.

    Null lang, source and text count as ''. Empty texts make their source occur. A language without terms in ``min_docs``
    documents has pairs of value 0 and no terms; a source alone in its language has no pairs. Repeated rows count each; no
    rows give no rows; other columns are not read.

    A hot source, language or term is one posting per run. Sources are numbered by a window over one row per source;
    pairs are added up in tiles of ``tile`` sources, so what one pass broadcasts stays under ``pass_sources`` names and numbers,
    and a text with very many different terms is the only thing that can exceed a block.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "divergence")
    given = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    frequencies(given.withColumn("text", F.col("text").cast("binary")), min_docs, block_postings).write.parquet(folder + "/frequencies")
    counted = spark.read.schema(FREQUENCY_SCHEMA).parquet(folder + "/frequencies")
    occurring = given.select("lang", "source").distinct()
    totals = counted.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    kept = counted.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.lit(0).cast("long")
    groups = occurring.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").select(
        "lang", "source", number.alias("no"), *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "lang_n")]
    )
    groups.write.parquet(folder + "/groups")
    groups = spark.read.schema("lang string, source string, no int, n long, v long, lang_n long").parquet(folder + "/groups")

    langs = [(r[0], r[1]) for r in groups.where("v > 0").groupBy("lang").agg(F.max("no") + 1).orderBy("lang").collect()]
    streamed = counted.select("lang", "term", "total", "sources", "counts")
    for step, chosen in enumerate(_passes(langs, tile, pass_sources)):
        plan = _plan(groups, chosen, tile)
        shared = spark.sparkContext.broadcast(plan)
        streamed.where(F.col("lang").isin(*plan)).mapInArrow(_stream(shared, top), _FOUND_SCHEMA).write.parquet(f"{folder}/found/pass={step}")
    if not langs:
        spark.createDataFrame([], _FOUND_SCHEMA).write.parquet(f"{folder}/found/pass=0")
    found = spark.read.schema(_FOUND_SCHEMA + ", pass int").parquet(folder + "/found")

    one, two = groups.alias("one"), groups.alias("two")
    both = one.join(two, (F.col("one.lang") == F.col("two.lang")) & (F.col("one.no") < F.col("two.no")))
    total = [F.col(f"{x}.n") + SMOOTHING * F.col(f"{x}.v") for x in ("one", "two")]
    apart = F.when(F.col("one.v") > 0, F.col("one.v") * F.abs(_base(total[0]) - _base(total[1]))).otherwise(zero)
    both = both.select(F.col("one.lang").alias("lang"), F.col("one.no").alias("a"), F.col("two.no").alias("b"), F.col("one.source").alias("x"), F.col("two.source").alias("y"), apart.alias("apart"))
    sums = found.where("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("change"))
    pairs = both.join(sums, ["lang", "a", "b"], "left").withColumn("value", F.col("apart") + F.coalesce("change", zero))
    ways = F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item")))
    pairs = pairs.select("lang", F.inline(ways), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    named = groups.select("lang", F.col("no").alias("a"), "source")
    marks = found.where("part = 'term'").select("lang", "a", "item", "value")
    first = Window.partitionBy("lang", "a").orderBy(F.desc("value"), "item")
    marks = marks.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top).join(named, ["lang", "a"])
    return pairs.unionByName(marks.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
