"""Near-duplicate components: b-bit MinHash signatures, a multi-index Hamming join, exact confirmation.

Texts with equal shingle sets form one class, and only classes are compared. A class has SYMBOLS minima of BITS bits each;
the distance of two signatures is the number of symbols that differ. The signature is split into CHUNKS chunks of WIDTH
symbols. If at most DISTANCE symbols differ, some chunk has at most one error (pigeonhole: DISTANCE < 2 * CHUNKS), so
both classes share a key made of that chunk with one symbol left out. Keys for all choices are enumerated, and every
pair under the distance meets in at least one. Two texts of similarity 0.8 differ in 9.6 of 48 symbols on average;
24 or more has a chance of about one in a million.

Sharing a key never means emitting all pairs. Each key's members are first compared with one hub, the one with most company over all
its keys; components of the confirmed links follow; only keys whose members still lie in different components are looked at again, and
only pairs across components. Keys with at most SMALL members pair them directly. Larger ones, such as those of a passage that many
texts share, go through an exact prefix filter: texts of that similarity share one of their rarest shingles, as many as
the similarity lets them miss and one more, in any order of rarity that is the same for all.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import map_texts, mixed, shuffle_join, window_hashes, word_hashes
from stratalake.session import work_folder

SHINGLE = 4
SYMBOLS, BITS, CHUNKS = 48, 16, 12
WIDTH = SYMBOLS // CHUNKS
DISTANCE = 2 * CHUNKS - 1
SMALL = 4
_RANDOM = np.random.default_rng(4711)
_FACTORS = _RANDOM.integers(1, 2**63, SYMBOLS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _RANDOM.integers(1, 2**63, SYMBOLS).astype(np.uint64)


def shingle_sets(texts: list, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles; fewer words than ``width`` count as one shingle."""
    words, at = word_hashes(texts, lower=True)
    found = []
    for start, end in zip(at[:-1], at[1:]):
        found.append(np.unique(window_hashes(words[start:end], max(1, min(width, end - start)))))
    return found


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """BITS bits of each of the SYMBOLS minima of every non-empty set."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    values = np.concatenate(sets)
    minima = [np.minimum.reduceat((values ^ m) * f, starts) for m, f in zip(_MASKS, _FACTORS)]
    return (mixed(np.stack(minima, 1)) >> np.uint64(64 - BITS)).astype(np.uint16)


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """Per signature, a key for every chunk and every symbol of it that may be wrong."""
    parts = symbols.reshape(len(symbols), CHUNKS, WIDTH).astype(np.uint64)
    keys = []
    for left_out in range(WIDTH):
        value = np.zeros(parts.shape[:2], np.uint64)
        for i in range(WIDTH):
            if i != left_out:
                value = (value << np.uint64(BITS)) | parts[:, :, i]
        tag = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out)
        keys.append(mixed(mixed(value) + tag))
    return np.concatenate(keys, 1)


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _features(ids: list, texts: list) -> list:
    sets = shingle_sets(texts)
    filled = [s for s in sets if len(s)]
    symbols = iter(signatures(filled)) if filled else iter(())
    return [ids, [len(s) for s in sets], [_digest(s) if len(s) else None for s in sets], [next(symbols).tolist() if len(s) else None for s in sets]]


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: int = 80) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest id reachable over links), kept (id = component_id).

    Texts link when 100 * shared shingles >= ``similarity`` * all shingles of both (80 or more; the signature's distance is set for that),
    with shingles of four words, A-Z lower-cased. Links are confirmed on full sets of 64-bit shingle hashes. A null text, or one without
    words, has no shingles and is linked with nothing. Repeated rows are equal texts, so one class, and keep their rows; several
    rows with the smallest id of a component are all kept. A null id is never a component's id unless all are null, and is not kept.
    No rows give no rows; other columns are not read.

    Texts are read once for the features, and those of candidate classes once more. All steps are shuffled joins and partial aggregations
    whose tables go to the work folder; nothing is broadcast but a measured table of components, nothing collected but row counts.
    """
    if similarity < 80:
        raise ValueError("the signature's distance covers similarities of 80 % and more")
    spark = docs.sparkSession
    folder = work_folder(spark, "neardup")
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = stored(map_texts(texts, ["doc_id", "text"], _features, "doc_id long, n long, digest binary, symbols array<int>"), "rows")
    grouped = rows.where("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("first"), F.min("symbols").alias("symbols"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")

    def spread(nodes: list, sizes: list, symbols: list) -> list:
        keys = chunk_keys(np.array(symbols, np.uint16)).astype(np.int64)
        count = keys.shape[1]
        return [keys.reshape(-1), np.repeat(nodes, count), np.repeat(sizes, count)]

    keys = _map_rows(classes, ["node", "n", "symbols"], spread, "key long, node long, n long")
    common = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = stored(shuffle_join(keys, common, "key"), "members")

    def sets_of(nodes: DataFrame, name: str) -> DataFrame:
        """node and its shingles, from the texts of the classes' first documents."""
        wanted = shuffle_join(nodes, classes, "node").select("node", "digest", "first")
        own = shuffle_join(texts, wanted.select("first").distinct(), texts["doc_id"].eqNullSafe(F.col("first")), "left_semi")
        sets = map_texts(own, ["text"], _sets, "digest binary, shingles array<long>").dropDuplicates(["digest"])
        return stored(shuffle_join(sets, wanted.select("node", "digest"), "digest").select("node", "shingles"), name)

    def prefix_pairs(nodes: DataFrame) -> DataFrame:
        """Pairs across components that share one of their rarest shingles; nodes: node, n, root."""
        tokens = shuffle_join(nodes, sets_of(nodes.select("node"), "prefix_sets"), "node").select("node", "n", "root", F.explode("shingles").alias("token"))
        rarity = tokens.groupBy("token").agg(F.count("*").alias("texts"))
        place = F.row_number().over(Window.partitionBy("node").orderBy("texts", "token"))
        prefix = shuffle_join(tokens, rarity, "token").withColumn("place", place)
        prefix = prefix.where((F.col("place") <= F.col("n") - F.ceil(F.col("n") * similarity / 100) + 1) & (F.col("texts") > 1))
        # At the first shared token, only what comes after it can be shared too; a pair that this leaves too little is no link.
        after = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
        return crossing(prefix, "token", (1 + after) * (100 + similarity) >= (F.col("n_a") + F.col("n_b")) * similarity)

    def crossing(rows: DataFrame, by: str, also=F.lit(True)) -> DataFrame:
        left = rows.select(by, F.col("node").alias("a"), *(F.col(c).alias(f"{c}_a") for c in rows.columns if c not in (by, "node")))
        right = rows.select(by, F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in rows.columns if c not in (by, "node")))
        similar = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
        return shuffle_join(left, right, by).where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & similar & also).select("a", "b")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a < b) that really link: by size, then signature distance, then full sets."""
        side = lambda k: classes.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("symbols").alias(f"s_{k}"))
        differ = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: (x != y).cast("int")), F.lit(0), lambda t, x: t + x)
        near = shuffle_join(shuffle_join(pairs, side("a"), "a"), side("b"), "b").where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity) & (differ <= DISTANCE))
        near = stored(near.select("a", "b", "n_a", "n_b"), f"{name}_near")
        sets = sets_of(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}_sets")
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = shuffle_join(shuffle_join(near, left, "a"), right, "b").withColumn("shared", F.size(F.array_intersect("x", "y")))
        return stored(both.where(F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * similarity).select("a", "b"), name)

    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    hubs = shuffle_join(members, company, "node").groupBy("key").agg(F.max_by("node", F.struct("company", "node")).alias("hub"))
    tried = shuffle_join(members, hubs, "key").where("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
    tried = stored(tried.distinct(), "tried")
    links = confirmed(tried, "hub_links")
    roots = components(links, f"{folder}/hub_roots")
    placed = stored(shuffle_join(members, roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    mixed_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    mixed_rows = stored(shuffle_join(placed, mixed_keys, "key"), "mixed")
    direct = crossing(mixed_rows.where(F.col("members") <= SMALL).select("key", "node", "n", "root"), "key")
    rest = stored(prefix_pairs(mixed_rows.where(F.col("members") > SMALL).select("node", "n", "root").distinct()), "prefix_pairs")
    fresh = stored(shuffle_join(direct.unionByName(rest).distinct(), tried, ["a", "b"], "left_anti"), "fresh")
    links = links.unionByName(confirmed(fresh, "crossing_links"))
    roots = components(links, f"{folder}/roots")
    linked = shuffle_join(roots, classes.select("node", "first", "digest"), "node")
    smallest = linked.groupBy("root").agg(F.min("first").alias("linked_id"))
    # A large component is one root; this table is expected to be large, so it is broadcast only if it is measured as small.
    linked = linked.join(smallest, "root").select("node", "linked_id")
    named = shuffle_join(classes, linked, "node", "left").select("digest", F.when(F.col("linked_id").isNotNull(), F.col("linked_id")).otherwise(F.col("first")).alias("class_id"))
    result = shuffle_join(rows.select("doc_id", "n", "digest"), named, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    return result.select(
        F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _sets(texts: list) -> list:
    sets = shingle_sets(texts)
    return [[_digest(s) for s in sets], [s.view(np.int64) for s in sets]]


def _map_rows(df: DataFrame, columns: list, function, schema: str) -> DataFrame:
    """As ``map_texts``, for a table whose last column is no text."""
    return map_texts(df, columns, function, schema, slice_rows=4096)


def components(links: DataFrame, folder: str) -> DataFrame:
    """node and root (smallest node of its component) of every node of ``links`` (a, b).

    Large-star and small-star steps in turn: each node hands its smallest neighbour to the others, until every component
    is a star. The number of steps is logarithmic; each step's edges are written, so no lineage grows.
    """
    spark = links.sparkSession
    edges, before, step = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = shuffle_join(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = shuffle_join(large, lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small.unionByName(lowest.withColumnRenamed("m", "b")).distinct().write.parquet(f"{folder}/{step}")
        edges = spark.read.schema("a long, b long").parquet(f"{folder}/{step}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if tuple(now) == before:
            break
        before, step = tuple(now), step + 1
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
