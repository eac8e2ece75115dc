"""Source divergence, whitening and WARC archives against brute force, and on awkward rows."""

import base64
import glob
import gzip
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratalake.llm import divergence, warc, whitening

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, str(v)) for v in r])


# --- source divergence ----------------------------------------------------------------------------


def brute_divergence(rows, min_docs, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        docs[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    found = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = {s: c for (x, s), c in counts.items() if x == lang}

        def p(count, total):
            return 1 + 10**9 * (count + 5) // (total + 5 * len(kept))

        n = {s: sum(c[t] for t in kept) for s, c in sources.items()}
        whole = {t: sum(c[t] for c in sources.values()) for t in kept}
        for a in sources:
            mine = {t: p(sources[a][t], n[a]) for t in kept}
            pairs = [(b, sum(abs(mine[t] - p(sources[b][t], n[b])) for t in kept)) for b in sources if b != a]
            terms = [(t, mine[t] - p(whole[t], sum(n.values()))) for t in kept if sources[a][t]]
            for part, items, limit in (("pair", pairs, None), ("term", [x for x in terms if x[1] > 0], top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, a, part, item, value, i) for i, (item, value) in enumerate(items[:limit], 1)]
    return found


@pytest.fixture(scope="module")
def sourced(spark):
    rng = np.random.default_rng(5)
    words = ["Aa", "aA", "bé", "x1y", "Ünï", "日本", "z" * 300, "q-q", "s", "t", "u", "v"]
    rows = [(None if i % 7 == 0 else "l%d" % (i % 2), None if i % 5 == 0 else "s%d" % (i % 4), " ".join(rng.choice(words, 9)), 1) for i in range(120)]
    rows += [("l0", "quiet", "", 1), ("l0", "quiet", None, 1), ("alone", "one", "12 34", 1), (None, None, None, None), rows[3], rows[3]]
    rows += [("l1", "long", " ".join(f"w{'abcdefgh'[i % 8]}{'xyz'[i % 3]}" for i in range(300_000)), 1)] * 2
    return spark.createDataFrame(rows, "lang string, source string, text string, no int")


@pytest.mark.parametrize("limits", [{}, {"block_postings": 20, "tile": 2, "pass_sources": 4}])
def test_divergence_equals_brute_force(sourced, limits):
    """Also with blocks that spill all the time, and with more sources than a tile or a pass takes."""
    rows = [(r["lang"], r["source"], r["text"]) for r in sourced.collect()]
    for min_docs, top in ((2, 3), (10, 50)):
        got = divergence.divergence(sourced, min_docs, top, **limits)
        assert sorted_rows(got.select("lang", "source", "part", "item", "value", "rank").collect()) == sorted_rows(brute_divergence(rows, min_docs, top))


def test_divergence_of_nothing(spark):
    schema = "lang string, source string, text string"
    assert divergence.divergence(spark.createDataFrame([], schema)).count() == 0
    rare = spark.createDataFrame([("a", "x", "one"), ("a", "y", None)], schema)
    got = [tuple(r) for r in divergence.divergence(rare).orderBy("source").collect()]
    assert got == [("a", "x", "pair", "y", 0, 1), ("a", "y", "pair", "x", 0, 1)]


def test_pieces_merge_like_sorting():
    """Runs of several blocks, cut into pieces and taken in the order of their first terms, give every term once."""
    rng = np.random.default_rng(2)
    want, docs, pieces = defaultdict(Counter), Counter(), []
    for _ in range(6):
        block = divergence.Block()
        for _ in range(40):
            terms = ["t%03d" % i for i in rng.integers(0, 6000, 200)]
            source = "s%d" % rng.integers(0, 3)
            block.add("en", source, " ".join(t.translate(str.maketrans("0123456789", "abcdefghij")) for t in terms).encode())
            for t in terms:
                want[t.translate(str.maketrans("0123456789", "abcdefghij"))][source] += 1
            docs.update({t.translate(str.maketrans("0123456789", "abcdefghij")) for t in terms})
        pieces += [p[2:] for p in block.run(1)]
    assert len(pieces) > 6
    got = list(divergence.merged(sorted(pieces, key=lambda p: p[0])))
    assert [t for t, _, _ in got] == sorted(t.encode() for t in want)
    assert all(docs[t.decode()] == n and want[t.decode()] == Counter(c) for t, n, c in got)


def test_long_texts_are_cut_between_terms():
    text = (b"ab" * 400_000 + b" ") * 3 + "é".encode() * 2_000_000 + b"7x"
    assert [len(t) for part in divergence.segments(text) for t in part] == [800_000] * 3 + [4_000_000, 1]


def test_probability_is_exact_beyond_64_bits():
    counts, totals = np.array([0, 1, 10**12, 9 * 10**14]), np.array([7, 9 * 10**15, 10**12 + 6, 9 * 10**15])
    assert divergence.probability(counts, totals).tolist() == [1 + 10**9 * (int(c) + 5) // int(t) for c, t in zip(counts, totals)]


# --- whitening ------------------------------------------------------------------------------------


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    made = (q * values) @ q.T
    return (made + made.T) / 2


@pytest.mark.parametrize(
    "values",
    [[3.0], [1.0, 1.0], np.arange(1.0, 65), 10.0 ** -np.arange(12), np.repeat([1.0, 2.0, 5.0], 8), np.r_[np.full(20, 5.0), 1 + 1e-13 * np.arange(20)]],
    ids=["one", "equal", "even", "steep", "groups", "close"],
)
def test_components_equal_eigenvectors(values):
    a = spectrum(np.asarray(values))
    found = whitening.components(a, len(a))
    size = np.abs(a).max()
    assert np.abs(found.values - np.sort(values)[::-1]).max() < 1e-13 * size
    assert np.abs(a @ found.vectors - found.vectors * found.values).max() < 1e-13 * size
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(a))).max() < 1e-13


def test_polar_factor_is_orthogonal():
    a = spectrum(np.r_[np.linspace(-3, -1e-9, 20), np.linspace(1e-9, 5, 20)])
    u = whitening.polar_factor(a)
    assert np.abs(u @ u - np.eye(40)).max() < 1e-12
    assert round(np.trace(u)) == 0


def brute_white(vectors, most=32):
    dim = max(map(len, vectors))
    x = np.array([[int(np.floor(64 * float(c))) for c in v] + [0] * (dim - len(v)) for v in vectors], object) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    apart = (x * n - sums).astype(float) / n
    values, axes = np.linalg.eigh(apart.T @ apart / n)
    return n, ((x * n - sums) ** 2).sum(axis=1).tolist(), np.abs(apart @ axes[:, ::-1] / np.sqrt(values[::-1]))[:, :most], (values[::-1] / values.sum())[:most]


def test_whitening_equals_brute_force(spark):
    df = spark.read.parquet(SMALL + "/embeddings.parquet").orderBy("vec_id")
    n, deviations, white, explained = brute_white([r["embedding"] for r in df.collect()])
    got = whitening.whiten(df).orderBy("vec_id", "component").toPandas()
    assert len(got) == n * 32 and set(got["n"]) == {n}
    assert got["deviation"][::32].tolist() == deviations
    assert np.abs(np.abs(got["whitened"].to_numpy().reshape(n, 32)) - white).max() < 1e-8
    assert np.abs(got["explained"][:32] - explained).max() < 1e-12
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10


def test_whitening_of_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, n long, whitened string"
    good = [(1, [1.0, 2.0, 3.0]), (1, [0.5, -2.0]), (None, [4.0, 1.0, -1.0]), (2, []), (2, [0.0, 9.0, 2.0]), (3, [2.0e6, 1.0, 1.0])]
    bad = [(4, None), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0]), (7, [float("inf")]), (8, [None])]
    rows = [(i, v, 1, "x") for i, v in bad[:2] + good + bad[2:]]
    got = whitening.whiten(spark.createDataFrame(rows, schema))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, deviations, white, _ = brute_white([v for _, v in good])
    first = got.where("component = 1").collect()
    assert sorted((r["vec_id"] or 0, r["deviation"]) for r in first) == sorted((i or 0, d) for (i, _), d in zip(good, deviations))
    assert sorted(round(abs(r["whitened"]), 6) for r in first) == sorted(np.round(white[:, 0], 6).tolist())
    for few in ([], bad, good[:1], good[:1] * 5, [(1, []), (2, [])]):
        assert whitening.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in few], schema)).count() == 0
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [3.0e38], 1, "x")], schema))


# --- WARC -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "u v\r\nX: y", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n"), (2, None, None), (3, "x", ""), (4, "y", "\r\n"), (5, "y", "\n"), (None, "z", "dup"), (7, "z", "dup"), (7, "z", "dup"), (9, "z", "é\n" * 900_000), (10, "z", "é\n" * 900_000), (None, None, None), (-5, "n", "only")]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, record_type string, key int")


def brute_revisits(pages, min_bytes=0):
    groups = defaultdict(list)
    for r in pages:
        groups[(r["html"] or "").encode()].append(r["page_id"])
    found = []
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i))
        code = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for place, i in enumerate(ids):
            original = len(payload) < min_bytes or place == len(ids) - 1
            found.append((i, len(payload), code, "response" if original else "revisit", None if original else ids[-1]))
    return found


@pytest.mark.parametrize("limits", [{}, {"spark__sql__autoBroadcastJoinThreshold": "-1"}], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("min_bytes", [0, 1, 4])
def test_revisits_equal_brute_force(odd_pages, settings, limits, min_bytes):
    settings(**limits)
    got = warc.resolve_pages(odd_pages, min_bytes)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted_rows(got.collect()) == sorted_rows(brute_revisits(odd_pages.collect(), min_bytes))


def parsed(folder):
    """Headers and blocks of archives by a reader of the test's own, which holds whole files."""
    for name in glob.glob(f"{folder}/*.gz"):
        raw = gzip.open(name).read()
        while raw:
            assert raw.startswith(b"WARC/1.1\r\n")
            head, _, raw = raw.partition(b"\r\n\r\n")
            fields = dict(line.decode().split(": ", 1) for line in head.split(b"\r\n")[1:])
            block, raw = raw[: int(fields["Content-Length"])], raw[int(fields["Content-Length"]) :]
            assert raw[:4] == b"\r\n\r\n"
            raw = raw[4:]
            yield fields, block


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_archives_follow_the_format(spark, odd_pages, tmp_path):
    warc.resolve_pages(odd_pages, folder=str(tmp_path)).count()
    records = list(parsed(tmp_path / "archives"))
    ids = {f["WARC-Record-ID"]: f for f, _ in records}
    assert len(ids) == len(records) == odd_pages.count()
    payloads = [block.partition(b"\r\n\r\n")[2] for f, block in records if f["WARC-Type"] == "response"]
    assert len(set(payloads)) == len(payloads) and sorted(payloads) == sorted({(r["html"] or "").encode() for r in odd_pages.collect()})
    for fields, block in records:
        assert fields["WARC-Block-Digest"] == sha1(block)
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == sha1(block.partition(b"\r\n\r\n")[2])
        else:
            original = ids[fields["WARC-Refers-To"]]
            assert original["WARC-Type"] == "response" and original["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert block.endswith(b"\r\n\r\n") and fields["WARC-Profile"] == warc.IDENTICAL
            assert fields.get("WARC-Refers-To-Target-URI") == original.get("WARC-Target-URI")
    captured = {f["WARC-Record-ID"] for f, _ in parsed(tmp_path / "captured")}
    assert not captured & set(ids)
    again = tmp_path / "again"
    warc.deduplicate(spark, str(tmp_path / "archives"), str(again))
    kinds = sorted((f["WARC-Type"], f.get(warc.KEY, ""), f.get(warc.REFERS_KEY, "")) for f, _ in records)
    assert sorted((f["WARC-Type"], f.get(warc.KEY, ""), f.get(warc.REFERS_KEY, "")) for f, _ in parsed(again)) == kinds


def test_reads_members_and_continued_fields(spark, tmp_path):
    """Archives of others: a gzip member per record, folded header lines, blocks that are no HTTP, payloads with the mark of a record."""
    made = [
        b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: a\r\n b\r\nContent-Type: text/plain\r\ncontent-length: 13\r\n\r\nWARC/1.0\r\n\r\nx\r\n\r\n",
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\xff\n\r\n\r\n",
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:3>\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, made)))
    (tmp_path / "empty.warc.gz").write_bytes(gzip.compress(b""))
    got = warc.read_archives(spark, str(tmp_path), payload=True).orderBy("record_id").collect()
    assert [(r["record_id"], r["record_type"], r["uri"], bytes(r["payload"])) for r in got] == [("1", "resource", "a b", b"WARC/1.0\r\n\r\nx"), ("2", "response", None, b"\xff\n"), ("3", "response", None, b"")]
    (tmp_path / "torn.warc.gz").write_bytes(gzip.compress(made[0][:-9]))
    with pytest.raises(Exception, match="archive ends inside a record"):
        warc.read_archives(spark, str(tmp_path)).count()


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_records_of_any_stretches(size):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"WARC/1.1\r\n\r\n" * 50
    whole = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\nX-Key: %d\r\n\r\n" % (len(block) - i, i) + block[: len(block) - i] + b"\r\n\r\n" for i in range(20))
    got = list(warc.records_of(whole[i : i + size] for i in range(0, len(whole), size)))
    assert [(h["x-key"], b) for h, b in got] == [(str(i), block[: len(block) - i]) for i in range(20)]


def test_pages_without_rows(spark):
    assert warc.resolve_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
