"""Operators on vectors and pages, against brute force."""

import base64
import gzip
import hashlib
import io
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import caps, covertree, warc

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    for c in ("row", "class", "n", "vector", "filters", "bucket", "score", "rank", "node", "a", "b", "links"):
        df = df.withColumn(c, F.lit("x"))
    return df


def clustered(seed, n=400, dim=16):
    """Vectors with copies, near copies at about the threshold, ties, and every kind of invalid row."""
    rng = np.random.default_rng(seed)
    out = []
    centres = rng.normal(size=(6, dim))
    for i in range(n):
        base = centres[rng.integers(6)] if i % 3 else rng.normal(size=dim)
        v = base / np.linalg.norm(base) + rng.normal(size=dim) * rng.choice([0, 0.02, 0.05]) * (i % 3 > 0)
        out.append((i, [float(np.float32(x)) for x in v], int(i % 2)))
    out += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * dim, 1), (n + 3, [float("nan")] + [1.0] * (dim - 1), 1), (n + 4, [None] + [1.0] * (dim - 1), 1), (n + 5, [float("inf")] + [1.0] * (dim - 1), 1), (n + 6, out[1][1], None), (n + 7, [1.0, 0.0], 1), (n + 8, [1.0, 0.0], 1), (1, out[1][1], 1), (None, out[1][1], 1)]
    return out


def valid(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize(("block", "exact", "wide"), [(512, False, False), (7, False, True), (30, True, False)])
def test_caps_equal_brute_force(spark, block, exact, wide):
    rows = clustered(1)
    table = vectors(spark, rows)
    table = table.withColumn("embedding", F.col("embedding").cast("array<double>")) if wide else table
    found = caps.near_duplicates(table, block=block, exact=exact).collect()
    ok = [valid(v) and any(v) and label is not None for _, v, label in rows]
    unit = [np.asarray(v, np.float64) / np.linalg.norm(v) if good else None for (_, v, _), good in zip(rows, ok, strict=True)]
    n = len(rows)
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    assert sum(map(len, links)) > 1000

    def component(i):
        seen, queue = {i}, [i]
        while queue:
            for j in links[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        return min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)

    expected = sorted((str(r[0]), len(links[i]), str(component(i)), r[0] == component(i)) for i, r in enumerate(rows))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found) == expected


@pytest.mark.parametrize("count", [10_000, 1_000_000, 20_000_000])
def test_cap_recall_at_the_threshold(count):
    rng = np.random.default_rng(0)
    code, least, m = caps.code(64, count), caps.least_list(count), 600
    u = rng.normal(size=(m, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=(m, 64))
    w -= (w * u).sum(1, keepdims=True) * u
    v = 0.98 * u + math.sqrt(1 - 0.98**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    lists = [[set(code.decode(s, code.least, least).tolist()) for s in code.scores(x)] for x in (u, v)]
    assert np.mean([bool(a & b) for a, b in zip(*lists, strict=True)]) >= 0.995


def test_list_decoding_is_complete():
    rng = np.random.default_rng(3)
    for blocks in (2, 4):
        words = 9
        own = caps.Code(np.eye(8), rng.normal(size=(blocks, words, 8 // blocks)), 0.4)
        x = rng.normal(size=(5, 8))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for s in own.scores(x):
            total = s[0]
            for k in range(1, blocks):
                total = np.add.outer(total, s[k])
            assert own.decode(s, 0.4, 0).tolist() == np.flatnonzero(total.reshape(-1) >= 0.4).tolist()


def test_caps_of_empty_tables(spark):
    assert caps.near_duplicates(vectors(spark, [])).count() == 0
    assert [tuple(r) for r in caps.near_duplicates(vectors(spark, [(5, None, 1)])).collect()] == [(5, 0, 5, True)]


@pytest.mark.parametrize(("block", "group", "stream"), [(None, 1024, 1 << 18), (40, 3, 5)])
def test_top_k_equals_brute_force(spark, block, group, stream):
    rows = clustered(2, 300)
    found = covertree.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, block=block, group=group, stream=stream).collect()
    own = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if valid(v) and len(v) == 16]
    expected = []
    for k, (i, q) in enumerate(own):
        if i is not None and i % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, d, strict=True)), 2**63 if j is None else j, j) for m, (j, d) in enumerate(own) if m != k)
            expected += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(scored[:5], 1)]
    assert sorted(map(str, found)) == sorted(f"Row(query_id={e[0]}, rank={e[1]}, vec_id={e[2]}, score={e[3]})" for e in expected)


def test_top_k_of_few_rows(spark):
    assert covertree.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    two = vectors(spark, [(50, [1.0, 0.5], 0), (3, [0.5, 0.5], 0), (4, [0.5, 0.5], 1)])
    assert [tuple(r) for r in covertree.top_k(two, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(50, 1, 3, 49152), (50, 2, 4, 49152)]
    assert covertree.top_k(two, F.col("vec_id") == 99).count() == 0


def searched(data, every, known=None):
    """Every `every`th vector asks all: checks the lists and gives the share of pairs that were scored."""
    rows, queries = np.arange(len(data)), data[::every]
    known = np.full(len(queries), covertree.NONE) if known is None else known
    index = covertree.tree(data)
    score, at, scored = covertree.dual_search(queries, rows[::every], data, index, rows, rows, 5, known)
    for q in range(len(queries)):
        s = (data @ queries[q]).astype(np.int64)
        order = [i for i in np.lexsort((rows, -s)) if i != every * q][:5]
        assert at[q].tolist() == order and score[q].tolist() == s[order].tolist()
    # every node's ball covers its points, and its children share them out
    for n in range(len(index.radius)):
        low, high = index.points[n]
        assert np.sqrt(((data[index.order[low:high]] - index.centre[n]) ** 2).sum(1)).max() <= index.radius[n] + 1e-9
        first, upto = index.children[n]
        assert first == upto or [low, high] == [index.points[first, 0], index.points[upto - 1, 1]]
    assert sorted(index.order.tolist()) == rows.tolist() and len(index.radius) > 1
    return scored / (len(queries) * len(data))


def test_dual_search_prunes_exactly():
    rng = np.random.default_rng(5)
    data = np.floor(rng.normal(size=(3000, 8)) * 40 + 200 * rng.normal(size=(20, 8))[rng.integers(20, size=3000)])
    assert searched(data, 30) < 0.1


def test_dual_search_prunes_clusters_of_64_components():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(512, 64))
    x = centre[rng.integers(512, size=8192)] + rng.normal(size=(8192, 64)) * 0.15
    data = covertree.quantised(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert searched(data, 50) < 0.05


def test_dual_search_of_copies_and_given_tables():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4000, 64))
    x[1000:3500] = x[0]
    data = covertree.quantised(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert searched(data, 50) <= 1
    path = "/root/testdata/sf0.1/embeddings.parquet"
    if os.path.exists(path):
        import pyarrow.parquet as pq

        given = np.asarray(pq.read_table(path).column("embedding").to_pylist(), np.float64)
        assert searched(covertree.quantised(given), 50) < 0.6


def test_trees_of_small_and_lopsided_data():
    rng = np.random.default_rng(8)
    assert len(covertree.tree(np.zeros((0, 3))).radius) == 0 and len(covertree.tree(np.ones((500, 3))).radius) == 1
    spread = 2.0 ** rng.integers(0, 16, size=(2000, 1)) * rng.normal(size=(2000, 3))  # a few points far from all others
    searched(np.floor(spread), 100)


def test_vectors_of_other_lengths_meet_their_like(spark):
    rows = [(i, [float(i % 7), 1.0, 2.0], 0) for i in range(40)] + [(100 + i, [float(i), 1.0], 0) for i in range(4)] + [(200, [1.0], 0)]
    found = covertree.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, block=7, group=2).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(found) if r.query_id == 100] == [(1, 101, 65536), (2, 102, 65536), (3, 103, 65536)]
    assert {r.query_id for r in found} == {0, 100} and all(r.vec_id < 100 for r in found if r.query_id == 0)


def test_products_of_any_size():
    big = np.asarray([[2.0**40, 3.0]])
    assert covertree.products(big, big).tolist() == [[2**63 - 1]]
    assert covertree.products(np.asarray([[2.0**30, 1.0]]), np.asarray([[2.0**30, 1.0]])).tolist() == [[2**60 + 1]]


# --- archives

PAGES = "page_id long, url string, html string"


def plain_pages(rows):
    owner = {}
    for i, _, html in rows:
        if i is not None:
            owner[html or ""] = max(i, owner.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        own = owner.get(html or "")
        revisit = own is not None and i != own
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", own if revisit else None))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7} é\r\n\r\nWARC/1.0\r\n</p>") for i in range(40)]
    rows += [(100, None, None), (101, "http://a b\r\nX: y", ""), (102, "u", "z" * 300_000), (102, "u", "z" * 300_000), (None, "u", "alone"), (None, "u", None)]
    df = spark.createDataFrame(rows, PAGES).repartition(5)
    for c in ("archive", "key", "owner", "n", "offset", "revisit", "refers_to"):
        df = df.withColumn(c, F.lit("x"))
    return rows, df


def test_archives_round_trip(spark, pages, tmp_path):
    rows, df = pages
    raw, index = warc.archive(df, folder=f"file://{tmp_path}/w")
    assert raw.agg(F.sum("records")).first()[0] == len(rows) == index.count()
    found = warc.read_records(index.select("archive").distinct())
    assert sorted(map(tuple, found.collect()), key=str) == plain_pages(rows)
    for r in raw.collect():  # one member a monolithic archive
        whole = open(r.archive.removeprefix("file://"), "rb").read()
        import zlib

        engine = zlib.decompressobj(31)
        content = engine.decompress(whole)
        assert engine.eof and not engine.unused_data
        name = os.path.basename(r.archive)
        normal = open(f"{tmp_path}/w/records/{name}", "rb").read()
        assert gzip.GzipFile(fileobj=io.BytesIO(normal)).read() == content
        for line in open(f"{tmp_path}/w/records/{name.removesuffix('.warc.gz')}.idx"):
            at, size = map(int, line.split()[:2])
            assert gzip.decompress(normal[at : at + size]).startswith(b"WARC/1.0\r\n")
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".part")]


def test_archives_in_other_stores(spark, pages, tmp_path, monkeypatch):
    """A store that pyarrow knows by another name, and one behind a mount table that only Hadoop reads."""
    rows, df = pages
    assert warc._filesystem.__globals__["SCHEMES"]["s3a"] == "s3"
    monkeypatch.setitem(warc.SCHEMES, "stub", "file")
    (tmp_path / "x").mkdir()
    out = warc._Output(f"stub://{tmp_path}/x/a.warc.gz")
    out.write(b"abc")
    out.close()
    with warc._input(f"stub://{tmp_path}/x/a.warc.gz") as file:
        assert file.read() == b"abc"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pages.link./data", f"file://{tmp_path}")
    _, index = warc.archive(df, folder="viewfs://pages/data/out")
    assert (tmp_path / "out/records").is_dir()
    assert sorted(map(str, plain_pages(rows))) == sorted(str(tuple(r)) for r in warc.read_records(index.select("archive").distinct()).collect())


def test_least_bytes_and_empty_tables(spark, pages):
    rows, df = pages
    judged = {r.page_id: r.revisit for r in warc.judge(df, least_bytes=10**6).collect()}
    assert not any(judged.values())
    raw, index = warc.archive(df.limit(0))
    assert warc.read_records(index.select("archive").distinct()).count() == 0


def test_records_stream_in_small_pieces():
    whole = b"".join(warc.record(i, "u", b"x" * i, None, False) for i in range(30))
    packed = gzip.compress(whole[:500]) + gzip.compress(whole[500:])
    pieces = (bytes([b]) for p in warc.inflated(io.BytesIO(packed)) for b in p)
    assert [warc.parse(raw)[:2] for _, raw in warc.records(pieces)] == [(i, i) for i in range(30)]
    with pytest.raises(ValueError):
        list(warc.records(iter([whole[:-9]])))
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", b"abc", None, False).replace(b"abc", b"abd"))
