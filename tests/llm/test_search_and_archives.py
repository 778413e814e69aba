"""Top-k search and WARC bundles, against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampora.llm import cover_tree, warc
from ampora.llm.cover_tree import Search, build, scaled, top_k
from ampora.llm.shared_files import source
from ampora.llm.warc import Reader, fetch, read_archives, write_archives
from ampora.session import scratch_path


def brute_top(rows, k=10):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            known.setdefault(i, np.floor(np.array(v, float) * 1024).astype(np.int64))
    out = []
    for q in sorted(i for i in known if i % 100 == 0):
        scores = sorted((-int(known[q] @ known[i]), i) for i in known if i != q and len(known[i]) == len(known[q]))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    # small blocks, so that a few hundred rows make many pairs of blocks
    for name, value in (("BLOCK", 64), ("QUERY_BLOCK", 4), ("PER_PIVOT", 100)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 1, (6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(0, 0.2, 8)).astype(np.float32).tolist()) for i in range(700)]
    hot = [0.5] * 8
    rows += [(700 + i, hot) for i in range(250)]                                       # a third is one vector
    rows += [(i, None) for i in (1000, 1001)] + [(1100, [1.0] * 7 + [None]), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8),
                                                 (None, hot), (300, rows[300][1]), (1400, [0.0] * 8), (1500, [0.25] * 3), (1501, [-0.25] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(5)
    df = df.select("vec_id", scaled(F.col("embedding")).alias("vector"))
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0).collect())
    assert got == brute_top(rows)
    assert top_k(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_dual_search_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    centers = rng.normal(0, 2000, (20, 16))
    points = np.concatenate([c + rng.normal(0, 20, (100, 16)) for c in centers]).astype(np.int64)
    queries = (centers[:5] + rng.normal(0, 20, (5, 16))).astype(np.int64)
    low = np.full(len(queries), -np.iinfo(np.int64).max)
    done = Search(queries, points, np.arange(len(points)), 11, low).run()
    exact = queries @ points.T
    for i in range(len(queries)):
        assert done.found[i].tolist() == np.lexsort((np.arange(len(points)), -exact[i]))[:11].tolist()
    assert done.compared < 0.5 * exact.size


def test_cover_tree_covers():
    points = np.random.default_rng(3).integers(-1000, 1000, (500, 5))

    def check(node):
        away = np.sqrt(((points[node.rows] - node.center) ** 2).sum(1))
        assert away.max() <= node.radius * (1 + 1e-9)
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            for c in node.children:
                assert len(c.rows) < len(node.rows)
                check(c)

    check(build(points))
    assert build(points[:0]) is None


PAYLOAD = "<p>" + "x" * 97
PAGES = [(5, "http://a/", PAYLOAD), (2, None, PAYLOAD), (9, "http://c/ \r\nX: y%41", PAYLOAD), (1, "u", "short"), (3, "u", "short"), (4, "é", None),
         (6, "u", ""), (7, "u", "é" * 50), (8, "u", "é" * 50), (10, "u", "é" * 49 + "x"), (11, "u", "é" * 49 + "x"), (None, "n", PAYLOAD),
         (2, None, PAYLOAD), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 20_000)]


def expected(pages):
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == data and p is not None]
        refers = min(same) if len(data) >= 100 and same and page_id != min(same) else None
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("frame", [1, 256 << 10])
def test_archives(spark, frame, monkeypatch):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload int").repartition(3)
    folder = scratch_path(spark, "warc-test")
    index = write_archives(pages, folder).cache()
    back = read_archives(index, folder)
    rows = back.collect()
    assert sorted((tuple(r[:5]) for r in rows), key=str) == expected(PAGES)
    urls = {(r.page_id, r.url) for r in rows}
    assert urls == {(p, u) for p, u, _ in PAGES}
    for r in index.collect():
        found = fetch(folder, r.file, r.frame, r.offset, r.length)
        assert found["page_id"] == r.page_id
        if found["record_type"] == "response":
            assert found["payload"].decode() in {h or "" for p, _, h in PAGES if p == r.page_id}


def test_bundle_has_a_seek_table_and_plain_zstd_readers_can_read_it(spark):
    import zstandard

    folder = scratch_path(spark, "warc-frames")
    bundle = warc.Bundle(folder, "one.warc.zst")
    for i in range(40):
        bundle.add(i, warc.record(i, "u", bytes([i]) * 20_000, hashlib.sha256(bytes([i]) * 20_000).hexdigest(), None))
    bundle.close()
    with source(folder, "one.warc.zst") as f:
        reader = Reader(f)
        assert len(reader.frames) == 1 + len({x[1] for x in reader.records()}) > 2
        f.seek(0)
        whole = zstandard.ZstdDecompressor().stream_reader(f.read(), read_across_frames=True).read()
    assert whole.count(b"WARC-Type: response") == 40


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_digests(empty).collect() == []
