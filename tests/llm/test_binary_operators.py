"""WARC ranges, alias components and the tile join against plain versions."""

import random
import uuid
import zlib

import numpy as np
from pyspark.sql import functions as F

from quartermart.llm import warc
from quartermart.llm.nearest import nearest
from quartermart.llm.url_filter import Rule, judge


def folder(spark):
    return f"{spark.sparkContext.getCheckpointDir()}/test-{uuid.uuid4().hex}"


def test_every_split_size_reads_the_same_records(spark):
    r = random.Random(8)
    pages = [(i, f"http://h/{i}", "".join(r.choice("abcdefgh <>\né") for _ in range(r.choice([0, 30, 700, 9000])))) for i in range(60)]
    pages += [(100 + i, None, pages[i % 7][2] + "z" * 1000) for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = folder(spark)
    warc.write_archives(df.coalesce(2), path)
    payload = {i: h.encode() for i, _, h in pages}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in (997, 4099, 65536, 1 << 27):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            rows = warc.read_archives(spark, path).collect()
            assert sorted(x.page_id for x in rows) == sorted(payload)
            for x in rows:
                if x.record_type == "response":
                    assert bytes(x.payload) == payload[x.page_id]
                assert x.payload_bytes == len(payload[x.page_id])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_archives_are_plain_gzip_members(spark):
    import gzip

    path = folder(spark)
    rows = [(1, "u", "a" * 2000), (2, "u", "a" * 2000), (3, "u", None)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).where("path like '%part-%'").collect())
    text = gzip.decompress(data).decode()
    assert text.count("WARC/1.1\r\n") == 3 and text.count("WARC-Type: revisit") == 1


def stored(block, level=0):
    z = zlib.compressobj(level, wbits=31)
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{len(block)}>\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    return z.compress(head + block + b"\r\n\r\n") + z.flush()


def test_magic_inside_members_is_no_record():
    """Stored members full of the magic, cut into ranges at every place: each record once, whole."""
    members = [stored(warc.GZIP_MAGIC * k + bytes([k]) * 50) for k in (1, 5, 2)] + [stored(b"plain", 6)]
    data = b"".join(members)
    want = sorted([1 * 3 + 50, 5 * 3 + 50, 2 * 3 + 50, 5])
    for size in (40, 64, 101, 1000):
        rows, cuts = [], list(range(0, len(data), size)) + [len(data)]
        starts = [i for i in range(len(data)) if data.startswith(warc.GZIP_MAGIC, i)]
        for lo, hi in zip(cuts, cuts[1:]):  # a separator that begins in a range opens a row of it
            if lo == 0:
                rows.append((data[:starts[0]], "f", 0))
            for s, e in zip(starts, starts[1:] + [len(data)]):
                if lo < s <= hi or s == lo == 0:
                    rows.append((data[s + 3:e], "f", lo))
        found = list(warc._scan(iter(rows), True))
        done = [x[4] for x in found if x[0]]
        pieces = sorted((x for x in found if x[10] is not None), key=lambda x: (x[8], x[9]))
        member = None
        for x in pieces:
            if member is None and warc._is_record(x[10]):
                member = warc._Member()
            if member and member.add(x[10]):
                done.append(warc._parse(b"".join(member.out), True)[4])
                member = None
        assert sorted(done) == want, size


def test_large_records_keep_the_format():
    block = np.random.default_rng(1).bytes(17_000_000)
    m = warc._member(["WARC-Type: resource"], block, 1)
    assert m[-1] == 0 and block in zlib.decompressobj(31).decompress(m)


def test_aliases_inherit_decisions(spark):
    """Chains of canonical links and redirects; an explicit allow goes before a block."""
    def canonical(to):
        return f'<html><LINK href="{to}" rel="canonical"></html>'

    def refresh(to):
        return f'<meta http-equiv="refresh" content="0; url={to}">'

    rows = [(1, "http://a.io/x", canonical("http://b.io/y")), (2, "http://b.io/y", refresh("http://bad.net/z")), (3, "http://bad.net/z", ""),
            (4, "http://c.io/", refresh("//good.org/fr/p")), (5, "http://d.io/q", canonical("http://c.io/") + canonical("http://other.net/")),
            (6, "http://e.io/dir/page", canonical("sub?x=1&amp;y=2")), (7, "http://e.io/dir/sub?x=1&y=2#top", refresh("http://q.net/")),
            (8, "http://f.io/", canonical("#here")), (9, "https://a.io/x#frag", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in judge(df).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "allow", 9: "block"}
    assert {r.verdict for r in judge(df, [Rule("block", "io", "/")]).collect() if r.page_id in (1, 4, 8)} == {"block"}


def test_nearest_equals_brute_force(spark):
    r = np.random.default_rng(4)
    n = 700
    v = r.standard_normal((n, 24)).astype(np.float32)
    v[100:400] = v[100]  # one vector that many rows share
    v[400:420] *= 1e-3
    v[420:430] *= 1e4
    ids = r.permutation(5 * n)[:n]
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<float>").repartition(5)
    got = {}
    for x in nearest(df, query_block=16, candidate_block=100).collect():
        got.setdefault(x.query_id, {})[x["rank"]] = (x.vec_id, x.score)
    s = v.astype(np.float64) @ v.astype(np.float64).T
    for q in np.flatnonzero(ids % 20 == 0):
        order = sorted((j for j in range(n) if j != q), key=lambda j: (-round(s[q, j], 9), ids[j]))[:20]
        mine = [got[int(ids[q])][k + 1] for k in range(20)]
        assert np.allclose([m[1] for m in mine], [s[q, j] for j in order], rtol=1e-9)
        assert {m[0] for m in mine} == {int(ids[j]) for j in order}
    assert len(got) == (ids % 20 == 0).sum()
    assert df.where(F.col("vec_id") % 20 == 0).count() == len(got)
