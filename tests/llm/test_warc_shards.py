import gzip
import hashlib
import tempfile

import pytest

from walletyield.llm import sharding, warc


def test_arc_lines_of_both_versions():
    def file(version, records):
        about = f"{version} 0 test\n{' '.join(warc.ARC_FIELDS[version])}\n"
        out = warc.arc_line(version, "filedesc://a.arc", "20010203040506", "text/plain", len(about), "a.arc") + "\n" + about + "\n"
        for url, block in records:
            out += warc.arc_line(version, url, "20010203040506", "text/html", len(block), "a.arc") + "\n" + block + "\n"
        return out.encode()

    block = "HTTP/1.1 200 OK\r\nX-Page-Id: 12\r\n\r\nhttp://trap 0.0.0.0 20010203040506 text/html 3\nabc"
    for version in (1, 2):
        got = list(warc.parse_arc(file(version, [("http://a b/c", block), ("dns:x", "plain"), ("http://e", "")])))
        assert [(r.url, r.date, r.mime) for r in got] == [(u, "20010203040506", "text/html") for u in ("http://a b/c", "dns:x", "http://e")]
        assert got[0].page_id == 12 and got[0].http[1].endswith(b"abc") and got[1].http == (b"", b"plain") and got[1].page_id is None
        (fields, body), = warc.parse_warc(warc.to_warc(got[0], None).encode() + b"\r\n\r\n")
        assert fields["WARC-Type"] == "response" and fields["WARC-Date"] == "2001-02-03T04:05:06Z" and body == block.encode()
        assert warc.to_warc(got[1], None).startswith("WARC/1.1\r\nWARC-Type: resource\r\n")
    with pytest.raises(ValueError):
        list(warc.parse_arc(file(1, [("http://a", block)])[:-30]))


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "VOLUME_BYTES", 5000)
    long = "é\r\n\r\nWARC/1.1\r\n" * 90
    pages = [(1, "http://a", long, 3), (2, None, long, 3), (3, "http://c d", "x" * 999, 3), (4, "http://c", "x" * 999, 3), (5, "u", None, 3),
             (6, "u", "", 3), (7, "u", "z" * 20000, 3), (None, "u", long, 3), (None, "v", "q" * 1000, 3), (None, "v", "q" * 1000, 3),
             (2, "again", long, 3), (8, "u", "w" * 1000, 3), (9, "u", "w" * 1000, 3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, volume int").repartition(3)
    base = tempfile.mkdtemp(prefix="warc-")
    warc.write_arc(df, f"{base}/arc")
    warc.convert(spark, f"{base}/arc", f"{base}/warc")
    got = sorted((tuple(r) for r in warc.read_warc(spark, f"{base}/warc").drop("url").collect()), key=str)
    want = []
    for page, _, html, _ in pages:
        data = (html or "").encode()
        top = max((p for p, _, h, _ in pages if h == html and p is not None), default=None)
        again = len(data) >= 1000 and top is not None and (page is None or page < top)
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    assert got == sorted(want, key=str)
    full = warc.read_warc(spark, f"{base}/warc", with_payload=True).where("page_id = 7").first()
    assert full.payload == b"z" * 20000 and full.url == "u"
    assert warc.read_warc(spark, f"{base}/warc").where("page_id = 3").first().url == "http://c%20d"
    warc.write_arc(df.limit(0), f"{base}/arc0")
    warc.convert(spark, f"{base}/arc0", f"{base}/warc0")
    assert warc.read_warc(spark, f"{base}/warc0").collect() == []
    assert gzip.decompress(gzip.compress(b"")) == b""


def test_lookup_table():
    names = sharding.shard_names(7)
    owner = sharding.lookup_table(names, 1009)
    counts = [owner.count(i) for i in range(7)]
    assert max(counts) - min(counts) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 6)
    assert moved < 0.25 * 1009
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)


def test_placement(spark):
    rows = [(i if i % 3 else None, None if i % 50 == 0 else f"text {i}", "s") for i in range(3000)] + [(7, "text 7", "s")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    placed = sharding.place(df, sharding.shard_names(8), 1009)
    got = placed.collect()
    assert len(got) == len(rows) and len({r.shard for r in got if r.doc_id == 7}) == 1
    owner = sharding.lookup_table(sharding.shard_names(8), 1009)
    for r in got:
        key = str(r.doc_id) if r.doc_id is not None else hashlib.md5((r.text or "").encode()).hexdigest()
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % 1009 and r.shard == owner[r.slot]
    alone = [sum(r.shard == s for r in got if r.doc_id is None) for s in range(8)]
    assert max(alone) < 3 * min(alone)  # rows without an id spread as well
    path = tempfile.mkdtemp(prefix="shards-") + "/out"
    sharding.write_shards(placed, path, 2)
    assert spark.read.parquet(path).count() == len(rows)
    assert sharding.place(df.limit(0), sharding.shard_names(8), 1009).collect() == []
