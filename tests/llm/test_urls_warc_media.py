import base64
import hashlib
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulaire.llm import media, urls, warc
from tests.llm.conftest import ODD

PAGES = [
    (1, "http://a.example.net/en/1", "x"), (2, "HTTP://WWW.Example.NET/en/2?q=/", "x"), (3, "http://net", "y"), (4, "http://net/", ""), (5, None, None), (6, "no scheme/en/", "z"),
    (7, "https://b.example.com/de/1#f", "x"), (8, "https://example.com/dex", "w"), (9, "http://x.org/fr/1", "x"), (10, "http://x.org?/fr/", "q"), (None, "http://x.org/fr/", "x"),
    (12, "http://notnet/", "é"), (12, "http://notnet/", "é"), (13, "http://h.co.uk:80/a b\r\n%41", "x" * 300_000), (14, "ftp://ÄÖ.example.com/de/", None), (15, "://", "v"),
]
LABELS = [(1, 1, 0), (2, 0, 0), (3, 1, 1), (7, 0, 1), (8, 1, 0), (9, 1, 0), (9, 0, 0), (12, None, None), (99, 0, 0), (None, 0, 0)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("k", *p, 1) for p in PAGES], "`host` string, page_id long, url string, html string, sha1 int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_verdicts_equal_sql(pages, labels):
    got = urls.judge(pages, urls.page_outcomes(pages, labels)).drop("bad_rate", "bad_bound")
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(PAGES, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"}))
    con.register("labels", pd.DataFrame(LABELS, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    rows = con.sql(urls.sql()).select(*got.columns).fetchall()
    assert sorted(map(str, rows)) == sorted(map(str, map(tuple, got.collect())))
    by = {r.page_id: r for r in got.collect()}
    assert (by[2].host, by[2].path, by[2].rule, by[2].verdict) == ("www.example.net", "/en/2", "example.net/en/", "allow")
    assert by[3].rule is None and by[4].rule == "net/" and by[10].rule is None and by[8].rule is None and by[7].rule == "example.com/de/"
    assert (by[5].host, by[6].path, by[14].host) == ("", "", "ÄÖ.example.com")


def test_shrinkage(spark):
    outcomes = spark.createDataFrame([("bad.a.com", 1)] * 40 + [("good.a.com", 0)] * 40 + [("few.a.com", 1)] + [(f"h{i}.b.com", i % 4 == 0 and 1 or 0) for i in range(40)], "host string, bad int")
    hosts = spark.createDataFrame([(h,) for h in ("bad.a.com", "bad.a.com:80", "good.a.com", "few.a.com", "new.a.com", "new.b.com", "new.c.com", "new.c.org", "")], "host string")
    rate = {r.host: r for r in urls.reputations(hosts, urls.learn(outcomes)).collect()}
    assert rate["bad.a.com"].bad_rate > 0.9 > rate["few.a.com"].bad_rate > rate["new.a.com"].bad_rate > rate["good.a.com"].bad_rate
    assert all(r.bad_rate >= r.bad_bound for r in rate.values()) and rate["bad.a.com"].bad_bound > 0.8 and rate["bad.a.com:80"].bad_bound == rate["bad.a.com"].bad_bound


@pytest.mark.parametrize(("total", "base", "hot"), [(200, 0.1, 10_000), (20_000, 0.1, 10_000), (20_000, 0.3, 5)])
def test_planted_hosts(spark, monkeypatch, total, base, hot):
    """Bad hosts and a bad domain are blocked, all others allowed, however many outcomes there are."""
    import random

    monkeypatch.setattr(urls, "often", lambda n: hot)
    rng = random.Random(total)
    names = [f"h{i}.d{i % 6}.{('com', 'org', 'co.uk')[i % 3]}" for i in range(12)]
    rows = [(names[i % 12], int(rng.random() < base)) for i in range(int(total * 0.7))]
    rows += [("bad.d0.com", int(rng.random() < 0.9)) for _ in range(int(total * 0.15))] + [(f"x{i % 5}.evil.org", int(rng.random() < 0.9)) for i in range(int(total * 0.15))]
    asked = [*names, "bad.d0.com", "bad.d0.com.:443", "x1.evil.org", "new.evil.org", "new.d1.org", "never.seen.io", "10.0.0.1:80", ""]
    pages = spark.createDataFrame([(i, f"https://{h}/p") for i, h in enumerate(asked)] + [(99, None)], "page_id long, url string")
    got = {r.host: r.verdict for r in urls.judge(pages, spark.createDataFrame(rows, "host string, bad int"), ()).collect()}
    unseen = got.pop("new.evil.org")  # its domain's outcomes speak for it once there are enough
    assert unseen == "block" or total == 200
    assert {h for h, v in got.items() if v == "block"} == {"bad.d0.com", "bad.d0.com.:443", "x1.evil.org"}


def test_sites_domains_and_suffixes(spark):
    hosts = ["a.b.co.uk", "co.uk", "b.co.uk:8080", "x.y.example.com.", "user:pw@a.com:80", "1.2.3.4:80", "1.2.3.4", "[::1]:80", "com", "", "notco.uk", "a..b", "localhost:1"]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", urls.site_of(F.col("host")).alias("site"))
    suffix = urls.suffix_of(F.col("site"))
    got = {r.host: (r.site, r.domain, r.suffix) for r in rows.select("*", urls.domain_of(F.col("site"), suffix).alias("domain"), suffix.alias("suffix")).collect()}
    assert got == {
        "a.b.co.uk": ("a.b.co.uk", "b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk", "co.uk"), "b.co.uk:8080": ("b.co.uk", "b.co.uk", "co.uk"), "x.y.example.com.": ("x.y.example.com", "example.com", "com"),
        "user:pw@a.com:80": ("a.com", "a.com", "com"), "1.2.3.4:80": ("1.2.3.4", "1.2.3.4", "(ip)"), "1.2.3.4": ("1.2.3.4", "1.2.3.4", "(ip)"), "[::1]:80": ("[::1]", "[::1]", "(ip)"),
        "com": ("com", "com", "com"), "": ("", "", ""), "notco.uk": ("notco.uk", "notco.uk", "uk"), "a..b": ("a..b", ".b", "b"), "localhost:1": ("localhost", "localhost", "localhost"),
    }


def test_empty_tables(pages, labels):
    outcomes = urls.page_outcomes(pages, labels)
    assert urls.judge(pages.limit(0), outcomes).count() == 0
    assert {r.verdict for r in urls.judge(pages, outcomes.limit(0)).where("rule is null").collect()} <= {"allow", "block"}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_archives_round_trip(pages):
    archives = warc.write_archives(pages)
    got = archives.read(warc.keys_of(pages), with_payload=True).collect()
    payload = {i: (h or "").encode() for i, _, h in PAGES}
    firsts: dict = {}
    for i, _, h in PAGES:
        firsts.setdefault((h or "").encode(), []).append(i)
    assert sorted(r.page_id or -1 for r in got) == sorted(i or -1 for i, _, _ in PAGES)
    for r in got:
        data = payload[r.page_id]
        first = min(i for i in firsts[data] if i is not None)
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == first else ("revisit", first))
        assert r.payload == data
    large = warc.write_archives(pages, least=2)
    assert {r.page_id for r in large.read(warc.keys_of(pages)).collect() if r.record_type == "revisit"} == set()


def test_many_repeated_payloads(spark, monkeypatch):
    """Most payloads repeat, one in a third of the rows; joins are none of broadcasts, packs and archives roll, tasks forget digests."""
    rows = [(i, f"http://h{i % 9}.example.com/{i}", "hot" if i % 3 == 0 else f"p{i % 150}" * 40) for i in range(900)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    results = []
    for least_hot, threshold in ((10_000, before), (1, -1)):
        monkeypatch.setattr(warc, "often", lambda total, least_hot=least_hot: least_hot)
        spark.conf.set(key, threshold)
        try:
            df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
            archives = warc.write_archives(df)
            results.append(sorted(map(tuple, archives.read(warc.keys_of(df), with_payload=True).collect())))
        finally:
            spark.conf.set(key, before)
    assert results[0] == results[1] and len(results[0]) == 900
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    expected = con.sql(warc.sql()).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").fetchall()
    assert [r[:5] for r in results[0]] == sorted(expected) and [bytes(r[5]).decode() for r in results[0]] == [h for _, _, h in rows]


def test_records_are_gzip_members(tmp_path):
    import gzip

    payload = "é".encode() * 5000
    raw = gzip.decompress(warc.member(warc.record_head("http://a/b", 7, len(payload), "D"), payload, warc.deflate(payload)))
    assert raw.endswith(b"\r\n\r\n" + payload + b"\r\n\r\n") and warc.parse(warc.member(warc.record_head(None, None, 0, "D", 3, "k 1"), b"", b""))[0]["Refers-To-Capture"] == "k 1"
    monkey = warc.Rolling(f"file://{tmp_path}", ".x")
    places = [monkey.write(b"ab"), monkey.write(b"c")]
    monkey.close()
    assert [p[1:] for p in places] == [(0, 2), (2, 1)] and (tmp_path / places[0][0]).read_bytes() == b"abc"


def test_archive_rows_equal_sql(pages):
    rows = [p for p in PAGES if p[0] is not None]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    got = warc.archive_round_trip(pages.where("page_id is not null"))
    expected = con.sql(warc.sql()).select(*got.columns).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_index_finds_every_key(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 4)
    rows = [(i, f"http://h{i % 7}.example.com/{i // 3}", "p") for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(df)
    assert archives.shards.selectExpr("sum(captures)", "sum(blocks)").first()[:] >= (100, 25)
    listed = sorted((r.first_key, r.shard) for r in archives.shards.collect())
    index = warc.CaptureIndex(archives.root, listed)
    for i, url, _ in rows:
        (place,) = index.lookup(warc.capture_key(url, i))
        assert warc.parse(index.fetch(*place))[0]["WARC-Record-ID"] == f"<urn:page:{i}>"
    assert list(index.lookup("com,example,h0)/nope 1")) == [] and list(index.lookup("")) == []
    assert warc.surt("http://a.B.com:80/x?y") == "com,b,a:80)/x?y"


def naive_cuts(payload):
    """Byte by byte: the gear hash of the last 32 bytes, a cut where its first 12 bits are 0, 1,024 bytes at least and 16,384 at most."""
    table = media._GEAR.tolist()
    ends, start, h = [], 0, 0
    for i, b in enumerate(payload):
        h = ((h << 1) + table[b]) % 2**32
        if i + 1 - start >= 16_384 or (i + 1 - start > 1024 and h >> 20 == 0) or (i + 1 - start == 1024 and h >> 20 == 0 and i + 1 < len(payload)) or i + 1 == len(payload):
            ends.append(i + 1)
            start = i + 1
    return ends


def naive_feature(payload):
    mean = sum(payload) * 100 // len(payload)
    spread = sum(b * b for b in payload) * 10_000 // len(payload) - mean * mean
    crossings = sum((a >= 128) != (b >= 128) for a, b in zip(payload, payload[1:]))
    return f"mean={mean};sd={int(max(spread, 0) ** 0.5)};crossings={crossings};values={len(set(payload))}"


def test_media_round_trip(odd, none):
    """Every column from the texts alone: chunks cut byte by byte, the stored form spelled out."""
    stored, root = media.store_media(odd)
    got = sorted(map(tuple, media.read_media(stored, root, with_payload=True).collect()), key=str)
    expected = []
    for i, t, _ in ODD:
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        ends = naive_cuts(payload)
        chunks = [payload[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        form = b"CDC1" + len(raw).to_bytes(8, "little") + b"".join(hashlib.sha256(c).digest() + len(c).to_bytes(4, "little") for c in chunks)
        assert b"".join(chunks) == payload and media.cuts(payload) == ends
        size = len(form) + sum(len(zlib.compress(c, 1)) for c in set(chunks))
        expected.append((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(form), hashlib.sha256(form).hexdigest(), naive_feature(payload), size, bytearray(payload)))
    assert got == sorted(expected, key=str)
    assert media.media_round_trip(none).count() == 0


def test_chunks_follow_content(monkeypatch):
    import random

    data = random.Random(0).randbytes(400_000)
    whole = {data[a:b] for a, b in zip([0, *media.cuts(data)], media.cuts(data), strict=False)}
    moved = b"something in front" + data
    ends = media.cuts(moved)
    shared = [moved[a:b] for a, b in zip([0, *ends], ends, strict=False) if moved[a:b] in whole]
    assert sum(map(len, shared)) > 0.9 * len(data)
    sizes = [b - a for a, b in zip([0, *ends], ends, strict=False)]
    assert max(sizes) <= media.MOST and min(sizes[:-1]) >= media.LEAST
    monkeypatch.setattr(media, "SLICE", 1000)
    assert media.cuts(moved) == ends


def test_neighbouring_chunks_are_read_at_once():
    place = lambda pack, offset, size: {"pack": pack, "offset": offset, "size": size}
    places = [place("a", 100, 10), place("a", 110, 5), place("b", 0, 7), place("a", 115, 20), place("a", 110, 5), place("a", 200, 1), place("b", 7, 9), place("b", 16, 100)]
    got = list(media.reads(places, most=50))
    assert got == [("a", 100, 35, [0, 1, 4, 3]), ("a", 200, 1, [5]), ("b", 0, 16, [2, 6]), ("b", 16, 100, [7])]
    assert sorted(i for _, _, _, own in got for i in own) == list(range(len(places)))
    assert list(media.reads([], 50)) == []
