import gzip
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from pitlane.llm import warc
from pitlane.llm.queries import QUERIES  # noqa: F401  registers without error
from pitlane.session import scratch_path


def record(body: bytes, extra: str = "", digest: bool = True) -> bytes:
    stated = f"WARC-Payload-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\n" if digest else ""
    return (f"WARC/1.1\r\nWARC-Type: resource\r\n{stated}{extra}Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"


def read(data):
    return list(warc.salvage(data))


def test_clean_archive_has_no_gap():
    parts = [record(b"one"), gzip.compress(record(b"two")), record(b"")]
    got = read(b"".join(parts))
    assert [g[0] for g in got] == ["record"] * 3
    assert [g[5] for g in got] == [b"one", b"two", b""]
    assert [g[2] for g in got] == [len(p) for p in parts]


def test_damage_is_quarantined_and_later_records_come_back():
    a, b, c = record(b"first"), record(b"second" * 50), record(b"third")
    for hurt in (b[:60], b.replace(b"second", b"SECOND", 1), b.replace(b"Content-Length", b"Content-Lengt?"),
                 b"junk" * 30, gzip.compress(b)[:-9], bytes(x ^ 255 * (i == 40) for i, x in enumerate(gzip.compress(b)))):
        for tail in (c, gzip.compress(c)):
            got = read(a + hurt + tail)
            kept = [g for g in got if g[0] == "record"]
            assert [g[5] for g in kept if g[5] in (b"first", b"third")] == [b"first", b"third"]
            gaps = [g for g in got if g[0] == "gap"]
            assert gaps and all(g[3] for g in gaps)
            assert sum(g[2] for g in got) == len(a + hurt + tail)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6), st.integers(0, 400), st.binary(max_size=12))
def test_records_and_gaps_cover_every_byte(bodies, at, noise):
    data = b"".join(gzip.compress(record(b)) if len(b) % 2 else record(b) for b in bodies)
    data = data[:at] + noise + data[at:]
    end = 0
    for _, offset, length, *_ in read(data):
        assert offset == end and length > 0
        end = offset + length
    assert end == len(data)


def test_round_trip_with_awkward_rows(spark, tmp_path):
    long = "x" * 300_000
    pages = [(5, "u\r\nX: y", "a" * 100), (3, None, "a" * 100), (9, "u", "a" * 100), (1, "u", "b"), (2, "u", "b"),
             (4, "u", None), (6, "u", ""), (7, "u", long), (7, "u", long), (None, "u", "a" * 100),
             (8, "u", "WARC/1.1\r\n" + "é\n\r\n\r\n" * 40)]
    df = spark.createDataFrame([(*p, "clash", "clash") for p in pages],
                               "page_id long, url string, html string, payload_digest string, refers_to string")
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.plan_records(df), path, archive_bytes=2000)
    found = warc.read_archives(spark, path).cache()
    assert warc.gaps(found).count() == 0
    got = warc.resolve_revisits(warc.record_digests(found)).collect()
    assert len(got) == len(pages)
    want = {}
    for i, _, h in pages:
        b = (h or "").encode()
        same = [p for p, _, x in pages if (x or "") == (h or "") and p is not None]
        first = min(same) if len(b) >= 100 else i
        want.setdefault(i, []).append((len(b), hashlib.sha256(b).hexdigest(), None if first == i else first))
    for r in got:
        assert (r.payload_bytes, r.payload_digest, r.refers_to) in want[r.page_id]
        assert (r.record_type == "revisit") == (r.refers_to is not None)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.plan_records(df), path)
    empty = spark.createDataFrame([("a", None), ("b", bytearray())], "path string, content binary")
    assert warc.read_contents(empty).count() == 0
    assert warc.read_archives(spark, path).count() == 0


def test_urls_with_line_separators_or_a_version_keep_their_pages(spark):
    urls = ["u\u0085rest", "u\u2028rest", "u\u2029rest", "http://x/WARC/1.0", "http://x/WARC/1.1", "WARC/1.1"]
    df = spark.createDataFrame([(i, u, "same " * 40) for i, u in enumerate(urls)], "page_id long, url string, html string")
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.plan_records(df), path)
    found = warc.read_archives(spark, path).cache()
    assert warc.gaps(found).count() == 0
    assert {r.target_uri for r in found.collect()} == set(urls)
    got = warc.resolve_revisits(warc.require_whole(warc.digest_log(found))).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(i, 200) for i in range(6)]


def test_a_gap_fails_where_none_may_be(spark):
    data = record(b"one") + b"junk" + record(b"two")
    log = warc.digest_log(warc.read_contents(spark.createDataFrame([("a", bytearray(data))], "path string, content binary")))
    try:
        warc.require_whole(log)
    except ValueError as e:
        assert "1 gaps" in str(e) and "4 bytes" in str(e)
    else:
        raise AssertionError("no error")
