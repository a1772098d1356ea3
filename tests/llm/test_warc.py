import gzip
import hashlib
import time
import tracemalloc
import zlib

import pytest

from ledgerwatch.llm import warc as w

LONG = "<p>é日本" * 400 + "\r\n\r\nWARC/1.1\r\n"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, None), (4, "http://a/4", ""),
         (5, "http://a b/\r\n5", "short"), (6, "x", "short"), (7, "y", "z" * 100), (8, "y", "z" * 100),
         (9, "y", "z" * 99), (10, "y", "z" * 99), (7, "y", "z" * 100), (None, "n", LONG),
         (12, "u", "0\r\n\r\n" * 30)]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(
        [(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")


def want(rows):
    first = {}
    for key, _, html in rows:
        if key is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, key), key)
    out = []
    for key, _, html in rows:
        raw = (html or "").encode()
        revisit = first.get(html, key) != key
        out.append((key, len(raw), hashlib.sha256(raw).hexdigest(),
                    "revisit" if revisit else "response", first[html] if revisit else None, "ok"))
    return sorted(out, key=str)


@pytest.mark.parametrize("config", [
    w.WarcConfig(), w.WarcConfig(chunk_bytes=7, segment_bytes=64, file_records=5),
    w.WarcConfig(chunk_bytes=1000, segment_bytes=333)])
def test_round_trip(pages, spark, tmp_path, config):
    path = str(tmp_path / "archives")
    w.write_archives(pages(PAGES), path, config)
    records = w.read_archives(spark, path)
    assert sorted(map(tuple, w.catalogue(records).collect()), key=str) == want(PAGES)
    payloads = {r.record_key: r.payload for r in w.payloads(records).collect() if r.type == "response"}
    assert payloads["1"].decode() == LONG and payloads["5"] == b"short"


def test_archives_are_valid_records(pages, tmp_path):
    w.write_archives(pages(PAGES), str(tmp_path / "a"), w.WarcConfig(segment_bytes=500))
    kinds, segments = [], {}
    for f in sorted((tmp_path / "a").glob("part-*")):
        for r in w.parse_archive(gzip.decompress(f.read_bytes())):
            kinds.append(r[1])
            if r[6] is not None:
                segments.setdefault(r[7] or r[0], []).append((r[6], len(r[9]), r[8]))
    assert set(kinds) == {"response", "revisit", "continuation"}
    for parts in segments.values():
        assert [p[0] for p in parts] == list(range(1, len(parts) + 1))
        assert parts[-1][2] == sum(p[1] for p in parts) and not any(p[2] for p in parts[:-1])


def segment(spark, rows):
    full = [(f"<{i}>", "response" if not origin else "continuation", key, None, None, None, number,
             origin, total, block, "ok") for i, key, number, origin, total, block in rows]
    return spark.createDataFrame(full, w.RECORDS)


def test_damaged_segments_have_a_state(spark):
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    rows = [
        ("a", "1", 1, None, None, head), ("a2", None, 3, "<a>", None, b"0\r\n\r\n"),
        ("a3", None, 2, "<a>", len(head) + 8, b"3\r\nxyz\r\n"),  # total on the wrong one
        ("b", "2", 1, None, None, head), ("b3", None, 3, "<b>", 99, b"0\r\n\r\n"),  # 2 is missing
        ("c", "3", 1, None, None, head), ("c2", None, 2, "<c>", 5, b"0\r\n\r\n"),  # wrong total
        ("d", "4", 1, None, None, head), ("d2", None, 2, "<d>", 9, b"x"), ("d3", None, 2, "<d>", 9, b"y"),
        ("e", "5", None, None, None, head + b"zz\r\nabc"),  # no chunk size
        ("f", "6", None, None, None, b"no http"),
        ("g2", None, 2, "<g>", 7, b"orphan"),
        ("h", "8", 1, None, None, head), ("h2", None, 2, "<h>", len(head) + 13, b"3;x=1\r\nabc\r\n0\r\n\r\n"[:13]),
        ("i", "9", 1, None, None, head), ("i2", None, 2, "<i>", len(head) + 14, b"2\r\nok\r\n00\r\n\r\n\r\n"[:14]),
        ("i2", None, 2, "<i>", len(head) + 14, b"2\r\nok\r\n00\r\n\r\n\r\n"[:14]),  # the same one again
    ]
    got = {r.record_key: (r.state, r.payload) for r in w.payloads(segment(spark, rows)).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "1": "length_mismatch", "2": "segment_missing", "3": "length_mismatch", "4": "segment_conflict",
        "5": "bad_chunk", "6": "no_http", None: "segment_missing", "8": "bad_chunk", "9": "ok"}
    assert got["9"][1] == b"ok"


def test_cut_file_and_foreign_bytes(spark, pages, tmp_path):
    w.write_archives(pages(PAGES[:3]).coalesce(1), str(tmp_path / "a"))
    whole = gzip.decompress(next((tmp_path / "a").glob("part-*")).read_bytes())
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cut.warc").write_bytes(whole[:-300])
    (tmp_path / "b" / "cut.warc.gz").write_bytes(gzip.compress(whole)[:-20])
    (tmp_path / "b" / "noise").write_bytes(b"not an archive")
    (tmp_path / "b" / "empty").write_bytes(b"")
    states = [r.state for r in w.read_archives(spark, str(tmp_path / "b")).collect()]
    assert states.count("damaged") >= 2 and states.count("ok") >= 2


def test_empty_table(pages, spark, tmp_path):
    w.write_archives(pages([]), str(tmp_path / "e"))
    assert w.catalogue(w.read_archives(spark, str(tmp_path / "e"))).count() == 0


def member(i, size=4000):
    body = f"{i}|".encode() * (size // 6)
    return (f"WARC/1.1\r\nWARC-Type: response\r\nRecord-Key: {i}\r\nContent-Length: {len(body)}"
            "\r\n\r\n").encode() + body + b"\r\n\r\n"


def test_a_member_for_each_record_is_linear(spark, tmp_path):
    n = 32_000
    data = b"".join(gzip.compress(member(i), 1) for i in range(n))
    start = time.perf_counter()
    keys = [int(r[2]) for r in w.parse_archive(w.inflated(data))]
    assert keys == list(range(n)) and time.perf_counter() - start < 5
    (tmp_path / "a.warc.gz").write_bytes(data[:len(data) // 8])
    got = w.read_archives(spark, str(tmp_path)).filter("state = 'ok'").count()
    assert got == n // 8 or abs(got - n // 8) <= n // 100


def test_memory_does_not_follow_the_archive():
    def most(n):
        data = gzip.compress(b"".join(member(i, 60_000) for i in range(n)), 1)
        tracemalloc.start()
        assert sum(1 for _ in w.parse_archive(w.inflated(data))) == n
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    assert most(1600) < 1.5 * most(200) < 8_000_000


@pytest.mark.parametrize("window, most", [(1, 1), (7, 3), (100, 50), (32_768, 1_000_000)])
def test_pieces_of_any_size_read_the_same(window, most):
    plain = b"".join(member(i, 50 + 90 * (i % 7)) for i in range(40))
    several = b"".join(gzip.compress(member(i, 50 + 90 * (i % 7))) for i in range(40))
    for data in (plain, several, gzip.compress(plain)):
        assert b"".join(w.inflated(data, window, most)) == plain
        assert list(w.parse_archive(w.inflated(data, window, most))) == list(w.parse_archive(plain))
        cut = list(w.parse_archive(w.inflated(data[:-30], window, most)))
        assert 20 < len(cut) <= 40 and cut[:-1] == list(w.parse_archive(plain))[:len(cut) - 1]
    bomb = zlib.compressobj(wbits=31)
    packed = bomb.compress(b"x" * 5_000_000) + bomb.flush()
    assert max(map(len, w.inflated(packed, 32_768, 10_000))) <= 10_000
