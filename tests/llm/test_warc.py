import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from paylode.llm import warc

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def by_force(rows, least=0):
    out = []
    for page, _, html in rows:
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        size = len((html or "").encode())
        latest = max(same, default=None)
        revisit = size >= least and latest is not None and page != latest
        out.append((page, size, digest(html), "revisit" if revisit else "response", latest if revisit else None))
    return sorted(out, key=str)


PAGES = [(1, "http://a.example/x", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"), (5, None, "<p>one</p>"),
         (3, "http://a.example/\r\nWARC-Type: evil", "zwei\r\n\r\nÄÖÜ\u2028"), (4, "http://e.example", None), (6, "", ""),
         (7, "http://big.example", "long " * 300_000), (8, "http://same.example", "same"), (8, "http://same.example", "same"),
         (None, "http://n.example", "<p>one</p>"), (None, "http://n.example", "alone without id")]


@pytest.mark.parametrize("least", [0, 5])
def test_records_come_back_as_written(spark, tmp_path, least):
    df = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "'x' AS digest", "1 AS size", "2 AS offset").repartition(3)
    index, folder = warc.write(df, str(tmp_path / "w"), least)
    found = warc.read(index, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) \
        == by_force(PAGES, least)
    payloads = {r.page_id: r.payload for r in found if r.record_type == "response"}
    assert payloads[3].decode() == PAGES[3][2] and payloads[7].decode() == PAGES[6][2]


def test_the_index_points_at_members_of_the_archives(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path / "w"))
    urls = sorted(str(u) for _, u, _ in PAGES)
    rows = index.collect()
    assert sorted(str(r.url) for r in rows) == urls
    for r in rows:
        data = (Path(folder) / r.archive).read_bytes()[r.offset:r.offset + r.length]
        headers, _ = warc.parse(gzip.decompress(data))
        assert headers["warc-payload-digest"] == f"sha1:{r.digest}" and headers["warc-type"] == r.record_type
    for archive in {r.archive for r in rows}:
        assert gzip.decompress((Path(folder) / archive).read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_a_selection_reads_only_its_records(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path / "w"))
    assert [r.page_id for r in warc.read(index.where("page_id = 3"), folder).collect()] == [3]


def test_ranges_join_neighbours():
    spots = [(0, 10), (10, 10), (25, 5), (100, 10), (110, 500)]
    assert list(warc.ranges(spots, gap=5, most=1000)) == [(0, 30, 3), (100, 510, 2)]
    assert list(warc.ranges(spots, gap=1000, most=40)) == [(0, 30, 3), (100, 10, 1), (110, 500, 1)]
    assert list(warc.ranges([], 5, 5)) == []


def test_damage_is_noticed(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame(PAGES[:1], SCHEMA), str(tmp_path / "w"))
    row = index.first()
    path = Path(folder) / row.archive
    data = path.read_bytes()
    member = gzip.decompress(data[row.offset:row.offset + row.length]).replace(b"one", b"two")
    packed = warc._member(member)
    path.write_bytes(data[:row.offset] + packed)
    broken = spark.createDataFrame([(row.archive, row.offset, len(packed))], "archive string, offset long, length long")
    with pytest.raises(Exception, match="damaged"):
        warc.read(broken, folder).collect()


def test_an_empty_table(spark, tmp_path):
    index, folder = warc.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert index.count() == 0 and warc.read(index, folder).count() == 0
