import gzip
import hashlib
import io
import itertools
import json
import random

import pytest

from chronogrid.llm import warc
from chronogrid.llm.common import open_fs, work_dir

SCHEMA = "page_id long, url string, html string, digest string, path string"
BIG = "<p>" + "é" * 80 + "\r\n\r\nWARC/1.0\r\n"
ROWS = [(5, "http://a", BIG, "d", "p"), (3, "http://b", BIG, "d", "p"), (9, None, BIG, "d", "p"), (None, "u", BIG, "d", "p"), (4, "http://x y", "short", "d", "p"), (6, "u", "short", "d", "p"), (7, "u", None, "d", "p"), (8, "u", "", "d", "p"), (10, "u", "z" * 300_000, "d", "p"), (None, "u", "q" * 200, "d", "p"), (3, "http://b", BIG, "d", "p")]


def expected(rows):
    first = {}
    for i, _, h, *_ in rows:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, _, h, *_ in rows:
        raw = (h or "").encode()
        refers = first.get(raw) if first.get(raw) != i else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = warc.round_trip(df)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == expected(ROWS)
    payloads = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert payloads[10] == b"z" * 300_000 and payloads[3] == BIG.encode()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_normalised_members_stand_alone(spark):
    raw, out = work_dir(spark, "t"), work_dir(spark, "t")
    index = warc.normalise(warc.write_monolithic(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), raw), out).collect()
    fs, _ = open_fs(out)
    for r in index:
        data = fs.open_input_file(r.path)
        data.seek(r.offset)
        assert gzip.decompress(data.read(r.length)).startswith(b"WARC/1.0\r\n")
        listed = [json.loads(x) for x in fs.open_input_stream(r.path + ".idx", compression=None).read().decode().splitlines()]
        assert {"offset": r.offset, "length": r.length} in listed
    assert sum(r.length for r in index) == fs.get_file_info(index[0].path).size


def test_inflates_one_member_or_many():
    rng = random.Random(2)
    parts = [warc.record(i, None, bytes(rng.randrange(256) for _ in range(rng.randrange(3000))) + b"0" * 9_000_000 * (i == 2), "d", None) for i in range(5)]
    for packed in (gzip.compress(b"".join(parts)), b"".join(map(gzip.compress, parts))):
        assert list(warc.records(warc.inflated(io.BytesIO(packed)))) == parts
        with pytest.raises(ValueError):
            list(warc.records(warc.inflated(io.BytesIO(packed[:-20]))))


def test_inflating_ends_whatever_follows_a_member_in_a_piece():
    """Members of more and of less than a piece, in every order: each inflated piece is told once, and the stream ends."""
    big, small, noise = b"0" * 9_000_000, b"abc", random.Random(3).randbytes(3_000_000)
    for order in itertools.permutations([big, small, noise, b""]):
        told = itertools.islice(warc.inflated(io.BytesIO(b"".join(gzip.compress(x, 1) for x in order))), 1000)
        assert b"".join(told) == b"".join(order)


def test_many_large_members():
    part = b"x" * 5_000_000
    told = list(itertools.islice(warc.inflated(io.BytesIO(gzip.compress(part, 1) * 30)), 1000))
    assert sum(map(len, told)) == 30 * len(part) and all(told)


def test_records_are_read_by_the_sidecars_alone(spark):
    raw, out = work_dir(spark, "t"), work_dir(spark, "t")
    index = warc.normalise(warc.write_monolithic(spark.createDataFrame(ROWS, SCHEMA).repartition(3), raw), out)
    listed = warc.sidecar_index(index.select("path"), out)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, index.select("path", "offset", "length").collect()))
    fs, _ = open_fs(out)
    path = index.first().path
    with fs.open_output_stream(path + ".idx", compression=None) as f:
        f.write(b"")
    n = index.where(index.path == path).count()
    assert warc.read_archives(warc.sidecar_index(index, out), out).count() == len(ROWS) - n
