"""The early stop of the sampling reader."""

import gzip
import io
import os

import pytest

from tidemark.session import scratch_path
from tidemark.sources import events_json
from tidemark.sources.capped_lines import first_lines_of, read_capped_lines


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def test_reads_no_further_than_the_cap():
    lines = [os.urandom(40).hex().encode() for _ in range(50_000)]
    raw = gzip.compress(b"\n".join(lines))
    stream = Counting(raw)
    assert list(first_lines_of(stream, 3, True)) == lines[:3]
    assert stream.taken < 64_000 < len(raw)


@pytest.mark.parametrize("compressed", [False, True])
def test_lines_equal_a_whole_read(compressed):
    texts = [b"", b"\n\n", b"a", b"a\n", b" \na\r\n\nb\nc", b"x" * 100_000 + b"\ny", b"\n".join(b"%d" % i for i in range(20_000))]
    for text in texts:
        whole = [x.rstrip(b"\r") for x in text.split(b"\n") if x.strip()]
        data = gzip.compress(text) if compressed else text
        for limit in (0, 1, 2, 3, 1_000_000):
            assert list(first_lines_of(io.BytesIO(data), limit, compressed)) == whole[:limit]


def test_members_damage_and_early_end():
    two = gzip.compress(b"a\nb\n") + gzip.compress(b"c\n")
    assert list(first_lines_of(io.BytesIO(two), 9, True)) == [b"a", b"b", b"c"]
    lines = [os.urandom(30).hex().encode() for _ in range(30_000)]
    raw = gzip.compress(b"\n".join(lines))
    damaged = raw[:len(raw) // 2] + bytes(1000) + raw[len(raw) // 2 + 1000:]
    assert list(first_lines_of(io.BytesIO(damaged), 5, True)) == lines[:5]
    with pytest.raises(Exception):
        list(first_lines_of(io.BytesIO(damaged), 10**9, True))
    with pytest.raises(EOFError):
        list(first_lines_of(io.BytesIO(raw[:5000]), 30_000, True))


def test_a_file_damaged_behind_the_cap_still_loads(spark):
    root = scratch_path(spark, "t-damaged").replace("file:", "")
    os.makedirs(f"{root}/a")
    os.makedirs(f"{root}/b/_hidden")
    raw = gzip.compress(b"".join(b'{"id": "%d", "type": "%s"}\n' % (i, os.urandom(20).hex().encode()) for i in range(20_000)))
    for path, data in (("a/2024-01-15-5.json.gz", raw[:len(raw) // 2] + bytes(500) + raw[len(raw) // 2 + 500:]),
                       ("b/2024-01-15-5.json.gz", raw), ("b/2024-01-15-6.json.gz", gzip.compress(b"")),
                       ("b/_hidden/2024-01-15-7.json.gz", raw)):
        with open(f"{root}/{path}", "wb") as f:
            f.write(data)
    with pytest.raises(Exception):
        events_json.read_event_files(spark, f"{root}/a").count()
    got = events_json.read_event_files(spark, f"{root}/*/*.json.gz", max_events=2).collect()
    # The same hour delivered twice is two files.
    assert sorted((r.event_id, r._source_file) for r in got) == [(i, "2024-01-15-5.json.gz") for i in "0011"]
    assert read_capped_lines(spark, [f"file://{root}/a", f"{root}/b/2024-01-15-5.json.gz"], 1).count() == 2
    assert read_capped_lines(spark, f"{root}/none*", 1).count() == 0
