import gzip
import hashlib
import uuid
from collections import defaultdict

import pyarrow.fs
import pytest

from tidemark.llm import warc as m
from tidemark.llm.common import shared_dir


@pytest.mark.parametrize("size", [7, 1 << 16])
def test_round_trip_of_payloads_and_revisits(spark, size):
    big = "é<p>\r\n\r\n" * 300
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", big), (7, "u", big + "x")]
    rows += [(8, "u", "z" * 90_000), (8, "u", "z" * 90_000)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, data int")
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    files = m.write_archives(m.chunk_table(m.decide(pages), size), folder, file_bytes=500)
    got = defaultdict(list)
    ends = []
    for r in m.read_archives(files, folder, size).collect():
        got[r.page_id, r.digest, r.record_type].append((r.chunk_no, r.data))
        ends += [r] * r.last
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in ends)
    assert kinds == sorted([("1", "revisit", 2), ("2", "response", None), ("3", "response", None), ("4", "response", None), ("5", "response", None), ("6", "response", None),
                            ("None", "response", None), ("7", "response", None), ("8", "response", None), ("8", "response", None)])
    for r in ends:
        if r.record_type == "response":
            assert r.sha1_so_far == r.digest == hashlib.sha1(next(h or "" for p, _, h in rows if p == r.page_id).encode()).hexdigest()
    assert b"".join(d for _, d in sorted(got[2, hashlib.sha1(big.encode()).hexdigest(), "response"])) == big.encode()
    fs, root = pyarrow.fs.FileSystem.from_uri(folder)
    whole = b"".join(gzip.decompress(fs.open_input_file(x.path).read()) for x in fs.get_file_info(pyarrow.fs.FileSelector(root)))
    assert whole.count(b"WARC/1.1\r\n") == len(rows)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    assert m.read_archives(m.write_archives(m.chunk_table(m.decide(pages)), folder), folder).count() == 0
