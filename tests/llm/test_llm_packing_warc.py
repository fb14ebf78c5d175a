"""Operators 2 and 3: exact round trips."""

import base64
import glob
import gzip
import hashlib
import io
import os
import random
import struct
import sys
import zlib
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import empty_docs, key, odd_docs, texts_of

from ledgerline.llm import packing, warc
from ledgerline.llm.common import scratch

TOKENIZER = __import__("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return odd_docs(spark).repartition(3).cache()


def test_fill_is_closest():
    r = random.Random(2)
    for _ in range(300):
        counts = Counter(r.randrange(1, 40) for _ in range(r.randrange(1, 12)))
        room = 60 - max(counts)
        best = 0
        rest = counts - Counter([max(counts)])
        sums = {0}
        for x in rest.elements():
            sums |= {s + x for s in sums}
        best = max(s for s in sums if s <= room) + max(counts)
        taken = packing.fill(dict(counts), 60)
        assert sum(k * n for k, n in taken.items()) == best
        assert all(n <= counts[k] for k, n in taken.items())


def test_ids_equal_the_tokenizers_on_real_texts(spark):
    """Every id of every sf0.001 document, put together from its pieces."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = defaultdict(list)
    for p in packing.pack(docs, TOKENIZER).collect():
        made[p["doc_id"]].append((p["start"], bytes(p["tokens"])))
    for i, t in texts_of(docs):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        assert b"".join(x for _, x in sorted(made[i])) == struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("capacity", [16, 256])
def test_pack_round_trip(docs, capacity):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    want = Counter((i, struct.pack(f"<{len(x)}I", *x)) for i, t in texts_of(docs) for x in [[*tok.encode(t or "", add_special_tokens=False).ids, 2]])
    pieces = packing.pack(docs, TOKENIZER, capacity).collect()
    sequences = defaultdict(list)
    for p in pieces:
        assert len(p["tokens"]) == 4 * p["length"] and p["length"] > 0
        sequences[p["sequence_id"]].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)       # no padding at all
    # every document's ids lie in exactly one piece
    whole = Counter()
    per_doc = defaultdict(list)
    for p in pieces:
        per_doc[p["doc_id"], p["doc_tokens"]].append(p)
    for (i, n), ps in per_doc.items():
        copies = sum(1 for p in ps if p["start"] == 0)
        covered = Counter(s for p in ps for s in range(p["start"], p["start"] + p["length"]))
        assert set(covered) == set(range(n)) and set(covered.values()) == {copies}
        by_start = defaultdict(list)
        for p in ps:
            for k in range(p["length"]):
                by_start[p["start"] + k].append(bytes(p["tokens"][4 * k:4 * k + 4]))
        if all(len(set(v)) == 1 for v in by_start.values()):
            whole[i, b"".join(by_start[s][0] for s in range(n))] += copies
    assert whole == Counter({k: v for k, v in want.items() if k in whole}) and sum(want.values()) - sum(whole.values()) <= 4


def test_digest_and_empty(spark, docs):
    rows = packing.piece_digests(packing.pack(docs, TOKENIZER, 64))
    tokens = {(p["sequence_id"], p["offset"]): bytes(p["tokens"]) for p in packing.pack(docs, TOKENIZER, 64).collect()}
    for r in rows.collect():
        assert r["ids_crc32"] == zlib.crc32(tokens[r["sequence_id"], r["offset"]])
    assert packing.pack(empty_docs(spark), TOKENIZER).collect() == []


def pages(spark):
    big = "a" * (17 << 20)                        # a member that does not end in a zero byte
    rows = [(5, "http://A.example/x", "<p>same</p>"), (2, "http://b.example/\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "u", None),
            (3, "v", ""), (4, "w", "é\r\n\r\nWARC/1.1"), (None, "n", "<p>same</p>"), (None, "m", "alone"), (2, "http://b.example/", "<p>same</p>"), (7, "big", big)]
    return spark.createDataFrame([(*r, 0, "clash") for r in rows], "page_id long, url string, html string, first long, payload string"), rows


@pytest.mark.parametrize("min_bytes", [0, 8, 10**9])
def test_warc_round_trip(spark, min_bytes):
    table, rows = pages(spark)
    path = scratch(spark, "test-warc")
    warc.write_archives(table, path, min_bytes, archive_bytes=600)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(ids) if ids else None
        revisit = len(data) >= min_bytes and i != first
        want.append((i, "revisit" if revisit else "response", first if revisit else None, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), True, None if revisit else data))
    for row_bytes in (warc.ROW_BYTES, 2000, 0):                                    # as rows, both ways, as streams
        got = warc.read_archives(spark, path, row_bytes).drop("url").collect()
        assert sorted((tuple(r) for r in got), key=lambda r: key(r[:6])) == sorted(want, key=lambda r: key(r[:6]))
    for f in glob.glob(path.removeprefix("file:") + "/part-*"):                  # plain gzip reads them too
        data = open(f, "rb").read()
        assert data[-1] == 0 and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_warc_damage(spark):
    member = warc.page_record(1, "u", b"payload", None, False, warc.DATE)
    headers, block = warc.parsed(next(warc.members(io.BytesIO(member))))
    assert warc.page_row(headers, block)[6]
    assert not warc.page_row(headers, block.replace(b"payload", b"poyload"))[6]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member[:-9])))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member + b"more")))
    with pytest.raises(ValueError):
        warc.parsed(gzip.decompress(member) + b"x")


def test_members_in_small_pieces(monkeypatch):
    """Members that end on, before and behind the end of a piece."""
    made = [warc.record("metadata", str(n), b"x" * n) for n in (0, 1, 50, 3000)] * 2
    for chunk in (1, 7, len(made[0]), 1 << 16):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        assert list(warc.members(io.BytesIO(b"".join(made)))) == [gzip.decompress(m) for m in made]
    assert list(warc.members(io.BytesIO(b""))) == []


def test_streamed_archive_holds_one_record(spark):
    """An archive of many records is not gathered: the reader is a few pieces ahead."""
    one = warc.page_record(1, "u", os.urandom(1 << 18), None, False, warc.DATE)

    class Counted(io.BytesIO):
        given = 0

        def read(self, n=-1):
            self.given += len(piece := super().read(n))
            return piece

    archive = Counted(one * 40)
    for done, _ in enumerate(warc.members(archive), 1):
        assert archive.given <= done * len(one) + 2 * warc.CHUNK


def test_streams_by_path(spark, tmp_path):
    folder = tmp_path / "a b%41ü"
    folder.mkdir()
    (folder / "x.warc.gz").write_bytes(warc.page_record(4, "u", b"payload", None, False, warc.DATE))
    for path in (f"file:{folder}/x.warc.gz", f"file://{folder}/x.warc.gz"):
        with warc.opened(path) as archive:
            assert len(list(warc.members(archive))) == 1
    assert [r["page_id"] for r in warc.read_archives(spark, str(folder), 0).collect()] == [4]


def test_check_revisits(spark):
    rows = [(1, "response", None, "A", True), (2, "revisit", 1, "A", True), (3, "revisit", 1, "B", True), (4, "revisit", 9, "A", True),
            (5, "response", None, "C", False), (6, "revisit", 5, "C", True), (None, "response", None, "D", True), (7, "revisit", None, "D", True),
            (1, "response", None, "B", True), (1, "response", None, "A", True), (8, "revisit", 1, None, True)]
    records = spark.createDataFrame(rows, "page_id long, record_type string, refers_to long, payload_digest string, digest_ok boolean")
    got = [(r["page_id"], r["payload_digest"], r["refers_ok"]) for r in warc.check_revisits(records).collect()]
    want = {2: True, 3: True, 4: False, 6: False, 7: False, 8: False}
    assert sorted(got, key=key) == sorted(((r[0], r[3], want.get(r[0])) for r in rows), key=key)


def test_warc_empty(spark):
    table, _ = pages(spark)
    path = scratch(spark, "test-warc")
    warc.write_archives(table.limit(0), path)
    assert warc.read_archives(spark, path).collect() == []
