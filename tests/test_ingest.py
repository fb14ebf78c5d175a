import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.sources import raw as rw
from ledgerline.sources import sinks

HEADER = ",".join(f'"{h}"' if "," in h else h for _, h in fixed.RAW_COLUMNS)
GOOD = "2024-01-02,Mortgage,,Issue A,,,,Acme,CA,94110,,Web,2024-01-03,Closed,Yes,1"
QUOTED = ('2024-01-02,Mortgage,,Issue B,,"line one\nline two, with ""quotes""",,Acme,CA,94110,,Web,2024-01-03,'
          'Closed,Yes,2')
SHORT = "2024-01-02,Mortgage,,Issue C,,,,Acme,CA,94110,,Web,2024-01-03,Closed,Yes"
LONG = "2024-01-02,Mortgage,,Issue D,,,,Acme,CA,94110,,Web,2024-01-03,Closed,Yes,4,extra"


def test_csv_edge_rows(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    with open(os.path.join(d, "chunk.csv"), "w") as f:
        f.write("\n".join([HEADER, GOOD, QUOTED, SHORT, LONG]) + "\n")
    table = os.path.join(d, "raw_table")
    r = rw.load_run(spark, d + "/chunk.csv", table, "run-1", "u", dt.datetime(2024, 1, 5), dt.date(2024, 1, 5))
    ok = {x.complaint_id: x for x in rw.accepted_rows(r).collect()}
    assert set(ok) == {"1", "2"}
    assert ok["2"].consumer_complaint_narrative == 'line one\nline two, with "quotes"'
    assert ok["1"].sub_product is None                      # empty -> NULL
    assert rw.rejects(r).count() == 2
    v = rw.load_verification(r, "run-1").collect()[0]
    assert v.row_count == 4 and v.null_ids == 1
    assert all(x.source_file_name == "chunk.csv" for x in ok.values())


def test_header_diff(spark):
    expected = [h for _, h in fixed.RAW_COLUMNS]
    actual = expected[:3] + expected[4:] + ["Consumer disputed?"]
    actual[0], actual[1] = actual[1], actual[0]
    rows = {(r.column, r.state) for r in rw.header_diff(spark, actual).collect()}
    assert (expected[3], "missing") in rows
    assert ("Consumer disputed?", "added") in rows
    assert any(s == "reordered" for _, s in rows)


def test_export_guards(spark):
    df = spark.createDataFrame([("1", True, "x")], "complaint_id string, has_narrative boolean, zip_code string")
    assert sinks.allowlisted(df, fixed.CASE_CONTEXT_ALLOWLIST).columns == ["complaint_id", "has_narrative"]
    try:
        sinks.assert_no_forbidden(df)
        raise AssertionError("expected refusal")
    except sinks.ForbiddenColumnError:
        pass


def test_write_chunks_round_trip(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    src = spark.range(25).select(*[(F.col("id").cast("string") if n == "complaint_id" else F.lit(" v "))
                                  .alias(n) for n, _ in fixed.RAW_COLUMNS])
    rw.write_chunks(src.toDF(*[h for _, h in fixed.RAW_COLUMNS]), d + "/out", rows=10, partitions=1)
    files = [f for f in os.listdir(d + "/out") if f.endswith(".csv.gz")]
    assert len(files) == 3
    back = rw.read_raw(spark, d + "/out")
    assert back.filter(F.col("product") == " v ").count() == 25    # whitespace preserved


def test_drifted_headers_and_repeated_runs_are_refused(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    names = [h for _, h in fixed.RAW_COLUMNS]
    swapped = [names[3] if n == names[1] else names[1] if n == names[3] else n for n in names]
    for kind, header in (("good", names), ("swapped", swapped), ("short", names[:-1]), ("internal", [n for n, _ in fixed.RAW_COLUMNS])):
        os.makedirs(f"{d}/{kind}")
        with open(f"{d}/{kind}/chunk.csv", "w") as f:
            f.write(",".join(header) + "\n" + GOOD + "\n")
    when = (dt.datetime(2024, 1, 5), dt.date(2024, 1, 5))
    assert rw.load_run(spark, f"{d}/good", f"{d}/table", "run-1", "u", *when).count() == 1
    with pytest.raises(rw.LoadRefused):
        rw.load_run(spark, f"{d}/good", f"{d}/table", "run-1", "u", *when)
    for kind in ("swapped", "short", "internal"):
        with pytest.raises(rw.LoadRefused, match="header"):
            rw.load_run(spark, f"{d}/{kind}", f"{d}/table", f"run-{kind}", "u", *when)
    assert rw.read_runs(spark, f"{d}/table").count() == 1 and rw.loaded_runs(spark, f"{d}/table") == ["run-1"]
    report = rw.header_report(rw.file_headers(spark, [f"{d}/good", f"{d}/swapped", f"{d}/short"])).collect()
    assert {(os.path.basename(os.path.dirname(r.file_name)), r.column, r.state) for r in report} == {
        ("swapped", names[1], "reordered"), ("swapped", names[3], "reordered"), ("short", names[-1], "missing")}


def test_gate(spark):
    checks = spark.createDataFrame([("a", True), ("b", False)], "check string, passed boolean")
    assert rw.gate(checks.filter("passed")).count() == 1
    with pytest.raises(rw.LoadRefused, match="b"):
        rw.gate(checks)


# -- one file, many tasks -------------------------------------------------------------

@pytest.fixture
def tiny_blocks(spark):
    """Text splits of a few bytes, so that records, quotes and even fields lie across them."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None, "spark.sql.files.minPartitionNum": None}
    for n in names:
        names[n] = spark.conf.get(n, None)

    def use(size: int):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1000")

    yield use
    for n, v in names.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def awkward_csv(r, rows: int, end: str) -> str:
    import csv
    import io
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow([h for _, h in fixed.RAW_COLUMNS])
    said = ["", "plain", 'a "quoted" word', "two\nlines", '"', '""', 'ends with "', "\n\n\n", ",,\n,", "é漢\n\u2028", "x" * 90 + "\n" + "y" * 200, " padded "]
    for i in range(rows):
        row = ["2024-01-02", r.choice(said) or "p", *[r.choice(said) for _ in range(13)], str(i)]
        row = row[:r.choice([16, 16, 16, 15])] + (["more"] if r.random() < .05 else [])
        w.writerow(row)
        if r.random() < .1:
            out.write(end)                            # an empty line
    return out.getvalue()


@pytest.mark.parametrize("size,end", [(150, "\n"), (400, "\r\n")])
def test_split_reader_equals_the_multi_line_reader(spark, tiny_blocks, size, end):
    import random
    from collections import Counter
    r = random.Random(size)
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    for k in range(2):
        with open(f"{d}/part {k}.csv", "w", newline="") as f:
            f.write(awkward_csv(r, 12, end).rstrip("\r\n" if k else ""))       # the second without a last line break
    cols = [*[n for n, _ in fixed.RAW_COLUMNS], F.col("_metadata.file_name")]
    want = rw.read_raw(spark, d).select(rw.CORRUPT, *cols).collect()
    tiny_blocks(size)
    got = rw.read_raw_split(spark, d).select(rw.CORRUPT, *cols).collect()
    ok = lambda rows: Counter(tuple(x)[1:] for x in rows if x[rw.CORRUPT] is None)
    assert ok(got) == ok(want) and len(got) == len(want) > 20
    assert Counter(x[rw.CORRUPT].strip() for x in got if x[rw.CORRUPT]) == Counter(x[rw.CORRUPT].strip() for x in want if x[rw.CORRUPT])


def test_split_reader_in_groups_and_tasks(spark, tiny_blocks):
    import random
    from ledgerline.sources import split_csv
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    for k in range(3):
        with open(f"{d}/{k}.csv", "w") as f:
            f.write(awkward_csv(random.Random(k), 8, "\n"))
    tiny_blocks(500)
    assert split_csv._lines(spark, [f"{d}/0.csv"]).rdd.getNumPartitions() > 8
    sizes = split_csv.file_sizes(spark, [d])
    assert sorted(n for _, n in sizes) == sorted(os.path.getsize(f"{d}/{k}.csv") for k in range(3))
    assert len(list(split_csv._groups(sizes, 500, 10))) == 3
    together = sorted(map(tuple, split_csv.split_records(spark, d).collect()))
    assert together == sorted(map(tuple, split_csv.split_records(spark, d, blocks=10).collect()))
    assert sum(x[1] for x in together) == 3
    os.makedirs(f"{d}/empty")
    open(f"{d}/empty/none.csv", "w").close()
    assert split_csv.split_records(spark, f"{d}/empty").collect() == []


def test_split_reader_refuses_drifted_headers(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    names = [h for _, h in fixed.RAW_COLUMNS]
    with open(f"{d}/chunk.csv", "w") as f:
        f.write(",".join(names[::-1]) + "\n" + GOOD + "\n")
    when = (dt.datetime(2024, 1, 5), dt.date(2024, 1, 5))
    with pytest.raises(rw.LoadRefused, match="reordered"):
        rw.load_run(spark, f"{d}/chunk.csv", f"{d}/table", "run-1", "u", *when, read=rw.read_raw_split)
    assert rw.loaded_runs(spark, f"{d}/table") == []


def test_headers_of_any_width(spark):
    d = tempfile.mkdtemp(prefix="ledgerline-test-")
    names = [h for _, h in fixed.RAW_COLUMNS] + [f"Added {k}" for k in range(24)] + ['With, comma', 'With "quote"', ""]
    with open(f"{d}/wide.csv", "w") as f:
        f.write("\ufeff" + ",".join('"' + n.replace('"', '""') + '"' if k % 2 or "," in n or '"' in n else n for k, n in enumerate(names)) + "\r\n")
        f.write("x,y\n" * 1000)
    (row,) = rw.file_headers(spark, d).collect()
    assert row["header"] == names
    report = {(r.column, r.state) for r in rw.header_report(rw.file_headers(spark, d)).collect()}
    assert report == {(n, "added") for n in names[16:]}


def test_refused_load_reads_headers_of_one_group(spark, monkeypatch, tmp_path):
    """Of many drifted files a few explain the refusal; a single one among good ones is found by its name."""
    names = [h for _, h in fixed.RAW_COLUMNS]
    monkeypatch.setattr(rw, "FILES_AT_ONCE", 2)
    read, plain = [], rw._headers
    monkeypatch.setattr(rw, "_headers", lambda s, files: read.append(len(files)) or plain(s, files))
    when = (dt.datetime(2024, 1, 5), dt.date(2024, 1, 5))
    for kind, short in (("all", range(9)), ("one", [7])):
        os.makedirs(tmp_path / kind)
        for k in range(9):
            (tmp_path / kind / f"chunk{k}.csv").write_text(",".join(names[:-1] if k in short else names) + "\n" + GOOD + "\n")
        with pytest.raises(rw.LoadRefused, match=f"chunk{short[0] if len(short) == 1 else '.'}.csv: {names[-1]} missing"):
            rw.load_run(spark, str(tmp_path / kind), str(tmp_path / f"{kind}-raw"), "run-1", "u", *when)
    assert read == [2, 2]                                        # one group for each load
    assert [tuple(r)[1:] for r in rw.header_differences(spark, str(tmp_path / "one"))] == [(names[-1], "missing")]      # without its name: by the groups


def test_lines_go_with_their_blocks_number(spark, tiny_blocks, tmp_path):
    """Every block has a number; a line is not followed by the name of its file."""
    from ledgerline.sources import split_csv
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text("h,i\n" + "".join(f'{i},"a\n""b\n{i}"\n' for i in range(40)))
    tiny_blocks(100)
    lines = split_csv._lines(spark, [str(tmp_path / f"{k}.csv") for k in range(2)])
    blocks = split_csv.known_blocks(lines).collect()
    assert len({b["code"] >> 2 for b in blocks}) == len(blocks) > 4 and sum(b["code"] & 1 for b in blocks) == 2 and any(b["code"] & 2 for b in blocks)
    assert "file" not in split_csv._PIECES
    got = split_csv.split_records(spark, str(tmp_path)).collect()
    assert sorted(r["text"] for r in got) == sorted(2 * (["h,i"] + [f'{i},"a\n""b\n{i}"' for i in range(40)])) and sum(r["first"] for r in got) == 2


# -- block-gzipped files ----------------------------------------------------------------

def block_gzipped(r, data: bytes, most: int) -> bytes:
    """Members that begin and end anywhere in the text, some of them empty, as any BGZF writer may make them."""
    import struct
    import zlib
    out, at = b"", 0
    while at < len(data):
        text = data[at:at + r.randrange(1, most)] if r.random() < .9 else b""
        at += len(text)
        packer = zlib.compressobj(r.choice([0, 1, 9]), zlib.DEFLATED, -15)
        body = packer.compress(text) + packer.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(text), len(text))
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


@pytest.mark.parametrize("seed,most,parts,end", [(1, 40, 40, "\n"), (2, 300, 150, "\r\n"), (3, 2000, 12, "\n")])
def test_block_gzipped_files_are_read_as_plain_ones(spark, tiny_blocks, tmp_path, seed, most, parts, end):
    import gzip
    import random
    from collections import Counter
    r = random.Random(seed)
    for kind in ("plain", "zipped"):
        (tmp_path / kind).mkdir()
    for k in range(2):
        text = awkward_csv(r, 15, end).rstrip("\r\n" if k else "").encode()           # the second without a last line break
        (tmp_path / "plain" / f"part {k}.csv").write_bytes(text)
        (tmp_path / "zipped" / f"part {k}.csv.bgz").write_bytes(data := block_gzipped(r, text, most))
        assert gzip.decompress(data) == text
    cols = [*[n for n, _ in fixed.RAW_COLUMNS], F.regexp_replace("_metadata.file_name", ".bgz", "")]
    want = rw.read_raw(spark, str(tmp_path / "plain")).select(rw.CORRUPT, *cols).collect()
    tiny_blocks(1 << 20)
    spark.conf.set("spark.sql.files.minPartitionNum", str(parts))
    got = rw.read_raw_split(spark, str(tmp_path / "zipped")).select(rw.CORRUPT, *cols).collect()
    ok = lambda rows: Counter(tuple(x)[1:] for x in rows if x[rw.CORRUPT] is None)
    assert ok(got) == ok(want) and len(got) == len(want) > 20
    assert Counter(x[rw.CORRUPT].strip() for x in got if x[rw.CORRUPT]) == Counter(x[rw.CORRUPT].strip() for x in want if x[rw.CORRUPT])


def test_one_file_is_written_in_members(spark, tmp_path):
    """A valid gzip file of the header and every record once, long ones too; the members are not kept beside it."""
    import gzip
    from ledgerline import session
    from ledgerline.sources import split_csv
    said = ["a,b", '"x\n""y"""', '"' + "".join(map(str, range(60_000))) + '"', "é漢,"]
    frame = spark.createDataFrame([(i, f"{i},{said[i % 4]}") for i in range(300)], "i int, value string").repartition(5)
    made = len(session._SCRATCH)
    split_csv.write_one_file(frame, str(tmp_path / "out"), "h,i")
    (name,) = (f for f in os.listdir(tmp_path / "out") if f[0] not in "._")
    text = gzip.decompress((tmp_path / "out" / name).read_bytes()).decode()
    assert name.endswith(".csv.bgz") and text.startswith("h,i\n") and len(text) == 4 + sum(len(f"{i},{said[i % 4]}") + 1 for i in range(300))
    assert not any(os.path.exists(d.removeprefix("file:") + "/csv-members") for d in session._SCRATCH[made:])
    got = split_csv.split_records(spark, str(tmp_path / "out")).collect()
    assert sorted(r["text"] for r in got) == sorted(["h,i", *(f"{i},{said[i % 4]}" for i in range(300))]) and [r["text"] for r in got if r["first"]] == ["h,i"]
    split_csv.write_one_file(frame.limit(0), str(tmp_path / "none"), "h,i")
    assert split_csv.split_records(spark, str(tmp_path / "none")).collect() == []


def test_block_gzipped_files_are_held_against_the_contract(spark, tmp_path):
    """A drifted header is named; a damaged file stops the load."""
    import random
    names = [h for _, h in fixed.RAW_COLUMNS]
    when = (dt.datetime(2024, 1, 5), dt.date(2024, 1, 5))
    for kind, header in (("drifted", ",".join(names[:-1])), ("damaged", HEADER)):
        data = bytearray(block_gzipped(random.Random(4), f"{header}\n{GOOD}\n{QUOTED}\n".encode(), 1000))
        if kind == "damaged":
            data[-40] ^= 1                                    # of the last member's checksum or size
        (tmp_path / f"{kind}.csv.bgz").write_bytes(data)
    with pytest.raises(rw.LoadRefused, match=f"drifted.csv.bgz: {names[-1]} missing"):
        rw.load_run(spark, str(tmp_path / "drifted.csv.bgz"), str(tmp_path / "table"), "run-1", "u", *when, read=rw.read_raw_split)
    with pytest.raises(Exception, match="block-gzip member"):
        rw.load_run(spark, str(tmp_path / "damaged.csv.bgz"), str(tmp_path / "table"), "run-1", "u", *when, read=rw.read_raw_split)
    assert rw.loaded_runs(spark, str(tmp_path / "table")) == []


def test_split_reader_writes_only_fragments(spark, tiny_blocks, tmp_path):
    """The records of a file, plain or block-gzipped, are not written beside it."""
    import random
    import string
    from ledgerline import session
    from ledgerline.sources import split_csv
    r = random.Random(5)
    rows = [f'{i},"' + "".join(r.choices(string.ascii_letters, k=1000)) + f'\n{i}"' for i in range(1000)]
    text = ("h,i\n" + "\n".join(rows) + "\n").encode()
    (tmp_path / "a.csv").write_bytes(text)
    (tmp_path / "b.csv.bgz").write_bytes(block_gzipped(r, text, 65_000))
    tiny_blocks(1 << 20)
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    for name in ("a.csv", "b.csv.bgz"):
        made = len(session._SCRATCH)
        got = split_csv.split_records(spark, str(tmp_path / name)).collect()
        assert sorted(x["text"] for x in got) == sorted(["h,i", *rows])
        sizes = [os.path.getsize(os.path.join(at, f)) for d in session._SCRATCH[made:] for at, _, files in os.walk(d.removeprefix("file:")) for f in files if f.endswith(".parquet")]
        assert sizes and sum(sizes) < len(text) / 4


def test_one_file_takes_less_disk_than_its_text(spark):
    from ledgerline import session
    from ledgerline.plans import load_all
    from conftest import SF_SMALL
    made = len(session._SCRATCH)
    rows = load_all()["csv_one_file"].build(spark, SF_SMALL)
    text = rows.agg(F.sum("narrative_length")).collect()[0][0]
    held = sum(os.path.getsize(os.path.join(at, f)) for d in {*session._SCRATCH[made:]} for at, _, files in os.walk(d.removeprefix("file:")) for f in files)
    assert 0 < held < text / 2
