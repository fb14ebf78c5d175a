"""Operators 1, 6 and 8 against plain versions on awkward tables."""

import hashlib
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_cases import components, empty_docs, key, odd_docs, simhash, texts_of, without_repeats

from ledgerline.llm import exact_dedup, exchange, simhash as S, substring_dedup
from ledgerline.llm.components import connected_components


@pytest.fixture(scope="module")
def docs(spark):
    return odd_docs(spark).repartition(3).cache()


def test_rice_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        codes = np.unique(r.integers(0, 1 << 48, n, dtype=np.uint64))
        assert (exchange.rice_decode(exchange.rice_encode(codes), len(codes)) == codes).all()
    dense = np.arange(500, dtype=np.uint64)
    assert (exchange.rice_decode(exchange.rice_encode(dense), 500) == dense).all()
    assert len(exchange.rice_encode(np.unique(r.integers(0, 1 << 48, 60_000, dtype=np.uint64)))) < 60_000 * 4.5


def test_exact_dedup(docs):
    texts = texts_of(docs)
    want = []
    for i, t in texts:
        same = [j for j, u in texts if (u or "") == (t or "")]
        ids = [j for j in same if j is not None]
        keep = max(ids) if ids else None
        want.append((i, keep, len(same), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    # exactly one row of every distinct text, under the largest id that has it
    assert sorted(((t or "", i) for i, t in texts_of(left)), key=key) == sorted({(t or "", max((j for j, u in texts if (u or "") == (t or "") and j is not None), default=None))
                                                                               for _, t in texts}, key=key)
    made = docs.sparkSession.createDataFrame([(1, "A", "x"), (2, "A", "x"), (1, "B", "y"), (None, "A", "z"), (None, "N", "1"), (None, "N", "2"), (3, "B", None), (3, "B", "w")],
                                             "doc_id long, text string, more string")
    assert sorted(texts_of(exact_dedup.drop_copies(made)), key=key) == sorted([(2, "A"), (3, "B"), (None, "N")], key=key)


def test_filter_passes_every_key_and_few_others(spark):
    from pyspark.sql import functions as F
    rows = spark.range(200_000).select(F.shiftrightunsigned(F.xxhash64("id"), 16).alias("fp"), "id", F.lit("x").alias("t"))
    for n in (0, 1, 3000, 60_000):
        keys = rows.filter(F.col("id") < n).select("fp")
        got = exchange.possibly_in(rows, "fp", keys)
        assert got.columns == rows.columns
        assert got.filter(F.col("id") < n).count() == n
        assert got.count() - n <= 200_000 / 7


def test_relays_answer_like_owners(spark):
    """Codes through groups of owners and relays: the answers of the direct way."""
    r = np.random.default_rng(5)
    for wide, bits in ((False, 48), (True, 64)):
        rows, want = [], {}
        drawn = [r.integers(0, 1 << bits, 400, dtype=np.uint64) for _ in range(30)]
        pool = np.concatenate(drawn)
        for unit in range(30):
            codes = np.concatenate([drawn[unit], r.choice(pool, 20), drawn[unit][:3]])
            want[unit] = codes
            codes = np.stack([codes, codes * np.uint64(3)], axis=1) if wide else codes
            rows += exchange.block_rows(unit, codes, bits, 6, b"").to_pylist()
        messages = spark.createDataFrame([tuple(x.values()) for x in rows], exchange.STAGED).filter("owner >= 0").repartition(5)
        seen = np.unique(np.concatenate(list(want.values())), return_counts=True)
        many = set(seen[0][seen[1] > 1].tolist())
        answers = []
        for owners in (exchange.Owners(6), exchange.Owners(6, 4)):
            got = exchange.repeated(messages, owners, bits, wide).orderBy("unit", "owner").collect()
            answers.append([(a["unit"], a["owner"], a["n"], bytes(a["bits"])) for a in got])
        assert answers[0] == answers[1] and len(answers[0]) == 180
        for unit, codes in want.items():
            flags = np.concatenate([exchange.flags_of(b, n) for u, _, n, b in answers[1] if u == unit])
            assert flags.tolist() == [c in many for c in np.unique(codes).tolist()]


def test_owners_stand_in_groups_beyond_a_number():
    assert exchange.owners_for(0) == exchange.Owners(64) and exchange.owners_for(exchange.DIRECT * exchange.PER_OWNER) == exchange.Owners(exchange.DIRECT)
    many = exchange.owners_for(3_000_000 * exchange.PER_OWNER)
    # a block of 2**18 codes, and a relay of 2**20, hold hundreds of codes for each receiver
    assert many.groups * many.each >= 3_000_000 and (1 << 18) // many.groups > 100 and exchange.PER_OWNER // many.each > 100


def test_dedup_through_relays(docs, monkeypatch):
    exact = {tuple(r) for r in exact_dedup.exact_dedup(docs).collect()}
    monkeypatch.setattr(exchange, "PER_OWNER", 4)
    monkeypatch.setattr(exchange, "LEAST_OWNERS", 2)
    monkeypatch.setattr(exchange, "DIRECT", 2)
    assert exchange.owners_for(docs.count()).each > 1
    assert {tuple(r) for r in exact_dedup.exact_dedup(docs).collect()} == exact
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs.filter("length(text) < 3000 or text is null"), 12, with_text=False).collect()]
    assert sorted(got, key=key) == sorted(without_repeats([x for x in texts_of(docs) if len(x[1] or "") < 3000], 12), key=key)


def test_only_suspects_move_text(docs, spark):
    """Unique texts beside a few copies: hardly any but the copies is grouped."""
    from pyspark.sql import functions as F
    many = spark.range(20_000).select("id", F.concat(F.lit("text "), F.when(F.col("id") < 40, F.col("id") % 20).otherwise(F.col("id"))).alias("t"))
    prints = many.withColumn("fp", exact_dedup.fingerprint(F.col("t")))
    suspects = prints.groupBy("fp").count().filter("count > 1").select("fp")
    assert 40 <= exchange.possibly_in(prints, "fp", suspects).count() < 40 + 20_000 / 7


def test_blocks_of_short_texts_are_flushed(docs, monkeypatch):
    """Texts without a window make no codes, yet a block of them is bounded."""
    monkeypatch.setattr(substring_dedup, "DOCS", 5)
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs, 12, with_text=False).collect()]
    assert sorted(got, key=key) == sorted(without_repeats(texts_of(docs), 12), key=key)
    from pyspark import TaskContext
    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 0)})))
    block = substring_dedup.Block(43, 64)
    none = np.empty(0, np.uint64)
    assert not list(block.add([(1, 1)] * 4, np.zeros(4, np.int64), none.astype(np.int64), none))
    assert len(list(block.add([(1, 1)] * 4, np.zeros(4, np.int64), none.astype(np.int64), none))) == 1 and block.docs == []


def test_exact_dedup_empty(spark):
    assert exact_dedup.exact_dedup(empty_docs(spark)).collect() == []


def test_fingerprint_collisions_are_split_by_text(docs, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup, "fingerprint", lambda text: F.shiftrightunsigned(F.xxhash64(F.length(text)), 16))
    got = {tuple(r) for r in exact_dedup.exact_dedup(docs).collect()}
    monkeypatch.undo()
    assert got == {tuple(r) for r in exact_dedup.exact_dedup(docs).collect()}


def test_simhash_shards_below_shards(spark, monkeypatch):
    """Trees of two levels link the very same fingerprints, and bound every shard."""
    from pyspark.sql import functions as F
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 64, 500, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (900, 2), dtype=np.uint64), axis=1)
    prints = np.unique(np.concatenate([base, r.choice(base, 900) ^ flips]))
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long").repartition(4)
    links, step = [], 200
    for at in range(0, len(prints), step):
        i, j = np.nonzero(np.bitwise_count(prints[at:at + step, None] ^ prints[None, :]) <= 2)
        links += [(int(a) + at, int(b)) for a, b in zip(i, j) if a + at < b]
    label = list(range(len(prints)))
    for _ in range(len(prints)):
        before = list(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    want = {}
    for x, g in zip(prints.view(np.int64).tolist(), label):
        want.setdefault(g, set()).add(x)
    made = []
    below = S._subdivided
    monkeypatch.setattr(S, "_subdivided", lambda *args: made.append(below(*args)) or made[-1])
    for name, value in (("PER_SHARD", 16), ("LEAST_SHARDS", 2), ("MOST_SHARDS", 4), ("PART", 64)):
        monkeypatch.setattr(S, name, value)
    got = {}
    for row in S._grouped(frame, 2).collect():
        got.setdefault(row["group"], set()).add(row["fp"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(got) < len(prints)
    sizes = [x["n"] // 8 for x in made[0].groupBy("shard").agg(F.sum(F.octet_length("own")).alias("n")).collect()]
    assert sum(sizes) == len(prints) and len(sizes) > 40 and max(sizes) < len(prints) / 8


@pytest.mark.parametrize("bits", [2, 9])
def test_simhash(docs, bits):
    texts = texts_of(docs)
    known = [(i, simhash(t)) for i, t in texts if i is not None]
    comp = components([i for i, _ in known], [f for _, f in known], bits)
    want = [(i, f"{simhash(t):016x}", comp.get(i)) for i, t in texts]
    got = [tuple(r) for r in S.near_duplicates(docs, max_bits=bits).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("bits", [2, 9])
def test_drop_near_copies_by_row(docs, bits):
    """One row of each component of the rows, ids repeated or missing."""
    made = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(
        [(1, "another text under the id of the first row"), (None, "only here and without an id at all"), (None, "only here and without an id at all")], "doc_id long, text string"))
    rows = texts_of(made)
    comp = components(list(range(len(rows))), [simhash(t) for _, t in rows], bits)
    groups = {}
    for k, row in enumerate(rows):
        groups.setdefault(comp[k], []).append(row)
    left = S.drop_near_copies(made, max_bits=bits)
    assert left.columns == made.columns
    left = texts_of(left)
    assert len(left) == len(groups)
    for members in groups.values():
        stayed = [r for r in left if r in members]
        least = min((i for i, _ in members if i is not None), default=None)
        assert [i for i, _ in stayed] == [least]
    assert S.drop_near_copies(docs, max_bits=bits).columns == docs.columns


def test_simhash_empty(spark):
    assert S.near_duplicates(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("near", [False, True])
def test_vantage_shards_find_every_pair(near):
    r = np.random.default_rng(3)
    points = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    if near:                                   # one dense group
        points[:2000] = points[0] ^ (np.uint64(1) << r.integers(0, 64, 2000, dtype=np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 2000, dtype=np.uint64))
    points[2500:2600] = points[100:200] ^ np.uint64(5)
    points = np.unique(points)
    tree, n = S.build_tree(points[::7], 32)
    found = set()
    for shard, own, ask in S.route(tree, points, 2):
        at = np.r_[own, ask]
        S.near_pairs(points[at], len(own), 2, lambda a, b: found.update(map(frozenset, zip(at[a].tolist(), at[b].tolist()))))
    want = {frozenset((i, int(j) + i + 1)) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 2)}
    assert found == want and want and n > 8


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5), (399, 3), (3, 399)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 3 for i in [7, *range(200, 400)]}


@pytest.mark.parametrize("size", [5, 12])
def test_substring_dedup(docs, size):
    want = without_repeats(texts_of(docs), size)
    got = substring_dedup.substring_dedup(docs, size)
    rows = [tuple(r[:4]) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(want, key=key)
    for r in got.filter("kept_text is not null").collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def test_substring_dedup_empty(spark):
    assert substring_dedup.substring_dedup(empty_docs(spark), 5).collect() == []


def test_saturated_sketch_loses_nothing(docs, monkeypatch):
    """With a sketch of a few cells every window is a candidate; the result stays."""
    monkeypatch.setattr(substring_dedup, "CELL_BITS", 3)
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs, 5, with_text=False).collect()]
    assert sorted(got, key=key) == sorted(without_repeats(texts_of(docs), 5), key=key)
