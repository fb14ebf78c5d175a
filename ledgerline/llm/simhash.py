"""SimHash near-dedup over vantage-point shards.

1. Every text gets a 64-bit fingerprint: a bit is 1 if it is set in more than
   half of the XXH64 (seed 42) hashes of its word shingles, repeats included.
   Equal fingerprints are folded first, so copies cost one row each task.
2. A vantage-point tree over a bounded sample of distinct fingerprints splits
   the Hamming space into shards.  A fingerprint lives in one shard; it also
   queries each shard its ball of `max_bits` reaches, by the triangle bounds
   |d(x, v) - radius|.  Of two shards only one direction is asked.
3. Inside a shard the same splitting goes on until blocks are small, then every
   pair of a block is compared exactly.  A shard returns a spanning forest,
   never all pairs, so a dense group costs one row for each fingerprint.
4. Alternating star contraction joins the forests into components.

The sample only balances the shards: any tree gives the exact links.
The tree that every task holds has MOST_SHARDS leaves at most.  Beyond, each leaf
has a tree of its own, built on a sample of its members: tasks that each hold
one such tree and PART of the leaf's members and askers route those to shards
below it, so tree, routing task and shard stay bounded whatever the input.

Defined cases: null, empty and wordless texts have fingerprint zero and link
like any other; fewer words than the shingle length give one shingle of the
whole sequence; repeated rows get equal results, and an id that occurs with
several texts links nothing by itself; a row without id has a fingerprint but no
component, and links nothing.  Empty table, empty result.
Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import apply_verdicts, stage, text_key
from ledgerline.llm.components import connected_components

SEED = 42
#: Members of a shard on average; least and most shards; sample for each shard.
PER_SHARD, LEAST_SHARDS, MOST_SHARDS, SAMPLE = 2048, 32, 1 << 16, 8
#: Fingerprints routed at once.
PART = 1 << 17
_ROUTED = "shard long, own binary, ask binary"
#: Members of a block that is compared pair by pair, and cells of one comparison.
BLOCK, CELLS = 256, 1 << 21


def simhash(text: bytes | None, shingle: int) -> int:
    words = (text or b"").lower().split()        # bytes.lower() changes A-Z only
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(hashes[at:at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(x.as_py(), shingle) for x in batch["text"]], np.uint64)
            yield pa.record_batch({"id": batch["id"], "key": batch["key"], "fp": pa.array(fp.view(np.int64), pa.int64())})
    return run


@dataclass
class Node:
    vantage: int = 0
    radius: int = 0
    inner: Node | None = None
    outer: Node | None = None
    shard: int = -1


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The candidate with the widest spread of distances, and the radius that
    halves the points best; None if every point is the same."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, 6).astype(int)]:
        d = distances(points, v)
        spread = float(d.std())
        if best is None or spread > best[0]:
            best = (spread, v, d)
    _, v, d = best
    if d.max() == d.min():
        return None
    radius = int(np.median(d))
    if radius >= d.max():
        radius = int(d[d < d.max()].max())
    return v, radius


def build_tree(sample: np.ndarray, shards: int) -> tuple[Node, int]:
    made = 0

    def grow(points: np.ndarray, n: int) -> Node:
        nonlocal made
        cut = _split(points) if n > 1 and len(points) > 1 else None
        if cut is None:
            made += 1
            return Node(shard=made - 1)
        inside = distances(points, cut[0]) <= cut[1]
        return Node(int(cut[0]), cut[1], grow(points[inside], n - n // 2), grow(points[~inside], n // 2))

    return grow(np.sort(sample), shards), made


def asks(home: np.ndarray, shard: int) -> np.ndarray:
    """Of two shards one asks the other; which one alternates, for balance."""
    return (home < shard) == ((home + shard) % 2 == 0)


def reached(node: Node, points: np.ndarray, at: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, those of the indices `at` whose ball reaches it)."""
    if not len(at):
        return
    if node.shard >= 0:
        yield node.shard, at
        return
    d = distances(points[at], np.uint64(node.vantage)).astype(np.int16)
    yield from reached(node.inner, points, at[d - max_bits <= node.radius], max_bits)
    yield from reached(node.outer, points, at[d + max_bits > node.radius], max_bits)


def route(tree: Node, points: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, indices that live there, indices that ask there)."""
    home = np.full(len(points), -1)

    def settle(node: Node, at: np.ndarray) -> None:
        if node.shard >= 0:
            home[at] = node.shard
        elif len(at):
            inside = distances(points[at], np.uint64(node.vantage)) <= node.radius
            settle(node.inner, at[inside])
            settle(node.outer, at[~inside])

    every = np.arange(len(points))
    settle(tree, every)
    for shard, at in reached(tree, points, every, max_bits):
        own = home[at] == shard
        yield shard, at[own], at[~own & asks(home[at], shard)]


def _routed(tree: Node, max_bits: int):
    def flush(fps: list):
        fp = np.concatenate(fps)
        found = [(s, fp[own].tobytes(), fp[ask].tobytes()) for s, own, ask in route(tree, fp, max_bits) if len(own) + len(ask)]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.binary(), pa.binary()))], names=["shard", "own", "ask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            fps.append(batch["fp"].to_numpy().view(np.uint64))
            n += batch.num_rows
            if n >= PART:
                yield flush(fps)
                fps, n = [], 0
        if n:
            yield flush(fps)
    return run


def _points(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u8")


def _subdivided(routed: DataFrame, leaves: int, max_bits: int) -> DataFrame:
    """The same members and askers, in about `leaves` shards for each one of `routed`.

    A member lives in one shard below its own and asks others there as `route` has
    it; an asker from elsewhere asks all that its ball reaches."""
    rows = stage(routed, "simhash-routed")
    most = (rows.groupBy("shard").agg(F.sum(F.octet_length("own") + F.octet_length("ask")).alias("n")).agg(F.max("n")).first()[0] or 0) // 8
    parts = max(1, -(-most // PART))
    chance = int(min(1.0, SAMPLE / PER_SHARD) * (2**64 - 1))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_points([x.as_py()]) for x in batch["own"]]
            some = [x[x * np.uint64(0x9E3779B97F4A7C15) <= np.uint64(chance)].tobytes() for x in own]
            yield pa.record_batch({"shard": batch["shard"], "some": pa.array(some, pa.binary())})

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, _ = build_tree(_points(pdf["some"]), leaves)
        return pd.DataFrame({"shard": pdf["shard"][:1], "tree": [pickle.dumps(tree)]})

    def below(key: tuple, members: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        tree = pickle.loads(trees["tree"].iloc[0]) if len(trees) else Node(shard=0)      # too small to be sampled
        own, ask = _points(members["own"]), _points(members["ask"])
        found = defaultdict(lambda: [b"", b""])
        for leaf, here, asking in route(tree, own, max_bits):
            found[leaf] = [own[here].tobytes(), own[asking].tobytes()]
        for leaf, asking in reached(tree, ask, np.arange(len(ask)), max_bits):
            found[leaf][1] += ask[asking].tobytes()
        return pd.DataFrame([((key[0] << 32) + leaf, *x) for leaf, x in found.items()], columns=["shard", "own", "ask"])

    trees = (rows.mapInArrow(sampled, "shard long, some binary").filter(F.octet_length("some") > 0)
             .groupBy("shard").applyInPandas(grown, "shard long, tree binary"))
    every_part = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("own", "ask"), F.lit(parts)).cast("int"))
    return dealt.groupBy("shard", "part").cogroup(every_part.groupBy("shard", "part")).applyInPandas(below, _ROUTED)


def near_pairs(points: np.ndarray, n_own: int, max_bits: int, emit: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """All (asker, owner) index pairs at most max_bits apart, owners being the
    first n_own points and askers all points, handed to emit in blocks."""

    def search(own: np.ndarray, ask: np.ndarray) -> None:
        if not len(own) or not len(ask):
            return
        cut = _split(points[own]) if len(own) > BLOCK else None
        if cut is None:
            step = max(1, CELLS // len(own))
            for at in range(0, len(ask), step):
                block = ask[at:at + step]
                i, j = np.nonzero(np.bitwise_count(points[block][:, None] ^ points[own][None, :]) <= max_bits)
                differ = block[i] != own[j]
                emit(block[i][differ], own[j][differ])
            return
        v, radius = cut
        d_own, d_ask = distances(points[own], v), distances(points[ask], v).astype(np.int16)
        search(own[d_own <= radius], ask[d_ask - max_bits <= radius])
        search(own[d_own > radius], ask[d_ask + max_bits > radius])

    search(np.arange(n_own), np.arange(len(points)))


class Forest:
    """Smallest-label components of index pairs that arrive in blocks."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.a, self.b, self.held = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > 1 << 21:
            self.fold()

    def fold(self) -> np.ndarray:
        if self.held:
            a, b, lab = np.concatenate(self.a), np.concatenate(self.b), self.label
            while True:
                la, lb = lab[a], lab[b]
                apart = la != lb
                if not apart.any():
                    break
                a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
                low, high = np.minimum(la, lb), np.maximum(la, lb)
                np.minimum.at(lab, high, low)
                while (lab[lab] != lab).any():
                    lab = lab[lab]
            self.label, self.a, self.b, self.held = lab, [], [], 0
        return self.label


def _linked(max_bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(np.frombuffer(b"".join(pdf["own"]), "<u8"))
        ask = np.sort(np.frombuffer(b"".join(pdf["ask"]), "<u8"))
        both = np.concatenate([own, ask])
        forest = Forest(len(both))
        near_pairs(both, len(own), max_bits, forest.add)
        root = forest.fold()
        fp = both.view(np.int64)
        linked = root != np.arange(len(both))
        return pd.DataFrame({"a": fp[linked], "b": fp[root[linked]]})
    return run


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """id, key (of the text), fp: one row per input row, written."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("key"), text.cast("binary").alias("text"))
    return stage(rows.mapInArrow(_fingerprints(shingle), "id long, key long, fp long"), "simhash-prints")


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """fp, group: every distinct fingerprint with one of those it reaches, the
    same for all of them."""
    folded = stage(prints.select("fp").distinct(), "simhash-folded")
    n = folded.count()
    wanted = max(LEAST_SHARDS, -(-n // PER_SHARD))
    shards = min(MOST_SHARDS, wanted)
    sample = [r.fp for r in folded.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE * shards).collect()]   # at most 2**19 numbers
    tree, _ = build_tree(np.array(sample, np.int64).view(np.uint64), shards)
    routed = folded.mapInArrow(_routed(tree, max_bits), _ROUTED)
    if wanted > shards:
        routed = _subdivided(routed, -(-wanted // shards), max_bits)
    links = routed.groupBy("shard").applyInPandas(_linked(max_bits), "a long, b long")
    parts = connected_components(links)
    return stage(folded.join(parts, folded["fp"] == parts["node"], "left").select("fp", F.coalesce("component", "fp").alias("group")), "simhash-labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (smallest id
    reachable over links, itself included): one row per input row."""
    prints = _prints(docs, id_col, text_col, shingle)
    least = prints.filter("id is not null").groupBy("fp").agg(F.min("id").alias("least"))        # folded: one row a fingerprint
    least = stage(least.join(_grouped(prints.filter("id is not null"), max_bits), "fp"), "simhash-least")
    labelled = least.join(least.groupBy("group").agg(F.min("least").alias("component")), "group").select("fp", "component")
    return (prints.join(labelled, "fp", "left")
            .select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component, with its own columns: the one with the smallest
    id, rows without id behind all others; of several under that id, the one of
    least fingerprint and text key.  Here rows without id link like any other."""
    prints = _prints(docs, id_col, text_col, shingle)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "fp", "key"))
    folded = prints.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stage(folded.join(_grouped(prints, max_bits), "fp"), "simhash-groups")
    several = groups.groupBy("group").agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    rows = prints.join(groups.select("fp", "group").join(several, "group"), "fp")        # only rows of components with others
    one = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("fp") == F.col("first.fp")) & (F.col("key") == F.col("first.key"))
    verdicts = rows.groupBy("id", "key").agg(F.bool_or(one).alias("one"), F.count(F.lit(1)).alias("n"))
    return apply_verdicts(docs, verdicts.filter("n > 1 or not one"), id_col, text_key(docs[text_col]))


