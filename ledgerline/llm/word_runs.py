"""Periodic runs of words, found by the branching-tandem test on an enhanced
suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least `min_length` words and `min_exponent` periods long, that no
neighbouring word extends.  Each run ends in one *branching* square: two equal
halves of q words whose next words differ.  So:

1. A task reads whole texts until they hold `BLOCK` words and writes them, as word
   numbers, one behind the other with a number of its own after each text, so no
   repeat reaches over a text's end.  Prefix doubling sorts the suffixes (SA) and
   ranks them (ISA); it sorts only suffixes that are not yet told apart, and keeps
   the classes of equal 2^k-grams.  Those give the LCP of neighbours.
2. Every LCP interval of depth d (all suffixes that share d words) is found from
   the previous and next smaller LCP; no tree is built.  Its children are cut at
   the LCPs equal to d.  For each suffix i in any but the largest child the test
   asks by ISA whether i+d or i-d lies in the same interval, and whether the word
   behind tells the two apart: then i, or i-d, starts a branching square.  Leaving
   out the largest child keeps the number of tests at n log n.
3. Squares are rotated to the left, in steps of halving powers of two, while the
   rotated one is a square of equal 2^k-grams still.  Squares that reach the same
   stretch are one run, of the least period.

All is array work on a block; nothing is shuffled.  A text is never split, so a
block is as large as its last text makes it.

Defined cases: null text is empty and holds no word; a null id is carried as
null; repeated rows are judged each for itself; an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words handled at once; suffix tests expanded at once.
BLOCK, TESTS = 1 << 18, 1 << 22
_RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, text string"


class SuffixArray:
    """SA, ISA, LCP and the classes of equal 2^k-grams of a sequence whose last
    number occurs once."""

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        self.words = numbers.astype(np.int64)
        sa = np.argsort(self.words, kind="stable")
        rank = self._ranked(self.words[sa], np.arange(n), sa, np.empty(n, np.int64))
        self.grams, step = [rank.astype(np.int32)], 1
        while True:
            tied = self._tied(rank[sa])
            if not len(tied):
                break
            at = sa[tied]                                  # a tied suffix has `step` more numbers: the last one is unique
            key = rank[at] * (n + 1) + rank[at + step]
            order = np.argsort(key, kind="stable")
            sa[tied] = at[order]
            rank = self._ranked(key[order], tied, sa[tied], rank.copy())
            self.grams.append(rank.astype(np.int32))
            step *= 2
        self.sa, self.isa = sa, rank
        self.lcp = self._common()

    @staticmethod
    def _ranked(keys: np.ndarray, places: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Rank of each suffix: the place of the first one equal to it."""
        first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.empty(0, bool)
        rank[at] = places[np.flatnonzero(first)][np.cumsum(first) - 1]
        return rank

    @staticmethod
    def _tied(ranks: np.ndarray) -> np.ndarray:
        same = ranks[1:] == ranks[:-1]
        return np.flatnonzero(np.r_[same, False] | np.r_[False, same])

    def _common(self) -> np.ndarray:
        """lcp[k]: numbers shared by the suffixes at places k-1 and k; -1 at both ends."""
        n = len(self.sa)
        a, b, total = self.sa[:-1].copy(), self.sa[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
        for k in reversed(range(len(self.grams) - 1)):      # no two are equal in the last
            same = self.grams[k][a] == self.grams[k][b]
            for x in (a, b, total):
                x[same] += 1 << k
        return np.r_[-1, total, -1] if n else np.empty(0, np.int64)

    def back(self, at: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The first place from which on the numbers up to `at` equal those
        `distance` later."""
        at = at.copy()
        for k in reversed(range(len(self.grams) - 1)):
            to = np.maximum(at - (1 << k), 0)
            same = (at >= 1 << k) & (self.grams[k][to] == self.grams[k][to + distance])
            at[same] = to[same]
        return at


def smaller(lcp: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """The nearest place before (step -1) or behind (step 1) with a smaller LCP,
    by pointer jumping: what a pointer has passed is known to be no smaller."""
    to = np.arange(len(lcp)) + step
    open_ = places
    while len(open_):
        open_ = open_[lcp[to[open_]] >= lcp[open_]]
        to[open_] = to[to[open_]]
    return to[places]


def tests(sa: SuffixArray) -> Iterator[tuple[np.ndarray, ...]]:
    """(suffix, depth, first place, last place): the suffixes of every LCP
    interval that are in none but its smaller children."""
    cuts = np.flatnonzero(sa.lcp > 0)
    if not len(cuts):
        return
    left, right = smaller(sa.lcp, cuts, -1), smaller(sa.lcp, cuts, 1) - 1
    order = np.lexsort((cuts, right, left))
    cuts, left, right = cuts[order], left[order], right[order]
    new = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]
    end = np.r_[new[1:], True]
    # children of an interval: from its first place to its first cut, from cut to cut, from its last cut on
    interval = np.r_[np.cumsum(new) - 1, np.arange(new.sum())]
    start = np.r_[cuts, left[new]]
    stop = np.r_[np.where(end, right + 1, np.r_[cuts[1:], 0]), cuts[new]]
    depth, low, high = sa.lcp[cuts[new]], left[new], right[new]
    order = np.lexsort((start, start - stop, interval))       # the largest child of each interval first
    interval, start, size = interval[order], start[order], (stop - start)[order]
    small = np.r_[False, interval[1:] == interval[:-1]]
    interval, start, size = interval[small], start[small], size[small]
    upto, a = np.cumsum(size), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] - size[a] + TESTS, side="right")))
        s, first = size[a:b], upto[a:b] - size[a:b]
        place = np.arange(first[0], upto[b - 1]) + np.repeat(start[a:b] - first, s)
        owner = np.repeat(interval[a:b], s)
        yield sa.sa[place], depth[owner], low[owner], high[owner]
        a = b


def branching_squares(sa: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half length), possibly repeated."""
    n, found = len(sa.sa), [(np.empty(0, np.int64),) * 2]
    for i, d, low, high in tests(sa):
        for other, first in ((i + d, i), (i - d, i - d)):
            inside = (other >= 0) & (other < n)
            place = sa.isa[np.where(inside, other, 0)]
            at = np.flatnonzero(inside & (place >= low) & (place <= high))
            at = at[sa.words[first[at] + d[at]] != sa.words[first[at] + 2 * d[at]]]
            found.append((first[at], d[at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def runs(numbers: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (start, length, period) by start, then period."""
    sa = SuffixArray(numbers)
    square, period = branching_squares(sa)
    start, stop = sa.back(square, period), square + 2 * period
    long_ = stop - start >= np.maximum(min_length, min_exponent * period)
    start, stop, period = start[long_], stop[long_], period[long_]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])][:len(start)]
    found = np.column_stack((start, stop - start, period))[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _block(ids: list, texts: list[list[bytes]], min_length: int, min_exponent: int) -> pa.RecordBatch:
    number = defaultdict(count(len(texts)).__next__)
    ends = np.cumsum([len(words) + 1 for words in texts])
    numbers = np.fromiter((x for k, words in enumerate(texts) for part in (map(number.__getitem__, words), (k,)) for x in part), np.int64, ends[-1])
    found = runs(numbers, min_length, min_exponent)
    cut = np.searchsorted(found[:, 0], ends)
    rows, kept, a = [], [], 0
    for words, end, b in zip(texts, ends.tolist(), cut.tolist()):
        base, mine, a = end - 1 - len(words), found[a:b].tolist(), b
        rows.append([{"start": start - base, "length": length, "period": period} for start, length, period in mine])
        if mine:
            stay = np.ones(len(words), bool)
            for start, length, period in mine:
                stay[start - base + period:start - base + length] = False
            words = [words[k] for k in np.flatnonzero(stay)]
        kept.append(b" ".join(words).decode())
    run = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
    return pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "runs": pa.array(rows, pa.list_(run)), "text": pa.array(kept, pa.string())})


def _runs(min_length: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                ids.append(doc_id.as_py())
                texts.append(text.as_buffer().to_pybytes().split())     # bytes.split(): the word rule
                size += len(texts[-1]) + 1
                if size >= BLOCK:
                    yield _block(ids, texts, min_length, min_exponent)
                    ids, texts, size = [], [], 0
        if ids:
            yield _block(ids, texts, min_length, min_exponent)
    return run


def word_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period of each, in words, by start, then
    period) and text: the words joined by one space, without those that lie in a
    run behind its first period.  One row per document."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run is at least two words and two periods long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).mapInArrow(_runs(min_length, min_exponent), _RUNS)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs; start, length, period and exponent_milli of the run with the
    greatest length / period (ties: smallest start, then period; no run: nulls);
    SHA-256 of all runs and of the text that is left."""
    def better(a: Column, b: Column) -> Column:
        """Fractions compared by their cross products, so exactly."""
        more = b["length"] * a["period"] - a["length"] * b["period"]
        return F.signum(F.when(more != 0, more).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])).cast("int")

    best = F.get(F.array_sort("runs", better), F.lit(0))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
                    F.sha2("text", 256).alias("collapsed_sha256")))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeats planted in those whose id's CRC-32 h ends in 0:
    from word a = g % n on, g = h div 10, the p = 1 + (n - a) div (3 + g % 8) words
    there are repeated up to the end.  A null id plants nothing."""
    h = F.crc32(F.col(id_col).cast("long").cast("string"))
    words = F.array_remove(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n, g = F.size("__words"), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - F.col("__a")) / (3 + g % 8))).cast("int")
    tail = n - F.col("__a")
    again = F.slice(F.flatten(F.array_repeat(F.slice("__words", F.col("__a") + 1, F.col("__p")), F.ceil(tail / F.col("__p")).cast("int"))), 1, tail)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.when(h % 10 == 0, words).alias("__words"))
            .withColumn("__a", F.when(n > 0, a)).withColumn("__p", p)
            .select("doc_id", F.when(n > 0, F.concat_ws(" ", F.slice("__words", 1, F.col("__a")), again)).otherwise(F.col("text")).alias("text")))
