"""Repeated-code exchange between blocks of rows and code owners.

A *block* (unit) is a run of rows of one task.  It sends each owner of a code
range its sorted distinct codes, compactly coded; the owner answers with one
bit per code: 1 if the code occurs more than once over all blocks (or more
than once within one block, which the block says itself with its `multi`
bits).  A code shared by a third of all rows costs one entry per block, never
one per row, and nothing but codes and bits is shuffled.

Message columns: unit long, owner int, n int, codes binary, multi binary.
Answer columns:  unit long, owner int, n int, bits binary.
"""

from __future__ import annotations

from math import ceil, isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

#: Codes an owner handles on average, the least number of owners, and the most
#: that a block sends to without groups between.
PER_OWNER, LEAST_OWNERS, DIRECT = 1 << 20, 64, 1 << 12
ANSWER = "unit long, owner int, n int, bits binary"


class Owners(NamedTuple):
    """Ranges of the codes: `groups` that blocks send to, each of `each` owners."""

    groups: int
    each: int = 1


def owners_for(n_codes: int) -> Owners:
    owners = max(LEAST_OWNERS, -(-n_codes // PER_OWNER))
    groups = owners if owners <= DIRECT else isqrt(owners)
    return Owners(groups, ceil(owners / groups))


def rice_encode(codes: np.ndarray) -> bytes:
    """Golomb-Rice code of sorted distinct unsigned integers (gaps, the
    parameter the power of two nearest the mean gap)."""
    n = len(codes)
    if n == 0:
        return b""
    gaps = np.diff(codes, prepend=np.uint64(0)).astype(np.uint64)
    k = max(0, int(np.log2(max(1.0, float(codes[-1]) / n))))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    stops = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    rest = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    head = np.packbits(unary).tobytes()
    return np.array([k, len(head)], "<u4").tobytes() + head + np.packbits(rest).tobytes()


def rice_decode(blob: bytes, n: int) -> np.ndarray:
    if n == 0:
        return np.empty(0, np.uint64)
    k, size = (int(x) for x in np.frombuffer(blob, "<u4", 2))
    raw = np.frombuffer(blob, np.uint8, offset=8)
    stops = np.flatnonzero(np.unpackbits(raw[:size]))[:n]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        rest = np.unpackbits(raw[size:], count=n * k).reshape(n, k)
        gaps += rest @ (np.uint64(1) << np.arange(k, dtype=np.uint64))
    return np.cumsum(gaps, dtype=np.uint64)


def pair_encode(codes: np.ndarray) -> bytes:
    """128-bit codes, an (n, 2) array of unsigned 64-bit halves, as they are."""
    return np.ascontiguousarray(codes, "<u8").tobytes()


def pair_decode(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<u8", 2 * n).reshape(n, 2)


def bits_of(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(bool)).tobytes()


def flags_of(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def owner_of(codes: np.ndarray, code_bits: int, owners: int) -> np.ndarray:
    """Owner of a code by range (sorted codes go to ascending owners)."""
    top = (codes >> np.uint64(code_bits - 32)) if code_bits > 32 else codes << np.uint64(32 - code_bits)
    return ((top * np.uint64(owners)) >> np.uint64(32)).astype(np.int32)


def _decoded(pdf: pd.DataFrame, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Codes and multi flags of messages, one behind the other."""
    decode = pair_decode if wide else rice_decode
    return (np.concatenate([decode(b, n) for b, n in zip(pdf["codes"], pdf["n"])]),
            np.concatenate([flags_of(b, n) for b, n in zip(pdf["multi"], pdf["n"])]))


def repeated(messages: DataFrame, owners: Owners, code_bits: int, wide: bool = False) -> DataFrame:
    """Answers for all messages to the groups of `owners`.  `wide`: 128-bit codes
    instead of Rice-coded ones of `code_bits`."""
    if owners.each > 1:
        return _relayed(messages, owners, code_bits, wide)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["n"].to_numpy()
        codes, flags = _decoded(pdf, wide)
        if wide:
            order = np.lexsort((codes[:, 1], codes[:, 0]))
            same = (codes[order[1:]] == codes[order[:-1]]).all(axis=1)
        else:
            order = np.argsort(codes, kind="stable")
            same = codes[order[1:]] == codes[order[:-1]]
        flags[order[1:][same]] = True
        flags[order[:-1][same]] = True
        return pd.DataFrame({"unit": pdf["unit"], "owner": pdf["owner"], "n": pdf["n"],
                             "bits": [bits_of(x) for x in np.split(flags, np.cumsum(sizes)[:-1])]})

    return messages.groupBy("owner").applyInPandas(answer, ANSWER)


def _relayed(messages: DataFrame, owners: Owners, code_bits: int, wide: bool) -> DataFrame:
    """`repeated` through relays: `each` of them for a group, so a relay gets on
    average as many codes as an owner."""
    every = owners.groups * owners.each

    def relay(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["owner"].iloc[0])
        codes, flags = _decoded(pdf, wide)
        twice = np.concatenate([codes, codes[flags]])          # a code that its block holds more than once comes twice
        batch = block_rows(group * owners.each + int(pdf["relay"].iloc[0]), twice, code_bits, every, b"",
                           pdf["unit"].to_numpy("<i8"), pdf["n"].to_numpy("<i4"), np.array([group], "<i4"))
        return batch.to_pandas()

    def back(kept: bytes, flags: np.ndarray) -> pd.DataFrame:
        place, units, sizes, group = unpack_arrays(kept, "<u4", "<i8", "<i4", "<i4")
        cuts = np.cumsum(sizes)
        bits = np.split(flags[place[:cuts[-1]]], cuts[:-1])
        return pd.DataFrame({"unit": units, "owner": group[0], "n": sizes, "bits": [bits_of(x) for x in bits]})

    relays = (messages.withColumn("relay", F.pmod(F.xxhash64("unit"), F.lit(owners.each)).cast("int"))
              .groupBy("owner", "relay").applyInPandas(relay, STAGED))
    return resolved(stage(relays, "exchange-relays"), back, ANSWER, Owners(every), code_bits, wide)


#: Bits of a filter: least and most (as a power of two), and for each key.
FILTER_BITS, PER_KEY = (15, 31), 8


def possibly_in(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """rows whose long `key` may be in `keys` (a column of that name): all that are,
    and about one in PER_KEY of the others.  The filter is a bitmap with PER_KEY bits
    for each distinct key, in blocks of 4 KB, broadcast; 2**31 bits, 256 MB, at most,
    so beyond 2**28 distinct keys more of the others pass."""
    n = keys.distinct().count()
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (PER_KEY * n - 1).bit_length()))
    slot = F.col(key).bitwiseAND((1 << bits) - 1)
    bitmap = (keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("__block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("__bits")))
    place = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.shiftright(place, 3) + 1), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, __place & 7) & 1") == 1
    known = rows.withColumn("__block", F.bitmap_bucket_number(slot)).join(F.broadcast(bitmap), "__block")       # 2**16 blocks of 4 KB at most
    return known.withColumns({"__byte": byte, "__place": place}).filter(hit).select(*rows.columns)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    return np.array([a.nbytes for a in arrays], "<i8").tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack_arrays(blob: bytes, *kinds: str) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, "<i8", len(kinds)), 8 * len(kinds), []
    for kind, size in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(blob, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


#: A block as staged: its messages (owner >= 0) and what it keeps for itself (owner -1, in codes).
STAGED = "unit long, owner int, n int, codes binary, multi binary"


def block_rows(unit: int, codes: np.ndarray, code_bits: int, owners: int, kept: bytes, *arrays: np.ndarray):
    """The staged rows of a block.  `codes`: one 64-bit code, or one (high, low)
    pair, for each entry; the place of each entry's code among the sorted
    distinct ones goes in front of `arrays` and `kept`."""
    import pyarrow as pa

    wide = codes.ndim == 2
    if wide:
        order = np.lexsort((codes[:, 1], codes[:, 0]))
        ranked = codes[order]
        new = np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)][:len(codes)]
    else:
        order = np.argsort(codes, kind="stable")
        ranked = codes[order]
        new = np.r_[True, ranked[1:] != ranked[:-1]][:len(codes)]
    place = np.empty(len(codes), "<u4")
    place[order] = np.cumsum(new) - 1
    distinct = ranked[new]
    multi = np.diff(np.r_[np.flatnonzero(new), len(codes)]) > 1
    owner = owner_of(distinct[:, 0] if wide else distinct, code_bits, owners)
    rows = [(unit, -1, len(codes), pack_arrays(place, *arrays) + kept, None)]
    for o in np.unique(owner):
        a, b = np.searchsorted(owner, [o, o + 1])
        rows.append((unit, int(o), int(b - a), (pair_encode if wide else rice_encode)(distinct[a:b]), bits_of(multi[a:b])))
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["unit", "owner", "n", "codes", "multi"])


def resolved(staged: DataFrame, resolve, schema: str, owners: Owners, code_bits: int, wide: bool = False) -> DataFrame:
    """`resolve(what the block kept, flags of its distinct codes)` -> pandas rows, for every block."""
    answers = repeated(staged.filter("owner >= 0"), owners, code_bits, wide)
    own = staged.filter("owner < 0").select("unit", "owner", "n", F.col("codes").alias("bits"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("owner")
        flags = [flags_of(b, n) for b, n in zip(pdf["bits"][pdf["owner"] >= 0], pdf["n"][pdf["owner"] >= 0])]
        return resolve(pdf["bits"].iloc[0], np.concatenate(flags) if flags else np.empty(0, bool))

    return own.unionByName(answers).groupBy("unit").applyInPandas(one, schema)
