"""Awkward tables and plain versions of the operators to hold them against."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import xxhash

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              # names the operators use inside
              "id long, fp string, rk string, t string, slot string, size string, bucket string, key string, kept string, "
              "spots string, stratum string, words string, unit string, edge string, plan_source string, host string")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa The the END, Über été ñandú x1 <|endoftext|> ### it's".split()


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_texts(seed: int = 1) -> list[str | None]:
    r = random.Random(seed)
    made = [" ".join(r.choice(WORDS) for _ in range(r.choice([1, 2, 3, 8, 40, 120]))) for _ in range(40)]
    passage = " ".join(r.choice(WORDS) for _ in range(30))
    near = made[3].split()
    made += [made[0], made[0], made[5] + "\n" + passage, passage + " tail", "  \t\n ", "", None, "", None, "word",
             "\u00a0", "a\u2028b", "line\nline\nline\nother\n\n", "x " * 3000, " ".join(near[:-1]), passage + " " + passage,
             "naïve\x00text \x0b tab\tend", "A B C", "a b c", "e\u0301 é"]
    return made


def odd_docs(spark, seed: int = 1):
    r, rows = random.Random(seed), []
    for i, text in enumerate(odd_texts(seed)):
        rows.append((i * 3 + 1, text, r.choice(["en", "de", None]), r.choice(["b", "a", "Z", "é", None]), None))
    rows += [rows[2], rows[41], (None, "no id here", "en", "a", 1), (None, rows[0][1], "en", None, 1), (10_000, None, None, None, None)]
    more = ("clash",) * (DOC_SCHEMA.count(",") + 1 - 6)
    return spark.createDataFrame([(*x, 7, *more) for x in rows], DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def texts_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def simhash(text: str | None, shingle: int = 3) -> int:
    lowered = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    w = words_of(lowered)
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids: list[int], prints: list[int], bits: int) -> dict[int, int]:
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    a = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits) + i + 1:
            x, y = sorted((top(ids[i]), top(ids[int(j)])))
            up[y] = x
    return {i: top(i) for i in ids}


def without_repeats(texts: list[tuple], size: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, sha256 of kept words)."""
    seen = Counter(tuple(w[k:k + size]) for _, t in texts for w in [words_of(t)] for k in range(len(w) - size + 1))
    out = []
    for i, t in texts:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)
