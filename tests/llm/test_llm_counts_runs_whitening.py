"""Operators 11 to 13, each against a plain version."""

import hashlib
import os
import random
import sys
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from conftest import SF_SMALL
from llm_cases import empty_docs, key, odd_docs, texts_of, words_of

from ledgerline.llm import queries, token_counts, whitening, word_runs
from ledgerline.llm.common import table

BYTE_BPE = __import__("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return odd_docs(spark).repartition(3).cache()


# -- 11 ------------------------------------------------------------------------

def library_counts(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_proof_holds_for_every_proven_string():
    from tokenizers import Tokenizer
    tokenizer, proof = Tokenizer.from_file(BYTE_BPE), token_counts.prove(BYTE_BPE)
    proven = np.flatnonzero(np.unpackbits(np.frombuffer(proof, np.uint8)))
    counter = token_counts.TokenCounter(BYTE_BPE, proof)
    assert len(counter.whole) > 49_000 and 50256 not in proven
    strings = [s for s in counter.whole if counter.pre_tokens(s) == [s]]
    assert {len(e.ids) for e in tokenizer.encode_batch(strings, add_special_tokens=False)} == {1}


def test_unproven_strings_are_merged():
    proof = token_counts.prove(BYTE_BPE)
    counter = token_counts.TokenCounter(BYTE_BPE, bytes(len(proof)))         # nothing proven: all is merged
    assert [counter.count(t) for t in ("the end of it", " and the")] == library_counts(["the end of it", " and the"])
    assert counter.merged == 6 and not counter.whole
    shortcut = token_counts.TokenCounter(BYTE_BPE, proof)
    shortcut.count("the end of it")
    assert shortcut.merged == 0


def test_counts_of_awkward_texts_small_tables():
    r, proof = random.Random(3), token_counts.prove(BYTE_BPE)
    parts = [" ", "  ", "a", "Bc", "'s", "'ll", "'", "<|endoftext|>", "<|endo", "é", "é", "漢字", "1", "²", "\n", "\t", "\x1c", "\x85",
             "　", "​", "!", "?…", "\U0001F600", " the", "\x00", " "]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(1500)]
    for keep, cut in ((3, 5), (1 << 18, 1 << 20)):
        counter = token_counts.TokenCounter(BYTE_BPE, proof, keep, cut)
        assert [counter.count(t) for t in texts] == library_counts(texts)


def test_token_counts_against_library(spark, docs):
    long_text = "word " * 300_000 + "x" * 100_000 + "é漢 <|endoftext|>" * 1000
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(77_777, long_text)], "doc_id long, text string"))
    want = Counter((i, len((t or "").encode()), n, n > 1024) for (i, t), n in zip(texts_of(more), library_counts(t for _, t in texts_of(more))))
    assert Counter(map(tuple, token_counts.token_counts(more, BYTE_BPE).collect())) == want
    assert token_counts.token_counts(docs, BYTE_BPE).count() == docs.count()
    assert token_counts.token_counts(empty_docs(spark), BYTE_BPE).collect() == []


def test_token_counts_query(spark):
    texts = texts_of(table(spark, SF_SMALL, "documents"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.op11_token_counts(spark, SF_SMALL).collect()}
    assert got == {i: (len((t or "").encode()), n, n > 1024) for (i, t), n in zip(texts, library_counts(t for _, t in texts))}


def test_token_counts_refuse_other_tokenizers():
    with pytest.raises(ValueError):
        token_counts.prove(__import__("public_tokenizers").path("word_bpe_49k.json"))


# -- 12 ------------------------------------------------------------------------

def plain_runs(words, min_length, min_exponent):
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            elif not same and start is not None:
                if i - start + q >= max(min_length, min_exponent * q):
                    found.setdefault((start, i - start + q), q)       # the least period of a stretch comes first
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, words, min_length=24, min_exponent=3):
    found = plain_runs(words, min_length, min_exponent)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def plain_planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)] if h % 10 == 0 else words


@pytest.mark.parametrize("limits", [(24, 3), (2, 2), (7, 3), (4, 2)])
def test_runs_of_random_words(limits):
    r = random.Random(8)
    for _ in range(500):
        n, letters = r.randrange(70), r.choice([1, 2, 3, 5])
        words = [r.randrange(letters) + 1 for _ in range(n)]
        if n > 5 and r.random() < .5:
            p, a = r.randrange(1, 7), r.randrange(n)
            words = [w if i < a else words[min(n - 1, a + (i - a) % p)] for i, w in enumerate(words)]
        got = [tuple(x) for x in word_runs.runs(np.array([*words, 0]), *limits).tolist()]
        assert got == plain_runs(words, *limits)


def test_suffix_array_parts():
    r = random.Random(4)
    for _ in range(60):
        numbers = [r.randrange(1, 4) for _ in range(r.randrange(40))] + [0]
        sa = word_runs.SuffixArray(np.array(numbers))
        order = sorted(range(len(numbers)), key=lambda i: numbers[i:])
        assert sa.sa.tolist() == order and [order[k] for k in sa.isa] == list(range(len(numbers)))
        common = [next(k for k in range(len(numbers)) if numbers[a + k] != numbers[b + k]) for a, b in zip(order, order[1:])]
        assert sa.lcp.tolist() == [-1, *common, -1]


def test_fibonacci_words_test_in_small_chunks(monkeypatch):
    x, y = [1], [1, 2]
    while len(y) < 300:
        x, y = y, y + x
    monkeypatch.setattr(word_runs, "TESTS", 16)
    assert [tuple(r) for r in word_runs.runs(np.array([*y, 0]), 2, 2).tolist()] == plain_runs(y, 2, 2)


def test_word_runs_rows(spark, docs):
    made = [(5, "a b c " * 9 + "d"), (6, "x " * 24), (7, "x " * 23), (8, "p q " * 14 + "r s t " * 10 + "s t " * 12), (8, "p q " * 14)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    got = Counter(map(tuple, word_runs.digests(word_runs.word_runs(more)).collect()))
    assert got == Counter(plain_row(i, words_of(t)) for i, t in texts_of(more))
    assert word_runs.word_runs(empty_docs(spark)).collect() == []
    for r in word_runs.word_runs(more).filter("size(runs) = 0").join(more, "doc_id").filter("doc_id > 9").collect():
        assert r[2] == " ".join(words_of(r[3]))


def test_blocks_do_not_matter(spark, docs, monkeypatch):
    whole = sorted(map(key, word_runs.digests(word_runs.word_runs(docs)).collect()))
    batch = __import__("pyarrow").record_batch({"id": [1, 2, None], "text": ["a b " * 20, "", "a b " * 20]})
    monkeypatch.setattr(word_runs, "BLOCK", 1)
    parts = [r for b in word_runs._runs(24, 3)(iter([batch])) for r in b.to_pylist()]
    assert [(r["doc_id"], r["runs"], r["text"]) for r in parts] == [
        (1, [{"start": 0, "length": 40, "period": 2}], "a b"), (2, [], ""), (None, [{"start": 0, "length": 40, "period": 2}], "a b")]
    assert len(whole) == docs.count()


def test_periodic_runs_query(spark):
    want = sorted(key(plain_row(i, plain_planted(i, words_of(t)))) for i, t in texts_of(table(spark, SF_SMALL, "documents")))
    got = sorted(map(key, queries.op12_periodic_runs(spark, SF_SMALL).collect()))
    assert got == want and any(r[1][1] > 0 for r in got)


def test_planting(spark, docs):
    got = Counter((i, " ".join(words_of(t))) for i, t in texts_of(word_runs.planted(docs)))
    assert got == Counter((i, " ".join(plain_planted(i, words_of(t)))) for i, t in texts_of(docs))
    assert word_runs.planted(empty_docs(spark)).collect() == []


# -- 13 ------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, w string, n string, component string, c string"


def vector_rows(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, *["clash"] * 6) for i, v in zip(ids, vectors)], VECTORS)


def plain_whitened(vectors, count):
    """x, scatter in integers, eigenvalues and vectors by numpy."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    z = [[n * c - t for c, t in zip(row, s)] for row in x]
    cov = np.array([[sum(a[i] * a[j] for a in z) for j in range(len(s))] for i in range(len(s))], dtype=object) / float(n) ** 3
    values, axes = np.linalg.eigh(cov.astype(float))
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    return [sum(c * c for c in row) for row in z], np.array(z, dtype=float) / n @ axes / np.sqrt(values), values / np.trace(cov.astype(float))


def held(df, ids, vectors, count):
    deviation, white, explained = plain_whitened(vectors, count)
    got = sorted(map(tuple, df.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()))
    assert [(r[0], r[1], r[2], int(r[3])) for r in got] == sorted((i, k + 1, len(ids), d) for i, d in zip(ids, deviation) for k in range(count))
    place = {i: k for k, i in enumerate(ids)}
    mine = np.zeros_like(white)
    for r in got:
        mine[place[r[0]], r[1] - 1] = r[4]
    for k in range(count):
        sign = np.sign(mine[:, k] @ white[:, k])
        assert np.allclose(mine[:, k] * sign, white[:, k], rtol=1e-7, atol=1e-7)
    assert np.allclose([r[5] for r in got if r[0] == ids[0]], explained, rtol=1e-9)
    assert {r[6] for r in got} and len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def test_whitening_of_random_vectors(spark):
    r = np.random.default_rng(3)
    vectors = (r.normal(size=(60, 5)) * [3, 1, .2, .01, 5] + 100).astype(np.float32).tolist()
    held(whitening.whiten(vector_rows(spark, vectors).repartition(4), count=4), list(range(60)), vectors, 4)


def test_whitening_drops_broken_vectors(spark):
    r = np.random.default_rng(5)
    good = r.normal(size=(30, 3)).astype(np.float32).tolist()
    broken = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 2.0], [1.0, float("inf"), 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    df = vector_rows(spark, good + broken)
    assert {x["vec_id"] for x in whitening.whiten(df, 8).collect()} == set(range(30))
    held(whitening.whiten(df, 8), list(range(30)), good, 3)


def test_whitening_null_and_repeated_ids(spark):
    v = [[1.0, 0.0], [0.0, 2.0], [3.0, 1.0], [3.0, 1.0], [0.5, 0.25]]
    got = whitening.whiten(vector_rows(spark, v, [1, None, 2, 2, 1]), 8).collect()
    assert Counter((r["vec_id"], r["component"]) for r in got) == Counter({(1, 1): 2, (1, 2): 2, (2, 1): 2, (2, 2): 2, (None, 1): 1, (None, 2): 1})
    assert {r["n"] for r in got} == {5} and max(r["identity_error"] for r in got) < 1e-12


def test_whitening_without_spread(spark):
    assert whitening.whiten(vector_rows(spark, []), 8).collect() == []
    assert whitening.whiten(vector_rows(spark, [None]), 8).collect() == []
    assert whitening.whiten(vector_rows(spark, [[1.0, 2.0]] * 4), 8).collect() == []
    line = [[float(k), 2.0 * k, 7.0] for k in range(5)]                    # rank one
    got = whitening.whiten(vector_rows(spark, line), 8).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == 1.0 and got[0]["identity_error"] < 1e-12


def test_whitening_equal_eigenvalues(spark):
    v = [[a, b, c / 2] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    got = whitening.whiten(vector_rows(spark, v), 8).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-12
    assert sorted({(r["component"], round(r["explained"], 12)) for r in got}) == [(1, round(4 / 9, 12)), (2, round(4 / 9, 12)), (3, round(1 / 9, 12))]


def test_whitening_of_great_numbers(spark):
    r = np.random.default_rng(9)
    vectors = (r.normal(size=(12, 3)) * [1e7, 1e3, 1]).astype(np.float32).tolist()
    held(whitening.whiten(vector_rows(spark, vectors), 3), list(range(12)), vectors, 3)


def test_products_are_exact():
    r = np.random.default_rng(2)
    for top in (5, 10**6, 10**10, 10**15):
        a = r.integers(-top, top, (300, 4))
        assert (whitening.products(a, a) == a.astype(object).T.dot(a.astype(object))).all()


def test_polynomial_and_roots(spark):
    r = np.random.default_rng(6)
    for d in (1, 2, 3, 6):
        b = r.integers(-9, 9, (d, d))
        b[:, :1] = 0 if d == 3 else b[:, :1]
        m = (b.T @ b).astype(object)
        got = whitening.characteristic(spark, m)
        # Faddeev-LeVerrier in integers
        want, mk = [1], np.zeros((d, d), object)
        for k in range(1, d + 1):
            mk = m.dot(mk) + want[-1] * np.eye(d, dtype=int).astype(object)
            want.append(-int(np.trace(m.dot(mk))) // k)
        assert got == want[::-1]
        roots = [x / 2**whitening.BITS for x, times in whitening.greatest_roots(got, d) for _ in range(times)]
        values = [x for x in np.linalg.eigvalsh(m.astype(float))[::-1] if x > 1e-9]
        assert np.allclose(roots, values)
    assert whitening.greatest_roots([-8, 12, -6, 1], 3, 64) == [(2 << 64, 3)]          # (t - 2)^3
    assert whitening.greatest_roots([0, 0, -3, 1], 3, 64) == [(3 << 64, 1)]             # t^2 (t - 3)


def test_whitening_query(spark):
    rows = table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").collect()
    held(queries.op13_embedding_whitening(spark, SF_SMALL), [r[0] for r in rows], [r[1] for r in rows], 8)
