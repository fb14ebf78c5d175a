"""Operators 7 and 10 against DuckDB, and the pipeline against plain versions."""

import os
import random
import sys
from collections import Counter, defaultdict

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import corpus_pipeline
from conftest import SF_SMALL
from llm_cases import components, empty_docs, key, odd_docs, simhash, texts_of, words_of

from ledgerline.llm import chat_threads, mixing, quality_classifier


def against(df, sql: str, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toArrow())
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    docs = odd_docs(spark, seed).filter("doc_id is not null")
    mixed = mixing.mix(docs)
    against(mixed.drop("source"), mixing.SQL, documents=docs.select("doc_id", "text", "source"))
    taken, target, size = Counter(), {}, Counter()
    for r in mixed.collect():
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in target:
        assert taken[s] == int(target[s]) and target[s] <= 3 * size[s]
    assert sum(target.values()) == pytest.approx(sum(size.values()))


def test_mix_awkward(spark):
    assert mixing.mix(empty_docs(spark)).collect() == []
    bare = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, " ", "a")], "doc_id long, text string, source string")
    assert {(r["doc_id"], r["target"], r["taken"]) for r in mixing.mix(bare).collect()} == {(1, 0.0, 0), (2, 0.0, 0), (None, 0.0, 0)}
    docs = odd_docs(spark)                       # with null ids and repeated rows
    assert mixing.mix(docs).count() == docs.count()
    again = sorted((tuple(r) for r in mixing.mix(docs.repartition(5)).collect()), key=key)
    assert again == sorted((tuple(r) for r in mixing.mix(docs).collect()), key=key)


def expected_copies(docs) -> Counter:
    """How often each (id, source, size) comes whole, from the rows of `mix`."""
    out = Counter()
    for r in mixing.mix(docs).collect():
        if r["size"]:
            out[r["doc_id"], r["source"], r["size"]] += r["taken"] // r["size"] + (2 * (r["taken"] % r["size"]) >= r["size"])
    return +out


@pytest.mark.parametrize("seed", [1, 4])
def test_mixed_documents(spark, seed):
    """No text is cut and no budget counted twice, with null and repeated ids."""
    docs = odd_docs(spark, seed)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    have = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in rows} <= have
    assert Counter((r["doc_id"], r["source"], len(words_of(r["text"]))) for r in rows) == expected_copies(docs)
    took, target = Counter(), {r["source"]: r["target"] for r in mixing.mix(docs).collect()}
    for r in rows:
        took[r["source"]] += len(words_of(r["text"]))
    longest = max(len(words_of(t)) for _, t in texts_of(docs))
    assert all(abs(took[s] - int(t)) <= longest / 2 for s, t in target.items())


def test_mixed_documents_repeated_rows(spark, monkeypatch):
    """100 words of budget stay 100 where many rows share an id; copies are dealt out in chunks."""
    monkeypatch.setattr(mixing, "CHUNK", 3)
    rows = [(7, "a b c d", "big")] * 25 + [(None, "a b c d", "big")] * 25 + [(1, "x y", "small"), (1, "x z w", "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    mixed = mixing.mix(docs)
    report = {r["source"]: r for r in mixing.source_report(mixed).collect()}
    out = mixing.mixed_documents(docs).collect()
    for s, r in report.items():
        mine = [x for x in out if x["source"] == s]
        assert len(mine) == r["documents"] and sum(len(words_of(x["text"])) for x in mine) == r["whole_taken"]
        assert abs(r["whole_taken"] - r["target"]) <= 3


def test_edge_documents_stay_whole(spark):
    texts = {i: "\n".join(f" w{i}  x\ty{k}" for k in range(3 + i % 9)) + "\n" for i in range(60)}
    docs = spark.createDataFrame([(i, t, f"host{i % 13}") for i, t in texts.items()], "doc_id long, text string, source string")
    report = {r["source"]: r for r in mixing.source_report(mixing.mix(docs)).collect()}
    whole = mixing.mixed_documents(docs).collect()
    assert all(r["text"] == texts[r["doc_id"]] for r in whole)
    took = Counter()
    for r in whole:
        took[r["source"]] += len(words_of(r["text"]))
    longest = max(len(words_of(t)) for t in texts.values())
    for s, r in report.items():
        assert r["taken"] == int(r["target"]) and r["whole_taken"] == took[s]
        assert abs(took[s] - r["taken"]) <= longest / 2


def test_low_weights_spread_over_buckets(spark):
    """Buckets stay small whatever the weights: keys of weight 0.05 are only moved along them."""
    from pyspark.sql import functions as F
    u = (F.col("id") + F.lit(0.5)) / 200_000
    for weight in (0.05, 1.0, 30.0):
        key = -F.log(u) / weight
        most = spark.range(200_000).groupBy(F.floor(mixing.BUCKETS * F.log2(key))).count().agg(F.max("count")).first()[0]
        assert most < 200_000 / 2000


def talk(spark, seed: int):
    r, rows = random.Random(seed), []
    said = ["hello there", "I think  so", "maybe not", "See the\tnote", "Why?", "", "fine.", "a b c d"]
    for c in [1, 2, 3, None]:
        texts = []
        for turn in range(25):
            lines = [r.choice(said) + (f" {r.randrange(60)}" if r.random() < .8 else "") for _ in range(r.randrange(1, 5))]
            if texts and r.random() < .7:
                quote = r.choice(texts[-6:]).split("\n")
                quote = quote[r.randrange(len(quote)):][:2] if r.random() < .4 else quote
                mark = r.choice([">", "> ", "  >", " > > "])
                quote = [mark + (x.upper() if r.random() < .3 else x) for x in quote]
                lines = quote + lines if r.random() < .7 else lines[:1] + quote + lines[1:]
            text = "\n".join(lines) if r.random() < .95 else None
            texts += [text] if text else []
            rows.append((c, turn if r.random() < .97 else None, r.choice(["user", "assistant", None]), text, 0, "clash"))
    return spark.createDataFrame(rows + rows[5:9], "conv_id long, turn long, role string, text string, mid long, key string")


@pytest.mark.parametrize("seed", [5, 6])
def test_chat_threads(spark, seed):
    messages = talk(spark, seed)
    df = chat_threads.linked(messages)
    against(df, chat_threads.SQL, conversations=messages.select("conv_id", "turn", "role", "text"))
    rows = df.collect()
    assert sum(r["n_linked"] for r in rows) > 20 and max(r["depth"] for r in rows) > 2
    assert all(r["parent_turn"] is None or r["parent_turn"] < r["turn"] for r in rows)
    assert not any(line.lstrip(" \t").startswith(">") for r in rows for line in r["text"].split("\n"))
    parts = chat_threads.conversations(df, part=8).collect()
    assert sum(p["n_messages"] for p in parts) == len(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_conversations(spark, seed):
    """Texts and their order, by SQL and plainly from the linked rows; the query gives them too."""
    from ledgerline.llm.queries import QUERIES
    build, sql = QUERIES["op10_chat_conversations"]
    messages = talk(spark, seed)
    rows = chat_threads.linked(messages).cache()
    against(chat_threads.conversations(rows), sql, conversations=messages.select("conv_id", "turn", "role", "text"))
    want, single = defaultdict(list), []
    for r in rows.collect():
        m = f"<|{r['role'] or 'user'}|>\n{r['text']}\n"
        if r["conv_id"] is None or r["turn"] is None:
            single.append((r["conv_id"], r["thread_turn"], None if r["turn"] is None else r["turn"] // 8, 1, m))
        else:
            want[r["conv_id"], r["thread_turn"], r["turn"] // 8].append((r["turn"], r["depth"], m))
    want = [(*k, len(v), "".join(m for *_, m in sorted(v))) for k, v in want.items()] + single
    assert sorted(map(tuple, chat_threads.conversations(rows, part=8).collect()), key=key) == sorted(want, key=key)
    assert build(spark, SF_SMALL).columns == ["conv_id", "thread_turn", "part", "n_messages", "text"]


def test_chat_threads_empty(spark):
    assert chat_threads.linked(talk(spark, 5).limit(0)).collect() == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["quality classifier"](spark, docs, SF_SMALL).cache()
    scored = {r["doc_id"] for r in quality_classifier.score(docs, labels).filter("kept").collect()}
    assert {i for i, _ in texts_of(kept)} == scored and kept.columns == docs.columns

    single = steps["exact dedup"](spark, kept, SF_SMALL).cache()
    best = defaultdict(int)
    for i, t in texts_of(kept):
        best[t] = max(best[t], i)
    assert sorted(i for i, _ in texts_of(single)) == sorted(best.values())

    apart = steps["SimHash near-dedup"](spark, single, SF_SMALL).cache()
    texts = texts_of(single)
    comp = components([i for i, _ in texts], [simhash(t) for _, t in texts], 2)
    assert sorted(i for i, _ in texts_of(apart)) == sorted(i for i in comp if comp[i] == i)

    mixed = steps["mixing to target weights"](spark, apart, SF_SMALL).cache()
    assert mixed.columns == docs.columns
    assert Counter((r["doc_id"], r["source"], len(words_of(r["text"]))) for r in mixed.collect()) == expected_copies(apart)
    assert set(texts_of(mixed)) <= set(texts_of(apart))

    packed = steps["packing"](spark, mixed, SF_SMALL).collect()
    assert sum(p["length"] for p in packed if p["start"] == 0) > 0
    assert Counter(p["doc_id"] for p in packed if p["start"] == 0) == Counter(i for i, _ in texts_of(mixed))


def test_pipeline_on_awkward_tables(spark, tmp_path):
    """Every stage takes empty tables, nulls, repeated rows and clashing columns, and keeps the columns."""
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (7, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for name, rows in (("odd", docs), ("empty", empty_docs(spark))):
        sf = str(tmp_path / name)
        labels.write.parquet(f"{sf}/labels.parquet")
        rows.write.parquet(f"{sf}/documents.parquet")
        at = spark.read.parquet(f"{sf}/documents.parquet")
        before = {t or "" for _, t in texts_of(at)}
        for step, run in corpus_pipeline.STAGES:
            n, columns = at.count(), at.columns
            at = run(spark, at, sf)
            at.write.parquet(f"{sf}/{step.replace(' ', '-')}")
            at = spark.read.parquet(f"{sf}/{step.replace(' ', '-')}")
            assert step == "packing" or at.columns == columns
            assert step.startswith(("mixing", "packing")) or at.count() <= n
            assert name == "odd" or at.count() == 0
            if step != "packing":
                texts = {t or "" for _, t in texts_of(at)}
                assert texts <= before                                    # none is cut
                if step == "exact dedup":
                    assert texts == before and at.count() == len(texts)   # none is lost, each once
                before = texts
        assert corpus_pipeline.run(spark, sf).count() == at.count()
