"""Quality classifier: document evidence combined with hierarchical empirical Bayes site posteriors.

1. *Document evidence.*  A logistic regression over a dozen text statistics
   and a word lexicon, fitted on a bounded sample of labelled rows
   (`sample_rows`, the labelled ids of least hash): one half picks the lexicon
   by a grouped count of documents per word and class, the other half fits the
   weights.  Its log odds less the sample's prior log odds are the evidence.
   A document is clean if its label says quality 1 and toxic 0.
2. *Sites.*  Grouped aggregates over all documents (labels where there are any,
   the classifier's probability elsewhere) give each host and each path (host
   and path column) its clean count.  Beta priors are fitted by moments: hosts
   shrink toward the global rate, paths toward their host.
3. A document's posterior log odds are its evidence plus the log odds of its
   path, its own share of the counts left out.  It is rejected below
   `threshold`.

A hot host only adds to a pre-aggregated count; documents meet their site's row
in a join that adaptive execution may split or broadcast by measured size.

Defined cases: null text is empty; null host or path is a site of its own;
labels with nulls are ignored, and repeated labels of an id count as clean only
if all say so; with no labels of one class the evidence is zero and the site
rates decide; a row without id is judged but takes no label; repeated rows get
equal results.  Empty table, empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage, text_key

SAMPLE_ROWS, LEXICON, LEAST_DOCS = 12_000, 1024, 4
THRESHOLD = 0.5
_MARKS = b"#*$%&|<>"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_TRIM = b".,;:!?\"'()"


def terms(text: bytes) -> set[bytes]:
    """Words and, for inflected forms, the starts of longer words (marked by `^`)."""
    words = {w.strip(_TRIM) for w in set(text.lower().split())}
    return words | {b"^" + w[:4] for w in words if len(w) > 4}


def statistics(text: bytes) -> list[float]:
    words, size = text.split(), len(text) + 1
    n = len(words) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    shares = [size - 1 - len(text.translate(None, x)) for x in (_MARKS, _UPPER, _DIGITS)]
    return [np.log(n), shares[0] / n, shares[1] / n, shares[2] / n, text.count(b"!!") / n, text.count(b"|") / n,
            sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(lines)) / (len(lines) + 1e-9) if lines else 0.0,
            len(set(words)) / n / np.sqrt(1 / np.log(n + 1.0)), size / n, len(lines) / n, text.count(b"http") / n]


@dataclass
class Model:
    lexicon: dict[bytes, float] = field(default_factory=dict)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.0

    def features(self, text: bytes) -> list[float]:
        found = sorted((self.lexicon[w] for w in terms(text) if w in self.lexicon), reverse=True)
        return statistics(text) + [found[0] if found else 0.0, sum(found[:8]), sum(x > 1 for x in found) / np.log(len(text) + 3.0), found[-1] if found else 0.0]

    def evidence(self, text: bytes) -> float:
        """Log likelihood ratio of clean against not clean."""
        if self.weights is None:
            return 0.0
        x = np.append((np.array(self.features(text)) - self.mean) / self.scale, 1.0)
        return float(np.clip(x @ self.weights - self.prior, -30, 30))


def fit(model: Model, x: np.ndarray, clean: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Model:
    if not len(clean) or clean.all() or not clean.any():
        return model
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
    w, keep = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (clean - p) - keep * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    model.weights, model.prior = w, float(np.log((clean.sum() + 1) / ((~clean).sum() + 1)))
    return model


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            words = [list(terms(x.as_py())) for x in part["text"]]
            yield pa.record_batch({"term": pa.array([w for ws in words for w in ws], pa.binary()),
                                   "clean": pa.array(np.repeat(np.array(part["clean"].to_pylist(), bool), list(map(len, words))), pa.bool_())})


def _features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"key": batch["key"], "clean": batch["clean"],
                                   "x": pa.array([model.features(x.as_py()) for x in batch["text"]], pa.list_(pa.float64()))})
    return run


def train(texts: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """texts (id, text binary), labels (id, clean) -> Model, from `sample_rows` labelled rows at most."""
    chosen = stage(labels.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "quality-chosen")        # bounded by the parameter
    rows = stage(texts.join(F.broadcast(chosen), "id").select(F.xxhash64(F.lit(7), "id").alias("key"), "text", "clean"), "quality-sample")
    half = F.pmod("key", F.lit(2))
    good, bad = (F.count(F.when(c, 1)) for c in (F.col("clean"), ~F.col("clean")))
    sizes = rows.filter(half == 0).agg(good.alias("good"), bad.alias("bad")).first()
    model = Model()
    if sizes["good"] and sizes["bad"]:
        p_bad, p_good = (F.col("bad") + 0.5) / (sizes["bad"] + 1.0), (F.col("good") + 0.5) / (sizes["good"] + 1.0)
        counted = (rows.filter(half == 0).mapInArrow(_terms, "term binary, clean boolean").groupBy("term").agg(good.alias("good"), bad.alias("bad"))
                   .filter(F.col("good") + F.col("bad") >= LEAST_DOCS)
                   .withColumn("weight", F.log(p_bad / p_good))
                   .withColumn("z", F.abs(F.col("weight")) / F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))))
        best = counted.orderBy(F.desc("z"), "term").limit(LEXICON).collect()
        model.lexicon = {bytes(r["term"]): r["weight"] for r in best if r["z"] > 2.5 and r["term"]}
    got = rows.filter(half == 1).mapInArrow(_features(model), "key long, clean boolean, x array<double>").orderBy("key").collect()
    return fit(model, np.array([r["x"] for r in got]), np.array([r["clean"] for r in got], bool))


def _judged(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"id": batch["id"], "rk": batch["rk"], "host": batch["host"], "path": batch["path"],
                                   "evidence": pa.array([model.evidence(x.as_py()) for x in batch["text"]], pa.float64())})
    return run


def _logit(p):
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, mean) -> DataFrame:
    """Prior strength by moments: what the groups' rates vary beyond their counting noise."""
    rate = F.col("clean_n") / F.col("n")
    spread = F.sum(F.col("n") * (rate - mean) * (rate - mean)) / F.sum("n")
    noise = F.sum(mean * (1 - mean)) / F.sum("n")
    between = F.greatest(spread - noise, F.lit(1e-6))
    return groups.agg(F.least(F.lit(1e4), F.greatest(F.lit(1.0), F.avg(mean * (1 - mean)) / between - 1)).alias("k"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          path_col: str = "lang", sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key, evidence, site_clean, clean_probability, kept: one row per input row.

    labels: doc_id, quality (0/1), toxic (0/1)."""
    scored = _scored(docs, labels, id_col, text_col, host_col, path_col, sample_rows, threshold)
    return scored.select(F.col("id").alias("doc_id"), F.col("rk").alias("text_key"), "evidence", "site_clean", "clean_probability", "kept")


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str, sample_rows: int, threshold: float) -> DataFrame:
    """id, rk (text key), host, path, evidence, site_clean, clean_probability, kept."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("rk"), F.col(host_col).cast("string").alias("host"),
                       F.col(path_col).cast("string").alias("path"), text.cast("binary").alias("text"))
    known = (labels.filter("doc_id is not null and quality is not null and toxic is not null")
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean")))
    model = train(rows.select("id", "text"), known, sample_rows)
    judged = stage(rows.mapInArrow(_judged(model), "id long, rk long, host string, path string, evidence double"), "quality-judged")
    seen = known.withColumnRenamed("id", "known_id")
    base = 1 / (1 + F.exp(-(F.col("evidence") + model.prior)))
    counted = stage(judged.join(seen, judged["id"] == seen["known_id"], "left")
                    .withColumn("own", F.coalesce(F.col("clean").cast("double"), base)).drop("clean", "known_id"), "quality-counted")

    paths = stage(counted.groupBy("host", "path").agg(F.sum("own").alias("clean_n"), F.count(F.lit(1)).alias("n")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("clean_n").alias("host_clean"), F.sum("n").alias("host_n"))
    total = hosts.agg(F.sum("host_clean").alias("c"), F.sum("host_n").alias("n")).first()
    rate = (total["c"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    k_host = _strength(hosts.select(F.col("host_clean").alias("clean_n"), F.col("host_n").alias("n")), F.lit(rate)).first()["k"] or 1.0
    within = paths.join(hosts.withColumnRenamed("host", "h"), paths["host"].eqNullSafe(F.col("h"))).drop("h")
    k_path = _strength(within, (F.col("host_clean") + k_host * rate) / (F.col("host_n") + k_host)).first()["k"] or 1.0
    sites = stage(within.withColumnsRenamed({"host": "site_host", "path": "site_path"}), "quality-sites")

    own = F.col("own")
    host_rate = (F.col("host_clean") - own + k_host * rate) / (F.col("host_n") - 1 + k_host)
    site = (F.col("clean_n") - own + k_path * host_rate) / (F.col("n") - 1 + k_path)
    site = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), site))
    probability = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("site_clean")))))
    return (counted.join(sites, counted["host"].eqNullSafe(sites["site_host"]) & counted["path"].eqNullSafe(sites["site_path"]))
            .withColumn("site_clean", site).withColumn("clean_probability", probability)
            .select("id", "rk", "host", "path", "evidence", "site_clean", "clean_probability", (F.col("clean_probability") >= threshold).alias("kept")))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
                  sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with their own columns.  A row's verdict
    depends on its id, text, host and path, so these name it."""
    names = ["id", "rk", "host", "path"]
    gone = _scored(docs, labels, id_col, text_col, host_col, path_col, sample_rows, threshold).filter("not kept").groupBy(*names).agg(F.lit(1).alias("n"))
    gone = gone.select(*[F.col(c).alias(f"__{c}") for c in names])
    mine = [docs[id_col].cast("long"), text_key(docs[text_col]), docs[host_col].cast("string"), docs[path_col].cast("string")]
    same = [a.eqNullSafe(F.col(f"__{c}")) for a, c in zip(mine, names)]
    return docs.join(gone, same[0] & same[1] & same[2] & same[3], "left_anti")
