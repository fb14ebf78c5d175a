"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each text gets plain counts; the base rule fails texts of fewer than 10 words
or with more than 20% of their words in repeated five-word windows.  Further
rules reject a text whose measure exceeds a cutoff, and the cutoffs come from a
labelled holdout: for each stratum (language) and rule, the cutoffs are tested
from the most lenient down, the null hypothesis being that the rule falsely
rejects more than its share of ALPHA of the good texts.  The test is exact: a
cutoff passes if P(Binomial(n, share) <= k) is at most DELTA over the number of
strata times rules (Bonferroni), k of n good texts being rejected; testing in
that fixed order and stopping at the first failure needs no correction over
cutoffs.  Of the cutoffs that pass, the one is used that gains most: the share
of bad texts it rejects less PRICE times the share of good ones, if that is
above zero; on a tie the most lenient.  A stratum without enough labels has no
cutoff and rejects nothing.  So with probability 1 - DELTA every stratum loses
at most ALPHA of its good texts to these rules.

Counts are made inside the row; only labelled rows, cut to one bucket number
for each rule, meet in grouped counts.

Defined cases: null and empty texts have no words and fail the base rule; a
null stratum is a stratum of its own; a null id takes no label; repeated
labels of an id count as good only if all say so; ties (a measure equal to its
cutoff) are kept; repeated rows get equal results.  Empty table, empty result.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import stage

ALPHA, DELTA, PRICE = 0.06, 0.05, 5.0
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5

#: Rules: measure -> cutoffs, ascending.
CUTOFFS = {
    "symbol_share": [0.005, 0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8],
    "dup_line_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7],
    "repeat_share": [0.005, 0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.18],
    "upper_share": [0.02, 0.03, 0.04, 0.05, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.5],
    "word_length": [4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0],
}


def _shifted(array: Column, n: int) -> Column:
    """Elements from the n-th on (0 is the first)."""
    return F.slice(array, F.lit(n + 1), F.greatest(F.lit(0), F.size(array) - n))


def _window(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i + k) for k in range(WINDOW)]


def _placed(words: Column, starts: Column) -> Column:
    """The windows with their places, sorted, so equal windows are neighbours."""
    return F.sort_array(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("w"), i.alias("p"))))


def _repeat_words(placed: Column) -> Column:
    """Words covered by windows found more than once: the places of windows with
    an equal neighbour, then the gaps between them, a gap counting as WINDOW at most."""
    none = F.array(F.lit(None).cast("struct<w:string,p:int>"))
    before = F.concat(none, F.slice(placed, F.lit(1), F.size(placed) - 1))
    after = F.concat(_shifted(placed, 1), none)
    marked = F.transform(F.arrays_zip(placed.alias("x"), before.alias("a"), after.alias("b")),
                         lambda z: F.when((z["x"]["w"] == z["a"]["w"]) | (z["x"]["w"] == z["b"]["w"]), z["x"]["p"]))
    return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))


def _covered(places: Column) -> Column:
    gaps = F.zip_with(places, _shifted(places, 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, the counts and the rules' measures: one row per input row.

    Each step that is used more than once is a column of its own, so it is
    computed once; windows are compared as text only where their hashes repeat."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), text.alias("t"))
    rows = rows.withColumns({"words": F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), ""),
                             "lines": F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    last = F.size("words") - WINDOW
    rows = rows.withColumn("starts", F.when(last >= 0, F.sequence(F.lit(0), F.greatest(F.lit(0), last))).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    hashes = F.transform("starts", lambda i: F.xxhash64(*_window(F.col("codes"), i)))
    rows = rows.withColumn("n_distinct", F.size(F.array_distinct(hashes)))
    rows = rows.withColumn("placed", F.when(F.col("n_distinct") < F.size("starts"), _placed(F.col("words"), F.col("starts"))))
    rows = rows.withColumn("places", F.when(F.col("placed").isNotNull(), _repeat_words(F.col("placed"))))
    counted = rows.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("places").isNotNull(), _covered(F.col("places"))), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"), F.regexp_count("t", F.lit("[A-Z]")).alias("n_upper"))
    share = lambda a, b: F.col(a) / F.greatest(F.lit(1), F.col(b))
    return counted.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "n_words").alias("symbol_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("n_upper", "word_chars").alias("upper_share"),
        share("word_chars", "n_words").alias("word_length"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Natural log of P(Binomial(n, p) <= k), added up term by term in logs."""
    first = n * F.log(F.lit(1 - p))
    step = F.log(F.lit(p / (1 - p)))

    def add(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + step
        high = F.greatest(s["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(F.least(s["total"], term) - high))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), k.cast("int")))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), add, lambda s: s["total"])


def _exceeded(measure: Column, cutoffs: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda x: measure > x))


def thresholds(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
               cutoffs: dict[str, list[float]] = CUTOFFS) -> DataFrame:
    """stratum, rule, cutoff: the chosen cutoffs (strata and rules without one are absent).

    rows: as `measured`; labels: doc_id, quality (0/1).  Texts that fail the base rule are left out."""
    known = (labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg((F.min("quality") == 1).alias("good")))
    held = rows.filter("not base_failed").join(known, F.col("doc_id") == F.col("id"))
    above = [F.struct(F.lit(r).alias("rule"), _exceeded(F.col(r), c).alias("above")) for r, c in cutoffs.items()]
    buckets = (held.select("stratum", "good", F.explode(F.array(*above)).alias("b")).groupBy("stratum", "b.rule", "b.above")
               .agg(F.count(F.when(F.col("good"), 1)).alias("n"), F.count(F.when(~F.col("good"), 1)).alias("m")))
    grid = F.create_map(*(x for r, c in cutoffs.items() for x in (F.lit(r), F.array(*map(F.lit, c)))))
    parts = F.collect_list(F.struct("above", "n", "m"))                           # at most one for each cutoff, and one more
    tested = (buckets.groupBy("stratum", "rule").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), parts.alias("parts"))
              .select("*", F.posexplode(grid[F.col("rule")]).alias("i", "cutoff")))
    over = F.filter("parts", lambda x: x["above"] > F.col("i"))
    tested = tested.withColumn("k", F.aggregate(over, F.lit(0).cast("long"), lambda s, x: s + x["n"])).withColumn(
        "gain", F.aggregate(over, F.lit(0).cast("long"), lambda s, x: s + x["m"]) / F.greatest(F.lit(1), F.col("m"))
        - PRICE * F.col("k") / F.greatest(F.lit(1), F.col("n")))
    strata = rows.select("stratum").distinct().agg(F.count(F.lit(1))).scalar()
    share = alpha / len(cutoffs)
    limit = F.log(F.lit(delta) / (strata * len(cutoffs)))
    passed = F.when(F.col("k") > share * F.col("n"), False).otherwise(binomial_tail(F.col("k"), F.col("n"), share) <= limit)
    order = W.partitionBy("stratum", "rule").orderBy(F.desc("cutoff"))           # at most one row for each cutoff
    return (tested.withColumn("passes", passed).withColumn("passed", F.min("passes").over(order)).filter("passed and gain > 0")
            .groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff"))["cutoff"].alias("cutoff")))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and the rules that fired: one row per input row."""
    rows = stage(measured(docs, id_col, text_col, stratum_col), "rules-measured")
    chosen = thresholds(rows, labels, alpha, delta).groupBy(F.col("stratum").alias("s")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut"))
    chosen = stage(chosen, "rules-cutoffs")                  # one row for each stratum
    fired = F.filter(F.array(*(F.when(F.col(r) > F.col("cut")[r], F.lit(r)) for r in CUTOFFS)), lambda x: x.isNotNull())
    return (rows.join(chosen, rows["stratum"].eqNullSafe(chosen["s"]), "left").withColumn("fired", F.coalesce(fired, F.array().cast("array<string>")))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.size("fired") == 0)).alias("kept"), "fired"))


def _sql() -> str:
    """DuckDB SQL of the whole operator; the binomial sum by its closed terms."""
    cuts = ", ".join(f"('{r}', {c})" for r, cs in CUTOFFS.items() for c in cs)
    rules, share = len(CUTOFFS), ALPHA / len(CUTOFFS)
    long = " UNION ALL ".join(f"SELECT doc_id, stratum, '{r}' AS rule, {r} AS x FROM measured WHERE NOT base_failed" for r in CUTOFFS)
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
spans AS (SELECT r, unnest(range(1, len(w) - 3)) AS s FROM texts WHERE len(w) >= 5),
keyed AS (SELECT r, s, array_to_string(w[s:s + 4], ' ') AS k FROM spans JOIN texts USING (r)),
found AS (SELECT r, s, count(*) OVER (PARTITION BY r, k) AS n FROM keyed),
covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(s, s + 5)) AS p FROM found WHERE n > 1) GROUP BY r),
counted AS (
  SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(regexp_extract_all(t, '[A-Z]')) AS n_upper
  FROM texts LEFT JOIN covered USING (r)),
measured AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
    n_symbols / greatest(1, n_words) AS symbol_share, n_dup_lines / greatest(1, n_lines) AS dup_line_share,
    n_repeat_words / greatest(1, n_words) AS repeat_share, n_upper / greatest(1, word_chars) AS upper_share,
    word_chars / greatest(1, n_words) AS word_length
  FROM counted),
known AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT m.*, good FROM ({long}) m JOIN known USING (doc_id)),
cutoffs AS (SELECT * FROM (VALUES {cuts}) v(rule, cutoff)),
tested AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS m,
    count(*) FILTER (good AND x > cutoff) AS k, count(*) FILTER (NOT good AND x > cutoff) AS b
  FROM held JOIN cutoffs USING (rule) GROUP BY ALL),
judged AS (
  SELECT *, b / greatest(1, m) - {PRICE} * k / greatest(1, n) AS gain,
    k <= {share!r} * n AND list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r}))))
      <= {DELTA} / ((SELECT count(*) FROM (SELECT DISTINCT stratum FROM measured)) * {rules}) AS passes
  FROM tested),
allowed AS (
  SELECT * FROM judged j WHERE gain > 0 AND NOT EXISTS (
    SELECT 1 FROM judged o WHERE o.rule = j.rule AND o.stratum IS NOT DISTINCT FROM j.stratum AND o.cutoff >= j.cutoff AND NOT o.passes)),
chosen AS (SELECT stratum, rule, arg_max(cutoff, (gain, cutoff)) AS cutoff FROM allowed GROUP BY ALL),
fired AS (
  SELECT DISTINCT m.doc_id FROM ({long}) m JOIN chosen c ON c.rule = m.rule AND c.stratum IS NOT DISTINCT FROM m.stratum AND m.x > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM fired) AS kept
FROM measured
"""


SQL = _sql()
