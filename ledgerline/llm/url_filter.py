"""URL filters: host and path rules first, a trained URL classifier for the rest.

Rules: a rule (verdict, host, path) fits its host and all its subdomains if
the URL's path starts with the rule's path; of the rules that fit the longest
wins.  URLs without a rule are judged by a logistic regression on hashed
character n-grams of host and path, trained from a small labelled URL table.

Everything is DataFrame and Spark ML functions on the JVM, one narrow pass over
the URLs; the model has 2**HASH_BITS weights whatever the input.

Defined cases: a null URL, or one without `://`, has empty host and path, fits
no rule and is judged on its empty n-grams; upper-case A-Z in the host are
lowered, nothing else is changed (ports stay); of equally long rules the first
in the list wins; repeated rows get equal results; null ids are carried.  Empty
table, empty result.  Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import scratch

HASH_BITS, GRAMS, RIDGE = 18, (3, 4, 5), 0.003
#: Block at odds of 3 to 1, as a good page lost costs more than a bad one kept.
THRESHOLD = 0.75

# The contract's rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# Words of the default labelled URL table, and where they stand.
BLOCKED = ("casino poker slots betting bets jackpot pills viagra meds pharmacy adult porn xxx escort "
           "spam linkfarm ads banner track clicks replica payday lottery warez crack torrent malware").split()
ALLOWED = ("news library blog museum docs wiki school science recipes theatre forum maps hospital garden "
           "weather history travel orchestra parliament journal cycling station university bakery theory nation thread").split()
SETTINGS = [("www.best-{}.example", "/en/{}"), ("{}-online.example", "/de/{}?page=2"), ("cheap-{}.example", "/fr/{}.html"),
            ("m.{}-x.example", "/{}/"), ("the{}.example", "/es/{}#top"), ("www.free-{}.example", "/item/{}"), ("{}-farm.example", "/en/{}/")]
PATH_SETTINGS = [("site{}.example", "/{}/"), ("www.page{}.example", "/en/{}.html"), ("m.example", "/{}-{}"), ("pages.example", "/de/{}/{}/"),
                 ("www.example", "/item/best-{}?page={}"), ("x{}.example", "/fr/online-{}"), ("home.example", "/es/{}_{}#top")]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url string, label double (1: block): every word in every setting, in the host
    and, under hosts that both labels share, in the path, so only words tell."""
    def urls(word: str, i: int) -> list[str]:
        hosts = [(host + path).format(word, 7 * i + k) for k, (host, path) in enumerate(SETTINGS)]
        paths = [host.format(i) + path.format(word, i) for host, path in PATH_SETTINGS]
        return hosts + paths

    rows = ", ".join(f"('http://{url}', {label})" for label, words in ((1.0, BLOCKED), (0.0, ALLOWED))
                     for i, word in enumerate(words) for url in urls(word, i))
    return spark.sql(f"SELECT url, CAST(label AS double) AS label FROM VALUES {rows} AS t(url, label)")


def host_of(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end, A-Z lowered."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _prefixed(name: str, grams: Column) -> Column:
    return F.transform(grams, lambda x: F.concat(F.lit(name), x))


def featured(urls: DataFrame) -> DataFrame:
    """Adds `grams` to a table with host and path: the distinct character n-grams of
    each between marks, prefixed by kind and length (a shorter text is one gram);
    digits count as one, as they are mostly page numbers.

    The characters are split off once.  The n-grams are the (n-1)-grams joined to
    the characters n-1 places on, so a URL costs its length, however long it is."""
    texts = {"h": F.col("host"), "p": F.regexp_replace("path", "[0-9]+", "0")}
    rows, made = urls, []
    for kind, text in texts.items():
        chars, last = f"__{kind}1", max(GRAMS)
        rows = rows.withColumn(chars, F.split(F.concat(F.lit("^"), text, F.lit("$")), ""))
        size = F.size(chars)
        for n in range(2, last + 1):
            shorter = F.col(f"__{kind}{n - 1}")
            longer = F.zip_with(F.slice(shorter, F.lit(1), size - n + 1), F.slice(chars, F.lit(n), size - n + 1), lambda a, b: F.concat(a, b))
            rows = rows.withColumn(f"__{kind}{n}", F.when(size >= n, longer).otherwise(F.array(F.array_join(chars, ""))))
        made += [_prefixed(f"{kind}{n}", F.col(f"__{kind}{n}")) for n in GRAMS]
    return rows.withColumn("grams", F.array_distinct(F.concat(*made))).drop(*[f"__{k}{n}" for k in texts for n in range(1, max(GRAMS) + 1)])


def _hashed(rows: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=1 << HASH_BITS, binary=True, inputCol="grams", outputCol="features").transform(rows)


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """labelled: url, label (1: block); small, so one task holds it and reruns agree.

    The model is read back from the shared folder: as fitted it carries its
    training summary, and with it the session, to every task."""
    rows = labelled.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label").coalesce(1)
    fitted = LogisticRegression(regParam=RIDGE, maxIter=60, threshold=THRESHOLD).fit(_hashed(featured(rows)).select("features", "label"))
    path = scratch(labelled.sparkSession, "url-model")
    fitted.write().save(path)
    return LogisticRegressionModel.load(path)


def rule_of(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in longest]
    found = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in longest]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return reduce(lambda rest, x: F.when(x[0], x[1]).otherwise(rest), reversed(list(zip(fits, found))), none)


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: list[tuple[str, str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability: one row per input row."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    scored = model.transform(_hashed(featured(rows))).withColumn("block_probability", vector_to_array("probability")[1])
    fit = rule_of(rules, F.col("host"), F.col("path"))
    verdict = F.coalesce(fit["verdict"], F.when(F.col("block_probability") >= THRESHOLD, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", fit["rule"].alias("rule"), verdict.alias("verdict"), "block_probability")
