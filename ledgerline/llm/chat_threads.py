"""Chat formatting by quotation linking, in DataFrame functions only.

A line that starts with `>` marks is quoted, one level for each mark.  Runs of
quoted lines of one level are passages.  A passage and every line of it are
normalised (white space runs to one space, trimmed, lower case) and hashed, and
so are a message's own lines, runs of lines and whole own text; a hash's
original is the first message of the conversation that wrote it.  A passage
links to its original if that is an earlier turn; if the passage as a whole has
none, its lines may.  The parent of a message is the latest original of its
outermost passages.  Chains of parents are followed by pointer doubling, so
rounds grow with the logarithm of the deepest reply.

Rows come in reply order by (conv_id, thread_turn, turn): a parent always
precedes its replies.  `conversations` joins them to formatted texts.

Joins are on (conversation, hash), (conversation, turn) or (conversation, salt),
which spread a conversation that holds a third of all rows; no group is gathered
but the lines of one passage and at most PART turns of a formatted part.  The lines
of a conversation without any quotation are neither hashed nor shuffled: the list of
those that have one is written first, so a short one is broadcast by its size.

Defined cases: null and empty texts have no lines to quote or own and stay as
empty messages; a message without a link starts a thread; a null conv_id or
turn never links, and such a message is a conversation of its own; repeated rows (conv_id and turn) get equal results; of equal
originals the smallest turn counts.  Empty table, empty result.  Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import stage

PART = 64
SALTS = 16
_MARK = r"^((?:[ \t]*>)+)[ \t]?"


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")))


def _key(text: Column) -> Column:
    """128 bits of the normalised text; null if nothing is left of it."""
    plain = normalised(text)
    return F.when(plain != "", F.md5(plain))


def lines_of(messages: DataFrame) -> DataFrame:
    """mid, conv_id, turn, pos, level, body, and `run`: consecutive lines of a level share it."""
    lines = messages.select("mid", "conv_id", "turn", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    mark = F.regexp_extract("line", _MARK, 1)
    lines = lines.select("mid", "conv_id", "turn", "pos", F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"),
                         F.regexp_replace("line", _MARK, "").alias("body"))
    place = F.row_number().over(W.partitionBy("mid", "level").orderBy("pos"))
    return lines.withColumn("run", F.col("pos") - place)


def passages_of(lines: DataFrame) -> DataFrame:
    """A row for each run: its lines in order."""
    parts = F.sort_array(F.collect_list(F.struct("pos", "body")))
    return (lines.groupBy("mid", "conv_id", "turn", "level", "run").agg(parts.alias("parts"))
            .withColumn("bodies", F.transform("parts", lambda p: p["body"])).drop("parts"))


def _own_text(text: Column) -> Column:
    return F.trim(F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(r"^[ \t]*>")), "\n"))


def linked(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text (without quotes), parent_turn, thread_turn,
    depth, n_quotes, n_linked: one row per input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).cast("string").alias("role"), text.alias("t"))
    # Rows that repeat conversation, turn and text are one message.
    rows = rows.withColumn("mid", F.xxhash64("conv_id", "turn", "t"))
    able = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    quoting = rows.filter(able & F.col("t").rlike(r"(?m)^[ \t]*>")).dropDuplicates(["mid", "conv_id", "turn"])
    quotes = stage(passages_of(lines_of(quoting).filter("level > 0")).withColumn("passage", F.monotonically_increasing_id()), "chat-quotes")
    whole = F.struct(_key(F.array_join("bodies", "\n")).alias("key"), F.lit(True).alias("whole"))
    each = F.transform("bodies", lambda b: F.struct(_key(b).alias("key"), F.lit(False).alias("whole")))
    keys = stage(quotes.select("passage", "mid", "conv_id", "turn", "level", F.explode(F.array_append(each, whole)).alias("k"))
                 .select("passage", "mid", "conv_id", "turn", "level", "k.key", "k.whole").filter("key is not null"), "chat-keys")

    # Originals, of quoted keys only: the first turn that wrote the text as its own.
    wanted = keys.select(F.col("conv_id").alias("c"), F.col("key").alias("q")).distinct()
    own = F.filter(F.split("t", "\n"), lambda x: ~x.rlike(r"^[ \t]*>"))
    runs = F.split(F.regexp_replace("t", r"(?m)^[ \t]*>.*$", "\u0000"), "\u0000")
    written = F.array_distinct(F.concat(F.array(F.array_join(own, "\n")), runs, own, F.split(F.array_join(own, "\n"), r"\n[ \t]*\n")))
    # Only conversations that quote anything have their lines hashed and moved.
    asked = stage(keys.select(F.col("conv_id").alias("a")).distinct().select("a", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")), "chat-asked")
    heard = rows.filter(able).join(asked, (F.col("conv_id") == F.col("a")) & (F.pmod(F.col("mid"), F.lit(SALTS)) == F.col("s")), "left_semi")
    sources = (heard.select("conv_id", "turn", F.explode(F.transform(written, _key)).alias("key")).filter("key is not null")
               .join(wanted, (F.col("conv_id") == F.col("c")) & (F.col("key") == F.col("q")), "left_semi")
               .groupBy(F.col("conv_id").alias("c"), F.col("key").alias("q")).agg(F.min("turn").alias("source")))
    found = (keys.join(sources, (F.col("conv_id") == F.col("c")) & (F.col("key") == F.col("q")) & (F.col("source") < F.col("turn")))
             .groupBy("passage").agg(F.coalesce(F.max(F.when(F.col("whole"), F.col("source"))), F.max("source")).alias("source")))
    per_message = stage(quotes.select("passage", "mid", "conv_id", "turn", "level").join(found, "passage", "left")
                        .groupBy("mid", "conv_id", "turn").agg(
                            F.count(F.lit(1)).alias("n_quotes"), F.count("source").alias("n_linked"),
                            F.max(F.when(F.col("level") == 1, F.col("source"))).alias("outer"), F.max("source").alias("any")), "chat-parents")
    per_message = per_message.select(F.col("mid").alias("qmid"), F.col("conv_id").alias("qc"), F.col("turn").alias("qt"), "n_quotes", "n_linked",
                                     F.coalesce("outer", "any").alias("parent_turn"))
    parents = per_message.filter("parent_turn is not null").groupBy("qc", "qt").agg(F.max("parent_turn").alias("up"))
    threads = _threads(parents.withColumnsRenamed({"qc": "conv_id", "qt": "turn"}))
    out = (rows.join(per_message, (F.col("mid") == F.col("qmid")) & (F.col("conv_id") == F.col("qc")) & (F.col("turn") == F.col("qt")), "left")
           .drop("qc", "qt")
           .join(threads.withColumnsRenamed({"conv_id": "tc", "turn": "tt"}), (F.col("conv_id") == F.col("tc")) & (F.col("turn") == F.col("tt")), "left"))
    zero = F.lit(0).cast("long")
    return out.select("conv_id", "turn", "role", _own_text(F.col("t")).alias("text"), "parent_turn",
                      F.coalesce("root", "turn").alias("thread_turn"), F.coalesce("depth", zero).alias("depth"),
                      F.coalesce("n_quotes", zero).alias("n_quotes"), F.coalesce("n_linked", zero).alias("n_linked"))


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, up) -> (conv_id, turn, root, depth) by pointer doubling."""
    now = stage(parents.select("conv_id", "turn", F.col("up").alias("root"), F.lit(1).cast("long").alias("depth")), "chat-threads")
    while True:
        above = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("at"), F.col("root").alias("next"), F.col("depth").alias("more"))
        step = now.join(above, (F.col("conv_id") == F.col("c")) & (F.col("root") == F.col("at")), "left")
        if not step.filter("next is not null").limit(1).count():
            return now
        now = stage(step.select("conv_id", "turn", F.coalesce("next", "root").alias("root"),
                                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "chat-threads")


def formatted(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"), text, F.lit("\n"))


def conversations(messages: DataFrame, part: int = PART) -> DataFrame:
    """`linked` rows -> conv_id, thread_turn, part, n_messages, text: the thread's
    messages in reply order, in parts of `part` consecutive turns.  A message
    without conv_id or turn belongs to no thread and is a conversation of its own."""
    rows = messages.select("conv_id", "thread_turn", "turn", "depth", F.floor(F.col("turn") / part).alias("part"),
                           formatted(F.col("role"), F.col("text")).alias("m"))
    able = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    ordered = F.sort_array(F.collect_list(F.struct("turn", "depth", "m")))
    threads = (rows.filter(able).groupBy("conv_id", "thread_turn", "part").agg(F.count(F.lit(1)).alias("n_messages"), ordered.alias("ms"))
               .select("conv_id", "thread_turn", "part", "n_messages", F.array_join(F.transform("ms", lambda m: m["m"]), "").alias("text")))
    single = rows.filter(~able).select("conv_id", "thread_turn", "part", F.lit(1).cast("long").alias("n_messages"), F.col("m").alias("text"))
    return threads.unionByName(single)


SQL = r"""
WITH RECURSIVE rows_ AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations),
lines_ AS (
  SELECT conv_id, turn, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM rows_),
parsed AS (
  SELECT conv_id, turn, t, pos, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)+)[ \t]?', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^((?:[ \t]*>)+)[ \t]?', '') AS body FROM lines_),
numbered AS (SELECT DISTINCT *, pos - dense_rank() OVER (PARTITION BY conv_id, turn, t, level ORDER BY pos) AS run FROM parsed),
runs AS (
  SELECT conv_id, turn, t, level, run, string_agg(body, chr(10) ORDER BY pos) AS whole, list(body ORDER BY pos) AS bodies
  FROM numbered GROUP BY ALL),
own AS (
  SELECT conv_id, turn, t, string_agg(body, chr(10) ORDER BY pos) AS whole, list(body ORDER BY pos) AS bodies
  FROM numbered WHERE level = 0 GROUP BY ALL),
written AS (
  SELECT conv_id, turn, whole AS x FROM own UNION ALL SELECT conv_id, turn, unnest(bodies) FROM own
  UNION ALL SELECT conv_id, turn, unnest(regexp_split_to_array(whole, '\n[ \t]*\n')) FROM own
  UNION ALL SELECT conv_id, turn, whole FROM runs WHERE level = 0),
sources AS (
  SELECT conv_id, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS k, min(turn) AS source FROM written GROUP BY ALL),
quoted AS (
  SELECT conv_id, turn, t, level, run, whole AS x, true AS is_whole FROM runs WHERE level > 0
  UNION ALL SELECT conv_id, turn, t, level, run, unnest(bodies), false FROM runs WHERE level > 0),
hits AS (
  SELECT q.conv_id, q.turn, q.t, q.level, q.run, coalesce(max(s.source) FILTER (q.is_whole), max(s.source)) AS source
  FROM quoted q LEFT JOIN sources s ON s.conv_id = q.conv_id AND s.k <> '' AND s.source < q.turn
       AND s.k = lower(trim(regexp_replace(q.x, '[\x20\x09-\x0D]+', ' ', 'g')))
  GROUP BY ALL),
per_message AS (
  SELECT conv_id, turn, t, count(*) AS n_quotes, count(source) AS n_linked,
         coalesce(max(source) FILTER (level = 1), max(source)) AS parent_turn FROM hits GROUP BY ALL),
parents AS (SELECT conv_id, turn, max(parent_turn) AS up FROM per_message WHERE parent_turn IS NOT NULL GROUP BY ALL),
climb AS (
  SELECT conv_id, turn, up AS root, 1 AS depth FROM parents
  UNION ALL SELECT c.conv_id, c.turn, p.up, c.depth + 1 FROM climb c JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.root),
threads AS (SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM climb GROUP BY ALL)
SELECT r.conv_id, r.turn, r.role, trim(coalesce(o.whole, '')) AS text, p.parent_turn, coalesce(h.root, r.turn) AS thread_turn,
       coalesce(h.depth, 0)::BIGINT AS depth, coalesce(p.n_quotes, 0)::BIGINT AS n_quotes, coalesce(p.n_linked, 0)::BIGINT AS n_linked
FROM rows_ r LEFT JOIN own o ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.turn IS NOT DISTINCT FROM r.turn AND o.t = r.t
LEFT JOIN per_message p ON p.conv_id = r.conv_id AND p.turn = r.turn AND p.t = r.t
LEFT JOIN threads h ON h.conv_id = r.conv_id AND h.turn = r.turn
"""

#: The built conversations, from the rows of SQL.
CONVERSATIONS_SQL = f"""
WITH built AS (
  SELECT conv_id, turn, thread_turn, depth, floor(turn / {PART}.0)::BIGINT AS part,
         '<|' || coalesce(role, 'user') || '|>' || chr(10) || text || chr(10) AS m
  FROM ({SQL}))
SELECT conv_id, thread_turn, part, count(*) AS n_messages, string_agg(m, '' ORDER BY turn, depth, m) AS text
FROM built WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, thread_turn, part
UNION ALL
SELECT conv_id, thread_turn, part, 1, m FROM built WHERE conv_id IS NULL OR turn IS NULL
"""
