"""Every registered query, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from topicflow.functions.wire import decode_long, long_hex
from topicflow.operators import changelog, pairs, records, tables, tokens
from topicflow.plans import flows, inputs
from topicflow.session import work_dir
from topicflow.sources import once, progress, sinks, topics
from topicflow.streaming import changelog as live, jobs, metrics, processors, state

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


# --- SQL building blocks ----------------------------------------------------------

NON_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+"


def _unicode_parts(text: str) -> str:
    kept = f"regexp_replace(lower({text}), '{NON_WORD}$', '')"
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN {kept} = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split_regex({kept}, '{NON_WORD}') END"
    )


def _space_parts(text: str) -> str:
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN rtrim({text}, ' ') = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split(rtrim({text}, ' '), ' ') END"
    )


def _conversation_words(parts: str, word: str = "word") -> str:
    return f"""
        SELECT topic, "partition", "offset", "key", message, seq,
               CAST(pos - 1 AS INTEGER) AS pos, {word} AS word
        FROM (SELECT *, unnest(parts) AS word, generate_subscripts(parts, 1) AS pos
              FROM (SELECT 'conversations' AS topic, CAST(conv_id % 3 AS INTEGER) AS "partition",
                           conv_id * 4294967296 + turn AS "offset", CAST(conv_id AS VARCHAR) AS "key",
                           text AS message, conv_id * 4294967296 + turn AS seq, {parts} AS parts
                    FROM conversations))"""


_EVENT_TOPIC = """
        SELECT 'events' AS topic, event_id // 3 AS "offset", CAST(user_id AS VARCHAR) AS "key",
               props AS message, CAST(event_id % 3 AS INTEGER) AS "partition"
        FROM events"""

_LINES = """
        SELECT event_id AS seq,
               CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'nocomma'
                    WHEN event_id % 11 = 0 THEN user_id || ',' ELSE user_id || ',' || event_type || ',x' END AS line
        FROM events"""

_PAIRS = f"""
        SELECT seq, upper(split_part(line, ',', 1)) AS "key", upper(split_part(line, ',', 2)) AS "value"
        FROM ({_LINES}) WHERE line IS NOT NULL AND contains(line, ',') AND split_part(line, ',', 2) <> ''"""

_VALID = f"""SELECT * FROM ({_PAIRS}) WHERE "value" IN ('CLICK', 'VIEW', 'PURCHASE')"""

_LATEST_COLOUR = f"""
        SELECT "key", "value"
        FROM (SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY seq DESC) AS rn FROM ({_VALID})) WHERE rn = 1"""

_COLOUR_COUNTS = f"""
        SELECT seen."value", CAST(count(latest."key") AS BIGINT) AS n
        FROM (SELECT DISTINCT "value" FROM ({_VALID})) seen
        LEFT JOIN ({_LATEST_COLOUR}) latest ON latest."value" = seen."value"
        GROUP BY seen."value" """

_RUNNING_COLOUR_COUNTS = f"""
        WITH steps AS (SELECT seq, "value", lag("value") OVER (PARTITION BY "key" ORDER BY seq) AS old FROM ({_VALID})),
             changes AS (SELECT seq, 0 AS step, old AS "value", -1 AS delta FROM steps WHERE old IS NOT NULL
                         UNION ALL SELECT seq, 1, "value", 1 FROM steps)
        SELECT seq, step, "value",
               CAST(sum(delta) OVER (PARTITION BY "value" ORDER BY seq, step ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n
        FROM changes"""

_ACCOUNT_EVENTS = """
        SELECT CAST(o_custkey AS VARCHAR) AS "key", o_orderkey AS seq, CAST(o_custkey AS INTEGER) AS id,
               o_totalprice AS amount, epoch_us(o_orderdate) AS "timestamp"
        FROM orders"""

_LATEST_BALANCE = f"""
        SELECT "key", id, amount, "timestamp"
        FROM (SELECT *, row_number() OVER (PARTITION BY "key" ORDER BY "timestamp" DESC, seq) AS rn
              FROM ({_ACCOUNT_EVENTS})) WHERE rn = 1"""

_RUNNING_BALANCE = f"""
        SELECT "key", seq, id, best.amount AS amount, best.t AS "timestamp"
        FROM (SELECT "key", seq, id,
                     max({{'t': "timestamp", 's': -seq, 'amount': amount}})
                       OVER (PARTITION BY "key" ORDER BY seq ROWS UNBOUNDED PRECEDING) AS best
              FROM ({_ACCOUNT_EVENTS}))"""

_PAYMENTS = """
        SELECT CASE WHEN c_custkey % 19 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS id,
               CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS name,
               CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS amount,
               CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS profile,
               CAST(NULL AS INTEGER) AS salary
        FROM customer"""

_UNICODE_COUNTS = f"""
        SELECT word, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT unnest({_unicode_parts("text")}) AS word FROM documents) GROUP BY word"""

_SPACE_COUNTS = f"""
        SELECT word, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT lower(unnest({_space_parts("text")})) AS word FROM documents) GROUP BY word"""

_CONVERSATION_COUNTS = f"""
        SELECT word, CAST(count(*) AS BIGINT) AS n
        FROM ({_conversation_words(_unicode_parts("text"))}) GROUP BY word"""


def _running_words(words: str) -> str:
    return f"""
        SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY seq, pos) AS BIGINT) AS n,
               "key", topic, "partition", "offset", pos
        FROM ({words})"""


# --- sources ----------------------------------------------------------------------


@query(_EVENT_TOPIC)
def record_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.translate(inputs.events(inputs.batch_reader(spark, sf_dir)))


@query(f"""SELECT "key", message AS "value", "partition", "offset" FROM ({_EVENT_TOPIC}) WHERE "partition" IN (0, 1)""")
def assigned_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.assigned_partitions(inputs.events(inputs.batch_reader(spark, sf_dir)), [0, 1])
    return rows.select("key", "value", "partition", "offset")


@query(f"""SELECT topic, "partition", max("offset") + 1 AS next_offset FROM ({_EVENT_TOPIC}) GROUP BY topic, "partition" """)
def partition_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.partition_progress(inputs.events(inputs.batch_reader(spark, sf_dir)))


@query(f"""SELECT "key", message AS "value", "partition", "offset" FROM ({_EVENT_TOPIC})""")
def drained_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the event topic into a file topic until nothing is left, and read that."""
    rows = inputs.events(inputs.stream_reader(spark, sf_dir)).select("key", "value", "partition", "offset")
    return jobs.read_rows(spark, jobs.start_append(rows, work_dir(spark, "drain")).wait())


@query(f"""SELECT "key", id, amount, "timestamp", CAST(seq % 2 AS INTEGER) AS "partition" FROM ({_ACCOUNT_EVENTS})""")
def typed_topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write account records to chosen partitions of a file topic and read them back."""
    rows = inputs.account_events(inputs.batch_reader(spark, sf_dir))
    path = work_dir(spark, "accounts")
    out = sinks.typed_records(rows.select("id", "amount", "timestamp", "seq"), "id", F.col("seq") % 2).drop("seq")
    sinks.write_topic(out, path)
    schema = out.select("key", "id", "amount", "timestamp", "partition").schema
    return topics.read_topic(spark, path, schema)


@query(f"""SELECT "key", message AS "value" FROM ({_EVENT_TOPIC})""")
def keyed_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write (key, value) records to a file topic and read them back."""
    path = work_dir(spark, "texts")
    rows = sinks.text_records(inputs.events(inputs.batch_reader(spark, sf_dir)))
    sinks.write_topic(rows, path)
    return topics.read_topic(spark, path, rows.schema)


@query(f"""SELECT "key", message, topic, "partition", "offset", count(*) OVER () AS peeked FROM ({_EVENT_TOPIC})""")
def peeked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that pass a peek on their way into a file topic, with the number the peek has seen."""
    path, seen = work_dir(spark, "peeked"), Observation("peeked")
    rows = sinks.peek(topics.translate(inputs.events(inputs.batch_reader(spark, sf_dir))), seen)
    rows.write.parquet(path)
    return topics.read_topic(spark, path, rows.schema).withColumn("peeked", F.lit(seen.get["rows"]).cast("bigint"))


@query(f"""SELECT "key", message, topic, "partition", "offset" FROM ({_EVENT_TOPIC})""")
def spread_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event topic dealt out by key."""
    return topics.spread(topics.translate(inputs.events(inputs.batch_reader(spark, sf_dir))), by=["key"])


@query(f"""SELECT message AS "key", "offset", "partition" FROM ({_EVENT_TOPIC}) WHERE message IS NOT NULL""")
def rekeyed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.translate(inputs.events(inputs.batch_reader(spark, sf_dir)))
    return pairs.rekey(rows, F.col("message")).select("key", "offset", "partition")


@query(
    """SELECT topic, "partition", "offset", "key", "value", seq - 1 AS seq
       FROM (SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset",
                    CAST(user_id AS VARCHAR) AS "key", props AS "value",
                    row_number() OVER (ORDER BY date_trunc('hour', ts), event_id % 3, event_id // 3) AS seq FROM events)"""
)
def ordered_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event topic numbered by (broker time, partition, offset)."""
    rows = topics.with_time_order(inputs.timed_events(inputs.batch_reader(spark, sf_dir)))
    return rows.select("topic", "partition", "offset", "key", "value", "seq")


def _by_offset(rows: DataFrame, pieces: int) -> list[DataFrame]:
    """A topic in consecutive pieces, as it has grown."""
    last = rows.agg(F.max("offset")).first()[0] or 0
    width = last // pieces + 1
    return [rows.where((F.col("offset") >= i * width) & (F.col("offset") < (i + 1) * width)) for i in range(pieces)]


@query(f"""SELECT "key", message AS "value", "partition", "offset" FROM ({_EVENT_TOPIC})""")
def committed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded reads of a growing topic: one is done, one fails before its commit and is done again by a new reader."""
    topic, out, log = work_dir(spark, "topic"), work_dir(spark, "read"), work_dir(spark, "log")
    rows = inputs.events(inputs.batch_reader(spark, sf_dir))

    def present() -> DataFrame:
        return topics.read_topic(spark, topic)

    def handle(found: DataFrame, number: int) -> None:
        found.write.mode("overwrite").parquet(f"{out}/read={number}")

    first, second, third = _by_offset(rows, 3)
    reader = progress.ReadLog(spark, log)
    first.write.parquet(topic)
    reader.drain(present, handle)
    second.write.mode("append").parquet(topic)
    lost = reader.begin(present())
    if lost:
        handle(lost.of(present()).limit(1), lost.number)  # some of its rows are written, and then it stops
    third.write.mode("append").parquet(topic)
    progress.ReadLog(spark, log).drain(present, handle)
    return spark.read.schema(rows.schema).parquet(out).select("key", "value", "partition", "offset")


@query(_EVENT_TOPIC)
def once_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer's batches, one of them delivered again in part and one as a whole, read once each."""
    topic, root = work_dir(spark, "topic"), work_dir(spark, "once")
    rows = inputs.events(inputs.batch_reader(spark, sf_dir))
    pieces = [once.marked(piece, "events", i) for i, piece in enumerate(_by_offset(rows, 3))]
    half = pieces[1].agg((F.min("offset") + F.max("offset")) / 2).first()[0] or 0
    for delivered in (pieces[0], pieces[1].where(F.col("offset") < half), pieces[1], pieces[0], pieces[2]):
        delivered.write.mode("append").parquet(topic)
        job = once.start_once(topics.stream_topic(spark, topic, pieces[0].schema), root).wait()
    return topics.translate(jobs.read_rows(spark, job))


@query(
    f"""SELECT row_number() OVER (ORDER BY piece) - 1 AS batch_id, count(*) AS "rows", max("offset") AS last
        FROM (SELECT "offset", "offset" // (max("offset") OVER () // 3 + 1) AS piece FROM ({_EVENT_TOPIC})) GROUP BY piece"""
)
def stream_peeked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a peek has seen of each micro-batch of a topic that grows in three pieces."""
    topic, root, seen = work_dir(spark, "topic"), work_dir(spark, "peeked"), work_dir(spark, "seen")
    with metrics.PeekRecorder(spark, seen, "passing") as recorder:
        for piece in _by_offset(inputs.events(inputs.batch_reader(spark, sf_dir)), 3):
            piece.write.mode("append").parquet(topic)
            rows = sinks.peek(topics.stream_topic(spark, topic), "passing", last=F.max("offset"))
            recorder.wait(jobs.start_append(rows, root).query)
    return metrics.peeked(spark, seen, "rows bigint, last bigint").select("batch_id", "rows", "last")


# --- words ------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts: cutting them into words is dearer than handing them to idle cores."""
    return topics.spread(inputs.documents(inputs.batch_reader(spark, sf_dir)), at_least=spark.sparkContext.defaultParallelism)


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.conversations(inputs.batch_reader(spark, sf_dir))


@query(f'SELECT "key", seq, pos, word FROM ({_conversation_words(_unicode_parts("text"))})')
def tokens_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.unicode_tokens(inputs.conversations(inputs.batch_reader(spark, sf_dir)))
    return words.select("key", "seq", "pos", "word")


@query(f'SELECT "key", word AS message, topic, "partition", "offset", pos '
       f'FROM ({_conversation_words(_space_parts("text"), "lower(word)")})')
def tokens_space_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.space_tokens(inputs.conversations(inputs.batch_reader(spark, sf_dir)), lower=True)
    return words.select("key", F.col("word").alias("message"), "topic", "partition", "offset", "pos")


@query(f'SELECT topic, "offset", "key", message, "partition", pos, word FROM ({_conversation_words(_space_parts("text"))})')
def tokens_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.token_explode(inputs.conversations(inputs.batch_reader(spark, sf_dir)))


@query(_UNICODE_COUNTS)
def word_count_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.unicode_word_count(_documents(spark, sf_dir))


@query(_SPACE_COUNTS)
def word_count_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.space_word_count(_documents(spark, sf_dir))


@query(f"SELECT word, lpad(hex(n), 16, '0') AS n_hex FROM ({_SPACE_COUNTS})")
def encoded_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count_space(spark, sf_dir).select("word", long_hex(F.col("n")).alias("n_hex"))


@query(_SPACE_COUNTS)
def count_bytes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write counts as (key, 8 bytes) records, read them back and decode them."""
    path = work_dir(spark, "counts")
    rows = sinks.count_records(word_count_space(spark, sf_dir))
    sinks.write_topic(rows, path)
    found = topics.read_topic(spark, path, rows.schema)
    return found.select(F.col("key").alias("word"), decode_long(F.col("value")).alias("n"))


@query(_running_words(_conversation_words(_space_parts("text"), "lower(word)")))
def running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.space_tokens(_conversations(spark, sf_dir), lower=True)
    return _running_rows(changelog.running_count(words.drop("value")))


@query(_running_words(_conversation_words(_unicode_parts("text"))))
def running_word_count_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.unicode_tokens(_conversations(spark, sf_dir))
    return _running_rows(changelog.running_count(words.drop("value")))


def _running_rows(counted: DataFrame) -> DataFrame:
    return counted.select("word", "n", "key", "topic", "partition", "offset", "pos")


@query(_CONVERSATION_COUNTS)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = flows.unicode_word_count(inputs.conversations(inputs.stream_reader(spark, sf_dir)))
    job = jobs.start_table(table, work_dir(spark, "words"), keys=["word"]).wait()
    return jobs.read_table(spark, job, ["word"])


@query(_CONVERSATION_COUNTS)
def stored_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts as the state store holds them."""
    table = flows.unicode_word_count(inputs.conversations(inputs.stream_reader(spark, sf_dir)))
    job = jobs.start_table(table, work_dir(spark, "words")).wait()
    return state.stored_counts(spark, job).drop("partition_id")


@query(_running_words(_conversation_words(_unicode_parts("text"))))
def stream_running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens.unicode_tokens(inputs.conversations(inputs.stream_reader(spark, sf_dir))).drop("value")
    job = live.start_running_count(words, work_dir(spark, "running-words")).wait()
    return _running_rows(jobs.read_rows(spark, job))


@query(
    f"""SELECT word, CAST(count(*) AS BIGINT) AS n
        FROM ({_conversation_words(_space_parts("text"), "lower(word)")}) GROUP BY word"""
)
def stream_space_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = flows.space_word_count(inputs.conversations(inputs.stream_reader(spark, sf_dir)))
    job = jobs.start_table(table, work_dir(spark, "space-words"), keys=["word"]).wait()
    return jobs.read_table(spark, job, ["word"])


@query(f'SELECT topic, "offset", "key", message, "partition", pos, word FROM ({_conversation_words(_space_parts("text"))})')
def stream_token_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows.token_explode(inputs.conversations(inputs.stream_reader(spark, sf_dir)))
    return jobs.read_rows(spark, jobs.start_append(rows, work_dir(spark, "exploded")).wait())


#: Pieces that a resumed job gets one after the other, each with a start, a micro-batch and a stop.
PIECES = 3


def _resumed(spark: SparkSession, rows: DataFrame, start: Callable[[DataFrame], jobs.Job], order: list[int]) -> jobs.Job:
    """Run a job over a topic that grows piece by piece, cut by ``seq``; the job stops and resumes between pieces."""
    path = work_dir(spark, "pieces")
    low, high = rows.agg(F.min("seq"), F.max("seq")).first()
    low, width = low or 0, ((high or 0) - (low or 0)) // PIECES + 1
    job = None
    for i in order:
        piece = rows.where((F.col("seq") >= low + i * width) & (F.col("seq") < low + (i + 1) * width))
        piece.write.mode("append").parquet(path)
        job = start(topics.stream_topic(spark, path, rows.schema)).wait()
    return job


@query(_CONVERSATION_COUNTS)
def resumed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over three micro-batches, the pieces out of order."""
    root = work_dir(spark, "resumed-words")
    rows = _conversations(spark, sf_dir)
    job = _resumed(spark, rows, lambda topic: jobs.start_table(flows.unicode_word_count(topic), root), [2, 0, 1])
    return jobs.read_table(spark, job, ["word"])


@query(_CONVERSATION_COUNTS)
def compacted_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over three micro-batches in a table that holds each word once."""
    root = work_dir(spark, "compacted-words")

    def start(topic: DataFrame) -> jobs.Job:
        return jobs.start_table(flows.unicode_word_count(topic), root, keys=["word"], compact_every=1)

    return jobs.read_table(spark, _resumed(spark, _conversations(spark, sf_dir), start, [2, 0, 1]), ["word"])


@query(
    f"""WITH words AS (
            SELECT word, (seq - min(seq) OVER ()) // ((max(seq) OVER () - min(seq) OVER ()) // {PIECES} + 1) AS batch_id
            FROM ({_conversation_words(_unicode_parts("text"))})
        )
        SELECT CAST(batch_id AS BIGINT) AS batch_id, 'update' AS change_type, word,
               CAST(sum(count(*)) OVER (PARTITION BY word ORDER BY batch_id) AS BIGINT) AS n
        FROM words GROUP BY batch_id, word"""
)
def stored_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of three micro-batches has changed in the state store."""
    root = work_dir(spark, "changed-words")
    rows = _conversations(spark, sf_dir)
    job = _resumed(spark, rows, lambda topic: jobs.start_table(flows.unicode_word_count(topic), root, keys=["word"]), [0, 1, 2])
    return state.count_changes(spark, job, 0, PIECES - 1).drop("partition_id")


# --- colours ----------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.colour_lines(inputs.batch_reader(spark, sf_dir))


def _updates(lines: DataFrame) -> DataFrame:
    return flows.colour_updates(lines, inputs.EVENT_COLOURS, line="line")


@query(_PAIRS)
def color_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.parse_pairs(_lines(spark, sf_dir), line="line").select("seq", "key", "value")


@query(f"""SELECT * FROM ({_LINES}) WHERE line IS NOT NULL AND contains(line, ',') AND split_part(line, ',', 2) = '' """)
def color_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.bad_pairs(_lines(spark, sf_dir), line="line")


@query(_VALID)
def color_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updates(_lines(spark, sf_dir)).select("seq", "key", "value")


@query(_LATEST_COLOUR)
def latest_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest_value(_updates(_lines(spark, sf_dir)))


@query(_COLOUR_COUNTS)
def favourite_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.favourite_colour(_lines(spark, sf_dir), inputs.EVENT_COLOURS, line="line")


@query(_RUNNING_COLOUR_COUNTS)
def running_color_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.running_value_count(_updates(_lines(spark, sf_dir)))


def _colour_job(spark: SparkSession, sf_dir: str) -> jobs.Job:
    updates = _updates(inputs.colour_lines(inputs.stream_reader(spark, sf_dir)))
    return live.start_value_counts(updates, work_dir(spark, "colours")).wait()


@query(_COLOUR_COUNTS)
def stream_favourite_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.value_counts(spark, _colour_job(spark, sf_dir))


@query(_RUNNING_COLOUR_COUNTS)
def stream_running_color_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_rows(spark, _colour_job(spark, sf_dir))


@query(_RUNNING_COLOUR_COUNTS)
def running_color_count_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with users cut into slots that have more than a few updates, and narrow slots."""
    return changelog.running_value_count(_updates(_lines(spark, sf_dir)), hot_rows=5, slot_bits=8)


def _resumed_colours(spark: SparkSession, sf_dir: str) -> jobs.Job:
    root = work_dir(spark, "resumed-colours")
    return _resumed(spark, _lines(spark, sf_dir), lambda lines: live.start_value_counts(_updates(lines), root), [0, 1, 2])


@query(_COLOUR_COUNTS)
def resumed_favourite_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.value_counts(spark, _resumed_colours(spark, sf_dir))


@query(_RUNNING_COLOUR_COUNTS)
def resumed_running_color_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_rows(spark, _resumed_colours(spark, sf_dir))


@query(_COLOUR_COUNTS)
def linked_favourite_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs with a topic of changes between them; the second stops for a while and catches up."""
    changes, counts, path = (work_dir(spark, name) for name in ("changes", "change-counts", "pieces"))
    lines = _lines(spark, sf_dir)
    low, high = lines.agg(F.min("seq"), F.max("seq")).first()
    half = ((low or 0) + (high or 0)) // 2
    for i, piece in enumerate((F.col("seq") < half // 2, F.col("seq").between(half // 2, half), F.col("seq") > half)):
        lines.where(piece).write.mode("append").parquet(path)
        first = live.start_changes(_updates(topics.stream_topic(spark, path, lines.schema)), changes).wait()
        if i != 1:
            second = live.start_change_counts(spark, first, counts).wait()
    return jobs.read_table(spark, second, ["value"])


# --- balances ---------------------------------------------------------------------


@query(_LATEST_BALANCE)
def latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.latest_balance(inputs.account_events(inputs.batch_reader(spark, sf_dir)))


@query(_RUNNING_BALANCE)
def running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.running_balance(inputs.account_events(inputs.batch_reader(spark, sf_dir)))


def _balance_job(spark: SparkSession, sf_dir: str) -> jobs.Job:
    table = flows.latest_balance(inputs.account_events(inputs.stream_reader(spark, sf_dir)))
    return jobs.start_table(table, work_dir(spark, "balances"), keys=["key"]).wait()


@query(_LATEST_BALANCE)
def stream_latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_table(spark, _balance_job(spark, sf_dir), ["key"])


@query(_LATEST_BALANCE)
def stored_latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account records as the state store holds them."""
    return state.stored_balances(spark, _balance_job(spark, sf_dir)).drop("partition_id")


@query(_RUNNING_BALANCE)
def stream_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.account_events(inputs.stream_reader(spark, sf_dir)).drop("name")
    return jobs.read_rows(spark, live.start_running_balance(events, work_dir(spark, "running-balances")).wait())


@query(_RUNNING_BALANCE)
def running_balance_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with accounts cut into slots that have more than a few events, and narrow slots."""
    return changelog.running_balance(inputs.account_events(inputs.batch_reader(spark, sf_dir)), hot_rows=8, slot_bits=8)


@query(_RUNNING_BALANCE)
def resumed_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "resumed-balances")
    rows = inputs.account_events(inputs.batch_reader(spark, sf_dir)).drop("name")
    job = _resumed(spark, rows, lambda events: live.start_running_balance(events, root), [0, 1, 2])
    return jobs.read_rows(spark, job)


@query(_RUNNING_BALANCE)
def state_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running balances from the state store, over three micro-batches."""
    root = work_dir(spark, "state-balances")
    rows = inputs.account_events(inputs.batch_reader(spark, sf_dir)).drop("name")
    job = _resumed(spark, rows, lambda events: jobs.start_append(processors.running_balance(events), root), [0, 1, 2])
    return jobs.read_rows(spark, job)


@query(_LATEST_BALANCE)
def compacted_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts over three micro-batches in a table that holds each account once."""
    root = work_dir(spark, "compacted-balances")
    rows = inputs.account_events(inputs.batch_reader(spark, sf_dir))

    def start(events: DataFrame) -> jobs.Job:
        return jobs.start_table(flows.latest_balance(events), root, keys=["key"], compact_every=1)

    return jobs.read_table(spark, _resumed(spark, rows, start, [0, 1, 2]), ["key"])


# --- records ----------------------------------------------------------------------


@query(f"""SELECT id, coalesce(name, '') AS name, coalesce(amount, 0.0) AS amount,
                  coalesce(profile, 'developer') AS profile, coalesce(salary, 100) AS salary
           FROM ({_PAYMENTS}) WHERE id IS NOT NULL""")
def payment_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.complete_records(inputs.payments(inputs.batch_reader(spark, sf_dir)), records.PAYMENT)


@query(f"SELECT *, 'id' AS missing FROM ({_PAYMENTS}) WHERE id IS NULL")
def payment_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.rejected_records(inputs.payments(inputs.batch_reader(spark, sf_dir)), records.PAYMENT)


@query(f'SELECT id, amount, "timestamp" FROM ({_ACCOUNT_EVENTS})')
def account_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.project_records(inputs.account_events(inputs.batch_reader(spark, sf_dir)), records.FINAL_ACCOUNT)
