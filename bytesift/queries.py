"""The registered queries, each over whole tables, and their SQL twins.

The SQL is DuckDB's and finds occurrences in its own way: a recursive step to the
next occurrence, or a split for patterns that cannot overlap themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bytesift import operators as op
from bytesift import sources, streaming
from bytesift.plans import fresh_folder

# Patterns that users of the searches would pass by hand.
SHORT = "the"
OVERLAPPING = "ana"
REPEATED = "***"
COMMON = ["the", "que", "ee", "und", "ción", "ana", "zzzzqq"]
MARKUP = ["<div", "</a>", "***", "&amp;", "?page=", ".*", "\\E"]
STRADDLING = [".Th", ".É", "n.In", "e.", ". "]
DIGITS = ['"k": 6', "7}", "99", "8"]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = sources.read_texts(
        spark, f"{sf}/documents.parquet", "parquet", text_id="doc_id", body="text"
    )
    return docs.select("text_id", "body")


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = sources.read_texts(
        spark, f"{sf}/part.parquet", "parquet", text_id="p_partkey", body="p_name"
    )
    return parts.select("text_id", "body")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = sources.read_texts(
        spark, f"{sf}/pages.parquet", "parquet", text_id="page_id", body="html"
    )
    return pages.select("text_id", "body")


def _benchmark(spark: SparkSession, sf: str) -> DataFrame:
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    named = items.select(F.col("item_id").alias("pattern_id"), F.col("text").alias("pattern"))
    return op.validate_patterns(named)


def _listed(spark: SparkSession, patterns: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(patterns)), "pattern_id BIGINT, pattern STRING")


def _words(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct words of the part names; a word is its own id."""
    names = spark.read.parquet(f"{sf}/part.parquet").select(
        F.explode(F.split("p_name", " ")).alias("pattern")
    )
    return names.distinct().select(F.col("pattern").alias("pattern_id"), "pattern")


def _names_and_words(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_name").alias("pattern"))
    both = names.distinct().select(F.col("pattern").alias("pattern_id"), "pattern")
    return both.unionByName(_words(spark, sf)).distinct()


def _stored(matches: DataFrame) -> DataFrame:
    """Written once and read back, for a consumer that reads matches twice."""
    return sources.write_matches(matches, fresh_folder(matches.sparkSession, "matches"))


def _filled(report: DataFrame) -> DataFrame:
    """-1 for the values that a kind of report line does not have."""
    return report.fillna(-1, ["text_id", "position", "n_matches"])


def _long(df: DataFrame) -> DataFrame:
    return df.withColumn("pattern_id", F.col("pattern_id").cast("long"))


# --- SQL pieces --------------------------------------------------------------


def _values(patterns: list[str]) -> str:
    rows = ", ".join(f"({i}, '{p.replace(chr(39), chr(39) * 2)}')" for i, p in enumerate(patterns))
    return f"SELECT CAST(i AS BIGINT) AS pattern_id, p AS pattern FROM (VALUES {rows}) v(i, p)"


DOCUMENTS = "SELECT doc_id AS text_id, text AS body FROM documents"
PARTS = "SELECT p_partkey AS text_id, p_name AS body FROM part"
PAGES = "SELECT page_id AS text_id, html AS body FROM pages"
BENCHMARK = "SELECT item_id AS pattern_id, text AS pattern FROM benchmark"
WORDS = (
    "SELECT DISTINCT w AS pattern_id, w AS pattern "
    "FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)"
)
NAMES_AND_WORDS = f"{WORDS} UNION SELECT p_name, p_name FROM part"


def _found(texts: str, patterns: str, then: str) -> str:
    """``then`` over matches(text_id, pattern_id, byte_pos), by stepping on."""
    return f"""
WITH RECURSIVE texts AS ({texts}), patterns AS ({patterns}), steps AS (
  SELECT t.text_id, p.pattern_id, p.pattern, t.body AS rest,
         CAST(0 AS BIGINT) AS base, CAST(-1 AS BIGINT) AS byte_pos
  FROM texts t JOIN patterns p ON contains(t.body, p.pattern)
  UNION ALL
  SELECT text_id, pattern_id, pattern, substr(rest, i + 1),
         base + strlen(substr(rest, 1, i)), base + strlen(substr(rest, 1, i - 1))
  FROM (SELECT *, instr(rest, pattern) AS i FROM steps) WHERE i > 0
), matches AS (
  SELECT text_id, pattern_id, byte_pos FROM steps WHERE byte_pos >= 0
)
{then}"""


ALL_MATCHES = "SELECT text_id, pattern_id, byte_pos FROM matches"
COUNTS = (
    "SELECT text_id, pattern_id, count(*) AS n_matches FROM matches GROUP BY text_id, pattern_id"
)
TOTALS = """
SELECT p.pattern_id, count(m.text_id) AS n_matches, count(DISTINCT m.text_id) AS n_texts
FROM patterns p LEFT JOIN matches m ON m.pattern_id = p.pattern_id GROUP BY p.pattern_id"""
REPORT = """
SELECT pattern_id, 'match' AS kind, text_id, byte_pos + 1 AS position,
       CAST(-1 AS BIGINT) AS n_matches
FROM {listed}
UNION ALL
SELECT p.pattern_id, 'total', -1, -1, count(m.text_id)
FROM patterns p LEFT JOIN matches m ON m.pattern_id = p.pattern_id GROUP BY p.pattern_id"""
FIRST_THREE = """(SELECT * FROM matches QUALIFY row_number() OVER (
  PARTITION BY pattern_id ORDER BY text_id, byte_pos) <= 3)"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


# --- search ------------------------------------------------------------------


@_register(_found(DOCUMENTS, BENCHMARK, TOTALS))
def benchmark_totals(spark, sf):
    """How often each benchmark passage occurs in the documents, zeros included."""
    items = _benchmark(spark, sf)
    matches = op.find_matches_multi(_documents(spark, sf), items)
    return op.pattern_totals(matches, items)


@_register(f"SELECT doc_id AS text_id FROM documents WHERE contains(text, '{REPEATED}')")
def contains_docs(spark, sf):
    return op.contains_filter(_documents(spark, sf), REPEATED).select("text_id")


@_register(f"SELECT doc_id AS text_id FROM documents WHERE NOT contains(text, '{SHORT}')")
def without_docs(spark, sf):
    return op.contains_filter(_documents(spark, sf), SHORT, negate=True).select("text_id")


@_register(f"""
WITH split AS (SELECT doc_id, string_split(text, '{SHORT}') AS pieces FROM documents),
numbered AS (SELECT doc_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS k,
                    len(pieces) AS n FROM split)
SELECT doc_id AS text_id, CAST(0 AS BIGINT) AS pattern_id, byte_pos FROM (
  SELECT doc_id, k, n, CAST(sum(strlen(piece)) OVER (PARTITION BY doc_id ORDER BY k)
         + (k - 1) * strlen('{SHORT}') AS BIGINT) AS byte_pos FROM numbered) WHERE k < n""")
def find_short_pattern(spark, sf):
    return _long(op.find_matches(_documents(spark, sf), SHORT))


@_register(_found(DOCUMENTS, _values([OVERLAPPING]), ALL_MATCHES))
def find_overlapping_pattern(spark, sf):
    return _long(op.find_matches(_documents(spark, sf), OVERLAPPING))


@_register(_found(DOCUMENTS, _values([REPEATED]), ALL_MATCHES))
def find_repeated_mark_split(spark, sf):
    return _long(op.find_matches(_documents(spark, sf), REPEATED, strategy="split"))


@_register(_found(DOCUMENTS, _values(COMMON), ALL_MATCHES))
def find_common_patterns(spark, sf):
    """A handful of short patterns: the literal scan."""
    return op.find_matches_multi(_documents(spark, sf), _listed(spark, COMMON))


@_register(_found(DOCUMENTS, _values(COMMON), ALL_MATCHES))
def find_common_patterns_hash(spark, sf):
    """The same through windows of one to three bytes."""
    return op.find_matches_multi(_documents(spark, sf), _listed(spark, COMMON), "hash")


@_register(_found(PAGES, _values(MARKUP), ALL_MATCHES))
def find_markup_in_pages(spark, sf):
    return op.find_matches_multi(_pages(spark, sf), _listed(spark, MARKUP))


@_register(_found(DOCUMENTS, BENCHMARK, ALL_MATCHES))
def find_benchmark_in_documents(spark, sf):
    return op.find_matches_multi(_documents(spark, sf), _benchmark(spark, sf))


@_register(_found(PAGES, BENCHMARK, ALL_MATCHES))
def find_benchmark_in_pages(spark, sf):
    return op.find_matches_multi(_pages(spark, sf), _benchmark(spark, sf))


@_register(_found(DOCUMENTS, BENCHMARK, ALL_MATCHES))
def hash_join_benchmark(spark, sf):
    return op.hash_join_matches(_documents(spark, sf), _benchmark(spark, sf), q=16, stride=16)


@_register(_found(DOCUMENTS, WORDS, ALL_MATCHES))
def find_words_in_documents(spark, sf):
    """Short patterns from a table, too many for literals."""
    return op.find_matches_multi(_documents(spark, sf), _words(spark, sf))


def _without_broadcast(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as it is planned for patterns beyond the broadcast bound."""
    had = spark.conf.get("spark.bytesift.broadcastBytes", None)
    spark.conf.set("spark.bytesift.broadcastBytes", "0")
    try:
        return build()
    finally:
        if had is None:
            spark.conf.unset("spark.bytesift.broadcastBytes")
        else:
            spark.conf.set("spark.bytesift.broadcastBytes", had)


@_register(_found(DOCUMENTS, WORDS, ALL_MATCHES))
def find_words_shuffled(spark, sf):
    """The same through the joins for pattern tables that cannot be broadcast."""
    docs, words = _documents(spark, sf), _words(spark, sf)
    return _without_broadcast(spark, lambda: op.find_matches_multi(docs, words))


@_register(_found(DOCUMENTS, BENCHMARK, TOTALS))
def totals_shuffled(spark, sf):
    docs, items = _documents(spark, sf), _benchmark(spark, sf)
    return _without_broadcast(spark, lambda: op.pattern_totals(op.find_matches_multi(docs, items), items))


@_register(_found(PARTS, WORDS, ALL_MATCHES))
def find_words_in_parts(spark, sf):
    return op.find_matches_multi(_parts(spark, sf), _words(spark, sf))


@_register(_found(DOCUMENTS, BENCHMARK, ALL_MATCHES))
def chunked_benchmark(spark, sf):
    items = _benchmark(spark, sf)
    return op.find_matches_chunked(op.chunk_texts(_documents(spark, sf), size=4096, patterns=items), items)


@_register(_found(DOCUMENTS, _values(COMMON), ALL_MATCHES))
def split_in_eight(spark, sf):
    """Every document cut to eight slices, spread over the cluster."""
    common = _listed(spark, COMMON)
    chunks = op.chunk_texts(
        _documents(spark, sf),
        num_splits=8,
        patterns=common,
        num_partitions=spark.sparkContext.defaultParallelism,
    )
    return op.find_matches_chunked(chunks, common)


@_register(_found(PARTS, WORDS, """
SELECT text_id, pattern_id, array_to_string(list_transform(range(0, strlen(body)),
         lambda i: CASE WHEN list_contains(starts, i) THEN '1' ELSE '0' END), '') AS mask
FROM (SELECT text_id, pattern_id, list(byte_pos) AS starts FROM matches GROUP BY text_id, pattern_id)
JOIN texts USING (text_id)"""))
def mask_of_words_in_parts(spark, sf):
    parts = _parts(spark, sf)
    masks = op.match_mask(parts, op.find_matches_multi(parts, _words(spark, sf)))
    return masks.select("text_id", "pattern_id", F.array_join("mask", "").alias("mask"))


@_register(_found(DOCUMENTS, BENCHMARK, """
SELECT text_id, pattern_id, strlen(body) AS n_bytes, count(*) AS n_ones,
       CAST(sum(byte_pos) AS BIGINT) AS sum_of_starts
FROM matches JOIN texts USING (text_id) GROUP BY text_id, pattern_id, body"""))
def mask_of_benchmark_in_documents(spark, sf):
    docs = _documents(spark, sf)
    masks = op.match_mask(docs, op.find_matches_multi(docs, _benchmark(spark, sf)))
    ones = F.filter(F.sequence(F.lit(0), F.size("mask") - 1), lambda i: F.get("mask", i) == 1)
    return masks.select(
        "text_id",
        "pattern_id",
        F.size("mask").cast("long").alias("n_bytes"),
        F.size(ones).cast("long").alias("n_ones"),
        F.aggregate(ones, F.lit(0).cast("long"), lambda a, i: a + i).alias("sum_of_starts"),
    )


# --- patterns ----------------------------------------------------------------


@_register("""
WITH b AS (SELECT item_id, hex(encode(text)) AS h, strlen(text) AS m FROM benchmark),
prefixes AS (SELECT item_id, h, m, unnest(range(1, m + 1)) AS j FROM b),
bordered AS (SELECT item_id, m, j, coalesce(list_max(list_filter(range(1, j),
    lambda k: substr(h, 1, 2 * k) = substr(h, 2 * (j - k) + 1, 2 * k))), 0) AS border FROM prefixes)
SELECT item_id AS pattern_id, CAST(m AS BIGINT) AS len,
       string_agg(CAST(border AS VARCHAR), ',' ORDER BY j) AS lps,
       CAST(arg_max(border, j) AS BIGINT) AS longest_border,
       CAST(m - arg_max(border, j) AS BIGINT) AS shortest_period,
       arg_max(border, j) > 0 AS self_overlapping
FROM bordered GROUP BY item_id, m""")
def pattern_profile(spark, sf):
    profile = op.pattern_profile(_benchmark(spark, sf))
    return profile.select(
        "pattern_id",
        F.col("len").cast("long").alias("len"),
        F.array_join("lps", ",").alias("lps"),
        F.col("longest_border").cast("long").alias("longest_border"),
        F.col("shortest_period").cast("long").alias("shortest_period"),
        "self_overlapping",
    )


@_register(_found(
    f"SELECT pattern_id AS text_id, pattern AS body FROM ({NAMES_AND_WORDS})",
    NAMES_AND_WORDS,
    "SELECT text_id AS outer_id, pattern_id AS inner_id, byte_pos FROM matches WHERE text_id <> pattern_id",
))
def nested_patterns(spark, sf):
    return op.nested_patterns(_names_and_words(spark, sf))


@_register("""
SELECT p_partkey AS pattern_id, CASE
    WHEN strlen(p_name) > 10 THEN 'too long'
    WHEN p_partkey > min(p_partkey) OVER (PARTITION BY p_name) THEN 'duplicate'
    ELSE 'good' END AS reason
FROM part""")
def checked_patterns(spark, sf):
    names = spark.read.parquet(f"{sf}/part.parquet").select(
        F.col("p_partkey").alias("pattern_id"), F.col("p_name").alias("pattern")
    )
    checked = op.validate_patterns(names, max_len=10, dedupe=True, keep_invalid=True)
    return checked.select("pattern_id", F.coalesce("reason", F.lit("good")).alias("reason"))


# --- counts and reports ------------------------------------------------------


@_register(_found(DOCUMENTS, _values(COMMON), COUNTS))
def count_per_document(spark, sf):
    return op.count_matches(_documents(spark, sf), _listed(spark, COMMON))


@_register(_found(DOCUMENTS, BENCHMARK, COUNTS))
def count_benchmark_per_document(spark, sf):
    return op.count_matches(_documents(spark, sf), _benchmark(spark, sf))


@_register(_found(DOCUMENTS, BENCHMARK, """
SELECT quality, toxic, count(DISTINCT m.text_id) AS n_texts, count(*) AS n_matches
FROM matches m JOIN labels l ON l.doc_id = m.text_id GROUP BY quality, toxic"""))
def benchmark_counts_by_label(spark, sf):
    counts = op.count_matches(_documents(spark, sf), _benchmark(spark, sf))
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("doc_id", "text_id")
    per_text = counts.groupBy("text_id").agg(F.sum("n_matches").alias("n"))
    return (
        per_text.join(labels, "text_id")
        .groupBy("quality", "toxic")
        .agg(F.count("*").alias("n_texts"), F.sum("n").alias("n_matches"))
    )


@_register(_found(DOCUMENTS, _values(COMMON), TOTALS))
def pattern_totals(spark, sf):
    patterns = _listed(spark, COMMON)
    return op.pattern_totals(op.count_matches(_documents(spark, sf), patterns), patterns)


@_register(_found(DOCUMENTS, BENCHMARK, REPORT.format(listed="matches")))
def full_report(spark, sf):
    items = _benchmark(spark, sf)
    matches = op.find_matches_multi(_documents(spark, sf), items)
    return _filled(op.match_report(_stored(matches), items))


@_register(_found(DOCUMENTS, _values(COMMON), REPORT.format(listed=FIRST_THREE)))
def first_k_report(spark, sf):
    patterns = _listed(spark, COMMON)
    matches = op.find_matches_multi(_documents(spark, sf), patterns)
    return _filled(op.match_report(_stored(matches), patterns, limit=3))


@_register("SELECT doc_id AS text_id, doc_id AS pattern_id, doc_id AS byte_pos, lang AS side FROM documents WHERE false")
def strategy_diff(spark, sf):
    """No row: the scan and the hash join agree."""
    docs, patterns = _documents(spark, sf), _listed(spark, COMMON)
    return op.diff_matches(
        op.find_matches_multi(docs, patterns, "scan"), op.find_matches_multi(docs, patterns, "hash")
    )


@_register(_found(DOCUMENTS, BENCHMARK, """
SELECT text_id, pattern_id, byte_pos, 'a' AS side FROM matches
WHERE text_id NOT IN (SELECT doc_id FROM labels)"""))
def diff_to_labelled(spark, sf):
    """The matches that a run over the labelled documents alone does not find."""
    docs, items = _documents(spark, sf), _benchmark(spark, sf)
    labelled = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("text_id"))
    return op.diff_matches(
        op.find_matches_multi(docs, items),
        op.find_matches_multi(docs.join(labelled.distinct(), "text_id", "left_semi"), items),
    )


@_register(_found(DOCUMENTS, _values(COMMON), f"""
SELECT strategy, chunk_size, CAST({len(COMMON)} AS BIGINT) AS n_patterns,
       (SELECT CAST(sum(strlen(body)) AS BIGINT) FROM texts) AS n_bytes,
       (SELECT count(*) FROM matches) AS n_matches, true AS agrees
FROM (VALUES ('scan'), ('split'), ('hash')) s(strategy), (VALUES (-1), (65536)) c(chunk_size)"""))
def compare_strategies(spark, sf):
    runs = op.compare_strategies(
        _documents(spark, sf), _listed(spark, COMMON), sizes=(None, 1 << 16)
    )
    # what is left is the same whatever the machine
    same = runs.drop("copies", "ms", "mb_per_s", "mb_per_s_core")
    return same.withColumn("chunk_size", F.coalesce("chunk_size", F.lit(-1)))


@_register(_found(DOCUMENTS, WORDS, """
SELECT 'hash' AS strategy, CAST(2 AS BIGINT) AS n_runs, true AS measured,
       CAST(round((SELECT count(*) FROM matches) / (SELECT sum(strlen(body)) / 1e6 FROM texts)) AS BIGINT) AS matches_per_mb"""))
def strategy_growth(spark, sf):
    """The words of the part names in one and in four copies of all documents: what a megabyte adds."""
    runs = op.compare_strategies(_documents(spark, sf), _words(spark, sf), ("hash",), copies=(1, 4))
    return op.strategy_slopes(runs).select(
        "strategy",
        "n_runs",
        F.col("ms_per_mb").isNotNull().alias("measured"),
        F.round("n_matches_per_mb").cast("long").alias("matches_per_mb"),
    )


# --- sources and sinks -------------------------------------------------------


@_register(_found(DOCUMENTS, BENCHMARK, ALL_MATCHES))
def stored_matches(spark, sf):
    """Written by pattern and read back."""
    matches = op.find_matches_multi(_documents(spark, sf), _benchmark(spark, sf))
    return sources.write_matches(matches, fresh_folder(spark, "matches"), "pattern_id")


def _as_files(spark: SparkSession, sf: str) -> str:
    """The documents as plain text files in the shared folder."""
    folder = fresh_folder(spark, "texts")
    _documents(spark, sf).select("body").write.text(folder)
    return folder


FILE_TOTALS = """
SELECT p.pattern_id, count(m.text_id) AS n_matches
FROM patterns p LEFT JOIN matches m ON m.pattern_id = p.pattern_id GROUP BY p.pattern_id"""


@_register(_found(DOCUMENTS, _values(COMMON), FILE_TOTALS))
def whole_file_totals(spark, sf):
    """Totals over files; no pattern holds the newline between two documents."""
    files = sources.read_texts(spark, f"{_as_files(spark, sf)}/*.txt")
    patterns = _listed(spark, COMMON)
    totals = op.pattern_totals(op.count_matches(files, patterns), patterns)
    return totals.select("pattern_id", "n_matches")


@_register(_found(DOCUMENTS, BENCHMARK, FILE_TOTALS))
def file_range_totals(spark, sf):
    items = _benchmark(spark, sf)
    ranges = sources.read_text_ranges(spark, f"{_as_files(spark, sf)}/*.txt", size=1 << 18, patterns=items)
    totals = op.pattern_totals(op.find_matches_chunked(ranges, items), items)
    return totals.select("pattern_id", "n_matches")


BRANDS = (
    "SELECT row_number() OVER (ORDER BY p_brand) - 1 AS pattern_id, p_brand AS pattern "
    "FROM (SELECT DISTINCT p_brand FROM part)"
)


@_register(_found("SELECT p_partkey AS text_id, p_brand AS body FROM part", BRANDS, TOTALS))
def pattern_file_totals(spark, sf):
    """The brands, one per line of a pattern file, searched in the brand column."""
    parts = spark.read.parquet(f"{sf}/part.parquet")
    folder = fresh_folder(spark, "patterns")
    # the brands are a small fixed domain; one sorted file lists them
    parts.select("p_brand").distinct().coalesce(1).sortWithinPartitions("p_brand").write.text(folder)
    patterns = _long(sources.read_patterns(spark, f"{folder}/*.txt"))
    texts = parts.select(F.col("p_partkey").alias("text_id"), F.col("p_brand").alias("body"))
    return op.pattern_totals(op.find_matches_multi(texts, patterns), patterns)


# --- streaming ---------------------------------------------------------------

CONVERSATIONS = (
    "SELECT conv_id AS text_id, string_agg(text, '' ORDER BY turn) AS body "
    "FROM conversations GROUP BY conv_id"
)


@_register(_found(CONVERSATIONS, _values(STRADDLING), ALL_MATCHES))
def conversation_straddle(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    found = streaming.find_across(turns, "conv_id", "turn", _listed(spark, STRADDLING), body="text")
    return found.withColumnRenamed("key", "text_id")


def _stream(spark: SparkSession, sf: str, table: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{table}*.parquet")


def _to_files(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream to its end, into files, and read those."""
    spark = stream.sparkSession
    out, state = fresh_folder(spark, name), fresh_folder(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _last_state(stream: DataFrame, name: str) -> DataFrame:
    """Run a complete-mode stream to its end and read its last result."""
    spark = stream.sparkSession
    out, state = fresh_folder(spark, name), fresh_folder(spark, f"{name}-state")
    query = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@_register(_found(DOCUMENTS, BENCHMARK, ALL_MATCHES))
def stream_find_benchmark(spark, sf):
    docs = _stream(spark, sf, "documents")
    found = streaming.stream_find_matches(docs, _benchmark(spark, sf), text_id="doc_id", body="text")
    return _to_files(found, "stream-matches")


@_register(_found(DOCUMENTS, _values(COMMON), """
SELECT pattern_id, count(*) AS n_matches FROM matches GROUP BY pattern_id"""))
def stream_totals(spark, sf):
    docs = _stream(spark, sf, "documents")
    totals = streaming.stream_pattern_totals(docs, _listed(spark, COMMON), body="text")
    return _last_state(totals, "stream-totals")


@_register(_found("SELECT event_id AS text_id, props AS body, ts FROM events", _values(DIGITS), """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, pattern_id,
       count(*) AS n_matches
FROM matches JOIN texts USING (text_id) GROUP BY 1, 2"""))
def stream_hourly_totals(spark, sf):
    events = _stream(spark, sf, "events")
    totals = streaming.stream_pattern_totals(
        events, _listed(spark, DIGITS), event_time="ts", window="1 hour", body="props"
    )
    return _last_state(totals, "stream-hours").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "pattern_id",
        "n_matches",
    )


@_register(_found(CONVERSATIONS, _values(STRADDLING), ALL_MATCHES))
def stream_conversation_straddle(spark, sf):
    turns = _stream(spark, sf, "conversations")
    found = streaming.stream_find_across(
        turns, "conv_id", "turn", _listed(spark, STRADDLING), first_order=0, body="text"
    )
    return _to_files(found.withColumnRenamed("key", "text_id"), "stream-across")


def _resumed(feeds: list[DataFrame], start: Callable[[DataFrame, str], StreamingQuery], name: str) -> None:
    """Give one table after the other to a stream, which stops and is resumed in between."""
    spark, schema = feeds[0].sparkSession, feeds[0].schema
    folder, state = fresh_folder(spark, name), fresh_folder(spark, f"{name}-state")
    for i, feed in enumerate(feeds):
        feed.write.parquet(f"{folder}/feed={i}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/feed=*")
        start(stream.select(*schema.names), state).awaitTermination()


@_register(_found(CONVERSATIONS, _values(STRADDLING), ALL_MATCHES))
def stream_straddle_resumed(spark, sf):
    """Turns in order of time over several runs; a conversation that is over leaves the state."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text")
    # from 2024 on: a watermark starts at 1970, and what is not after it is late
    timed = turns.withColumn("at", F.timestamp_seconds(1_704_067_200 + F.col("conv_id") * 3600 + F.col("turn") * 60))
    seconds = F.unix_seconds("at")
    cuts = timed.agg(F.percentile_approx(seconds, [0.33, 0.67])).first()[0] or [0, 0]
    feeds = [timed.where(seconds <= cuts[0]), timed.where((seconds > cuts[0]) & (seconds <= cuts[1])), timed.where(seconds > cuts[1])]
    out, patterns = fresh_folder(spark, "stream-resumed"), _listed(spark, STRADDLING)

    def start(stream: DataFrame, state: str) -> StreamingQuery:
        return streaming.write_stream_across(
            stream, "conv_id", "turn", patterns, out, state, first_order=0, body="text",
            event_time="at", watermark="10 minutes", timeout="20 minutes",
        )

    _resumed(feeds, start, "turns")
    found = spark.read.schema("key BIGINT, pattern_id BIGINT, byte_pos BIGINT").parquet(f"{out}/matches/batch=*")
    return found.withColumnRenamed("key", "text_id")


# Every tenth event up to this time comes after all others up to it.
LATE_UNTIL = "2024-01-20 00:00:00"


def _late_events(spark: SparkSession, sf: str) -> list[DataFrame]:
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "props")
    until = F.lit(LATE_UNTIL).cast(events.schema["ts"].dataType)
    early, late = F.col("ts") <= until, F.col("event_id") % 10 == 0
    return [events.where(early & ~late), events.where(early & late), events.where(~early)]


def _closed_totals(spark: SparkSession, sf: str, name: str, listed: list[str], **windows) -> DataFrame:
    """Totals of the windows that closed over three runs with late rows in the second."""
    out, patterns = fresh_folder(spark, name), _listed(spark, listed)

    def start(stream: DataFrame, state: str) -> StreamingQuery:
        totals = streaming.stream_pattern_totals(
            stream, patterns, event_time="ts", watermark="30 minutes", body="props", **windows
        ).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "pattern_id", "n_matches")
        writer = totals.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start()

    _resumed(_late_events(spark, sf), start, f"{name}-feeds")
    return spark.read.schema("window_start STRING, pattern_id BIGINT, n_matches BIGINT").parquet(out)


def _closed_sql(hours: int, join: str) -> str:
    """Rows that come late count only in windows that were open; only closed windows are told."""
    return f"""
, bounds AS (
  SELECT coalesce(max(ts) FILTER (text_id % 10 <> 0 AND ts <= '{LATE_UNTIL}'), TIMESTAMP '1970-01-01') - INTERVAL 30 MINUTE AS late,
         max(ts) - INTERVAL 30 MINUTE AS closed FROM texts
), windowed AS (
  SELECT text_id, ts, date_trunc('hour', ts) - h * INTERVAL 1 HOUR AS w FROM texts, range({hours}) r(h)
), counted AS (
  SELECT w, text_id FROM windowed, bounds
  WHERE w + INTERVAL {hours} HOUR <= closed
    AND (text_id % 10 <> 0 OR ts > '{LATE_UNTIL}' OR w + INTERVAL {hours} HOUR > late)
)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, p.pattern_id, count(m.text_id) AS n_matches
FROM counted c CROSS JOIN patterns p {join} JOIN matches m ON m.text_id = c.text_id AND m.pattern_id = p.pattern_id
GROUP BY 1, 2"""


EVENTS = "SELECT event_id AS text_id, props AS body, ts FROM events"


@_register(_found(EVENTS, _values(DIGITS), _closed_sql(1, "INNER")))
def stream_late_totals(spark, sf):
    """Tumbling windows in append mode: rows behind the watermark are dropped."""
    return _closed_totals(spark, sf, "stream-late", DIGITS, window="1 hour")


@_register(_found(EVENTS, _values([*DIGITS, "zzzzqq"]), _closed_sql(2, "LEFT")))
def stream_sliding_totals(spark, sf):
    """Sliding windows in append mode, each with all patterns when it closes."""
    return _closed_totals(spark, sf, "stream-sliding", [*DIGITS, "zzzzqq"], window="2 hours", slide="1 hour", zeros=True)


@_register(_found(PARTS, NAMES_AND_WORDS, ALL_MATCHES))
def stream_find_in_passes(spark, sf):
    """More anchors than one broadcast may hold, on a stream."""
    parts = _stream(spark, sf, "part")
    found = _without_broadcast(
        spark, lambda: streaming.stream_find_matches(parts, _names_and_words(spark, sf), "hash", text_id="p_partkey", body="p_name")
    )
    return _to_files(found, "stream-passes")
