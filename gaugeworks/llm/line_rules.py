"""Quality rules: lines that many documents of a host share, and documents depleted by them.

Only DataFrame functions. Lines are normalised (lower case, single blanks) and hashed together
with their host; the documents of a host that have a line are counted by distinct text, so exact
copies of one document, which are not this rule's matter, count once. Lines above the limit go;
a document that loses more than a share of its words is rejected, as is one that fails the base
rules (too few words, or too many words inside repeated five-word windows).

Null texts count as empty. A null host is a host of its own. Repeated rows and repeated ids get
a row each with the verdict of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import query, table

#: Production parameters: distinct documents of a host a line may be in, and the percentage of
#: its words a document may lose.
MAX_DOCUMENTS = 50
MAX_LOST_PERCENT = 50

BLANK = r"[\x20\x09-\x0D]+"


def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"), "text", "source")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def _line_hash(host: Column, line: Column) -> Column:
    return F.xxhash64(host, F.array_join(_words(F.lower(line)), " "))


def base_columns(docs: DataFrame) -> DataFrame:
    """Adds the counts of the base rules to (key, doc_id, text, ...), and drops the text.

    Five-word windows are hashed into the upper bits of a long whose lower bits are the
    position, so sorting longs brings equal windows together and still tells where they were.
    """
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = (
        docs.withColumn("words", _words(F.col("text")))
        .withColumn("lines", lines)
        .withColumn("n_symbols", F.expr(r"CAST(regexp_count(text, '[#*$%&|<>]') AS BIGINT)"))
        .drop("text")
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("bits", F.ceil(F.log2(F.col("n_words") + 2)).cast("int"))
        .drop("lines")
    )
    sorted_windows = words.withColumn(
        "windows",
        F.expr(
            "CASE WHEN n_words >= 6 THEN sort_array(transform(sequence(1, CAST(n_words AS INT) - 4), i -> "
            "shiftleft(xxhash64(words[i - 1], words[i], words[i + 1], words[i + 2], words[i + 3]), bits) | i)) "
            "ELSE CAST(array() AS ARRAY<BIGINT>) END"
        ),
    ).drop("words")
    repeated = sorted_windows.withColumn(
        "at",
        F.expr(
            "sort_array(transform(filter(windows, (x, j) -> "
            "(j > 0 AND shiftright(windows[j - 1], bits) = shiftright(x, bits)) OR "
            "(j < size(windows) - 1 AND shiftright(windows[j + 1], bits) = shiftright(x, bits))), "
            "x -> x & (shiftleft(1L, bits) - 1)))"
        ),
    ).drop("windows")
    return repeated.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(at, named_struct('total', 0L, 'last', -5L), "
            "(a, x) -> named_struct('total', a.total + least(5L, x - a.last), 'last', x), a -> a.total)"
        ),
    ).drop("at", "bits")


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("source").cast("string").alias("source")
    ).withColumn("key", _key())


def frequent_lines(keyed: DataFrame, max_documents: int) -> DataFrame:
    """(key, all_lost_words, lost_lines): what each document loses. Absent: nothing.
    ``all_lost_words`` has every occurrence in all rows of the key."""
    lines = (
        keyed.select("key", "source", F.xxhash64("text").alias("same"), F.explode(F.split("text", "\n")).alias("line"))
        .select("key", "same", _line_hash(F.col("source"), F.col("line")).alias("line"), F.size(_words(F.col("line"))).alias("w"))
        .where("w > 0")
        .groupBy("key", "same", "line")
        .agg(F.max("w").alias("w"), F.count("*").alias("times"))
    )
    frequent = (
        lines.select("line", "same").distinct().groupBy("line").count().where(F.col("count") > max_documents).select("line")
    )
    return (
        lines.join(frequent, "line")
        .groupBy("key")
        .agg(
            F.sum(F.col("w") * F.col("times")).alias("all_lost_words"),
            F.collect_set("line").alias("lost_lines"),
        )
    )


def line_rules(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """(doc_id, text, source) to one row per input row: the base counts, ``base_failed``,
    ``lost_words`` (words in lines above the limit, every occurrence of a line), ``kept``."""
    keyed = _with_key(docs)
    stats = base_columns(keyed.drop("source"))
    lost = frequent_lines(keyed, max_documents).select("key", "all_lost_words")
    # Rows of one key have the same text, so each has its share of what they lose together.
    own = F.expr("all_lost_words div count(*) OVER (PARTITION BY key)")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        stats.join(lost, "key", "left")
        .withColumn("lost_words", F.coalesce(own, F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (100 * F.col("lost_words") <= max_lost_percent * F.col("n_words")))
    )


def clean(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Rows of ``docs``, all columns, that the rules keep; their text goes without the lines
    above the limit and ``n_chars`` follows it. Other rows stay as they are. The share of words a
    document loses counts every occurrence of a line, as every one is cut."""
    keyed = _with_key(docs)
    verdict = base_columns(keyed.drop("source")).select(
        "key", ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("failed"), "n_words"
    )
    lost = frequent_lines(keyed, max_documents)
    change = (
        verdict.join(lost, "key", "left")
        .groupBy("key")
        .agg(
            # both sums are over all rows of the key, which have the same text
            (F.max("failed") | (100 * F.coalesce(F.max("all_lost_words"), F.lit(0)) > max_lost_percent * F.sum("n_words"))).alias("rejected"),
            F.first("lost_lines", ignorenulls=True).alias("lost_lines"),
        )
        .where("rejected OR lost_lines IS NOT NULL")
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("source").cast("string").alias("source"),
        "doc_id",
    )
    rows = rows.select("row", "source", _key().alias("key")).join(change, "key", "left").where("rejected IS NULL OR NOT rejected")
    left = F.array_join(
        F.filter(
            F.split(F.col("row.text"), "\n"),
            lambda x: ~F.array_contains(F.col("lost_lines"), _line_hash(F.col("source"), x)),
        ),
        "\n",
    )
    text = F.when(F.col("lost_lines").isNull(), F.col("row.text")).otherwise(left)
    rows = rows.withColumn("kept_text", text)
    out = [
        F.col("kept_text").alias(c) if c == "text"
        else F.when(F.col("lost_lines").isNull(), F.col("row.n_chars")).otherwise(F.length("kept_text")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return rows.select(*out)


_SPLIT = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: The rules in SQL, for {documents} and the two limits.
RULES_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT k, doc_id, text, {_SPLIT.format('text')} AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT k, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
g5 AS (SELECT k, i, array_to_string(w[i:i + 4], ' ') AS five FROM g),
hit AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, five) AS n FROM g5) WHERE n > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM hit) GROUP BY k),
l AS (SELECT k, text, source, line, count(*) AS times FROM (
  SELECT k, text, source, array_to_string({_SPLIT.format('lower(line)')}, ' ') AS line
  FROM (SELECT k, text, source, unnest(string_split(text, chr(10))) AS line FROM d)) WHERE line <> '' GROUP BY k, text, source, line),
f AS (SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT text) > {{max_documents}}),
lost AS (SELECT k, sum(times * len(string_split(l.line, ' '))) AS n FROM l JOIN f ON f.line = l.line AND f.source IS NOT DISTINCT FROM l.source GROUP BY k),
s AS (SELECT w.k, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS lost_words
  FROM w LEFT JOIN rep ON rep.k = w.k LEFT JOIN lost ON lost.k = w.k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_words <= {{max_lost_percent}} * n_words AS kept
FROM s
"""


@query("op6_line_rules", RULES_SQL.format(max_documents=MAX_DOCUMENTS, max_lost_percent=MAX_LOST_PERCENT))
def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents; hosts are their sources."""
    return line_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept"
    )
