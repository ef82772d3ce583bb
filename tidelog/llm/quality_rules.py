"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one text: too few words, or too many words inside eight-word
windows that come back in the same text. The corpus rule counts, per host, in how
many documents each normalised line stands. A line that stands in at least
``MIN_DOCS`` documents of its host and in more than ``LINE_SHARE`` per cent of them
is template: it is removed, and a document that keeps under ``KEEP_SHARE`` per cent
of its words is rejected as depleted.

Normalised: lower case, white space runs as one space, trimmed. Lines without a
word are neither counted nor removed. Within a document a line counts once.

Counts go per (host, line) and are combined before the shuffle, so a host with a
third of all documents is many keys and a line in a third of them a few partial
counts. The template lines are dealt in ``SALTS`` copies to meet their occurrences.

A null text has no words; a null host is the host ``""``. Rows that repeat a
document are documents of their own. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import let, source
from tidelog.session import settle

MIN_WORDS = 20
MAX_REPEAT = 30
WINDOW = 8
MIN_DOCS = 10
LINE_SHARE = 10
KEEP_SHARE = 50
SALTS = 16

SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r"
_HAS_WORD = r"[^\x20\x09-\x0D]"
_RUN = r"[\x20\x09-\x0D]+"


def _spaced(text: Column) -> Column:
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_spaced(text), " "), "")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.lower(F.regexp_replace(line, _RUN, " "))))


def _repeated(keys: Column) -> Column:
    """Words covered by windows whose key comes twice or more; linear but for one sort."""

    def covered(sorted_: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before, after = F.get(sorted_, i - 1), F.get(sorted_, i + 1)
            return F.coalesce(before["key"] == x["key"], F.lit(False)) | F.coalesce(after["key"] == x["key"], F.lit(False))

        places = F.array_sort(F.transform(F.filter(sorted_, twin), lambda x: x["at"]))
        return F.aggregate(
            places,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum")),
            lambda acc, at: F.struct(at.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("sum")),
            lambda acc: acc["sum"],
        )

    pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(let(pairs, covered))


def _word_rules(words: Column) -> Column:
    def keyed(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        keys = F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))
        return F.when(F.size(h) < WINDOW, F.lit(0).cast("long")).otherwise(let(keys, _repeated))

    return let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            let(F.transform(w, lambda x: F.xxhash64(x)), keyed).alias("n_repeat_words"),
        ),
    )


def _line_rules(lines: Column) -> Column:
    """Exact repeats inside the text, and a hash and word count of every line with a word."""
    return let(
        F.filter(lines, lambda x: x.rlike(_HAS_WORD)),
        lambda own: F.struct(
            (F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
            F.transform(own, lambda x: F.struct(line_hash(x).alias("line"), F.size(_words(x)).alias("words"))).alias("lines"),
        ),
    )


def measure(docs: DataFrame) -> DataFrame:
    """Base figures and line hashes of each row, written once: everything after reads this small table."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("print"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.length(_without(text, SPACES + " ")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        _word_rules(_words(text)).alias("by_word"),
        _line_rules(F.split(text, "\n")).alias("by_line"),
    )
    return settle(rows, "quality")


def template_lines(
    rows: DataFrame, min_docs: int = MIN_DOCS, share: float = LINE_SHARE
) -> DataFrame:
    """(host, line) above the limits, from all rows."""
    lines = rows.select("host", F.explode(F.array_distinct("by_line.lines.line")).alias("line"))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= min_docs)
    return counts.join(hosts, "host").filter(F.col("docs") * 100 > F.col("host_docs") * share).select("host", "line")


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = LINE_SHARE, keep: float = KEEP_SHARE) -> DataFrame:
    """One row per document: figures, verdict, and the hashes of its lines that are template."""
    rows = measure(docs)
    template = template_lines(rows, min_docs, share)
    salted = template.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # The first 33 bits of a row number count within its partition; so its last bits are even.
    dealt = rows.select(
        "row", "host", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"), F.explode("by_line.lines").alias("own")
    ).select("row", "host", "salt", "own.line", "own.words")
    cut = (
        dealt.join(salted, ["host", "line", "salt"])
        .groupBy("row")
        .agg(
            F.sum("words").alias("cut_words"),
            F.count(F.lit(1)).alias("n_template_lines"),
            F.collect_set("line").alias("template"),
        )
    )
    n, repeat = F.col("by_word.n_words"), F.col("by_word.n_repeat_words")
    left = n - F.coalesce("cut_words", F.lit(0))
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT * n)
    depleted = (100 * left < keep * n) & (n > 0)
    return rows.join(cut, "row", "left").select(
        "doc_id",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("by_line.n_dup_lines").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        F.coalesce("n_template_lines", F.lit(0)).cast("long").alias("n_template_lines"),
        left.cast("long").alias("words_left"),
        depleted.alias("depleted"),
        "print",
        F.coalesce("template", F.array().cast("array<bigint>")).alias("template"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, without their template lines; columns as before.

    ``n_chars``, where there is one, counts the new text. Rows with one id and one
    text have one verdict.
    """
    verdict = judge(docs).filter("kept").select("doc_id", "print", "template").dropDuplicates(["doc_id", "print"])
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    met = docs.join(
        verdict.withColumnsRenamed({"doc_id": "_doc", "print": "_print", "template": "_template"}),
        docs["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_print")),
    )
    lines = F.filter(
        F.split(text, "\n"),
        lambda x: ~(x.rlike(_HAS_WORD) & F.array_contains(F.col("_template"), line_hash(x))),
    )
    rest = F.when(F.size("_template") == 0, docs["text"]).otherwise(F.array_join(lines, "\n"))
    out = met.withColumn("text", rest)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(source(spark, sf_dir, "documents")).drop("print", "template")


OP1_SQL = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), toks AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM base
), windows AS (
  SELECT r, i, list_slice(w, i, i + {WINDOW - 1}) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM toks)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1
), repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY r
), lines AS (
  SELECT r, host, l, trim(lower(regexp_replace(l, '[\\x20\\x09-\\x0D]+', ' ', 'g')), ' ') AS nl,
         len(list_filter(regexp_split_to_array(l, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS lw
  FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')
), dups AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r
), hosts AS (
  SELECT host, count(*) AS n FROM base GROUP BY host
), template AS (
  SELECT c.host, c.nl FROM (SELECT host, nl, count(DISTINCT r) AS d FROM lines GROUP BY host, nl) c
  JOIN hosts h ON h.host = c.host WHERE c.d >= {MIN_DOCS} AND c.d * 100 > h.n * {LINE_SHARE}
), cut AS (
  SELECT l.r, sum(lw) AS words, count(*) AS n FROM lines l JOIN template t ON t.host = l.host AND t.nl = l.nl GROUP BY l.r
), figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(cut.n, 0) AS BIGINT) AS n_template_lines,
         CAST(len(w) - coalesce(cut.words, 0) AS BIGINT) AS words_left
  FROM toks LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN cut USING (r)
), verdict AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
         100 * words_left < {KEEP_SHARE} * n_words AND n_words > 0 AS depleted
  FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, n_template_lines, words_left, depleted
FROM verdict
"""
