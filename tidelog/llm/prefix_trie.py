"""The prefix trie of all conversations, by whole-sequence collapse.

1. **Rebuild.** Each conversation's first turns are replaced by those of the conversation that
   opens its hundred (``rebuilt``).
2. **Name prefixes.** Turns are 16-byte digests; a prefix is named by a digest chained over its
   turns, so equal prefixes have equal names in every conversation. Conversations are sorted
   and streamed: memory doesn't grow with their length, and no text is shuffled.
3. **Collapse.** Rebuilt conversations with one name are one weighted sequence, told by its
   smallest conversation; only that one's prefixes go on.
4. **Leaves.** Sequences that are proper prefixes of others fall by an anti-join with all
   parents' names; the others are the childless nodes.
5. **Aggregate.** Weighted prefixes are summed per name, combined before the shuffle, so a first
   turn that all share is no hot group. Sums over subtrees need no walk: every node is owned by
   the smallest leaf sequence through it. What a leaf owns is the lower end of its path, so the sum
   below a node is the owner's sum from there on and the whole sum of every other leaf
   that passes.

Rows are ordered by turn (null first), then role, then the digest of role and text; repeated rows are turns of their own. Null roles and texts are empty.
Rows without ``conv_id`` belong to no conversation and are left out. An empty table gives
an empty result (no root, as it has no member). Extra columns are ignored.

The list of one sequence's ends is hashed in one task, since hashing is sequential: sorted
by Spark, streamed in batches, never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_type, source
from tidelog.operators.scan import by_width, ordered_scan, row_index, running_sum
from tidelog.session import settle

#: Conversations of one hundred share the first turns of its first one, up to ``HEADS`` - 1 of them.
GROUP, HEADS = 100, 6
ROOT = bytes(16)

PREFIXES = "conv long, depth long, node binary, parent binary, chars long, last boolean"


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that name a turn; the role's length keeps role and text apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def short_turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, name, chars) of every turn; place from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        turn_digest(role, text).alias("name"),
        F.length(text).cast("long").alias("chars"),
    ).filter("conv is not null")
    # Repeated rows are alike, so any order of them is the same.
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    # A read of files numbers its rows the same each time, but settled rows surely do.
    rows = settle(rows, "short_turns")
    placed = ordered_scan(rows, ["conv"], ["turn", "role", "name", "copy"], by_width("turn"), place=row_index())
    return placed.select("conv", (F.col("place") - 1).alias("place"), "name", "chars")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes over."""
    return F.crc32(conv.cast("string")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, place, name, chars) of the rebuilt conversations, and a row of place -1 for each of them."""
    convs = turns.select("conv").distinct().withColumn("shared", shared_turns(F.col("conv")))
    head = F.struct("place", "name", "chars")
    heads = (
        turns.filter((F.col("conv") % GROUP == 0) & (F.col("place") < HEADS - 1))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.collect_list(head).alias("heads"))  # at most HEADS - 1
    )
    taken = convs.withColumn("base", F.col("conv") - F.col("conv") % GROUP).join(heads, "base")
    taken = taken.select("conv", "shared", F.inline("heads")).filter("place < shared").drop("shared")
    own = turns.filter(F.col("place") >= shared_turns(F.col("conv")))
    root = convs.select("conv", F.lit(-1).cast("long").alias("place"), F.lit(ROOT).alias("name"), F.lit(0).cast("long").alias("chars"))
    return root.unionByName(taken).unionByName(own)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of all prefixes. A row is given out when the next one tells whether it was the last."""
    schema, open_ = arrow_type(PREFIXES), None

    def give(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        out = []
        for conv, place, name, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if open_ is not None:
                out.append((*open_, place < 0))
            if place < 0:
                open_ = (conv, 0, ROOT, None, 0)
            else:
                parent = open_[2]
                open_ = (conv, open_[1] + 1, hashlib.blake2b(parent + name, digest_size=16).digest(), parent, chars)
        if out:
            yield give(out)
    if open_ is not None:
        yield give([(*open_, True)])


def prefixes(sequences: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, chars, last): one row for each prefix of each conversation."""
    ordered = sequences.select("conv", "place", "name", "chars").repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.mapInArrow(_chain, PREFIXES)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, now, state, begun = arrow_type("node binary, ends_sha256 string"), None, None, False
    for batch in batches:
        nodes, out = batch.column(0), []
        ids = batch.column(1).cast(pa.string()).to_pylist()
        names = nodes.dictionary_encode()
        known, at = names.dictionary.to_pylist(), names.indices.to_pylist()
        k = 0
        while k < len(at):
            stop = k
            while stop < len(at) and at[stop] == at[k]:
                stop += 1
            if known[at[k]] != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state, begun = known[at[k]], hashlib.sha256(), False
            state.update((("," if begun else "") + ",".join(ids[k:stop])).encode())
            begun, k = True, stop
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], schema=schema)


def end_digests(prefix: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end."""
    ends = prefix.filter("last").select("node", "conv").repartition("node").sortWithinPartitions("node", "conv")
    return ends.mapInArrow(_ends, "node binary, ends_sha256 string")


def collapse(prefix: DataFrame) -> DataFrame:
    """Prefixes of one conversation per distinct sequence, with its weight and whether it is a leaf."""
    sequences = prefix.filter("last").groupBy("node").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"))
    kept = settle(prefix.join(sequences.select("conv", "weight"), "conv"), "sequences")
    inner = kept.filter("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = kept.filter("last").join(inner, "node", "left_anti").select("conv", F.lit(True).alias("leaf"))
    return kept.join(leaves, "conv", "left")


def trie(prefix: DataFrame) -> DataFrame:
    """One row per node from settled ``prefixes``."""
    paths = settle(collapse(prefix), "paths")
    nodes = paths.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("chars").alias("chars"),
        F.min("conv").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf"), F.col("conv"))).alias("owner"),
    )
    nodes = nodes.withColumn("up", -F.col("depth")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    nodes = settle(nodes, "nodes")
    # What each leaf owns: summed from its end upwards, and in whole.
    nodes = settle(ordered_scan(nodes, ["owner"], ["up"], by_width("up"), below=running_sum("saved")), "owned")
    whole = nodes.groupBy(F.col("owner").alias("conv")).agg(F.max("below").alias("whole"))
    passing = paths.filter("leaf").join(whole, "conv").groupBy("node").agg(
        F.sum("whole").alias("passing"), F.max(F.struct(-F.col("conv"), "whole"))["whole"].alias("own")
    )
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(passing, "node").join(children, "node", "left").join(end_digests(prefix), "node", "left").join(above, "parent", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") + F.col("passing") - F.col("own")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = settle(short_turns(source(spark, sf_dir, "conversations")), "turns")
    return trie(settle(prefixes(rebuilt(turns)), "prefixes"))


#: crc32 of decimal numbers from its table, as DuckDB has no such function.
CRC_TABLE = """
crc AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k:
      CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) AS r(i))
)"""


def crc_sql(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a >> 8, crc.tab[(xor(a, b) & 255) + 1])))"""


OP12_SQL = f"""
WITH {CRC_TABLE},
turns AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
sized AS (SELECT c, own, {crc_sql("c::VARCHAR")} % 6 AS h FROM turns, crc),
whole AS (
  SELECT a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS seq
  FROM sized a LEFT JOIN turns b ON b.c = a.c - a.c % 100
),
prefix AS (SELECT c, d, seq[1:d] AS node, len(seq) = d AS ended FROM whole, LATERAL (SELECT unnest(range(len(seq) + 1)) AS d)),
nodes AS (
  SELECT d, node, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ended THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM prefix GROUP BY d, node
),
kids AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children,
    CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.node[n.d]['t']) END AS value
  FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.node = n.node
),
below AS (
  SELECT a.d, a.node, sum(v.value) AS saved, count(*) FILTER (WHERE v.n_children = 0) AS leaves
  FROM (SELECT v.d AS at, v.value, v.n_children, v.node, unnest(range(v.d + 1)) AS up FROM valued v) v
  JOIN nodes a ON a.d = v.up AND a.node = v.node[1:v.up]
  GROUP BY a.d, a.node
)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM valued v JOIN below b ON b.d = v.d AND b.node = v.node
LEFT JOIN nodes p ON p.d = v.d - 1 AND p.node = v.node[1:v.d - 1] AND v.d > 0
"""
