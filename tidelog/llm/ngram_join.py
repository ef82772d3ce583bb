"""Set similarity join on word n-grams by vertical partitioning.

All n-grams stand in one global order, rare ones first. The order is cut into
fragments; a set becomes one segment per fragment, segments meet per fragment,
each counts its partial overlap, and partial overlaps are summed per pair.

1. ``sets``: a set per row as a 128-bit key, and a table of how often n-grams of
   each of 2^18 hash buckets occur over all documents. Its size is fixed, so it may
   go to the driver; it defines the order (bucket count, then hash) and the cuts.
   Equal sets are one class from here on.
2. ``prefixes``: two sets that reach the threshold share an n-gram among their first
   ones in the order (prefix filter). Classes that share one are candidates, as long as
   their sizes, the places of what they share and their marks (parities of the n-grams
   per hash bucket) allow a link. These filters are exact: they never drop a link.
3. Star round: in each n-gram's list only the smallest class is paired with the
   others. Pairs are verified, links joined to groups. A group of near copies costs
   its size, not its square.
4. Rest: pairs of one list that are still in different groups, unless verified
   before, are verified too. Pairs inside one group change nothing, so no link
   between groups is lost and the groups are exact.

Lists hold classes, not documents. Segments of the classes in candidate pairs are
the only sets that are shuffled.

A null or empty text, and one without words, links with nothing. A text of fewer
words is one n-gram of all its words. Rows with a null id stay alone, with a null
component. Repeated rows are one class. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_type, gram_hashes, hashes, list_array, map_batches, mix, ready, source
from tidelog.llm.groups import components, star_and_rest
from tidelog.session import settle, settle_alone

BITS = 18
BLOCKS = 16
FRAGMENTS = 8

#: N-grams of segments handed on at once, and sets that one row has to meet (on average).
LOAD, HOMES = 500_000, 256

#: Least and most bits of a set's mark, in between one per n-gram at least, and the longs of the short mark it folds to.
MARK_BITS, MOST_BITS, SHORT = 1024, 1 << 20, 4

SETS = (
    "doc_id long, n_shingles long, key binary, mark binary, "
    + ", ".join(f"m{k} long" for k in range(SHORT))
    + ", block int, counts binary"
)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Distinct n-gram hashes of a text, lower-cased in A-Z."""
    words = text.encode().lower().split() if text else []
    h = hashes(words)
    if 0 < len(words) < n:
        # Fewer words: the whole sequence, told apart by its length.
        return mix(gram_hashes(h, len(words)) + np.uint64(len(words)))
    return np.unique(gram_hashes(h, n))


def mark(grams: np.ndarray) -> np.ndarray:
    """Parity of the n-grams in each hash bucket, as bits. Their number is a power of two."""
    bits = min(MOST_BITS, max(MARK_BITS, 1 << max(0, len(grams) - 1).bit_length()))
    counts = np.bincount((mix(grams) >> np.uint64(32)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def folded(mark: np.ndarray, size: int) -> np.ndarray:
    """The mark in ``size`` longs: folding xors buckets together, which keeps parities."""
    return np.bitwise_xor.reduce(mark.reshape(-1, size), axis=0)


def marks_differ(one: np.ndarray, two: np.ndarray) -> int:
    """Bits in which two marks differ, the longer one folded."""
    size = min(len(one), len(two))
    return int(np.bitwise_count(folded(one, size) ^ folded(two, size)).sum())


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def sets(docs: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, n_shingles, key) and, per task, rows (block, counts) of the frequency table."""

    def run(batches):
        schema, counts = arrow_type(SETS), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            sizes, keys, marks = [], [], []
            for text in batch.column(1).to_pylist():
                grams = shingles(text, n)
                counts += np.bincount(_bucket(grams), minlength=1 << BITS) if len(grams) > 5000 else 0
                if 0 < len(grams) <= 5000:
                    np.add.at(counts, _bucket(grams), 1)
                sizes.append(len(grams))
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                marks.append(mark(grams))
            short = np.array([folded(m, SHORT) for m in marks], np.uint64).reshape(-1, SHORT).view(np.int64)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([m.tobytes() for m in marks], pa.binary()), *(pa.array(short[:, k]) for k in range(SHORT)),
                 none.cast(pa.int32()), none.cast(pa.binary())],
                schema=schema,
            )
        parts = [c.astype("<u4").tobytes() for c in np.split(counts, BLOCKS)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.binary()),
             pa.nulls(BLOCKS, pa.binary()), *(pa.nulls(BLOCKS, pa.int64()) for _ in range(SHORT)),
             pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], schema=schema,
        )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SETS)


def frequencies(rows: DataFrame) -> np.ndarray:
    """The frequency table: 2^18 sums. Blocks are added up as they stream by."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            schema=arrow_type("block int, counts binary"),
        )

    parts = rows.filter("block is not null").select("block", "counts").repartition(BLOCKS, "block")
    table = np.zeros((BLOCKS, (1 << BITS) // BLOCKS), np.int64)
    for r in parts.mapInArrow(add, "block int, counts binary").collect():  # 2 MB, whatever the input
        table[r["block"]] = np.frombuffer(r["counts"], np.int64)
    return table.ravel()


class Order:
    """The global order of n-grams and its cuts into fragments of even weight."""

    def __init__(self, table: np.ndarray, fragments: int):
        self.rank = np.zeros(len(table), np.uint32)
        by_count = np.argsort(table, kind="stable")
        # Equal counts rank alike, so the hash decides among them.
        steps = np.concatenate(([0], np.cumsum(np.diff(table[by_count]) > 0)))
        self.rank[by_count] = steps
        weight = np.bincount(steps, table[by_count])
        # Half of each step lies before its middle; a step is never cut.
        middle = np.cumsum(weight) - weight / 2
        self.fragment = np.minimum(middle * fragments / max(1.0, weight.sum()), fragments - 1).astype(np.int8)

    def sort(self, grams: np.ndarray) -> np.ndarray:
        return grams[np.lexsort((grams, self.rank[_bucket(grams)]))]

    def fragments(self, grams: np.ndarray) -> np.ndarray:
        return self.fragment[self.rank[_bucket(grams)]]


def least_overlap(n: int, num: int, den: int) -> int:
    return -(-num * n // den)


def prefixes(docs: DataFrame, order: Order, n: int, num: int, den: int) -> DataFrame:
    """(gram, key, size, pos): the first n-grams of each set, enough to meet every set that links."""

    def run(batch: pa.RecordBatch):
        grams, keys, sizes, places = [], [], [], []
        for text in batch.column(1).to_pylist():
            own = shingles(text, n)
            if not len(own):
                continue
            first = order.sort(own)[: len(own) - least_overlap(len(own), num, den) + 1]
            grams.append(first.view(np.int64))
            keys += [xxhash.xxh3_128_digest(own.tobytes())] * len(first)
            sizes.append(np.full(len(first), len(own), np.int32))
            places.append(np.arange(len(first), dtype=np.int32))
        return [np.concatenate(grams), keys, np.concatenate(sizes), np.concatenate(places)] if grams else None

    return map_batches(docs, run, "gram long, key binary, size int, pos int")


def segments(texts: DataFrame, order: Order, n: int) -> DataFrame:
    """(home, fragment, key, size, grams): the set of each row (text, key, homes) cut along the order, for each home.

    ``homes`` are the smaller keys of the pairs that a set is in; one that is its own home is there
    for others to meet. A text that only shares its id with the one wanted has another key and is left out.
    """
    ddl = "home binary, fragment int, key binary, size int, grams array<long>"

    def run(batches):
        schema = arrow_type(ddl)
        for batch in batches:
            out, weight = [], 0
            for text, wanted, homes in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                own = shingles(text, n)
                if xxhash.xxh3_128_digest(own.tobytes()) != wanted:
                    continue
                where = order.fragments(own)
                parts = [(f, own[where == f].view(np.int64)) for f in np.unique(where).tolist()]
                for home in homes:
                    out += [(home, f, wanted, len(own), part) for f, part in parts]
                    weight += len(own)
                    if weight > LOAD:
                        yield _segment_batch(out, schema)
                        out, weight = [], 0
            if out:
                yield _segment_batch(out, schema)

    return texts.mapInArrow(run, ddl)


def _segment_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    *flat, grams = zip(*rows, strict=True)
    columns = [pa.array(c, f.type) for c, f in zip(flat, schema, strict=False)]
    return pa.RecordBatch.from_arrays([*columns, list_array(list(grams), pa.int64())], schema=schema)


def _may_link(x: dict, y: dict, num: int, den: int):
    """Length and position filters for two sets that share the n-gram at these places."""
    small, large = F.least(x["size"], y["size"]), F.greatest(x["size"], y["size"])
    # The overlap asked for: o * den >= num * (a + b - o).
    need = F.ceil((x["size"] + y["size"]).cast("long") * num / (num + den) - 1e-9)
    most = F.least(x["pos"], y["pos"]) + 1 + F.least(x["size"] - x["pos"], y["size"] - y["pos"]) - 1
    return (small * den >= large * num) & (most >= need)


def _close(x: dict, y: dict, num: int, den: int):
    """Whether the short marks of two sets differ no more than linked sets may."""
    both = (x["size"] + y["size"]).cast("long")
    allowed = both - 2 * F.ceil(both * num / (num + den) - 1e-9)
    bits = [F.bit_count(x[f"m{k}"].bitwiseXOR(y[f"m{k}"])) for k in range(SHORT)]
    return sum(bits[1:], bits[0]) <= allowed


def promising(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose marks differ no more than linked sets may differ.

    A mark is the parity of a set's n-grams in each hash bucket, so two sets differ in at
    least as many n-grams as their marks do in bits. Large sets have longer marks, as all
    bits of a short one may differ by chance and rule nothing out.
    """
    marks = classes.select("key", "mark")
    one, two = (marks.withColumnsRenamed({"key": s, "mark": f"mark_{s}"}) for s in "ab")
    met = pairs.join(two, "b").join(one, "a").select("a", "b", "size_a", "size_b", "mark_a", "mark_b")

    def run(batch: pa.RecordBatch):
        if not batch.num_rows:
            return None
        left, right = ([np.frombuffer(m, np.uint64) for m in batch.column(k).to_pylist()] for k in (4, 5))
        differ = np.array([marks_differ(x, y) for x, y in zip(left, right, strict=True)])
        both = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
        allowed = both - 2 * -(-both * num // (num + den))
        keep = pa.array(differ <= allowed)
        return [batch.column(k).filter(keep) for k in range(4)]

    return map_batches(met, run, "a binary, b binary, size_a int, size_b int")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order: Order, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    ends = pairs.select("a", F.explode(F.array("a", "b")).alias("key")).distinct()
    # A set of very many homes is several rows.
    many = ends.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / HOMES).alias("parts"))
    dealt = ends.join(many, "key").withColumn("part", F.pmod(F.xxhash64("a"), "parts"))
    homes = dealt.groupBy("key", "part").agg(F.collect_list("a").alias("homes")).drop("part")
    wanted = settle(classes.join(homes, "key"), "wanted")
    # The comparison lets Spark test ids against a Bloom filter before texts are shuffled.
    wanted = wanted.filter(F.col("doc_id") >= F.lit(-(1 << 63)))
    texts = docs.join(wanted, "doc_id").select("text", "key", "homes")
    # Each set is sent once to each set it is to meet, and nothing with n-grams is shuffled twice.
    parts = settle(segments(texts, order, n), "segments")
    own = parts.filter("home = key").select("home", "fragment", F.col("grams").alias("grams_a"), F.col("size").alias("size_a"))
    partial = parts.filter("home <> key").join(own, ["home", "fragment"])
    partial = partial.withColumn("overlap", F.size(F.array_intersect("grams_a", "grams")))
    # Repeated rows give a segment twice, hence the maximum per fragment.
    return (
        partial.groupBy(F.col("home").alias("a"), "fragment", F.col("key").alias("b"), "size_a", "size")
        .agg(F.max("overlap").alias("overlap"))
        .groupBy("a", "b", "size_a", "size")
        .agg(F.sum("overlap").alias("overlap"))
        .filter(F.col("overlap") * den >= (F.col("size_a") + F.col("size") - F.col("overlap")) * num)
        .select("a", "b")
    )


def similar_groups(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, fragments: int = FRAGMENTS) -> DataFrame:
    """Per row (doc_id, n_shingles, component_id): documents link when ``den`` times the
    intersection is at least ``num`` times the union of their n-word sets. What else it writes is dropped."""
    return settle_alone(lambda: _similar_groups(docs, n, num, den, fragments), "groups")


def _similar_groups(docs: DataFrame, n: int, num: int, den: int, fragments: int) -> DataFrame:
    rows = settle(sets(docs, n), "sets")
    order = Order(frequencies(rows), fragments)
    rows = rows.filter("block is null").drop("block", "counts")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("doc_id is not null")
    shorts = [f"m{k}" for k in range(SHORT)]
    classes = settle(
        rows.filter("key is not null and doc_id is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("mark", *shorts)]),
        "classes",
    )
    rows = rows.select("doc_id", "n_shingles", "key")
    ready(docs.sparkSession).conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1MB")

    def verify(pairs: DataFrame) -> DataFrame:
        few = settle(promising(pairs, classes, num, den), "promising")
        return verified(few, texts, classes.select("key", "doc_id"), order, n, num, den)

    def found() -> DataFrame:
        return star_and_rest(
            prefixes(texts, order, n, num, den),
            ["size", "pos"],
            lambda x, y: _may_link(x, y, num, den),
            verify,
            classes.select("key", *shorts),
            lambda x, y: _close(x, y, num, den),
        )

    links = settle_alone(found, "set_links")
    grouped = components(links).withColumnRenamed("id", "key").join(classes, "key")
    smallest = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(smallest, "component").select("key", "component_id")
    # A class that links with nothing is the group of its own copies.
    own = classes.join(named, "key", "left").select("key", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.join(own, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(source(spark, sf_dir, "documents"), n=3, num=90)


OP2_SQL = r"""
WITH RECURSIVE toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM toks WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * o >= 90 * (s.n + t.n - o)
), ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT x, y FROM ways UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x
)
SELECT t.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles,
       least(t.doc_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = t.doc_id), t.doc_id)) AS component_id
FROM toks t LEFT JOIN sizes s ON s.doc_id = t.doc_id
"""
