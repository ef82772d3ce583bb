"""Column metadata: table maps derived from the event table, one per event."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import binary as bx
from tidelog.functions import columns as col_fn
from tidelog.operators import catalog, changes
from tidelog.plans import views as v
from tidelog.plans.registry import query
from tidelog.plans.views import CTE, with_views
from tidelog.session import spread_table

# Type codes the fixture draws columns from (fixed values).
PALETTE = [1, 2, 3, 8, 9, 246, 4, 15, 252, 254, 245, 10, 255]
N_TYPES = len(PALETTE)


def eid():
    return F.col("event_id")


# The oracle builds the same columns by unnest, and finds list positions with
# row_number windows instead of array functions.
CTE["map_cols"] = f"""
SELECT e.event_id, i.n AS ordinal,
  ([{", ".join(map(str, PALETTE))}])[CAST((e.event_id + 3 * i.n + i.n * i.n) % {N_TYPES} AS BIGINT) + 1] AS type,
  CASE ([{", ".join(map(str, PALETTE))}])[CAST((e.event_id + 3 * i.n + i.n * i.n) % {N_TYPES} AS BIGINT) + 1]
    WHEN 254 THEN CASE (e.event_id + i.n) % 3 WHEN 0 THEN 247 * 256 + 1 WHEN 1 THEN 248 * 256 + 1 ELSE 238 * 256 + 40 END
    WHEN 246 THEN 2562 WHEN 15 THEN 255 WHEN 252 THEN 2 WHEN 255 THEN 4 WHEN 245 THEN 4 WHEN 4 THEN 4 ELSE 0 END AS meta,
  e.event_id % 5 <> 0 AS named, e.user_id % 2 = 0 AS keyed, (e.event_id + i.n) % 2 = 0 AS nullable
FROM events e, (SELECT unnest(range(0, 11)) AS n) i
WHERE i.n < 4 + e.user_id % 8"""
CTE["map_real"] = """
SELECT *, CASE WHEN type = 254 AND meta >> 8 IN (247, 248) THEN meta >> 8 WHEN type = 10 THEN 14 ELSE type END AS real_type FROM map_cols"""
CTE["map_class"] = """
SELECT *, CASE WHEN real_type IN (1, 2, 3, 4, 5, 8, 9, 246) THEN 'numeric' WHEN real_type IN (15, 252, 253, 254) THEN 'character'
  WHEN real_type = 247 THEN 'enum' WHEN real_type = 248 THEN 'set' WHEN real_type = 255 THEN 'geometry' WHEN real_type = 245 THEN 'json' ELSE 'other' END AS class
FROM map_real"""
CTE["map_ranked"] = """
SELECT *, row_number() OVER (PARTITION BY event_id, class ORDER BY ordinal) - 1 AS k,
  row_number() OVER (PARTITION BY event_id, class IN ('enum', 'set') ORDER BY ordinal) - 1 AS kes FROM map_class"""
CTE["map_catalog"] = """
SELECT event_id, ordinal, type, meta, real_type, class, nullable,
  CASE WHEN class = 'numeric' THEN (event_id * 7 + k * 3) % 5 < 2 END AS unsigned,
  CASE WHEN named THEN 'c' || CAST(ordinal AS VARCHAR) END AS name,
  CASE WHEN class = 'character' THEN CASE WHEN event_id % 3 = 0 THEN CASE k WHEN 0 THEN 45 WHEN 2 THEN 63 ELSE 8 END ELSE 33 + k END
       WHEN class IN ('enum', 'set') THEN CASE WHEN event_id % 3 = 0 THEN 100 + kes ELSE CASE kes WHEN 1 THEN 48 ELSE 9 END END END AS "collation",
  CASE WHEN class = 'enum' THEN 'e' || CAST(k AS VARCHAR) || 'a,e' || CAST(k AS VARCHAR) || 'b'
       WHEN class = 'set' THEN 's' || CAST(k AS VARCHAR) || 'x,s' || CAST(k AS VARCHAR) || 'y,s' || CAST(k AS VARCHAR) || 'z' END AS labels,
  CASE WHEN class = 'geometry' THEN k + 1 END AS geometry,
  CASE WHEN keyed AND ordinal = 2 THEN 0 WHEN keyed AND ordinal = 0 THEN 1 END AS pk_ord,
  CASE WHEN keyed AND ordinal = 2 THEN 0 WHEN keyed AND ordinal = 0 THEN 10 END AS pk_prefix
FROM map_ranked"""
CATALOG = "map_cols map_real map_class map_ranked map_catalog"


def table_maps(spark, sf) -> DataFrame:
    """Decoded table maps (as ``binlog.table_maps`` gives them) computed per event."""
    rows = spread_table(spark, sf, "events")
    ints = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    palette = F.array(*[F.lit(t) for t in PALETTE])

    def type_of(i):
        return F.element_at(palette, ((eid() + 3 * i + i * i) % N_TYPES + 1).cast("int"))

    def meta_of(i):
        t, hidden = type_of(i), (eid() + i) % 3
        folded = F.when(hidden == 0, 247 * 256 + 1).when(hidden == 1, 248 * 256 + 1).otherwise(238 * 256 + 40)
        fixed = (
            F.when(t == 246, 2562).when(t == 15, 255).when(t == 252, 2).when(t.isin(255, 245, 4), 4).otherwise(0)
        )
        return F.when(t == 254, folded).otherwise(fixed)

    def pack(flag, n_bytes, msb_first):
        bits = 8 * n_bytes
        at = [F.when(flag(i), 1 << (bits - 1 - i if msb_first else i)).otherwise(0) for i in range(bits)]
        return (bx.to_be if msb_first else bx.to_le)(reduce(add, at).cast("bigint"), n_bytes)

    def labels(k, prefix, ends):
        return F.array(*[F.lit(f"{prefix}{k}{e}") for e in ends])

    def constant(of):
        return F.array(*[of(k) for k in range(11)])

    nothing = F.array().cast("array<bigint>")
    third, keyed = eid() % 3 == 0, F.col("user_id") % 2 == 0
    longs = lambda *xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    n = 4 + F.col("user_id") % 8
    return rows.select(
        "event_id",
        F.transform(ints(n), type_of).alias("types"),
        F.transform(ints(n), meta_of).alias("metas"),
        pack(lambda i: (eid() + i) % 2 == 0, 2, False).alias("null_bitmap"),
        pack(lambda k: (eid() * 7 + k * 3) % 5 < 2, 2, True).alias("signedness"),
        F.when(third, longs(8, 0, 45, 2, 63)).otherwise(nothing).alias("default_charset"),
        F.when(third, nothing).otherwise(longs(*range(33, 44))).alias("column_charset"),
        F.when(eid() % 5 != 0, F.transform(ints(n), lambda i: F.concat(F.lit("c"), i.cast("string"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("column_names"),
        constant(lambda k: labels(k, "s", "xyz")).alias("set_values"),
        constant(lambda k: labels(k, "e", "ab")).alias("enum_values"),
        longs(*range(1, 12)).alias("geometry_types"),
        F.when(keyed, longs(2, 0)).otherwise(nothing).alias("pk"),
        F.when(keyed, longs(0, 10)).otherwise(nothing).alias("pk_prefix"),
        F.when(third, nothing).otherwise(longs(9, 1, 48)).alias("enum_set_default_charset"),
        F.when(third, longs(*range(100, 111))).otherwise(nothing).alias("enum_set_column_charset"),
    )


def columns_of(spark, sf, flavor="mysql") -> DataFrame:
    found = catalog.column_catalog(table_maps(spark, sf), ["event_id"], flavor)
    return found.withColumn("labels", F.array_join("labels", ","))


def _oracle(columns: str, where: str = "true") -> str:
    return with_views(CATALOG, f"SELECT {columns} FROM map_catalog WHERE {where}")


@query(
    "column_catalog",
    _oracle('event_id, ordinal, type, meta, nullable, unsigned, name, "collation", labels, geometry, pk_ord, pk_prefix'),
)
def column_catalog(spark, sf):
    return columns_of(spark, sf).drop("real_type", "class")


@query(
    "column_catalog_join",
    with_views(CATALOG, "SELECT e.event_id, e.pk, m.ordinal, m.name, m.type, m.unsigned FROM (SELECT event_id, user_id AS pk, event_id - event_id % 4 AS map_id FROM events) e JOIN map_catalog m ON m.event_id = e.map_id AND m.ordinal = e.pk % 4"),
)
def column_catalog_join(spark, sf):
    cells = spread_table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("pk"),
        (eid() - eid() % 4).alias("map_id"),
        (F.col("user_id") % 4).alias("ordinal"),
    )
    known = columns_of(spark, sf).withColumnRenamed("event_id", "map_id")
    return catalog.join_catalog(cells, known, ["map_id"]).select(
        "event_id", "pk", "ordinal", "name", "type", "unsigned"
    )


@query("metadata_align", _oracle("event_id, ordinal, unsigned, labels", "class IN ('numeric', 'enum', 'set')"))
def metadata_align(spark, sf):
    return (
        columns_of(spark, sf)
        .filter(F.col("class").isin("numeric", "enum", "set"))
        .select("event_id", "ordinal", "unsigned", "labels")
    )


@query("collation_resolve", _oracle('event_id, ordinal, "collation"', '"collation" IS NOT NULL'))
def collation_resolve(spark, sf):
    found = columns_of(spark, sf).filter(F.col("collation").isNotNull())
    return found.select("event_id", "ordinal", "collation")


@query("geometry_types", _oracle("event_id, ordinal, geometry", "class = 'geometry'"))
def geometry_types(spark, sf):
    found = columns_of(spark, sf).filter(F.col("class") == "geometry")
    return found.select("event_id", "ordinal", "geometry")


@query(
    "column_class",
    with_views(CATALOG, """SELECT event_id, ordinal, class, CASE WHEN class = 'geometry' THEN 'character' ELSE class END AS mariadb_class FROM map_catalog"""),
)
def column_class(spark, sf):
    found = columns_of(spark, sf)
    other = col_fn.column_class(F.col("real_type"), "mariadb").alias("mariadb_class")
    return found.select("event_id", "ordinal", "class", other)


@query("real_type", _oracle("event_id, ordinal, real_type"))
def real_type(spark, sf):
    return columns_of(spark, sf).select("event_id", "ordinal", "real_type")


@query("nullable_flags", _oracle("event_id, ordinal, nullable"))
def nullable_flags(spark, sf):
    return columns_of(spark, sf).select("event_id", "ordinal", "nullable")


@query("column_names", _oracle("event_id, ordinal, coalesce(name, '@' || CAST(ordinal AS VARCHAR)) AS name"))
def column_names(spark, sf):
    label = catalog.column_label(F.col("name"), F.col("ordinal"))
    return columns_of(spark, sf).select("event_id", "ordinal", label.alias("name"))


@query(
    "primary_key_project",
    _oracle("event_id, pk_ord, ordinal, coalesce(name, '@' || CAST(ordinal AS VARCHAR)) AS name, pk_prefix", "pk_ord IS NOT NULL"),
)
def primary_key_project(spark, sf):
    return catalog.primary_key(columns_of(spark, sf), ["event_id"])


@query(
    "char_length_fold",
    _oracle("event_id, ordinal, meta, CASE WHEN meta = 238 * 256 + 40 THEN 40 + 256 ELSE 1 END AS len, CASE WHEN meta = 238 * 256 + 40 THEN 254 ELSE meta >> 8 END AS char_type", "type = 254"),
)
def char_length_fold(spark, sf):
    strings = columns_of(spark, sf).filter(F.col("type") == 254)
    return strings.select(
        "event_id",
        "ordinal",
        "meta",
        col_fn.char_length(F.col("meta")).alias("len"),
        col_fn.char_type(F.col("meta")).alias("char_type"),
    )


@query(
    "json_column_count",
    with_views(CATALOG, "SELECT event_id, count(*) FILTER (WHERE type = 245) AS json_columns FROM map_catalog GROUP BY event_id"),
)
def json_column_count(spark, sf):
    return catalog.json_column_count(columns_of(spark, sf), ["event_id"])


_YES = "CASE WHEN {0} IS NULL THEN '<n/a>' WHEN {0} THEN 'yes' ELSE 'no ' END"


@query(
    "column_report",
    _oracle(
        f"""event_id, ordinal, '  ' || coalesce(name, '<n/a>') || '  type=' || rpad(CAST(real_type AS VARCHAR), 3, ' ')
        || CASE WHEN class = 'numeric' THEN '  unsigned=' || {_YES.format("unsigned")} ELSE '' END
        || CASE WHEN class = 'character' THEN '  collation=' || CAST("collation" AS VARCHAR) || ' ' ELSE '' END
        || CASE WHEN class IN ('enum', 'set') THEN '  ' || class || '_collation=' || CAST("collation" AS VARCHAR) || '  ' || class || '=["' || replace(labels, ',', '", "') || '"]' ELSE '' END
        || CASE WHEN class = 'geometry' THEN '  geometry_type=' || CAST(geometry AS VARCHAR) ELSE '' END
        || '  null=' || {_YES.format("nullable")} || CASE WHEN pk_ord IS NOT NULL THEN '  pri' ELSE '' END AS line"""
    ),
)
def column_report(spark, sf):
    found = catalog.column_catalog(table_maps(spark, sf), ["event_id"])
    return catalog.column_report(found, ["event_id"])


# -- values --------------------------------------------------------------------

_LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("enum_label", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS label FROM orders")
def enum_label(spark, sf):
    labels = F.array(*[F.lit(x) for x in _LABELS])
    index = F.when(F.col("o_orderkey") % 7 > 0, F.array_position(labels, F.col("o_orderpriority"))).otherwise(0)
    return spread_table(spark, sf, "orders").select("o_orderkey", col_fn.enum_label(index, labels).alias("label"))


@query(
    "set_labels",
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 8 & 1 > 0 THEN 'red' END, CASE WHEN o_orderkey % 8 & 2 > 0 THEN 'green' END,
              CASE WHEN o_orderkey % 8 & 4 > 0 THEN 'blue' END) AS labels FROM orders""".replace("o_orderkey % 8 &", "(o_orderkey % 8) &"),
)
def set_labels(spark, sf):
    labels = F.array(F.lit("red"), F.lit("green"), F.lit("blue"))
    found = col_fn.set_labels(F.col("o_orderkey") % 8, labels)
    return spread_table(spark, sf, "orders").select("o_orderkey", F.array_join(found, ",").alias("labels"))


@query(
    "unsigned_fix",
    """SELECT event_id, CAST((event_id * 13) % 256 AS VARCHAR) AS tiny, CAST((event_id * 1009) % 16777216 AS VARCHAR) AS medium,
              CASE WHEN event_id = 0 THEN '0' ELSE CAST(18446744073709551616 - event_id AS VARCHAR) END AS big, CAST(-event_id AS VARCHAR) AS plain FROM events""",
)
def unsigned_fix(spark, sf):
    def wrapped(x, width):
        half, full = 1 << (8 * width - 1), 1 << (8 * width)
        return F.when(x >= half, x - full).otherwise(x)

    yes = F.lit(True)
    fix = lambda value, width, unsigned=yes: col_fn.fix_unsigned(value, F.lit(width), unsigned).cast("string")
    return spread_table(spark, sf, "events").select(
        "event_id",
        fix(wrapped((eid() * 13) % 256, 1), 1).alias("tiny"),
        fix(wrapped((eid() * 1009) % 16777216, 3), 3).alias("medium"),
        fix(-eid(), 8).alias("big"),
        fix(-eid(), 8, F.lit(False)).alias("plain"),
    )


@query(
    "typed_table_view",
    with_views("change_log", """SELECT seq, pk, op, value, CAST(json_extract_string(props, '$.k') AS INT) AS k, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM change_log"""),
)
def typed_table_view(spark, sf):
    # Rendered values in a map, as row_changes carries them, typed again by a column spec.
    rendered = F.map_from_arrays(
        F.array(F.lit("value"), F.lit("k"), F.lit("at")),
        F.array(
            F.col("value").cast("string"),
            F.get_json_object("props", "$.k"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        ),
    )
    log = v.change_log(spark, sf).select("seq", "pk", "op", rendered.alias("after"))
    typed = changes.typed_view(log, {"value": "double", "k": "int", "at": "timestamp_ntz"})
    return typed.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
