"""GTID set queries (MySQL and MariaDB)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import gtid, mariadb
from tidelog.plans import views as v
from tidelog.plans.registry import query
from tidelog.plans.views import with_views

# Reading of single gnos as the oracle of every set: islands are rebuilt from
# the gnos that are left, so it shares no logic with the interval operators.


def _islands(members: str, keys: str = "sid") -> str:
    return f"""
SELECT {keys}, min(gno) AS start, max(gno) + 1 AS stop
FROM (SELECT {keys}, gno, gno - row_number() OVER (PARTITION BY {keys} ORDER BY gno) AS run
      FROM (SELECT DISTINCT {keys}, gno FROM {members}))
GROUP BY {keys}, run"""


def _executed(gtids, view):
    return gtid.executed_set(view(gtids).select("sid", "gno"))


def _both(spark, sf):
    gtids = v.gtids_all(spark, sf)
    return _executed(gtids, v.gtids_mysql), _executed(gtids, v.gtids_mysql_b)


@query("gtid_executed_set", with_views("gtids_all gtids_mysql", _islands("gtids_mysql")))
def executed_set(spark, sf):
    return _executed(v.gtids_all(spark, sf), v.gtids_mysql)


@query(
    "gtid_normalize",
    with_views("gtids_all", """
, iv AS (SELECT sid, gno * 3 AS start, gno * 3 + 1 + (event_id % 7) AS stop FROM gtids_all),
m AS (SELECT *, max(stop) OVER (PARTITION BY sid ORDER BY start, stop
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END)
          OVER (PARTITION BY sid ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS grp FROM m)
SELECT sid, min(start) AS start, max(stop) AS stop FROM g GROUP BY sid, grp"""),
)
def normalize(spark, sf):
    start = F.col("gno") * 3
    raw = v.gtids_all(spark, sf).select(
        "sid", start.alias("start"), (start + 1 + F.col("event_id") % 7).alias("stop")
    )
    return gtid.normalize(raw)


@query(
    "gtid_union",
    with_views(
        "gtids_all gtids_mysql gtids_mysql_b",
        _islands("(SELECT sid, gno FROM gtids_mysql UNION SELECT sid, gno FROM gtids_mysql_b)"),
    ),
)
def union(spark, sf):
    return gtid.union_sets(*_both(spark, sf))


@query(
    "gtid_minus",
    with_views(
        "gtids_all gtids_mysql gtids_mysql_b",
        _islands("(SELECT sid, gno FROM gtids_mysql EXCEPT SELECT sid, gno FROM gtids_mysql_b)"),
    ),
)
def minus(spark, sf):
    return gtid.subtract_sets(
        *_both(spark, sf)
    )


@query(
    "gtid_intersect",
    with_views(
        "gtids_all gtids_mysql gtids_mysql_b",
        _islands("(SELECT sid, gno FROM gtids_mysql INTERSECT SELECT sid, gno FROM gtids_mysql_b)"),
    ),
)
def intersect(spark, sf):
    return gtid.intersect_sets(
        *_both(spark, sf)
    )


_CHUNKS = "gtids_all gtids_mysql chunk_a chunk_b"
_VERDICT = """
, d AS (
  SELECT coalesce(a.set_id, b.set_id) AS set_id,
         count(*) FILTER (WHERE b.gno IS NULL) AS only_a,
         count(*) FILTER (WHERE a.gno IS NULL) AS only_b
  FROM chunk_a a FULL OUTER JOIN chunk_b b
    ON a.set_id = b.set_id AND a.sid = b.sid AND a.gno = b.gno
  GROUP BY 1)
"""


def _chunks(spark, sf):
    gtids = v.gtids_all(spark, sf)
    return gtid.executed_set(v.chunk_a(gtids)), gtid.executed_set(v.chunk_b(gtids))


@query("gtid_contains", with_views(_CHUNKS, _VERDICT + " SELECT set_id, only_b = 0 AS contains FROM d"))
def contains(spark, sf):
    return gtid.contains_sets(*_chunks(spark, sf))


@query(
    "gtid_equal",
    with_views(_CHUNKS, _VERDICT + ' SELECT set_id, only_a = 0 AND only_b = 0 AS "equal" FROM d'),
)
def equal(spark, sf):
    return gtid.equal_sets(*_chunks(spark, sf))


@query(
    "gtid_compare",
    with_views(
        _CHUNKS,
        _VERDICT
        + """ SELECT set_id, CASE WHEN only_a = 0 AND only_b = 0 THEN 0
                     WHEN only_b = 0 THEN 1 ELSE -1 END AS cmp FROM d""",
    ),
)
def compare(spark, sf):
    return gtid.compare_sets(*_chunks(spark, sf))


@query(
    "gtid_member_semi",
    with_views(
        "gtids_all gtids_mysql_b",
        """SELECT event_id, sid, gno FROM gtids_all a
           WHERE EXISTS (SELECT 1 FROM gtids_mysql_b b WHERE a.sid = b.sid AND a.gno = b.gno)""",
    ),
)
def member_semi(spark, sf):
    gtids = v.gtids_all(spark, sf)
    return gtid.in_set(gtids, _executed(gtids, v.gtids_mysql_b))


@query(
    "gtid_missing_anti",
    with_views(
        "gtids_all gtids_mysql_b",
        """SELECT event_id, sid, gno FROM gtids_all a
           WHERE NOT EXISTS (SELECT 1 FROM gtids_mysql_b b WHERE a.sid = b.sid AND a.gno = b.gno)""",
    ),
)
def missing_anti(spark, sf):
    gtids = v.gtids_all(spark, sf)
    return gtid.not_in_set(gtids, _executed(gtids, v.gtids_mysql_b))


@query(
    "gtid_gaps",
    with_views(
        "gtids_all gtids_mysql",
        """, n AS (SELECT sid, gno, lead(gno) OVER (PARTITION BY sid ORDER BY gno) AS nx FROM gtids_mysql)
        SELECT sid, gno + 1 AS gap_start, nx AS gap_stop FROM n WHERE nx > gno + 1""",
    ),
)
def gaps(spark, sf):
    return gtid.gaps(_executed(v.gtids_all(spark, sf), v.gtids_mysql))


@query(
    "gtid_set_len",
    with_views(
        "gtids_all gtids_mysql chunk_a",
        f""", i AS ({_islands("chunk_a", "set_id, sid")})
        SELECT set_id, count(DISTINCT sid) AS sids, count(*) AS intervals,
               CAST(sum(stop - start) AS BIGINT) AS transactions FROM i GROUP BY set_id""",
    ),
)
def set_len(spark, sf):
    return gtid.set_sizes(gtid.executed_set(v.chunk_a(v.gtids_all(spark, sf))))


_TEXT = f""", i AS ({_islands("chunk_a", "set_id, sid")}),
t AS (SELECT set_id, sid, string_agg(CASE WHEN stop = start + 1 THEN CAST(start AS VARCHAR)
          ELSE CAST(start AS VARCHAR) || '-' || CAST(stop - 1 AS VARCHAR) END, ':' ORDER BY start) AS body
      FROM i GROUP BY set_id, sid)
SELECT set_id, string_agg(sid || ':' || body, ',' ORDER BY sid || ':' || body) AS gtid_set FROM t GROUP BY set_id"""


@query("gtid_set_to_text", with_views("gtids_all gtids_mysql chunk_a", _TEXT))
def set_to_text(spark, sf):
    return gtid.gtid_set_text(gtid.executed_set(v.chunk_a(v.gtids_all(spark, sf))))


@query(
    "gtid_set_lines",
    with_views(
        "gtids_all gtids_mysql",
        f""", i AS ({_islands("gtids_mysql")}),
        n AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY sid ORDER BY start) - 1) / 64) AS BIGINT) AS line_no FROM i)
        SELECT sid, line_no, sid || ':' || string_agg(CASE WHEN stop = start + 1 THEN CAST(start AS VARCHAR)
          ELSE CAST(start AS VARCHAR) || '-' || CAST(stop - 1 AS VARCHAR) END, ':' ORDER BY start) AS line
        FROM n GROUP BY sid, line_no""",
    ),
)
def set_lines(spark, sf):
    return gtid.gtid_set_lines(_executed(v.gtids_all(spark, sf), v.gtids_mysql), per_line=64)


@query(
    "gtid_parse",
    with_views(
        "gtids_all",
        """SELECT event_id, sid, gno AS start, CASE WHEN event_id % 4 = 1 THEN gno + 6 ELSE gno + 1 END AS stop,
                  CAST(NULL AS VARCHAR) AS error FROM gtids_all WHERE event_id % 4 <> 3
           UNION ALL SELECT event_id, sid, gno + 10, gno + 13, NULL FROM gtids_all WHERE event_id % 4 = 2
           UNION ALL SELECT event_id, NULL, NULL, NULL, 'end before start' FROM gtids_all WHERE event_id % 4 = 3
           UNION ALL SELECT event_id, sid, 7, 8, NULL FROM gtids_all WHERE event_id % 5 = 0""",
    ),
)
def parse(spark, sf):
    gno, kind = F.col("gno"), F.col("event_id") % 4
    s = lambda c: c.cast("string")
    tail = (
        F.when(kind == 0, "")
        .when(kind == 1, F.concat(F.lit("-"), s(gno + 5)))
        .when(kind == 2, F.concat(F.lit(":"), s(gno + 10), F.lit("-"), s(gno + 12)))
        .otherwise(F.concat(F.lit("-"), s(gno - 1)))
    )
    extra = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(", "), "sid", F.lit(":7"))).otherwise("")
    text = F.concat(F.upper("sid"), F.lit(":"), s(gno), tail, extra)
    texts = v.gtids_all(spark, sf).select("event_id", text.alias("txt"))
    return gtid.parse_gtid_sets(texts, "txt")


# -- order-dependent set state ------------------------------------------------

_ASOF = """, r AS (
  SELECT event_id, sid, gno, count(*) OVER w AS executed, max(gno) OVER w AS high_gno
  FROM gtids_mysql WINDOW w AS (PARTITION BY sid ORDER BY event_id ROWS UNBOUNDED PRECEDING))
"""


@query(
    "executed_asof_commit",
    with_views(
        "gtids_all gtids_mysql",
        _ASOF + "SELECT *, executed = high_gno AS contiguous FROM r",
    ),
)
def executed_asof(spark, sf):
    return gtid.executed_as_of(v.gtids_mysql(v.gtids_all(spark, sf)), [], "event_id")


@query(
    "resume_prev_set",
    with_views(
        "gtids_all gtids_mysql",
        _ASOF + """SELECT event_id, sid, gno, lag(executed) OVER p AS prev_executed,
                lag(high_gno) OVER p AS prev_high_gno FROM r
                WINDOW p AS (PARTITION BY sid ORDER BY event_id)""",
    ),
)
def resume_prev(spark, sf):
    points = gtid.resume_points(v.gtids_mysql(v.gtids_all(spark, sf)), [], "event_id")
    return points.select("event_id", "sid", "gno", "prev_executed", "prev_high_gno")


# -- MariaDB ------------------------------------------------------------------


@query(
    "mariadb_fold",
    with_views(
        "gtids_mariadb",
        """SELECT domain_id, server_id, seq FROM gtids_mariadb
           QUALIFY row_number() OVER (PARTITION BY domain_id ORDER BY event_id DESC) = 1""",
    ),
)
def fold(spark, sf):
    return mariadb.mariadb_fold(v.gtids_mariadb(spark, sf), "event_id")


@query(
    "mariadb_out_of_order",
    with_views(
        "gtids_mariadb",
        """, l AS (SELECT *, lag(seq) OVER (PARTITION BY domain_id ORDER BY event_id) AS prev_seq FROM gtids_mariadb)
        SELECT event_id, domain_id, server_id, seq, prev_seq FROM l WHERE seq <= prev_seq""",
    ),
)
def out_of_order(spark, sf):
    return mariadb.mariadb_out_of_order(v.gtids_mariadb(spark, sf), "event_id")


_MSETS = """, s AS (SELECT CAST(floor(event_id / 50) AS BIGINT) AS set_id, * FROM gtids_mariadb),
a AS (SELECT set_id, domain_id, server_id, seq FROM s
      QUALIFY row_number() OVER (PARTITION BY set_id, domain_id ORDER BY event_id DESC) = 1),
b AS (SELECT set_id, domain_id, server_id, seq FROM s WHERE event_id % 50 < 40 OR set_id % 2 = 0
      QUALIFY row_number() OVER (PARTITION BY set_id, domain_id ORDER BY event_id DESC) = 1)
"""


def _msets(spark, sf):
    s = v.gtids_mariadb(spark, sf).withColumn("set_id", v.div("event_id", 50))
    early = s.filter((F.col("event_id") % 50 < 40) | (F.col("set_id") % 2 == 0))
    fold = lambda df: mariadb.mariadb_fold(df, "event_id", ["set_id"])
    return fold(s), fold(early)


@query(
    "mariadb_contains",
    with_views(
        "gtids_mariadb",
        _MSETS + """SELECT a.set_id, bool_and(b.seq IS NOT NULL AND b.seq >= a.seq) AS contains
        FROM a LEFT JOIN b USING (set_id, domain_id) GROUP BY a.set_id""",
    ),
)
def m_contains(spark, sf):
    a, b = _msets(spark, sf)
    return mariadb.mariadb_contains(b, a, ["set_id"])


@query(
    "mariadb_equal",
    with_views(
        "gtids_mariadb",
        _MSETS + """SELECT set_id, bool_and(coalesce(a.server_id = b.server_id AND a.seq = b.seq, false)) AS "equal"
        FROM a FULL JOIN b USING (set_id, domain_id) GROUP BY set_id""",
    ),
)
def m_equal(spark, sf):
    return mariadb.mariadb_equal(*_msets(spark, sf), ["set_id"])


@query(
    "mariadb_set_to_text",
    with_views(
        "gtids_mariadb",
        _MSETS + """, t AS (SELECT set_id, domain_id || '-' || server_id || '-' || seq AS g FROM a)
        SELECT set_id, string_agg(g, ',' ORDER BY g) AS gtid_set FROM t GROUP BY set_id""",
    ),
)
def m_text(spark, sf):
    return mariadb.mariadb_set_text(_msets(spark, sf)[0], ["set_id"])


@query(
    "mariadb_parse",
    with_views(
        "gtids_mariadb",
        """SELECT event_id, 0 AS ordinal, CASE WHEN event_id % 9 <> 4 THEN domain_id END AS domain_id,
             CASE WHEN event_id % 9 <> 4 THEN server_id END AS server_id,
             CASE WHEN event_id % 9 <> 4 THEN CAST(abs(seq) AS VARCHAR) END AS seq,
             CASE WHEN event_id % 9 = 4 THEN 'not domain-server-sequence' END AS error FROM gtids_mariadb
           UNION ALL SELECT event_id, 1, 0, 0, '0', NULL FROM gtids_mariadb WHERE event_id % 4 = 1""",
    ),
)
def m_parse(spark, sf):
    eid = F.col("event_id")
    text = F.concat(
        F.concat_ws("-", "domain_id", "server_id", F.abs("seq")),
        F.when(eid % 9 == 4, "-1").otherwise(""),
        F.when(eid % 4 == 1, ",").otherwise(""),
    )
    texts = v.gtids_mariadb(spark, sf).select("event_id", text.alias("txt"))
    return mariadb.parse_mariadb_gtids(texts, "txt").withColumn("seq", F.col("seq").cast("string"))
