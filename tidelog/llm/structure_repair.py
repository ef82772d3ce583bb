"""Repair of conversation structure by a dynamic programme over persistent audits.

A conversation's rows are kept, given another role, deleted, or joined by empty inserted
turns so that the initials of the roles read ``(s?(ua)+)?``, at the least cost; of equally
cheap ways the one whose audit (the initials of its edits) comes first is taken.

**Audits.** The programme keeps, for each state of the grammar, the best audit that leads to
it. Audits are linked nodes: a row adds nodes to prefixes that all states share. Each
node has its depth, a rolling hash of the text so far and its ancestors 1, 2, 4, ... steps up, so
two audits of one cost are compared by a search for their longest common prefix in
logarithmic time. Nodes are interned within a row: equal prefixes are one node, so
where the hashes have led is verified by identity, and a collision falls back to a
search by identity. Nodes no state leads to are dropped from time to time.

**Spark.** The first pass needs no texts: rows of a few bytes are sorted per conversation and
streamed; it holds one code per row of one conversation and gives the audit. The second
streams the texts behind their audit and hashes the repaired conversation on the way. A
hash over a conversation is sequential by nature; memory is that of its audit.

Order: by turn (null first), then role, then a digest of role and text. Null roles and texts are one
space. Roles with other initials, empty ones too, can't be kept. Null conversation ids are one conversation. Repeated rows are duplicates. A conversation without rows is whole (zeros,
empty audit). An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_type, source
from tidelog.llm.prefix_trie import CRC_TABLE, crc_sql, turn_digest

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
SPACE = " \t\n\v\f\r"
#: Hash of a prefix: times BASE plus the letter, modulo a prime.
BASE, PRIME = 1_000_003, (1 << 61) - 1
#: Rows after which nodes out of use are dropped.
PRUNE = 1 << 14
#: Audits of conversations up to so many rows are remembered by their codes.
SHORT, KNOWN = 32, 1 << 16

FAULTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = f"{FAULTS}, repaired_sha256 string"


class Audits:
    """Edit prefixes as linked nodes; node 0 is the empty one."""

    def __init__(self, prime: int = PRIME):
        self.prime, self.collisions = prime, 0
        self.letter, self.depth, self.hash, self.up, self.row = [""], [0], [0], [()], {}

    def add(self, node: int, letter: str) -> int:
        known = self.row.get((node, letter))
        if known is None:
            known = self.row[node, letter] = len(self.letter)
            ups = [node]
            while len(self.up[ups[-1]]) >= len(ups):
                ups.append(self.up[ups[-1]][len(ups) - 1])
            self.letter.append(letter)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * BASE + ord(letter)) % self.prime)
            self.up.append(tuple(ups))
        return known

    def at(self, node: int, depth: int) -> int:
        """The prefix of ``depth`` letters."""
        over = self.depth[node] - depth
        while over:
            step = over.bit_length() - 1
            node = self.up[node][step]
            over -= 1 << step
        return node

    def _differ(self, a: int, b: int, name) -> tuple[int, int]:
        """The first prefixes of two different audits of one depth whose names differ."""
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and name(self.up[a][k]) != name(self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return a, b

    def before(self, a: int, b: int) -> bool:
        """Whether audit a comes before audit b."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.at(a, depth), self.at(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        if self.hash[x] != self.hash[y]:
            p, q = self._differ(x, y, self.hash.__getitem__)
            if self.up[p][0] == self.up[q][0]:
                return self.letter[p] < self.letter[q]
        self.collisions += 1
        p, q = self._differ(x, y, int)
        return self.letter[p] < self.letter[q]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def prune(self, live: list[int]) -> dict[int, int]:
        """Drops all but the prefixes of ``live``; gives the new numbers of what stays."""
        stay = {0}
        for node in live:
            while node not in stay:
                stay.add(node)
                node = self.up[node][0]
        order = sorted(stay)
        new = {node: k for k, node in enumerate(order)}
        self.letter, self.depth, self.hash = ([v[n] for n in order] for v in (self.letter, self.depth, self.hash))
        self.up = [tuple(new[u] for u in self.up[n]) for n in order]
        self.row = {}
        return new


# One letter per row: its role's initial, upper case if cut off; "-" if it has to go.
Best = tuple[int, int] | None


def solve(codes: str, audits: Audits | None = None, prune: int = PRUNE) -> tuple[int, str]:
    """Least cost and its first audit. States: nothing yet, after s, after u, after a."""
    audits = audits or Audits()

    def best(*ways: tuple[Best, int, str]) -> Best:
        found, how = None, ""
        for way, cost, letter in ways:
            if way is not None:
                cost += way[0]
                if found is None or cost < found[0]:
                    found, how = (cost, way[1]), letter
                elif cost == found[0]:
                    a, b = (audits.add(n, x) if x else n for n, x in ((way[1], letter), (found[1], how)))
                    if audits.before(a, b):
                        found, how = (cost, a), ""
                    else:
                        found, how = (cost, b), ""
        return (found[0], audits.add(found[1], how)) if how else found

    def inserted(none: Best, s: Best, u: Best, a: Best) -> tuple[Best, ...]:
        u = best((u, 0, ""), (none, INSERT, "I"), (s, INSERT, "I"), (a, INSERT, "I"))
        return none, s, u, best((a, 0, ""), (u, INSERT, "I"))

    state: tuple[Best, ...] = ((0, 0), None, None, None)
    for k, code in enumerate(codes):
        audits.row.clear()
        none, s, u, a = inserted(*state)
        initial, cut = code.lower(), CUT_OFF * code.isupper()
        to_s, to_u, to_a = [(s, DELETE, "D")], [(u, DELETE, "D")], [(a, DELETE, "D")]
        if code != "-":
            to_s += [(none, KEEP + cut, "K")] if initial == "s" else []
            for how, cost, roles in (("K", KEEP + cut, initial), ("R", REROLE + cut, "ua")):
                to_u += [(x, cost, how) for x in (none, s, a)] if "u" in roles else []
                to_a += [(u, cost, how)] if "a" in roles else []
        state = best((none, DELETE, "D")), best(*to_s), best(*to_u), best(*to_a)
        if (k + 1) % prune == 0:
            new = audits.prune([b[1] for b in state if b])
            state = tuple(b and (b[0], new[b[1]]) for b in state)
    audits.row.clear()
    none, _, _, a = inserted(*state)
    cost, node = best((none, 0, ""), (a, 0, ""))
    return cost, audits.text(node)


@lru_cache(maxsize=KNOWN)
def _solve_short(codes: str) -> tuple[int, str]:
    return solve(codes)


def audit_of(codes: str) -> tuple[int, str]:
    return _solve_short(codes) if len(codes) <= SHORT else solve(codes)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, name) with nulls as one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    return rows.withColumn("name", turn_digest(F.col("role"), F.col("text")))


def faults(turns: DataFrame) -> DataFrame:
    """``turns`` with ``code``, ``fault`` (b, d, t or null) and ``seen``, equal rows so far; no texts."""
    whole = F.rtrim("text", F.lit(SPACE))
    rows = turns.select(
        "conv", "turn", "role", "name", (whole == "").alias("blank"), (~F.right(whole, F.lit(1)).isin(".", "!", "?")).alias("cut")
    )
    # The window asks for (conv, name) together, which rows dealt by conv are already.
    along = Window.partitionBy("conv", "name").orderBy("turn")
    rows = rows.repartition("conv").withColumn("seen", F.row_number().over(along))
    fault = F.when(F.col("blank"), "b").when(F.col("seen") > 1, "d").when(F.col("cut"), "t")
    first = F.left("role", F.lit(1))
    code = F.when(first.isin("s", "u", "a"), first).otherwise("x")
    rows = rows.withColumns({"fault": fault, "first": first})
    return rows.select(
        "conv", "turn", "role", "name", "seen", "fault", "first",
        F.when(F.col("fault").isin("b", "d"), "-").when(F.col("fault") == "t", F.upper(code)).otherwise(code).alias("code"),
    )


class _Conversation:
    def __init__(self, conv):
        self.conv, self.codes, self.last = conv, [], None
        self.low = self.high = self.turn = None
        self.distinct = self.illegal = 0
        self.found = {"b": 0, "d": 0, "t": 0}

    def add(self, turn, fault, first, code) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.distinct += turn != self.turn
            self.high = self.turn = turn
        if fault:
            self.found[fault] += 1
        if self.last is not None:
            self.illegal += self.last + first not in ("su", "ua", "au")
        self.last = first
        self.codes.append(code)

    def close(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, *self.found.values(), self.illegal, *audit_of("".join(self.codes)))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, now = arrow_type(FAULTS), None
    for batch in batches:
        out = []
        for conv, top, turn, fault, first, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if top:
                if now is not None:
                    out.append(now.close())
                now = _Conversation(conv)
            else:
                now.add(turn, fault, first, code)
        if out:
            yield _batch(out, schema)
    if now is not None:
        yield _batch([now.close()], schema)


def audits(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per id of ``conversations``: faults, cost and audit of its rows in ``turns``."""
    tops = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.lit(True).alias("top")).distinct()
    rows = faults(turns).withColumn("top", F.lit(False)).unionByName(tops, allowMissingColumns=True)
    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.desc("top"), "turn", "role", "name", "seen")
    return ordered.select("conv", "top", "turn", "fault", "first", "code").mapInArrow(_audit, FAULTS)


class Replay:
    """A conversation repaired by its audit, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, ""

    def _next(self) -> str:
        role = "assistant" if self.state == "u" else "user"
        self.state = role[0]
        return role

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._next(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = role[0]
            yield role, text
        elif edit == "R":
            yield self._next(), text


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, head, replay, digest, begun = arrow_type(REPAIRED), None, None, None, False

    def take(turns):
        nonlocal begun
        for role, text in turns:
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True

    def close():
        take(replay.inserts())
        return (*head, digest.hexdigest())

    for batch in batches:
        out = []
        for role, text, *stats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if stats[-1] is not None:
                if head is not None:
                    out.append(close())
                head, replay, digest, begun = stats, Replay(stats[-1]), hashlib.sha256(), False
            else:
                take(replay.row(role, text))
        if out:
            yield _batch(out, schema)
    if head is not None:
        yield _batch([close()], schema)


def repair(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per id of ``conversations``: what is wrong with its rows in ``turns``, the cheapest audit, the digest of the repair."""
    names = [c.split()[0] for c in FAULTS.split(", ")]
    found = audits(turns, conversations).withColumn("conv", F.col("conv_id"))
    rows = turns.unionByName(found, allowMissingColumns=True).repartition("conv")
    ordered = rows.sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "role", "name")
    return ordered.select("role", "text", *names).mapInArrow(_repair, REPAIRED)


def repaired_turns(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations themselves."""

    def write(batches):
        schema, replay, conv, place = arrow_type("conv_id long, place long, role string, text string"), None, None, 0
        for batch in batches:
            out = []
            for role, text, own, audit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = replay.inserts() if replay and audit is not None else ()
                if audit is None:
                    made = replay.row(role, text)
                for r, t in made:
                    out.append((conv, place, r, t))
                    place += 1
                if audit is not None:
                    replay, conv, place = Replay(audit), own, 0
            if out:
                yield _batch(out, schema)
        rest = [(conv, place + k, r, t) for k, (r, t) in enumerate(replay.inserts())] if replay else []
        if rest:
            yield _batch(rest, schema)

    found = audits(turns, conversations).select(F.col("conv_id").alias("conv"), "audit")
    rows = turns.unionByName(found, allowMissingColumns=True).repartition("conv")
    ordered = rows.sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "role", "name")
    return ordered.select("role", "text", "conv", "audit").mapInArrow(write, "conv_id long, place long, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, robbed of their points, repeated or given to the user, by a checksum of their place."""
    where = F.concat_ws(":", *(F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(where) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).filter("fault <> 0")
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role").cast("string")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(turns_of(damaged(rows)), rows)


def _way(state: str, cost: int, letter: str, turn: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {turn}}}"


def _ways(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _edits(target: str, sources: tuple[str, ...], initial: str, role: str, same: str = "") -> str:
    """Best way into a state: delete there, keep a row of the initial, or give it the role."""
    kept = "chr(10) || role || ':' || text"
    ways = [_way(same or target, 3, "D")]
    for s in sources:
        keep, rerole = _way(s, 0, "K", kept), _way(s, 2, "R", f"chr(10) || '{role}:' || text")
        for way, when in ((keep, f"first = '{initial}'"), *(((rerole, "true"),) if role else ())):
            ways.append(f"CASE WHEN NOT gone AND {when} THEN {way.replace('.c + ', '.c + cut + ')} ELSE {_BIG} END")
    return _ways(*ways)


_BIG = "{'c': 1000000000, 'a': '~', 'r': ''}"

#: The same by a recursive query that carries whole audits and repaired texts.
OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations
),
coded AS (SELECT raw.*, {crc_sql("place")} % 20 AS fault FROM raw, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded WHERE fault <> 0)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body
  FROM hurt
),
told AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS first, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior,
    CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM placed
),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
    count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE prior IS NOT NULL AND prior || first NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM told GROUP BY conv_id
),
ids AS (SELECT DISTINCT conv_id FROM conversations),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': ''}} AS d0, {_BIG} AS d1, {_BIG} AS d2, {_BIG} AS d3 FROM ids
  UNION ALL
  SELECT conv_id, i, {_way("d0", 3, "D")}, {_edits("d1", ("d0",), "s", "")}, {_edits("e2", ("d0", "d1", "e3"), "u", "user")},
    {_edits("e3", ("e2",), "a", "assistant")}
  FROM (
    SELECT *, {_ways("d3", _way("e2", 2, "I", "chr(10) || 'assistant:'"))} AS e3
    FROM (
      SELECT s.conv_id, t.i, d0, d1, d3, role, text, first, fault IN ('b', 'd') AS gone, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut,
        {_ways("d2", *(_way(d, 2, "I", "chr(10) || 'user:'") for d in ("d0", "d1", "d3")))} AS e2
      FROM steps s JOIN told t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i + 1
    )
  )
),
ended AS (
  SELECT conv_id, {_ways("d0", "d3", _way("d2", 2, "I", "chr(10) || 'assistant:'"),
    *(_way(d, 4, "II", "chr(10) || 'user:' || chr(10) || 'assistant:'") for d in ("d0", "d1", "d3")))} AS b
  FROM steps s
  WHERE i = coalesce((SELECT n FROM sums u WHERE u.conv_id IS NOT DISTINCT FROM s.conv_id), 0)
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.b.c::BIGINT AS cost, e.b.a AS audit,
  sha256(substr(e.b.r, 2)) AS repaired_sha256
FROM ended e LEFT JOIN sums u ON u.conv_id IS NOT DISTINCT FROM e.conv_id
"""
