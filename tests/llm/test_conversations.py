"""Structure repair and prefix trie against brute force, ties and odd rows included."""

import hashlib
import itertools
import random
import zlib

import pytest
from compare import canonical, oracle_rows

from tidelog.llm import prefix_trie, structure_repair
from tidelog.llm.common import source

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, node string, audit string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def name_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def cheapest(codes):
    """Dijkstra over (rows done, state) with whole audits as they are."""
    import heapq

    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, state = heapq.heappop(heap)
        if (k, state) in seen:
            continue
        seen.add((k, state))
        if k == len(codes) and state in ("", "a"):
            return cost, audit
        if state == "u":
            heapq.heappush(heap, (cost + 2, audit + "I", k, "a"))
        else:
            heapq.heappush(heap, (cost + 2, audit + "I", k, "u"))
        if k < len(codes):
            c, cut = codes[k].lower(), codes[k].isupper()
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, state))
            if c == "-":
                continue
            for to in ("s", "u", "a"):
                if to == "s" and state != "" or to == "u" and state == "u" or to == "a" and state != "u":
                    continue
                if c == to:
                    heapq.heappush(heap, (cost + cut, audit + "K", k + 1, to))
                if to != "s":
                    heapq.heappush(heap, (cost + 2 + cut, audit + "R", k + 1, to))


def test_every_short_conversation_has_its_cheapest_first_audit():
    for n in range(5):
        for codes in itertools.product("suax-SUAX", repeat=n):
            assert structure_repair.solve("".join(codes)) == cheapest(codes), codes


@pytest.mark.parametrize("prime", [3, (1 << 61) - 1])
def test_long_conversations_colliding_hashes_and_pruning(prime):
    some = random.Random(prime)
    for n in (40, 200, 700):
        for letters in ("ua", "u", "suax-SUAX", "sx", "-"):
            codes = "".join(some.choices(letters, k=n))
            audits = structure_repair.Audits(prime)
            assert structure_repair.solve(codes, audits, prune=16) == cheapest(codes)
            assert len(audits.letter) <= 8 * n + 20
    if prime == 3:
        audits = structure_repair.Audits(prime)
        structure_repair.solve("u" * 300, audits)
        assert audits.collisions > 0


def test_prefix_search_by_lifting():
    audits, some = structure_repair.Audits(), random.Random(1)
    nodes = [0]
    for _ in range(3000):
        nodes.append(audits.add(some.choice(nodes[-40:]), some.choice("DIKR")))
    for _ in range(3000):
        a, b = some.choice(nodes), some.choice(nodes)
        x, y = audits.text(a), audits.text(b)
        assert audits.at(a, len(x) // 2) in range(len(audits.letter)) and audits.text(audits.at(a, len(x) // 2)) == x[: len(x) // 2]
        if x != y:
            audits.row.clear()
            assert audits.before(a, b) == (x < y)


def repaired(rows, ids):
    """What the contract asks for, row by row."""
    out = {}
    for conv in ids:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), name_of(r[1], r[2])))
        seen, codes, counts = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, role, text in mine:
            body = text.rstrip(" \t\n\v\f\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            code = role[:1] if role[:1] and role[:1] in "sua" else "x"
            codes.append("-" if fault in ("b", "d") else code.upper() if fault else code)
        cost, audit = cheapest("".join(codes))
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        made, k, state = [], 0, ""
        for edit in audit:
            new = "assistant" if state == "u" else "user"
            if edit == "I":
                made.append(f"{new}:")
                state = new[0]
                continue
            _, role, text = mine[k]
            k += 1
            if edit == "K":
                made.append(f"{role}:{text}")
                state = role[0]
            elif edit == "R":
                made.append(f"{new}:{text}")
                state = new[0]
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        if fault == 1:
            text = ""
        elif fault == 2:
            text = text.translate(dict.fromkeys(map(ord, ".!?")))
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def odd_rows():
    some = random.Random(11)
    texts = ["Yes.", "No!", "why", " ", "", None, "a\x1c", "End. \t\n", "Ü?", "\xa0", "x" * 50_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(-3, 60), 10**15]:
        for _ in range(some.randint(1, 9)):
            rows.append((conv, some.choice([None, 0, 1, 2, 3, 7]), some.choice(roles[: some.choice([2, 7])]), some.choice(texts)))
    return rows + some.sample(rows, 20) + [(99, t, "user", f"m{t}.") for t in range(400)]


def test_repair_against_brute_force(spark):
    rows = odd_rows()
    table = conversations(spark, rows)
    hurt = structure_repair.damaged(table)
    assert sorted(map(repr, map(tuple, hurt.select("conv_id", "turn", "role", "text").collect()))) == sorted(map(repr, damage(rows)))
    turns = structure_repair.turns_of(hurt)
    got = {r[0]: tuple(r[1:]) for r in structure_repair.repair(turns, table).collect()}
    assert got == repaired(damage(rows), {r[0] for r in rows})
    written = {}
    for r in structure_repair.repaired_turns(turns, table).orderBy("place").collect():
        written.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(written.get(c, [])).encode()).hexdigest() for c in got} == {c: r[-1] for c, r in got.items()}
    assert structure_repair.repair(turns.limit(0), table.limit(0)).count() == 0
    alone = structure_repair.repair(turns.limit(0), table.filter("conv_id = 1")).collect()
    assert [tuple(r) for r in alone] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def nodes_of(rows):
    """The trie by walking every prefix of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", name_of(role or "", text or ""), text or ""))
    for conv in own:
        own[conv] = [(r[2], r[4]) for r in sorted(own[conv])]
    whole = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        whole[conv] = tuple(own.get(base, [])[:h] + own[conv][h:])
    members = {}
    for conv, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(conv)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) == len(n) + 1 for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in own if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_of(table, batch="7"):
    spark = table.sparkSession
    source(spark, SF, "labels")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    turns = prefix_trie.short_turns(table)
    return prefix_trie.trie(prefix_trie.prefixes(prefix_trie.rebuilt(turns)).cache())


def test_trie_against_brute_force(spark):
    some = random.Random(12)
    rows = []
    for conv in [None, *range(0, 40), *range(100, 130), 250, 251, -1, -205, 10**15, 10**15 + 3]:
        for turn in range(some.choice([1, 2, 3, 8])):
            rows.append((conv, some.choice([turn, turn, None]), some.choice(["u", "a", None]), some.choice(["é", "bb", "", None, "x" * 9000])))
    rows += some.sample(rows, 15)
    rows += [(c, t, "user", "same") for c in range(300, 330) for t in range(7)]
    table = conversations(spark, rows)
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted((tuple(r) for r in trie_of(table).collect()), key=key)
    assert got == sorted(nodes_of(rows), key=key)
    assert trie_of(table.limit(0)).count() == 0
    only_null = trie_of(table.filter("conv_id is null"))
    assert only_null.count() == 0


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    got = [tuple(r) for r in trie_of(conversations(spark, [(conv, 0, "user", "a")])).collect()]
    assert got == [(conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())]


@pytest.mark.parametrize("query,sql", [(structure_repair.op11_structure_repair, structure_repair.OP11_SQL), (prefix_trie.op12_prefix_trie, prefix_trie.OP12_SQL)])
def test_queries_equal_their_sql(spark, query, sql):
    df = query(spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(*oracle_rows(SF, sql))
    assert got[1]
