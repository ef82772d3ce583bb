"""Quality rules, n-gram join, lines, passages: edge cases and brute force."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from compare import canonical, oracle_rows
from pyspark.sql import functions as F

from tidelog.llm import edit_distance, fuzzy_lines, groups, ngram_join, quality_rules, substring_dedup
from tidelog.llm.common import source
from tidelog.llm.edit_distance import within
from tidelog.llm.fm_index import FMIndex
from tidelog.llm.groups import components, meetings, star_and_rest
from tidelog.llm.queries import ORACLES, QUERIES
from tidelog.session import shared_folder

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(300))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, key):
    df = QUERIES[key](spark, SF)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(*oracle_rows(SF, ORACLES[key]))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, None), (5, 5)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_groups_of_which_the_smallest_key_links_with_few_are_no_square(spark):
    """Two lists of 300 keys; half of the pairs of one link, of the other those of one residue, three keys of both meet."""
    family = {0: range(0, 300), 1: range(297, 597)}
    items = spark.createDataFrame([(g, k, 1) for g, keys in family.items() for k in keys], "gram long, key long, size int")
    tried = []

    def linked(a, b):
        return (a * 7919 + b * 104729) % 101 < 50 if b < 300 else a >= 297 and (a - b) % 5 == 0

    def verify(pairs):
        rows = [(r["a"], r["b"]) for r in pairs.collect()]
        tried.extend(rows)
        return spark.createDataFrame([r for r in rows if linked(*r)], "a long, b long")

    links = star_and_rest(items, ["size"], lambda x, y: x["size"] == y["size"], verify)
    found = {r["id"]: r["component"] for r in components(links).collect()}
    label = list(range(597))
    every = [(a, b) for keys in family.values() for a in keys for b in keys if a < b and linked(a, b)]
    while any(label[a] != label[b] for a, b in every):
        for a, b in every:
            label[a] = label[b] = min(label[a], label[b])
    assert [found.get(k, k) for k in range(597)] == label
    assert len(tried) == len(set(tried))
    # All pairs of the first list are 44,850.
    assert sum(b < 300 for a, b in tried) < 3000


def test_pairs_of_the_smallest_key_are_made_once_and_marked_ones_not_verified(spark, monkeypatch):
    """Lists of two and three keys that don't link: the last round holds the other two of three only."""
    lists = [(g, k, 1) for g in range(50) for k in range(10 * g, 10 * g + 2 + g % 2)]
    items = spark.createDataFrame(lists, "gram long, key long, size int")
    seen, settle = {}, groups.settle

    def noted(df, label="step"):
        out = settle(df, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(groups, "settle", noted)
    asked = []

    def verify(pairs):
        asked.extend((r["a"], r["b"]) for r in pairs.collect())
        return spark.createDataFrame([], "a long, b long")

    assert star_and_rest(items, ["size"], lambda x, y: x["size"] == y["size"], verify).count() == 0
    assert seen["mixed"] == 2 * 25
    assert sorted(asked) == sorted((a, b) for g in range(50) for a, b in [(0, 1), (0, 2), (1, 2)] if b < 2 + g % 2 for a, b in [(10 * g + a, 10 * g + b)])
    asked.clear()
    more = items.select("key", (items["key"] % 10).alias("m"))
    same = lambda x, y: x["size"] == y["size"]
    assert star_and_rest(items, ["size"], same, verify, more, lambda x, y: x["m"] + y["m"] == 2).count() == 0
    assert sorted(asked) == [(10 * g, 10 * g + 2) for g in range(1, 50, 2)]


def test_keys_that_share_many_grams_meet_once(spark):
    rows = [(g, k, k) for k in (5, 7, 9) for g in range(10)] + [(20, 5, 5), (20, 8, 8), (30, 9, 9), (30, 8, 8)]
    met = meetings(spark.createDataFrame(rows, "gram long, key long, size long"), F.lit(True))
    assert sorted((r[0], r[1]) for r in met.select("x.key", "y.key").collect()) == [(5, 7), (5, 8), (5, 9), (7, 9), (8, 9)]


def test_what_operators_write_for_themselves_is_dropped(spark, docs):
    text = LONG + "\n" + LONG.replace("w5 ", "other ")
    rows = docs((1, text), (2, text), (3, text.replace("w9 ", "x ")), (4, None))

    def written():
        return {f.name for f in Path(shared_folder(spark).removeprefix("file:")).iterdir()}

    for run, left in ((ngram_join.similar_groups, "groups"), (fuzzy_lines.remove_lines, "line_marks"), (substring_dedup.remove_repeats, "spans")):
        before = written()
        assert run(rows).count() == 4
        assert [name.rpartition("-")[0] for name in written() - before] == [left]
    # Nor are shuffle files kept.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_marks_of_large_sets_rule_pairs_out():
    rng, mark, differ = np.random.default_rng(7), ngram_join.mark, ngram_join.marks_differ
    one, two = (rng.integers(0, 1 << 63, 6000).astype(np.uint64) for _ in range(2))
    near = np.concatenate((one[:5800], two[:200]))
    allowed = 12000 - 2 * -(-12000 * 90 // 190)
    assert differ(mark(one), mark(two)) > allowed >= differ(mark(one), mark(near))
    # Marks of other lengths are folded, and differ no more than the sets.
    assert differ(mark(one), mark(one[:4000])) <= 2000


def test_marks_and_runs_never_rule_out_a_link():
    rng = random.Random(8)
    for size in (9, 12, 19, 25, 60, 99, 100, 130, 250):
        for _ in range(30):
            a = "".join(rng.choice("abc d\u00e9") for _ in range(size - 1)) + "q"
            b = list(a)
            for _ in range(rng.randrange(1 + size // 5)):
                at = rng.randrange(len(b))
                b[at : at + rng.randrange(2)] = rng.choice(["", "z", "a"])
            b = "".join(b) or "q"
            far = edits(a, b)
            one, two = fuzzy_lines.marks([a.encode(), b.encode()])
            assert np.bitwise_count(one ^ two).sum() <= 4 * far
            assert [within(a, b, k) for k in (far - 1, far)] == [False, True]


def test_pairs_are_verified_together_as_one_by_one():
    rng = random.Random(9)
    pairs = [("", "", 0), ("a", "b", 0), ("a", "b", 1), ("x" * 64, "y" * 64, 64), ("x" * 65, "x" * 64, 0), ("ab" * 40, "ba" * 40, 8)]
    for size in (5, 63, 64, 65, 130, 260, 500):
        for far in range(0, 2 + size // 4, 1 + size // 40):
            a = "".join(rng.choice("abc d\u00e9\u4e00") for _ in range(size))
            b = list(a)
            for _ in range(far):
                at = rng.randrange(len(b) + 1)
                b[at : at + rng.randrange(2)] = rng.choice(["", "z", "a"])
            pairs.append((a, "".join(b), size // 10))
            pairs.append((a, a[: size // 2] + "".join(rng.sample(a[size // 2 :], size - size // 2)), size // 10))
    want = [edits(a, b) <= most for a, b, most in pairs]
    assert edit_distance.all_within(pairs) == want and 20 < sum(want) < len(want) - 20


def test_lists_of_shared_keys_are_of_about_one_length(spark, monkeypatch):
    """Keys of one class go, and lines that can't link by length meet in no list; before, they did."""
    monkeypatch.setattr(fuzzy_lines, "BLOCK", 40)
    monkeypatch.setattr(fuzzy_lines, "HELD", 100)
    rng = np.random.default_rng(3)
    rows = []
    for cls in range(300):
        keys = rng.integers(0, 400, int(rng.integers(0, 6))) | (rng.integers(0, 27) << 32)
        rows.append(((cls % 3 << 33) + cls, int(rng.integers(9, 300)), np.unique(keys).astype(np.int64)))
    packs = fuzzy_lines._packed(np.concatenate([r[2] for r in rows]), np.array([len(r[2]) for r in rows])).to_pylist()
    frame = spark.createDataFrame([(*r[:2], x) for r, x in zip(rows, packs, strict=True)], "cls long, size int, grams binary")
    sizes, met = {r[0]: r[1] for r in rows}, {}
    for r in fuzzy_lines.shared_keys(frame).collect():
        met.setdefault(r.gram, []).append(r.key)
    got = {(a, b) for keys in met.values() for a in keys for b in keys if a < b}
    share = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and set(a[2].tolist()) & set(b[2].tolist())}
    link = {(a, b) for a, b in share if abs(sizes[a] - sizes[b]) <= max(sizes[a], sizes[b]) // 10}
    assert link <= got <= share and len(got) < len(share) and all(len(x) > 1 for x in met.values())
    for keys in met.values():
        own = sorted(sizes[k] for k in keys)
        assert all(b <= a * 1.25 for a, b in zip(own, own[1:]))
    assert fuzzy_lines.shared_keys(frame.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 1 << 26])
def test_wanted_lines_are_fetched_once_whatever_the_bitmap_holds(docs, monkeypatch, bits):
    monkeypatch.setattr(fuzzy_lines, "MOST_BITS", bits)
    rows = [(k, f"First  Line {k}\n\nother {k}\nLAST line") for k in range(30)] + [(3, "First  Line 3\n\nother 3\nLAST line"), (90, None), (91, "")]
    frame = docs(*rows)
    lines = fuzzy_lines.line_rows(frame, 1, wide=False).filter("doc_id % 7 = 3 and line <> 2").distinct()
    wanted = lines.select((F.col("doc_id") * 10 + F.col("line")).alias("cls"), "doc_id", "print", "line")
    got = [(r.cls, r.words) for r in fuzzy_lines.line_texts(frame, wanted).collect()]
    assert sorted(got) == sorted((10 * k + n, x) for k in (3, 10, 17, 24) for n, x in ((0, f"first line {k}"), (3, "last line")))
    assert fuzzy_lines.line_texts(frame, wanted.limit(0)).count() == 0


def test_quality_edge_cases(docs):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c d e f g h " * 10), (5, LONG), (5, LONG), (None, LONG)]
    got = quality_rules.judge(docs(*rows)).drop("print", "template").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[4].n_repeat_words == 80 and by[4].base_failed
    assert by[5].kept and by[None].kept and by[5].n_repeat_words == 0
    assert quality_rules.judge(docs(*rows).limit(0)).count() == 0


def test_template_lines_go_and_depleted_documents_too(docs):
    own = [(i, "the same menu line on every page\n" + " ".join(f"d{i}w{k}" for k in range(60))) for i in range(20)]
    poor = [(100, "the  SAME menu line on every page\n" * 3 + "a few words of its own that are not many at all ok then")]
    frame = docs(*own, *poor)
    got = {r.doc_id: r for r in quality_rules.judge(frame).collect()}
    assert all(got[i].kept and got[i].n_template_lines == 1 and got[i].words_left == 60 for i in range(20))
    assert got[100].depleted and not got[100].kept
    kept = quality_rules.clean(frame)
    assert kept.columns == frame.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert set(rows) == set(range(20))
    assert rows[3].text == own[3][1].split("\n")[1] and rows[3].n_chars == len(rows[3].text)


def test_ngram_groups_edge_cases(docs):
    near = LONG.replace("w5 ", "other ")
    rows = [(9, LONG), (3, near), (4, LONG.upper()), (5, None), (6, ""), (7, "a b"), (8, "A  B"), (2, "b a"), (None, LONG)]
    rows += [(3, near), (11, "a b c")]
    got = ngram_join.similar_groups(docs(*rows), n=3, num=90).collect()
    by = {(r.doc_id): (r.n_shingles, r.component_id) for r in got}
    assert len(got) == len(rows)
    assert [by[i][1] for i in (9, 3, 4)] == [3, 3, 3] and by[None] == (298, None)
    assert by[5] == (0, 5) and by[6] == (0, 6)
    assert by[7] == (1, 7) and by[8] == (1, 7) and by[2] == (1, 2) and by[11] == (1, 11)
    assert ngram_join.similar_groups(docs(*rows).limit(0)).count() == 0


def test_near_copies_need_no_chain_through_the_smallest(docs):
    """Each text is near the next one only; the group is still one."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words[30 * k + 5 : 30 * k + 15] = [f"x{k}_{i}" for i in range(10)]
    got = ngram_join.similar_groups(docs(*rows), n=3, num=90)
    assert {r.component_id for r in got.collect()} == {0}


def brute_passages(rows, width):
    first, out = {}, {}
    for i, t in sorted(rows):
        w = t.split()
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    for i, t in rows:
        w = t.split()
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 2, "shard": 3000}])
def test_passages_against_brute_force(spark, options):
    docs = source(spark, SF, "documents").select("doc_id", "text")
    want = brute_passages([(r.doc_id, r.text) for r in docs.collect()], 50)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, **options).collect()}
    assert got == want and sum(v[1] for v in want.values())


def test_passages_edge_cases(docs):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"one\n{passage} end"), (2, f"two {passage}\ttail"), (3, passage), (3, passage), (4, None), (5, ""), (None, passage)]
    rows += [(6, " ".join(["again"] * 200))]
    frame = docs(*rows)
    got = substring_dedup.remove_repeats(frame)
    assert got.columns == [*frame.columns, "n_words", "n_removed", "kept_sha256"]
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert by[1].n_removed == 0 and by[1].text == rows[0][1]
    assert by[2].text == "two tail" and by[3].text == "" and by[4].text is None and by[None].n_removed == 0
    assert by[6].n_removed == 0
    assert substring_dedup.remove_repeats(frame.limit(0)).count() == 0


def test_index_answers_every_window():
    rng = np.random.default_rng(5)
    for _ in range(20):
        texts = [rng.integers(1, 4, rng.integers(1, 60)) for _ in range(30)]
        owners = rng.integers(0, 9, 30)
        width = int(rng.integers(1, 9))
        want = {}
        for t, o in zip(texts, owners, strict=True):
            for k in range(len(t) - width + 1):
                key = tuple(t[k : k + width])
                want[key] = min(int(o), want.get(key, 99))
        index = FMIndex(texts, owners, width)
        for t, found in zip(texts, index.window_owners(texts), strict=True):
            assert found.tolist() == [want[tuple(t[k : k + width])] for k in range(len(t) - width + 1)]
        other = rng.integers(1, 6, 40)
        none = np.iinfo(np.int64).max
        (found,) = index.window_owners([other])
        exact = [want.get(tuple(other[k : k + width]), none) for k in range(len(other) - width + 1)]
        # After a word that breaks a match the search starts anew, so it may miss but never invents.
        assert all(f in (e, none) for f, e in zip(found.tolist(), exact, strict=True))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_by_bits():
    rng = random.Random(10)
    for _ in range(4000):
        x = "".join(rng.choices("abé", k=rng.randint(0, 14)))
        at = rng.randint(0, 14)
        y = "".join(rng.choices("abé", k=rng.randint(0, 14))) if rng.random() < 0.5 else x[:at] + "b" + x[at + 1 :]
        d = edits(x, y)
        assert [within(x, y, k) for k in (d - 1, d, d + 1, 99)] == [False, True, True, True]
    long = "".join(rng.choices("abcdefgh", k=30_000))
    other = "".join(c if k % 50 else "Z" for k, c in enumerate(long))
    assert within(long, other, 600) and not within(long, other, 599) and not within(long, long[::-1], 3000)


def near_pairs(lines):
    """All pairs of 90 % edit similarity, by edits alone; letter counts only rule out what can't be."""
    texts = [x.decode() for x in lines]
    sizes = np.array([len(t) for t in texts])
    counts = np.zeros((len(texts), 128), np.int32)
    for k, t in enumerate(texts):
        np.add.at(counts[k], [ord(c) % 128 for c in t], 1)
    for a in range(len(texts)):
        most = np.maximum(sizes[a + 1 :], sizes[a]) // 10
        less = counts[a + 1 :] - counts[a]
        bag = np.maximum(np.maximum(less, 0).sum(1), np.maximum(-less, 0).sum(1))
        for b in np.flatnonzero(bag <= most) + a + 1:
            if within(texts[a], texts[b], int(most[b - a - 1])):
                yield a, b


def test_lines_against_brute_force(spark):
    """Recall against edit similarity alone; what goes is right whatever is missed."""
    docs = source(spark, SF, "documents").select("doc_id", "text")
    places = {}
    for r in docs.collect():
        for k, line in enumerate(r.text.split("\n")):
            if len(fuzzy_lines.normal(line).split()) >= fuzzy_lines.MIN_WORDS:
                places.setdefault(fuzzy_lines.normal(line), []).append((r.doc_id, k))
    lines = list(places)
    group = list(range(len(lines)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in near_pairs(lines):
        low, high = sorted((top(a), top(b)))
        group[high] = low
    gone, whole = {}, {}
    for k, line in enumerate(lines):
        whole.setdefault(top(k), []).extend(places[line])
    for v in whole.values():
        for doc, _ in sorted(v)[1:]:
            gone[doc] = gone.get(doc, 0) + 1
    got = {r.doc_id: r.n_removed for r in fuzzy_lines.remove_lines(docs).collect() if r.n_removed}
    assert all(n <= gone.get(doc, 0) for doc, n in got.items())
    assert sum(got.values()) >= 0.98 * sum(gone.values()) > 100


def test_lines_edge_cases(docs):
    line = " ".join(f"word{i}" for i in range(150))
    near = line.replace("word7 ", "wort7 ")
    one, two = fuzzy_lines.simhashes([line.encode(), near.encode()])
    assert np.bitwise_count(one ^ two) <= fuzzy_lines.DISTANCE
    rows = [(5, f"{line}\nshort one"), (2, f"{near}\nshort one\nmore"), (7, f" {line.upper()} "), (8, None), (9, ""), (None, line)]
    rows += [(7, f" {line.upper()} ")]
    frame = docs(*rows)
    got = {r.doc_id: r for r in fuzzy_lines.remove_lines(frame).collect()}
    assert got[2].n_removed == 0 and got[5].text == "short one" and got[7].text == ""
    assert got[8].text is None and got[9].n_lines == 0 and got[None].n_removed == 0
    assert fuzzy_lines.remove_lines(frame.limit(0)).count() == 0


def test_line_candidates_by_edit_similarity_alone():
    """Changes in one place always share a key, on lines of every length and without spaces."""
    rng = np.random.default_rng(4)
    for size in [*range(10, 60), 90, 200, 700]:
        for letters in ("abcdefghij klmnop", "\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b\u4e5d"):
            line = "".join(rng.choice(list(letters), size)).replace(" ", "q")
            at, wide = int(rng.integers(0, size - size // 10 + 1)), size // 10
            for new in (line[:at] + "Z" * wide + line[at + wide :], line[:at] + line[at + wide :]):
                if edits(line, new) > max(len(line), len(new)) // 10:
                    continue
                one, two = fuzzy_lines.line_keys([line.encode(), new.encode()])
                assert set(one.tolist()) & set(two.tolist())


def test_lines_with_one_word_replaced_go(docs):
    """Short and long lines, edit similarity of 90 % and more; the SimHash of words saw few of them."""
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for k, n in enumerate([6, 7, 8, 9, 12, 15, 20, 27, 40, 80] * 4):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(n)]
        rows.append((k, " ".join(words)))
        words[int(rng.integers(n))] = words[0][:3] + "xyz" if n > 10 else words[0]
        at = int(rng.integers(n))
        words = rows[-1][1].split() if n <= 10 else words
        words[at] = words[at][:2] + "0" + words[at][3:]
        rows.append((1000 + k, " ".join(words)))
        near = edits(rows[-2][1], rows[-1][1]) <= max(len(rows[-2][1]), len(rows[-1][1])) // 10
        want |= {k: 0, 1000 + k: int(near)}
    got = {r.doc_id: r.n_removed for r in fuzzy_lines.remove_lines(docs(*rows)).collect()}
    assert got == want and sum(want.values()) > 30


def test_short_lines_and_lines_without_spaces_take_part(spark, docs, tmp_path):
    """As the query and the pipeline run it: every line with a word."""
    chinese = "".join(chr(0x4E00 + 37 * k) for k in range(40))
    rows = [(1, f"Les.\n{chinese}\n\nab"), (2, f"les. \n{chinese[:20]}x{chinese[21:]}\n\nac"), (3, "Les.")]
    docs(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_removed for r in fuzzy_lines.op10_fuzzy_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 2, 3: 1}


def test_hot_windows_go_to_no_shard(docs, monkeypatch):
    """A passage of many documents in different surroundings is not dealt to one task."""
    shared = " ".join(f"p{i}" for i in range(60))
    rows = [(k, " ".join([*(f"a{k}x{i}" for i in range(50)), shared, *(f"b{k}x{i}" for i in range(50))])) for k in range(200)]
    search = substring_dedup.search_shard

    def guarded(width):
        inner = search(width)

        def run(table):
            if table.num_rows > 20:
                raise ValueError("one shard has it all")
            return inner(table)

        return run

    monkeypatch.setattr(substring_dedup, "search_shard", guarded)
    got = substring_dedup.remove_repeats(docs(*rows), hot=50, shard=500)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == brute_passages(rows, 50)
