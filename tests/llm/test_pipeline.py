"""The pipeline's stages against plain Python, each on what the one before kept."""

import corpus_pipeline
from test_rules_and_groups import SF, brute_passages

from tidelog.llm import quality_rules
from tidelog.session import settle


def grams(text, n=5):
    w = text.lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name.replace(" ", "_"))
        seen.append(docs)
        assert docs.columns == columns or name == "best-fit packing"
    rows = [{r.doc_id: r.text for r in d.collect()} for d in seen[:5]]
    raw, good, lined, joined, cut = rows
    assert all(d.filter("n_chars <> length(text)").isEmpty() for d in seen[:5])

    kept = {r.doc_id for r in quality_rules.judge(seen[0]).filter("kept").collect()}
    assert set(good) == kept and 0 < len(kept) < len(raw)

    assert set(lined) <= set(good) and sum(map(len, lined.values())) < sum(map(len, good.values()))
    assert all(set(t.split("\n")) <= set(good[i].split("\n")) for i, t in lined.items())
    assert all(t.strip() for t in lined.values())

    ids, sets = sorted(lined), {i: grams(t) for i, t in lined.items()}
    low = {i: i for i in ids}
    for a in ids:
        for b in ids:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((low[a], low[b]))
                low = {i: x if g == y else g for i, g in low.items()}
    assert set(joined) == {i for i in ids if low[i] == i}

    want = brute_passages(list(joined.items()), 50)
    assert set(cut) == {i for i, (n, gone, _) in want.items() if gone < n or not gone}
    assert all(len(t.split()) == want[i][0] - want[i][1] for i, t in cut.items())

    packed = seen[5].collect()
    assert {r.doc_id for r in packed} == set(cut)
    used = {}
    for r in packed:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 4096 and len(used) <= -(-sum(used.values()) // 4096) + 1


def test_a_stage_drops_what_the_one_before_left(spark, tmp_path):
    import os

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, second = corpus_pipeline.STAGES[1][1], corpus_pipeline.STAGES[2][1]
    made = first(spark, docs, SF)
    left = [f.rpartition(":")[2] for f in corpus_pipeline._left]
    assert left and all(map(os.path.isdir, left))
    # Not written yet: what it reads stays.
    second(spark, made, SF).limit(1).count()
    assert all(map(os.path.isdir, left)) and made.count() > 0
    corpus_pipeline._left[:] = left
    made.write.parquet(str(tmp_path / "made"))
    second(spark, spark.read.parquet(str(tmp_path / "made")), SF)
    assert not any(map(os.path.isdir, left))
