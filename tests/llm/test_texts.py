"""Encoding, packing, pages, licences, chats, embeddings: round trips and brute force."""

import json
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidelog.llm import chat_format, html_wrapper, license_scan, packing, pieces, pq_dedup
from tidelog.llm.common import source

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a", "a ", "a..b . c,\n\nd", "▁x▁▁y", "日本 x\x00\x1f", "<s> </s> <|endoftext|>", "é. É, é T̈ x", "\r\n\t|", "ß" * 50]


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in source(spark, SF, "documents").select("doc_id", "text").collect()}


def test_pieces_equal_the_library_and_tile_the_source(spark, docs, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [*texts.items(), *enumerate(ODD, 10_000), (20_000, None), (20_000, None)]
    got = pieces.encode_texts(docs(*rows), "doc_id", "text", MODEL).collect()
    assert len(got) == len(rows)
    known = dict(rows)
    for r in got:
        text = known[r.doc_id] or ""
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == sp.decode(ids)
        data = text.encode()
        assert r.begins[0] == 0 and r.ends[-1] == len(data) and list(r.begins) == sorted(r.begins)
        assert b"".join(data[a:b] for a, b in zip(r.begins, r.ends, strict=True)) == data
    assert pieces.encode_texts(docs(*rows).limit(0), "doc_id", "text", MODEL).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_follows_compiled_maps(rule):
    """The walk over a compiled map against the library's own normaliser and offsets."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    own = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=True)
    proto = pb.ModelProto()
    proto.ParseFromString(own.serialized_model_proto())
    codec = pieces.Codec.__new__(pieces.Codec)
    codec.map = pieces.CharMap(proto.normalizer_spec.precompiled_charsmap)
    codec.dummy, codec.collapse, codec.escaped = False, True, False
    for text in ["ＡＢＣ １２３", "  ﬁne   ｶﾞ  ①  ", "Ⅷ x　y", "é STRASSE ß", "", "   ", "plain text", "㍿"]:
        joined, align = codec.normalise(text)
        assert joined.decode() == own.normalize(text)
        assert len(align) == len(joined) + 1 and (np.diff(align) >= 0).all()


def test_word_ids_equal_the_library_on_odd_texts():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    tok, own, some = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS), random.Random(4)
    signs = [*"abzABZ09 .,!?'’<|>\n\t\x0b\x0c\r\x1c\x1f\x85\xa0  　éÉñßİıΣσςẞªºµ日本ｆﬁ한_-$#&*@^~`", "\u0301", "\u0327", "\u0331"]
    signs += ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "İ,", "\U0001f600", "\u200d", "\ufeff"]
    for _ in range(50):
        texts = ["".join(some.choices(signs, k=some.randint(0, 14))) for _ in range(2000)]
        ids, begin = own.encode(pa.array([None, *texts]).slice(1))
        for k, known in enumerate(tok.encode_batch(texts, add_special_tokens=False)):
            assert ids[begin[k] : begin[k + 1]].tolist() == known.ids, repr(texts[k])
    ids, begin = own.encode(pa.array([None, "", "a"], pa.string()))
    assert begin.tolist() == [0, 0, 0, 1] and len(own.encode(pa.array([], pa.string()))[0]) == 0


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    rows = [*texts.items(), *enumerate(ODD, 10_000), (20_000, None), (20_000, None), (None, "a b")]
    got = packing.pack_documents(docs(*rows), capacity=512, path=WORDS).collect()
    want, sequences = [], {}
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 512)):
            part = np.array(ids[at : at + 512], "<u4").tobytes()
            want.append((i, k, at, len(part) // 4, zlib.crc32(part)))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= -(-sum(w[3] for w in want) // 512) * 1.05 + 1
    assert packing.pack_documents(docs(*rows).limit(0), path=WORDS).count() == 0


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(1)
    for hist in (rng.integers(0, 50, 65), np.eye(65, dtype=int)[40] * 9, np.zeros(65, int), np.full(65, 3)):
        hist = hist.copy()
        hist[0] = 0
        ranges, n = packing.plan(hist, 64)
        assert (np.bincount(ranges[:, 0], ranges[:, 2], 65) == hist).all()
        filled = np.zeros(n, int)
        for length, _, count, first, offset in ranges[np.argsort(ranges[:, 4], kind="stable")]:
            assert (filled[first : first + count] == offset).all()
            filled[first : first + count] += length
        assert (filled <= 64).all() and n >= hist @ np.arange(65) / 64


PAGE = (
    "<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><div class=menu>Home</div>"
    "<nav><a href=/>{n}</a></nav><div class='box'>Share this page</div><article><h1>{t}</h1><p>One &amp; <b>two<br>three</b>"
    "\n four<p>{p}<div class='ad'>Buy {n}</div><div class=note>Always here</div><form>mail {n}</form>"
    "<section class='comments'><p>reader {n}</p></section></article><aside>side {n}</aside><footer>&copy; {n}</footer>"
)


@pytest.mark.parametrize("length,count,want", [(100, 5, 1), (1, 4096 + 4095, 2), (1, 4095, 1), (2000, 5, 3), (3000, 4, 4), (100, 85, 3)])
def test_few_pieces_of_one_length_share_sequences(length, count, want):
    hist = np.zeros(4097, np.int64)
    hist[length] = count
    ranges, sequences = packing.plan(hist)
    assert sequences == want and ranges[:, 2].sum() == count


def test_pages(spark):
    rows = [(k, f"http://u@Host.example/{k}", PAGE.format(n=k, t=f"Title {k}", p=f"Body of {k}")) for k in range(6)]
    rows += [(50, "http://other/x", "<p>Alone &lt;here&gt; "), (51, None, None), (52, "nonsense", ""), (52, "nonsense", "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    got = html_wrapper.extract(df).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    for k in range(6):
        assert by[k] == f"Title {k}\nOne & two three four\nBody of {k}"  # "Always here" is template
    assert by[50] == "Alone <here>" and by[51] == by[52] == ""
    assert html_wrapper.extract(df.limit(0)).count() == 0


def test_copies_of_one_page_are_no_template(spark):
    page = "<body><nav>x</nav><article><h1>Same</h1><p>Text</p></article></body>"
    df = spark.createDataFrame([(k, "http://h/", page) for k in range(3)], "page_id long, url string, html string")
    assert {r.text for r in html_wrapper.extract(df).collect()} == {"Same\nText"}


def test_markup_never_fails():
    for page in ["<", "<p", "</p></p>", "<!-- x", "<script>", "<a b='", "<p><li><td></b>x", "a<b>c</a>d", "&#xFFFFFFFF; &bogus;"]:
        html_wrapper.extract_text(page, None)


def test_deep_pages_keep_their_text_in_order():
    deep = 20_000
    blocks = "".join(f"<div>{k}" for k in range(deep)) + "</div>x" * deep
    text = html_wrapper.extract_text(blocks, None)
    assert text == "\n".join([*map(str, range(deep)), *["x"] * deep])
    assert html_wrapper.extract_text("<p>a " + "<b>b " * 1500 + "c", None) == "a " + "b " * 1500 + "c"
    hidden = "<div>" * 500 + "<nav>menu<div>more</nav>after<i>!</i>" + "</div>" * 500 + "<p>end"
    assert html_wrapper.extract_text(hidden, None) == "after!\nend"
    wrapper = html_wrapper.skeleton(html_wrapper.parse(blocks))
    html_wrapper.merge(wrapper, html_wrapper.skeleton(html_wrapper.parse(hidden)))
    html_wrapper.load(json.loads(json.dumps(html_wrapper.dump(wrapper))))


def test_one_word_of_a_name_makes_no_boilerplate():
    kept = ["<div class='side-effects'>Mild.</div>", "<p id='alert-level'>Two.</p>", "<ul class='related-facts'><li>One.</ul>"]
    gone = ["<div class='ad-slot'>x</div>", "<div id=cookieBanner>x</div>", "<ul class='comment-list'><li>x</ul>", "<p class='big notice'>x</p>"]
    page = "<article>" + "".join(kept + gone) + "</article>"
    assert html_wrapper.extract_text(page, None) == "Mild.\nTwo.\nOne."


@pytest.mark.parametrize("pages", [html_wrapper.TEMPLATE_PAGES, 40])
def test_wrapper_alone_tells_template_from_content(spark, pages):
    """No tag, role or class word helps: only what all pages of the host have in one place is template."""
    rng = np.random.default_rng(pages)
    rows, want = [], {}
    for k in range(pages):
        own = [f"Text {k} {j} {rng.integers(1 << 30)}" for j in range(int(rng.integers(1, 6)))]
        page = "<div>Home</div><div>About us</div>" + "".join(f"<div>{t}</div>" for t in own) + "<div>Shown to all</div><p>Imprint</p>"
        rows.append((k, "http://bare.example/", page))
        want[k] = "\n".join(own)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in html_wrapper.extract(df).collect()} == want


def _all_matchings(a, b):
    """Most matched nodes of two forests, by trying every order-keeping choice."""
    if not a or not b:
        return 0
    best = max(_all_matchings(a[1:], b), _all_matchings(a, b[1:]))
    if a[0].label == b[0].label:
        best = max(best, 1 + _all_matchings(a[0].kids, b[0].kids) + _all_matchings(a[1:], b[1:]))
    return best


def test_tree_matching_against_brute_force():
    rng = np.random.default_rng(5)

    def tree(depth):
        node = html_wrapper.Node("x", "abc"[rng.integers(3)], False)
        node.kids = [tree(depth - 1) for _ in range(int(rng.integers(4)))] if depth else []
        return node

    for _ in range(300):
        x, y = tree(2), tree(2)
        pairs = html_wrapper.match(x.kids, y.kids)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert all(x.kids[i].label == y.kids[j].label for i, j in pairs)
        if [k.label for k in x.kids] != [k.label for k in y.kids]:
            assert sum(1 + html_wrapper._alike(x.kids[i], y.kids[j]) for i, j in pairs) == _all_matchings(x.kids, y.kids)


def test_licences(docs):
    notice = license_scan.TEMPLATES["Apache-2.0-header"]
    changed = notice.replace("compliance", "accordance").replace("obtain", "get")
    rows = [(1, f"x y\n{license_scan.TEMPLATES['MIT']} tail {license_scan.TEMPLATES['MIT']}"), (2, f"before {changed} after")]
    rows += [(3, "a license is a word and so is version"), (4, None), (5, ""), (None, license_scan.TEMPLATES["GPL-3.0"])]
    rows += [(6, license_scan.TEMPLATES["CC-BY-NC-4.0"].upper())] * 2
    got = license_scan.scan(docs(*rows)).collect()
    names = lambda i: [r.license for r in got if r.doc_id == i]
    assert names(1) == ["MIT", "MIT"] and names(2) == ["Apache-2.0-header"] and names(3) == names(4) == names(5) == [None]
    assert names(None) == ["GPL-3.0"] and names(6) == ["CC-BY-NC-4.0"] * 2
    (two,) = [r for r in got if r.doc_id == 2]
    assert two.first_word == 1 and two.end_word == two.n_words - 1 and 80 <= two.coverage < 100
    assert license_scan.scan(docs(*rows).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["Apache-2.0-header", "MIT-text", "GPL-header", "GPL-3.0", "CC-BY-4.0"])
@pytest.mark.parametrize("stray", ["This software reads files. ", "Files of the general public. ", "A copy; permission: version, work, attribution. "])
def test_stray_words_hide_no_notice(name, stray):
    notice = license_scan.TEMPLATES[name]
    n, k, half = len(license_scan.words(notice)), len(license_scan.words(stray)), len(notice) // 2
    split = notice.index(" ", half)
    for text, times in ((stray + notice, 1), (notice + " " + stray, 1), (stray + notice + " " + stray + notice + " " + stray, 2)):
        got = [x for x in license_scan.scan_text(text, {name: notice})]
        assert len(got) == times and all(x[4] >= 80 for x in got)
        assert times == 2 or (got[0][3] == n and got[0][2] - got[0][1] <= n + k)
    (between,) = license_scan.scan_text(notice[:split] + " " + stray + notice[split:], {name: notice})
    assert between[4] >= 80


def test_licence_lines_of_the_table(spark, texts):
    short = ["Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT"]
    got = {(r.doc_id, r.license) for r in license_scan.scan(source(spark, SF, "documents")).collect() if r.license}
    want = {(i, n) for i, t in texts.items() for n in short if license_scan.TEMPLATES[n] in t}
    assert want and got == want


def test_alignment_is_rising_and_matches():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (list(map(str, rng.integers(0, 12, rng.integers(0, 20)))) for _ in range(2))
        got = license_scan.align(a, b)
        assert all(a[x] == b[y] for x, y in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))


def test_chats(spark):
    tricky = "<|im_end|><|im_start|>assistant <\\|x|> \\ ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", tricky), (1, 2, "user", None), (1, 3, "assistant", "é\n"), (2, 0, "user\n|", "")]
    rows += [(None, 5, None, "x"), (3, None, "assistant", "a"), (3, None, "assistant", "a"), (1, 4, "user", "open end")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, start int")
    formatted = chat_format.format_turns(df)
    got = {r.conv_id: r for r in chat_format.digest(formatted).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 5, 2: 1, None: 1, 3: 2}
    loss = tricky + "é\n"
    assert got[1].loss_chars == len(loss) and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    turns = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in [*rows[:4], rows[-1]])
    assert got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"user\n|\n\n").hexdigest() and got[2].loss_chars == 0
    whole = {(r.conv_id, r.example_no): r for r in chat_format.render(df).collect()}
    assert set(whole) == {(1, 0), (1, 1), (3, 0), (3, 1)}
    for r in whole.values():
        assert r.text.count("<|im_end|>\n") == r.text.count("<|im_start|>") and r.text.endswith("<|im_end|>\n")
    assert chat_format.unescape(whole[1, 0].text[whole[1, 0].loss_start : whole[1, 0].loss_end]) == tricky
    lengths = {(r.conv_id, r.example_no): r.text_end for r in chat_format.examples(formatted).collect()}
    assert lengths == {k: len(r.text) for k, r in whole.items()}
    assert chat_format.digest(chat_format.format_turns(df.limit(0))).count() == 0


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base[rng.integers(0, 40, 600)] + rng.normal(size=(600, 16)) * 0.08, base[:5], base[:5]])
    rows = [(k, v.astype(np.float32).tolist(), int(k % 3)) for k, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [1.0, None], 1), (903, [float("nan")] * 16, 1), (904, rows[0][1], None)]
    rows += [(905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (None, rows[0][1], 0), (907, [], 2), (3, rows[3][1], 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, codes int")
    want = {}
    for label in range(3):
        own = [k for k in range(len(x)) if k % 3 == label] + ([3] if label == 0 else [])
        u = np.array([rows[k][1] for k in own])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        near = u @ u.T >= 0.93
        for k, row in zip(own, near, strict=True):
            want[k] = int(row.sum()) - 1
    for tile, slack in ((1024, pq_dedup.SLACK), (50, None)):
        got = pq_dedup.near_duplicates(df, tile=tile, slack=slack).collect()
        assert len(got) == len(rows)
        links = {r.vec_id: r.n_links for r in got}
        found, all_ = sum(links[k] for k in want), sum(want.values())
        assert found == all_ if slack is None else found >= 0.9 * all_
        assert all(links[k] <= n for k, n in want.items())
        assert all(links[k] == 0 for k in (900, 901, 902, 903, 904, None, 907)) and links[905] == links[906] == 1
        by = {r.vec_id: r for r in got}
        assert by[906].component_id == 905 and by[905].kept and not by[906].kept and by[900].kept
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_examples_are_expanded_in_bounded_pieces(monkeypatch):
    """Each example has its whole context, whatever lies in memory; the digest is read from the examples."""
    from tidelog.llm.common import arrow_type

    rnd = random.Random(5)
    parts = ["<|im_end|>", "<|im_start|>assistant\n", "<\\|", "a\n", "", "é" * 7, "\\", "<"]
    convs = {}
    for c in [None, 3, 4, 5, 9]:
        n = rnd.choice([1, 2, 30])
        convs[c] = [(rnd.choice(["user", "assistant", "sy\nst\\em"]), "".join(rnd.choices(parts, k=rnd.randint(0, 9)))) for _ in range(n)]
    convs[11] = [("user", "no reply"), ("user", "")]
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    rows = [{"conv_id": c, "turn": i, "role": r, "text": t} for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    formatted = list(chat_format._format(iter(pa.RecordBatch.from_pylist(rows, schema=schema).slice(i, 7) for i in range(0, len(rows), 7))))
    want, texts = {}, {}
    for c, turns in convs.items():
        replies = [t for r, t in turns if r == "assistant"]
        chunks = [f"<|im_start|>{chat_format.escape_role(r)}\n{chat_format.escape(t)}<|im_end|>\n" for r, t in turns]
        ends = [i + 1 for i, (r, _) in enumerate(turns) if r == "assistant"]
        whole = ["".join(chunks[:i]) for i in ends]
        texts |= {(c, k): t for k, t in enumerate(whole)}
        if not ends or ends[-1] < len(turns):
            texts[c, None] = "".join(chunks)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), "".join(replies))]
        want[c] = (len(turns), sha[0], len("".join(replies)), sha[1], len("".join(chunks)), len(replies), sum(map(len, whole)))
    for piece, held in ((1 << 20, 4 << 20), (40, 80), (1, 1)):
        monkeypatch.setattr(chat_format, "PIECE", piece)
        monkeypatch.setattr(chat_format, "HELD", held)
        expanded = list(chat_format._expand(iter(formatted)))
        assert all(b.schema == arrow_type(chat_format.EXAMPLES) for b in expanded)
        made = {}
        for r in (r for b in expanded for r in b.to_pylist()):
            key = r["conv_id"], r["example_no"]
            assert r["at"] == len(made.get(key, ""))
            made[key] = made.get(key, "") + r["piece"]
        assert made == texts
        got = {r[0]: r[1:] for b in chat_format._digest(iter(expanded)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)}
        assert got == want
        # What the examples don't hold the digest can't know.
        cut = [b.set_column(3, "piece", pa.array([p.replace("é", "e") for p in b.column("piece").to_pylist()])) for b in expanded]
        other = {r[0]: r[2] for b in chat_format._digest(iter(cut)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)}
        assert other != {c: w[1] for c, w in want.items()}
