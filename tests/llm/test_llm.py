"""The training-data operators against brute force on small fixtures."""

import base64
import collections
import hashlib
import html as html_lib
import re
import time
import uuid

import numpy as np
import pytest
from conftest import DATA, same_rows
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from countloom.llm import graph, html, minhash, mixing, pieces, pii, quality, queries, rollup, substrings, urls, vectors
from countloom.llm.common import written
from plain import roots, shingles

WORD = re.compile(r"[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, id long, key string, copies int, gone string, epoch int, digest string, `row` string, node string, base string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
HARD = [None, "", "   ", "one two", "a b c d e", "A B c D e", LONG, LONG, "x" * 200_000, "é​😀 " * 100, "1.2.3.4 a@b.co +12 345-678 90 4111111111111111 999.1.1.1", "l1 a\nl1 a\n\nl1 a"]


MORE = ("g", 3, "d", "r", "n", "b")


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en", ["s", None, "t"][i % 3], 0, "z", 1, "k", 2, *MORE) for i, t in enumerate(HARD)]
    rows += [(3, "one two", None, "s", None, None, None, None, None, *[None] * 6), (None, "null id text here now", "en", None, 1, "z", 1, "k", 2, *MORE), rows[4]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(name, spark, duck):
    same_rows(queries.QUERIES[name](spark, DATA), duck.sql(queries.ORACLES[name]).df())


def test_near_documents(spark, docs):
    base = " ".join(f"v{i}" for i in range(100)).split()
    more = []
    for k in range(60):  # a group of near copies, each with its own few words changed
        w = list(base)
        w[(7 * k) % 95] = f"new{k}"
        more.append(Row(doc_id=10_000 + k, text=" ".join(w)))
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more))
    rows = d.collect()
    sets = {r.doc_id: shingles(r.text) for r in rows}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(ids, pairs)
    got = minhash.near_documents(d).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (want[r.doc_id] == r.doc_id) for r in got)


def test_star_of_copies(spark):
    """One text and more variants of it than neighbours can meet; no variant links with another."""
    rng = np.random.default_rng(3)
    base, rows = [f"v{i}" for i in range(400)], []
    for k in range(700):
        w = list(base)
        for i in rng.choice(79, 10, replace=False):
            w[5 * i + 2] = f"new{k}x{i}"
        rows.append((k + 1, " ".join(w)))
    rows.insert(350, (1000, " ".join(base)))
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert pairs == [(k + 1, 1000) for k in range(700)]
    got = minhash.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict.fromkeys(ids, 1)


@pytest.mark.parametrize("size", [512, 7])
def test_near_documents_tile_by_tile(spark, monkeypatch, size):
    """Dense regions in pieces and tiles of any size: variants that link in chains, and a group of texts that are alike but don't link."""
    monkeypatch.setattr(minhash, "PIECE", size)
    monkeypatch.setattr(minhash, "TILE", size)
    monkeypatch.setattr(minhash, "FEW", 1)
    rng, rows = np.random.default_rng(5), []
    for group, changes in enumerate([4, 6, 9, 12]):
        base = [f"g{group}v{i}" for i in range(200)]
        for k in range(60):
            w = list(base)
            for i in rng.choice(39, changes, replace=False):
                w[5 * i + 2] = f"new{k}x{i}"
            rows.append((len(rows), " ".join(w)))
    sets = [shingles(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if plain.linked(sets[a], sets[b])]
    got = minhash.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == roots(range(len(rows)), pairs)


def test_text_ids(spark):
    """Ids of text and negative ids name components in their own order; null ids name none."""
    t = " ".join(f"w{i}" for i in range(40))
    rows = [("b", t), ("ab", t + " x"), (None, t + " y"), ("c", "other words"), (None, "more words")]
    got = minhash.near_documents(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted(str(r.component_id) for r in got) == ["None", "ab", "ab", "ab", "c"]
    rows = [(5, t), (-3, t + " x"), (-1, t + " y")]
    got = minhash.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {-3}


def test_drop_near_copies(spark, hard):
    """Row by row: a repeated id doesn't take a unique text with it, and of equal rows one stays."""
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(1, t, "a"), (3, t + " x", "b"), (3, "totally different words", "c"), (None, t + " y", "d"), (4, t, "e"), (7, "one more", "f"), (7, "one more", "g"), (8, "", "h"), (8, "", "i")]
    got = minhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, gone string")).collect()
    assert sorted(r.gone for r in got if r.doc_id != 7) == ["a", "c", "h", "i"] and len([r for r in got if r.doc_id == 7]) == 1
    assert same(minhash.drop_near_copies(hard), plain.near(as_rows(hard)))


def test_components(spark):
    """Several chunks, with a long chain and a star of links."""
    rng = np.random.default_rng(2)
    key = lambda i: b"%06d" % i
    links = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 700)] + [tuple(map(int, rng.integers(1000, 1400, 2))) for _ in range(250)]
    d = spark.createDataFrame([(key(a), key(b)) for a, b in links], "a binary, b binary")
    want = roots(range(1400), links)
    for chunk in (50, 10_000):
        got = {bytes(r.node): bytes(r.root) for r in graph.components(d, chunk=chunk).collect()}
        assert got == {key(i): key(want[i]) for a, b in links if a != b for i in (a, b)}


def test_repeats(docs):
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    n = collections.Counter(x[i : i + 200] for x in texts.values() for i in range(len(x) - 199))
    for r in substrings.without_repeats(docs).collect():
        x = texts[r.doc_id]
        hit = np.zeros(len(x) + 1, int)
        for i in range(len(x) - 199):
            if n[x[i : i + 200]] > 1:
                hit[i] += 1
                hit[i + 200] -= 1
        covered = np.cumsum(hit)[:-1] > 0
        kept = bytes(b for b, c in zip(x, covered, strict=True) if not c)
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(x), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_repeats_in_hot_buckets(docs, monkeypatch):
    want = {r.doc_id: r.kept_sha256 for r in substrings.without_repeats(docs).collect()}
    monkeypatch.setattr(substrings, "BUCKET", 1)
    assert {r.doc_id: r.kept_sha256 for r in substrings.without_repeats(docs).collect()} == want


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    rows = [(i, [float(x) for x in (base[i % 40] + rng.normal(size=16) * [0, 0.1, 0.25][i % 3]).astype(np.float32)], i % 2) for i in range(300)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, rows[0][1], None), (305, rows[2][1], 0), (306, [], 0)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    v = {i: np.array(e, float) for i, e, k in rows[:300] + [rows[305]]}
    label = {r[0]: r[2] for r in rows}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    pairs = [(a, b) for a in v for b in v if a < b and label[a] == label[b] and cos(v[a], v[b]) >= 0.98]
    n = collections.Counter(x for p in pairs for x in p)
    want = roots([r[0] for r in rows], pairs)
    for block in (2048, 16):
        got = vectors.near_vectors(d, block=block).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], c, c == i) for i, c in want.items()}


def test_quality_measures(spark, docs, hard):
    for d in (docs, hard):
        texts = collections.defaultdict(list)
        for r in d.collect():
            texts[r.doc_id].append(r.text or "")
        for r in quality.quality(d).collect():
            found = []
            for t in texts[r.doc_id]:
                w = WORD.findall(t)
                at = collections.defaultdict(list)
                for i in range(len(w) - 2):
                    at[tuple(w[i : i + 3])].append(i)
                repeat = len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)})
                lines = [x for x in t.split("\n") if WORD.search(x)]
                found.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat, len(w) < 50 or 100 * repeat > 50 * len(w)))
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in found
            assert not (r.kept and r.base_failed)


def test_quality_verdict(spark):
    d = quality.quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").join(d, "doc_id").filter("not base_failed").collect()
    clean, junk = [r.kept for r in labels if r.quality == 1], [r.kept for r in labels if r.quality == 0]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.2


def test_quality_of_other_scripts(spark, docs):
    """Letters without case count as plain ones, with the marks of scripts that write no spaces."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 3000, 6))
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**6, " ".join(f"{word()}，{word()}。" for _ in range(80)))], "doc_id long, text string"))
    r = quality.quality(d).filter("doc_id = 1000000").first()
    assert r.kept and r.p_good > 0.5


def test_personal_data(spark, docs):
    odd = ["a@b.com_x@y.org..z@q", "@@ a@b@c.d 1.2.3.4.5.6.7.8 01.002.0003.255", "4111 1111-1111 1111 22 1234567890123", "+1 (20) 555-0100 x +4 +12345678901234567", "😀 a@b.co", "a" * 50_000 + "@", "12-" * 5000]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in d.collect()}
    for r in pii.find_pii(d).collect():
        spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(plain.PII) for m in re.finditer(p, texts[r.doc_id]) if plain.valid(kind, m.group()))
        base = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), texts[r.doc_id][:80]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_disclosing_terms(spark):
    rows = [(1, "call zanzibar at a@b.co today"), (2, "mister zanzibar has a@b.co here"), (3, "today here mister"), (4, "only zanzibar"), (5, "c@d.org today")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(d).collect()}
    assert got == {1: "term:5:13,email:17:23", 2: "term:7:15,email:20:26", 3: "", 4: "term:5:13", 5: "email:0:7"}
    assert {r.text for r in pii.mask_pii(d).collect()} >= {"call <TERM> at <EMAIL> today", "only <TERM>"}


def test_disclosing_terms_in_copies(spark):
    """Copies count on both sides, and a term between two spans of one entity once."""
    texts = ["call zanzibar at a@b.co today"] * 3 + ["mister zanzibar has a@b.co here"] * 40 + ["c@d.org kwantum c@d.org"] * 2 + ["big kwantum c@d.org", "kwantum", "kwantum", "kwantum", "kwantum"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(d).collect()}
    assert got[0] == got[2] == "term:5:13,email:17:23" and got[3] == got[42] == "term:7:15,email:20:26"
    r = pii.disclosures(d.withColumn("base", pii.base_spans()), 4, 2, 10**6).filter("term = 'kwantum'").first()
    assert abs(r.pmi - r.ic - np.log2(3 / 7)) < 1e-9  # three of its seven occurrences stand beside the entity


def test_disclosing_terms_at_any_distance(spark):
    """Long terms, terms behind many digits, and runs of letters that go on into a span."""
    far, digits = "q" * 97, "1 2 " * 2000
    texts = [f"{far} {digits} a@b.co and more", f"see {far} a@b.co here", f"only a@b.co {digits} {far} here", "éééa@c.org one", "éééa@c.org two", "a@c.orgééé three"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = plain.disclosing(texts)
    assert far in terms
    got = {r.doc_id: r.spans for r in pii.find_pii(d).collect()}
    assert got == {i: ",".join(f"{x[3]}:{x[0]}:{x[2]}" for x in plain.spans(t, terms)) for i, t in enumerate(texts)}


def test_terms_of_documents(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    terms = plain.disclosing(list(texts.values()))
    for r in pii.find_pii(docs).collect():
        assert r.spans == ",".join(f"{x[3]}:{x[0]}:{x[2]}" for x in plain.spans(texts[r.doc_id], terms))


def test_html(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r for r in html.extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = " ".join(html_lib.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)
    side = "<body><nav>menu</nav><main><p>Some long enough text of the page stands here, in full.<div class='comments'>no</div><aside>no</aside><p>And &amp; more of it.</main><form>x</form></body>"
    assert html.main_text(side) == "Some long enough text of the page stands here, in full. And & more of it."
    assert [html.main_text(x) for x in (None, "", "<", "<p>", "<script>x", "plain text")] == ["", "", "<", "", "", "plain text"]


def test_html_regions():
    long, more = "A paragraph that is long enough to stand in a cluster of the page, it says.", "Another one of those, which also has many words between only two tags."
    assert html.main_text(f"<article><p>{long}</p></article><article><p>{more}</p></article>") == f"{long} {more}"
    assert html.main_text(f"<main><p>Intro.</p><article><p>{long}</p><article><p>Inner.</p></article></article><p>End.</p></main>") == f"Intro. {long} Inner. End."
    items = "".join(f"<li>i{k}</li>" for k in range(9))
    assert html.main_text(f"<body><p>{long}</p><ul>{items}</ul><p>{more}</p></body>") == " ".join([long, *(f"i{k}" for k in range(9)), more])
    for mark in ("layout has-sidebar", "page-with-sidebar", "no-menu", "sidebar"):
        assert html.main_text(f"<div class='{mark}'><article><p>{long}</p></article></div>") == long, mark
    assert html.main_text(f"<article><p>{long}</p></article><div class='related'><article><p>{more}</p></article></div><aside><article>{more}</article></aside>") == long


def test_html_unknown_sections():
    for odd in ("<![foo[x]]>", "<![ x>", "<![>", "<![1[>", "<!x y>", "<![CDATA[x]]>"):
        assert html.main_text(f"<article><p>a</p>{odd}<p>b</p></article>") == "a b", odd


def test_html_without_articles():
    """Clusters choose the content of a page without content elements."""
    long, more = "A paragraph that is long enough to stand in a cluster of the page, it says.", "Another one of those, which also has many words between only two tags."
    menu = "".join(f"<div><a href='/{x}'>{x}</a></div>" for x in ("Home", "News", "Contact"))
    for box in ("div", "section", "td", "main"):
        page = f"<body><div>{menu}</div><{box}><h1>Title</h1><p>{long}</p><p>Short.</p><p>{more} <a href='x'>link</a></p></{box}><div>{menu}</div><div>Imprint</div></body>"
        want = f"Title {long} Short. {more} link"
        assert html.main_text(page) == want, box
    assert html.main_text(f"<ul><li>a</li><li>b</li></ul><p>{long}</p>") == f"a b {long}"


def test_html_marks():
    long = "A paragraph that is long enough to stand in a cluster of the page, it says."
    inside = "<h1 class='post-header'>Title</h1><p class='market share'>Sales rose.</p><p class='ad-free'>No adverts.</p>"
    assert html.main_text(f"<article>{inside}<p>{long}</p></article>") == f"Title Sales rose. No adverts. {long}"
    assert html.main_text(f"<main><h1>Title</h1><p>Lead</p><article><p>{long}</p></article><p>Closing</p></main>") == f"Title Lead {long} Closing"
    for out in ("class='share-buttons'", "class='share clearfix'", "id=comments", "class='comment-list'", "class='ad'", "role=navigation", "class='cookie-banner'", "hidden"):
        assert html.main_text(f"<article><p>{long}</p><div {out}>gone</div></article>") == long, out
    assert html.main_text("<p>text <span class='ad'>BUY</span> more</p>") == "text more"
    assert html.main_text("<p>text <span class='ad'>BUY<br>NOW</span> more</p>") == "text more"
    assert html.main_text("<p>a<title>q") == html.main_text("<p>a<b q") == html.main_text("<p>a<!-- b <i> c") == "a"


def test_html_takes_linear_time():
    """Deep nesting and broken markup, of 20 000 to 100 000 elements."""
    began = time.time()
    for page in ("<div>" * 100_000 + "x", "<ul><li>" * 50_000 + "x", "<span>" * 30_000 + "<hr>" * 30_000 + "x", "<a " * 20_000, "<a href='" * 20_000 + "'>x", "<!--" * 20_000, "<![" * 20_000, "<" * 50_000):
        html.main_text(page)
    assert time.time() - began < 20


def tokens(rows, name=rollup.VOCABULARY.rsplit("/", 1)[-1]):
    """(source, lang, tokenizer) -> [documents, tokens, characters] of rows, by the library itself."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rollup.VOCABULARY, "rb"))}
    encode = tiktoken.Encoding("plain", pat_str=rollup.PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    out = collections.defaultdict(lambda: [0, 0, 0])
    for r in rows:
        x = out[r["source"], r["lang"], name]
        x[0] += 1
        x[1] += len(encode(r["text"] or ""))
        x[2] += len(r["text"] or "")
    return dict(out)


def totals(d):
    return {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens, r.n_chars] for r in d.collect()}


def test_rollup(spark, hard):
    """Insert, replay, revision, delete, a batch that breaks off, and two writers of one batch, against a plain count."""
    state = rollup.Rollups(spark, f"{queries.shared_folder(spark)}/t-{uuid.uuid4().hex}")
    assert state.totals().count() == 0 and not state.committed("b/1")
    counts, rows = written(rollup.with_tokens(hard), "t-counts"), as_rows(hard)
    assert state.commit("b/1", rollup.signed(counts, 1)) and not state.commit("b/1", rollup.signed(counts, 1))
    assert totals(state.totals()) == tokens(rows)
    state.commit("b2", rollup.signed(counts.filter("doc_id = 6"), -1))
    left = [r for r in rows if r["doc_id"] != 6]
    assert totals(state.totals()) == tokens(left)
    state.add("b3", rollup.signed(counts, 1))  # breaks off before its record
    assert not state.committed("b3") and totals(state.totals()) == tokens(left)
    new = hard.filter("doc_id = 9").withColumn("text", F.lit("a new text"))
    state.commit("b3", rollup.revised(counts.filter("doc_id = 9"), rollup.with_tokens(new)))
    left = [{**r, "text": "a new text"} if r["doc_id"] == 9 else r for r in left]
    assert totals(state.totals()) == tokens(left)
    for attempt in [state.add("b4", rollup.signed(counts.filter("doc_id = 10"), -1)) for _ in range(2)]:  # both saw the id free
        state.record("b4", attempt)
    assert totals(state.totals()) == tokens([r for r in left if r["doc_id"] != 10])
    # Another process finds what this one has written.
    assert totals(rollup.Rollups(spark, state.data.removesuffix("/data")).totals()) == totals(state.totals())


def test_corpus_rollup(spark, docs, hard):
    for d in (docs, hard, hard.limit(0)):
        rows = as_rows(d)
        got = rollup.corpus_rollup(d, f"{queries.shared_folder(spark)}/t-{uuid.uuid4().hex}").collect()
        distinct = {(r["source"], r["lang"], r["text"]): r for r in rows}.values()
        for state, of in (("all", rows), ("distinct", distinct)):
            assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens, r.n_chars] for r in got if r.state == state} == tokens(of)


def test_pieces(spark, docs, hard):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for d in (docs, hard):
        e = pieces.encode(d, keep=["text"])
        for r in e.collect():
            assert r.ids == model.encode(r.text or "") and r.round_trip
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()} == texts


def test_unigram_pieces():
    """The recurrence against all cuts of a word; the vocabulary is made up, no model is trained."""
    rng = np.random.default_rng(4)
    pool = ["<unk>", *"abc", "ab", "bc", "abc", "ca", "aab", "bcab", "cc"]
    for _ in range(20):
        scores = [0.0, *(-rng.random(len(pool) - 1) * 5 - 0.1)]
        v = pieces.Vocabulary(pool, scores, {}, set(), 0)
        assert not v.bpe
        score = dict(zip(pool[1:], scores[1:], strict=True))
        texts = sorted({"".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(40)})
        got = v.encode_sorted(texts)
        for w in texts:
            cuts = [[w[a:b] for a, b in zip([0, *c], [*c, len(w)], strict=True)] for k in range(2 ** (len(w) - 1)) for c in [[i + 1 for i in range(len(w) - 1) if k >> i & 1]]]
            total = {i: sum(score.get(p, min(score.values()) - pieces.UNKNOWN) for p in x) for i, x in enumerate(cuts) if all(p in score or len(p) == 1 for p in x)}
            best = [[pool.index(p) if p in score else 0 for p in cuts[i]] for i in total if total[i] >= max(total.values()) - 1e-9]
            assert got[w] in [[x for i, x in enumerate(ids) if x or ids[i - 1 : i] != [0]] for ids in best]


def as_rows(d):
    return [r.asDict() for r in d.collect()]


def same(d, rows):
    """Equal rows of d and plain rows, in the same columns; of equal ids and texts only these count."""
    got = sorted(map(str, ((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in as_rows(d))))
    assert not rows or d.columns == list(rows[0])
    return got == sorted(map(str, ((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in rows)))


def test_stages_on_hard_rows(spark, hard):
    """Each stage gives the plain version's rows on hard rows, in the same columns, and nothing on an empty table."""
    more = " ".join(f"Good plain words in a line of text number {w} here." for w in "one two three four five six seven eight nine ten".split())
    rows = [(100 + k, f"{more} {extra}", "en", "s", 1, "z", 1, "k", 2, *MORE) for k, extra in enumerate(["tail", "tail", "mail a@b.co", "and so on " * 400])]
    d = hard.unionByName(spark.createDataFrame(rows, DOCS))
    plainly = {"quality": plain.quality, "near_copies": plain.near, "personal_data": plain.masked, "mix": plain.mix}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, DATA)
        if name == "pieces":
            assert out.count() == d.count()
        else:
            assert out.columns == d.columns and same(out, plainly[name](as_rows(d))), name
        assert stage(spark, d.limit(0), DATA).count() == 0


def test_hard_rows(spark, hard):
    """Nothing crashes on hard rows or empty tables, and every row gets a row."""
    pages = spark.createDataFrame([(1, None, None), (None, "http://a.com/en/", ""), (2, "x", "<p>x"), (2, "x", "<p>x")], "page_id long, url string, html string")
    none = spark.createDataFrame([], hard.schema)
    for f in (minhash.near_documents, mixing.mix_sources, substrings.without_repeats, pieces.encode, quality.quality, pii.find_pii):
        assert f(hard).count() == hard.count(), f
        assert f(none).count() == 0, f
    rules = urls.rule_table(spark)
    for f in (html.extract_text, lambda d: urls.filter_urls(d, rules)):
        assert f(pages).count() == 4 and f(pages.limit(0)).count() == 0
    assert urls.filter_urls(pages, rules.limit(0)).filter("verdict = 'allow' and rule is null").count() == 4
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    clash = spark.createDataFrame([(1, "http://a.com/en/", "<p>x", "h", "p", "r", "t", 1)], "page_id long, url string, html string, host string, path string, rule string, text string, at int")
    assert html.extract_text(clash).first().text == "x" and urls.filter_urls(clash, rules).first().rule == "com/"
    clash = spark.createDataFrame([(1, [1.0], 0, "a", 2, 3, "o"), (2, [2.0], 0, "b", 2, 3, "o")], "vec_id long, embedding array<float>, label int, class_id string, weight int, dim int, own string")
    assert [r.component_id for r in vectors.near_vectors(clash).collect()] == [1, 1]


def test_hard_rows_in_full(spark, hard):
    """op1 and op6 on hard rows equal the plain version."""
    rows = as_rows(hard)
    sets = [shingles(r["text"]) for r in rows]
    at = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if plain.linked(sets[i], sets[j])])
    ids = collections.defaultdict(list)
    for i, root in at.items():
        if rows[i]["doc_id"] is not None:
            ids[root].append(rows[i]["doc_id"])
    want = sorted(str((r["doc_id"], len(sets[i]), min(ids[at[i]], default=None))) for i, r in enumerate(rows))
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in minhash.near_documents(hard).collect()) == want
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in rows]
    starts = collections.Counter(x[i : i + 200] for _, x in texts for i in range(len(x) - 199))
    want = []
    for i, x in texts:
        hit = np.zeros(len(x) + 1, int)
        for k in range(len(x) - 199):
            if starts[x[k : k + 200]] > 1:
                hit[k] += 1
                hit[k + 200] -= 1
        want.append(str((i, len(x), int((np.cumsum(hit)[:-1] > 0).sum()))))
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed)) for r in substrings.without_repeats(hard).collect()) == sorted(want)


def test_nested_rules(spark):
    """Many nested rules of a few hosts against a look at every rule."""
    rng = np.random.default_rng(8)
    step = lambda: "".join(rng.choice(["a/", "b/", "ä"], rng.integers(0, 5)))
    rules = sorted({(str(rng.choice(["com", "x.com", "y.x.com", "net"])), "/" * int(rng.integers(0, 2)) + step()) for _ in range(60)})
    rules = [(h, p, ["allow", "block"][k % 2]) for k, (h, p) in enumerate(rules)]
    urls_ = [(k, f"http://{rng.choice(['com', 'x.com', 'z.y.x.com', 'ax.com', 'net', 'q.net', 'org'])}/{step()}{step()}?q") for k in range(300)]
    want = {}
    for k, u in urls_:
        host, path = re.match(r"http://([^/]*)([^?]*)", u).groups()
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[k] = max(fits)[2:] if fits else (None, "allow")
    got = urls.filter_urls(spark.createDataFrame(urls_, "page_id long, url string"), urls.rule_table(spark, rules), run=20)
    assert {r.page_id: (r.rule, r.verdict) for r in got.collect()} == want


def test_mix_totals(docs):
    rows = mixing.mix_sources(docs).collect()
    taken, target = collections.Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-3


def test_pipeline(spark, docs):
    """run() against the stages in plain Python and the tokenizer's own library."""
    import sentencepiece

    rows = plain.mix(plain.masked(plain.near(plain.quality(as_rows(docs)))))
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = sorted(str((r["doc_id"], r["source"], r["lang"], model.encode(r["text"]))) for r in rows)
    got = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(str((r.doc_id, r.source, r.lang, list(r.ids))) for r in got) == want
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got)
