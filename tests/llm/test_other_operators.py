"""Archives, tokenizer, vectors, language model, packing, pages and the pipeline: brute force, round trips, defined cases."""

import collections
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import zstandard

import corpus_pipeline
from rankwell.llm import embedding_dedup, html_text, kneser_ney, packing, sentencepiece_fst, warc

DOC = "doc_id long, text string"


# --- archives

ODD_PAGES = [
    (1, "http://a.example/x y", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"), (3, None, None), (4, "http://a.example/4", ""),
    (5, "http://a.example/5", "http://fake.example 0.0.0.0 20240101000000 text/html 3\nabc\r\n\r\nWARC/1.0\r\n"), (6, "u", "é😀\r\n\r\n" * 1000),
    (None, "http://a.example/n", "<p>one</p>"), (2, "http://a.example/2", "<p>two</p>"), (7, "http://b.example/", "x" * 3_000_000),
]


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, tmp_path, version):
    pages = spark.createDataFrame([(*p, "extra") for p in ODD_PAGES], "page_id long, url string, html string, date string").repartition(3)
    warc.write_arc(pages, str(tmp_path / "arc"), version)
    rows = warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc")).collect()
    first = {}
    for page, _, text in sorted(ODD_PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(text or "", page)
    want = sorted((str(p), warc.sha1_base32((t or "").encode()), len((t or "").encode()), "response" if first[t or ""] == p else "revisit",
                   None if first[t or ""] == p else first[t or ""]) for p, _, t in ODD_PAGES)
    assert sorted((str(r.page_id), r.payload_digest, r.payload_bytes, r.record_type, r.refers_to) for r in rows) == want
    assert {bytes(r.payload) for r in rows if r.payload is not None} == {(t or "").encode() for _, _, t in ODD_PAGES}
    assert len({r.record_id for r in rows}) == len(rows)
    assert all(r.date == "2024-01-01T00:00:00Z" for r in rows)
    assert "http://a.example/x%20y" in {r.url for r in rows} and "about:blank" in {r.url for r in rows}


def test_archives_empty_and_broken(spark, tmp_path):
    warc.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "arc"))
    assert warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc")).count() == 0
    head = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    good = b"filedesc://x 0.0.0.0 20200101 text/plain %d\n%s\nhttp://a 1.2.3.4 2020 text/plain 5\nhello\n" % (len(head), head)
    assert [(r["url"], r["block"]) for r in warc.arc_records(good)][1] == ("http://a", b"hello")
    for bad in (good[:-4], good.replace(b"text/plain 5", b"5"), good.replace(b"1 0 x", b"3 0 x")):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad))
    assert warc._timestamp("2020") == "2020-01-01T00:00:00Z"


# --- tokenizer

@pytest.mark.skipif(not os.path.exists(sentencepiece_fst.DEFAULT_MODEL), reason="no vocabulary file")
def test_transducer_equals_the_library(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.DEFAULT_MODEL)
    rng = random.Random(5)
    texts = ["", "  ", " a", "a  b   c    d", "\n\t\r x", "▁▁a▁", "日本語テキスト 🙂🙂 👩‍👩", "a" * 2000, " " * 2000, "x\0y", None]
    texts += ["".join(rng.choice("abcdeth ning  ▁\n.,é日🙂1230") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    encoded = sentencepiece_fst.encode(df)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert all(got[i] == (None if t is None else library.encode(t)) for i, t in enumerate(texts))
    for r in sentencepiece_fst.decode(encoded).collect():
        t = texts[r.doc_id]
        assert r.text == (None if t is None else library.decode(library.encode(t)))
        assert t is None or r.text == t.replace("▁", " ")
    there_and_back = {r.doc_id: r for r in sentencepiece_fst.round_trip(df).collect()}
    assert all(there_and_back[i].ids == got[i] and there_and_back[i].round_trip == (None if t is None else True) for i, t in enumerate(texts))
    assert sentencepiece_fst.encode(spark.createDataFrame([], DOC)).count() == 0
    assert sentencepiece_fst.round_trip(spark.createDataFrame([], DOC)).count() == 0
    table = sentencepiece_fst.Transducer(open(sentencepiece_fst.DEFAULT_MODEL, "rb").read())
    bad = [[200, 201, 300], [3 + 0xE9, 3 + 0x41, 260], [0, 1, 2, 400], [3 + 0xF0, 3 + 0x9F, 3 + 0x99]]
    assert [table.decode(x) for x in bad[:2] + bad[3:]] == [library.decode(x) for x in bad[:2] + bad[3:]]


# --- vectors

def brute_links(rows, cosine=0.98):
    good = [(i, np.array(v, dtype=float), label) for i, v, label in rows if i is not None and label is not None and v and None not in v
            and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    links, comp = collections.Counter(), {i: i for i, _, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for x in range(len(good)):
        for y in range(x):
            (i, v, a), (j, w, b) = good[x], good[y]
            if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                links[i] += 1
                links[j] += 1
                p, q = sorted((find(i), find(j)))
                comp[q] = p
    return {i: (links[i], find(i)) for i, _, _ in rows}


def test_lattice_decoder_is_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    got = embedding_dedup.nearest_e8(x)
    best = ((x - got) ** 2).sum(axis=1)
    for root in embedding_dedup.ROOTS:
        assert (((x - got - root) ** 2).sum(axis=1) >= best - 1e-12).all()
    assert len(embedding_dedup.ROOTS) == 240 and (best <= 1 + 1e-12).all()


def test_vectors_recall_and_defined_cases(spark):
    rng = np.random.default_rng(2)
    rows = []
    for group in range(60):
        centre = rng.normal(size=64)
        centre /= np.linalg.norm(centre)
        rows += [(len(rows) + k, [float(np.float32(x)) for x in centre + rng.normal(size=64) * 0.0125], group % 3) for k in range(12)]
    copies = [(1000 + i, rows[0][1], rows[0][2]) for i in range(3)]
    odd = [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 64, 1), (2003, [float("nan")] * 64, 1), (2004, [None] + [1.0] * 63, 1), (2005, rows[0][1], None),
           (2006, rows[0][1][:10], rows[0][2]), (2007, [2 * x for x in rows[0][1]], rows[0][2]), (2008, [float("inf")] * 64, 1)]
    every = rows + copies + odd
    df = spark.createDataFrame([(*r, "x") for r in every], "vec_id long, embedding array<float>, label int, key string")
    got = {r.vec_id: r for r in embedding_dedup.embedding_links(df).collect()}
    want = brute_links([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in every])
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(n for n, _ in want.values()) > 5000
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.99 * len(want)
    for i in (2000, 2001, 2002, 2003, 2004, 2005, 2006, 2008):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[2007].component_id == got[0].component_id == 0 and got[0].kept and not got[1000].kept
    assert embedding_dedup.embedding_links(spark.createDataFrame([], df.schema)).count() == 0


def test_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.001]), (3, [0.001, 1.0])]
    out = embedding_dedup.embedding_links(spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_tiles_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in centre + rng.normal(size=16) * 0.01], 1) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_links(df).collect()}
    assert got == brute_links(rows)


# --- language model

def brute_kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney from its definition: p(byte | bytes before)."""
    grams = collections.Counter()
    for t in texts:
        raw = bytes(order - 1) + b" ".join(t.encode().split())
        for i in range(len(raw) - order + 1):
            grams[raw[i:i + order]] += 1
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    discounts, inside = {}, {}
    for k, table in tables.items():
        n = collections.Counter(table.values())
        y = n[1] / max(n[1] + 2 * n[2], 1)
        discounts[k] = [max(0.1, min(i - 0.1, i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i)) for i in (1, 2, 3)]
        inside[k] = collections.defaultdict(list)
        for g, c in table.items():
            inside[k][g[:-1]].append(c)

    def p(gram, k):
        if k == 0:
            return 1 / 256
        below = p(gram[1:], k - 1)
        counts = inside[k].get(gram[:-1])
        if counts is None:
            return below
        d = discounts[k]
        mass = sum(d[min(c, 3) - 1] for c in counts) / sum(counts)
        c = tables[k].get(gram, 0)
        return (max(0, c - d[min(c, 3) - 1]) / sum(counts) if c else 0) + mass * below

    def score(t):
        raw = bytes(order - 1) + b" ".join(t.encode().split())
        return -float(np.mean([np.log2(p(raw[i:i + order], order)) for i in range(len(raw) - order + 1)]))
    return score


def test_perplexity_matches_the_definition(spark):
    rng = random.Random(4)
    en = [" ".join(rng.choice("the of and to in that is was he for".split()) for _ in range(40)) for _ in range(12)]
    de = [" ".join(rng.choice("der die das und nicht ein über".split()) for _ in range(30)) for _ in range(6)]
    rows = [(i, t, "en") for i, t in enumerate(en)] + [(100 + i, t, "de") for i, t in enumerate(de)]
    rows += [(200, "xqz zzq !!## 12345 " * 10, "en"), (201, "", "en"), (202, None, "de"), (203, "the of", "fr"), (204, "the of", None), (None, en[0], "en"),
             (200, "the of and", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, block string")
    labels = spark.createDataFrame([(i, 1) for i in range(8)] + [(100 + i, 1) for i in range(4)] + [(8, 0), (None, 1)], "doc_id long, quality int")
    out = kneser_ney.perplexity_filter(docs, labels).collect()
    score = {"en": brute_kneser_ney(en[:8], kneser_ney.ORDER), "de": brute_kneser_ney(de[:4], kneser_ney.ORDER)}
    assert len(out) == len(rows)
    for i, text, lang in rows:
        match = [r for r in out if r.doc_id == i and r.n_bytes == len(b" ".join((text or "").encode().split()))]
        assert match
        if lang in score and text:
            assert abs(match[0].score - score[lang](text)) < 1e-9
        else:
            assert match[0].score is None and match[0].kept == bool(text)
    junk = [r for r in out if r.doc_id == 200 and r.n_bytes > 50]
    assert not junk[0].kept and all(r.kept for r in out if r.doc_id is not None and r.doc_id < 12)
    empty = docs.limit(0)
    assert kneser_ney.perplexity_filter(empty, labels.limit(0)).count() == 0


def test_junk_does_not_move_the_threshold(spark, monkeypatch):
    """More junk than prose in a language, and a sample that is smaller than the frequent language's trusted texts."""
    monkeypatch.setattr(kneser_ney, "TRUSTED_DOCS", 20)
    rng = random.Random(12)
    prose = lambda words, n: " ".join(rng.choice(words.split()) for _ in range(n))
    rows = [(i, prose("the of and to in that is was he for", 60), "en") for i in range(60)]
    rows += [(100 + i, prose("der die das und nicht ein", 60), "de") for i in range(6)]
    rows += [(200 + i, "".join(rng.choice("xqzjkvw0123456789 #") for _ in range(300)), "en") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(40), *range(100, 103)]], "doc_id long, quality int")
    out = {r.doc_id: r for r in kneser_ney.perplexity_filter(docs, labels).collect()}
    assert len(out) == len(rows) and {i for i, r in out.items() if r.kept} == {i for i, _, _ in rows if i < 200}
    assert all(out[100 + i].score is not None for i in range(6))
    base = docs.selectExpr("doc_id", "xxhash64(lang) as lang")
    sample = kneser_ney._sample(base, labels, "quality = 1").collect()
    assert len(sample) == 20 and {100, 101, 102} < {r.doc_id for r in sample}


def test_all_trusted_documents_train_the_model(spark):
    """The sample that a caller does not ask for is all of them, whatever their number."""
    base = spark.range(25_000).selectExpr("id as doc_id", "xxhash64('en') as lang")
    labels = base.selectExpr("doc_id", "1 as quality")
    assert kneser_ney._sample(base, labels, "quality = 1").count() == 25_000


# --- packing

def brute_best_fit(items, capacity):
    bins, out = [], []
    for size, source, cluster in items:
        fit = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= size and (source is None or source not in b["sources"]) and cluster not in b["clusters"]]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "sources": set(), "clusters": set()})
        bins[i]["left"] -= size
        bins[i]["sources"].add(source)
        bins[i]["clusters"].add(cluster)
        out.append(i)
    return out


def test_best_fit_equals_the_plain_search():
    rng = random.Random(6)
    for _ in range(20):
        items = sorted(((rng.randint(1, 100), rng.choice([None, "a", "b", "c", "d", "a", "a"]), rng.randint(0, 40)) for _ in range(200)), key=lambda x: -x[0])
        assert packing.best_fit(*map(list, zip(*items)), 100) == brute_best_fit(items, 100)


def test_packing_with_a_column_of_its_own_names(spark):
    docs = spark.createDataFrame([(1, "a b c", "k", 7), (2, "d e f", "k", 7), (3, "g", None, 8)], "doc_id long, text string, words string, size int")
    out = {r.doc_id: r for r in packing.pack(docs, source_col=None, cluster_col="words").collect()}
    assert len(out) == 3 and out[1].bin_id != out[2].bin_id and [out[i].length for i in (1, 2, 3)] == [3, 3, 1]


def test_packing_covers_every_word_once(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(rng.choice([0, 1, 7, 30, 64, 65, 200]))), rng.choice(["a", "b", None, "a"]), "z") for i in range(300)]
    rows += [(5000 + i, "same text here", f"s{i}", "z") for i in range(20)] + [(6000, None, "a", "z"), (None, "null id", "a", "z"), (7, "again 7", "a", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, cluster string").repartition(4)
    packed = packing.pack(df, capacity=64, shard_items=100).collect()
    covered = collections.Counter()
    bins = collections.defaultdict(list)
    source = {i: s for i, _, s, _ in rows if i != 7}
    for r in packed:
        covered[r.doc_id] += r.length
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
        else:
            assert r.length == 0
    want = collections.Counter()
    for i, t, _, _ in rows:
        want[i] += len((t or "").split())
    assert all(covered[i] == n for i, n in want.items()) and {r.doc_id for r in packed} == set(want)
    for members in bins.values():
        assert 0 < sum(r.length for r in members) <= 64
        taken = [source[r.doc_id] for r in members if source.get(r.doc_id)]
        assert len(taken) == len(set(taken))
        assert sum(r.doc_id is not None and 5000 <= r.doc_id < 6000 for r in members) <= 1
    unique = df.filter("doc_id < 5000 and doc_id <> 7")
    texts = packing.bin_texts(unique, packing.pack(unique, capacity=64)).collect()
    assert sorted(w for r in texts for w in r.text.split()) == sorted(w for i, t, _, _ in rows if i is not None and i < 5000 and i != 7 for w in t.split())
    assert packing.pack(df.limit(0)).count() == 0


# --- pages

PAGE = ('<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><a>menu</a></nav><!-- ad --><div class="ad">buy</div>'
        "<article><h1>A &amp; B</h1><p>one <i>t</i>wo<p>three<br>four &lt;x&gt;<ul><li>x<li>y</ul><form>q</form></article>"
        '<section id="comments"><p>c</p></section><footer>f</footer></body></html>')


def test_main_text_rules():
    assert html_text.main_text(PAGE) == "A & B one two three four <x> x y"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("plain  text\n with &eacute; &#33; & 1 < 2") == "plain text with é ! & 1 < 2"
    assert html_text.main_text("<div class='sidebar'>s</div><p>unclosed <b>bold<p>next</div></p>") == "unclosed bold next"
    assert html_text.main_text("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert html_text.main_text("<p>" + "a " * 200000) == ("a " * 200000).strip()
    assert html_text.main_text('<p title="a > b">x</p><p class=\'c" d\'>y</p><p z="unclosed>z</p>').startswith("x y")
    assert html_text.main_text("<body><header>h</header><div role=main><p>a</p></div><p>b</p></body>") == "a"


def test_names_that_only_contain_a_telling_word():
    page = ('<article><h1 class="page-header">Title</h1><div class="legal-history">The law of 1832</div><p class="search-theory">Search theory</p>'
            '<div class="share-price">Shares rose</div><div class="site-footer">gone</div><div class="comment-list"><p>a reader</p></div>'
            '<div class="related-reading"><a href="x">more of this</a> <a href="y">and that</a></div><div id="ad3">buy</div><section class="ad">buy</section></article>')
    assert html_text.main_text(page) == "Title The law of 1832 Search theory Shares rose"


def brute_subtrees(node):
    """(serialised subtree, is a container) of every element; a node is (tag, class, [texts and nodes])."""
    tag, name, inside = node
    out, parts = [], []
    for x in inside:
        if isinstance(x, str):
            parts.append("t" + x)
        else:
            below = brute_subtrees(x)
            out += below
            parts.append("e" + below[-1][0])
    return out + [(repr((tag, name, parts)), tag in html_text.CONTAINER)]


def brute_site_text(node, gone):
    """Blocks of a tree without the container subtrees in ``gone``."""
    if brute_subtrees(node)[-1] in gone:
        return []
    out = []
    for x in node[2]:
        out += [x] if isinstance(x, str) else brute_site_text(x, gone)
    return out


def test_random_sites_against_counted_subtrees(spark):
    rng = random.Random(17)

    def tree(depth, words):
        if depth == 0 or rng.random() < 0.3:
            return ("p", "", [" ".join(rng.choice(words) for _ in range(3))])
        return (rng.choice(["div", "section", "ul", "table"]), rng.choice(["", "x", "yy"]), [tree(depth - 1, words) for _ in range(rng.randint(1, 3))])

    def write(node):
        return f'<{node[0]} class="{node[1]}">' + "".join(x if isinstance(x, str) else write(x) for x in node[2]) + f"</{node[0]}>"

    rows, want = [], {}
    for site in range(4):
        shared = [tree(2, [f"menu{site}", "home", "about"]) for _ in range(4)]
        pages = []
        for _ in range((3, 5, 12, 30)[site]):
            parts = [t for t in shared if rng.random() < 0.7] + [tree(2, [f"w{rng.randint(0, 10**6)}" for _ in range(20)]) for _ in range(2)]
            rng.shuffle(parts)
            pages.append(("body", "", parts))
        pages.append(pages[0])
        seen = collections.Counter(x for page in {repr(p): p for p in pages}.values() for x in set(brute_subtrees(page)))
        distinct = len({repr(p) for p in pages})
        gone = {x for x, n in seen.items() if x[1] and n >= html_text.MIN_PAGES and n >= html_text.SHARE * distinct}
        for page in pages:
            want[len(rows)] = " ".join(brute_site_text(page, gone))
            rows.append((len(rows), f"http://s{site}.example/", write(page)))
    out = html_text.html_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {r.page_id: r.text for r in out} == want
    assert any(len(w.split()) < len(re.sub("<[^>]*>", " ", h).split()) for w, (_, _, h) in zip(want.values(), rows))


def test_site_templates_are_removed_per_host(spark):
    body = lambda i: f'<div class="box"><p>Read our site</p><p>every day</p></div><div class="story"><p>story {i} text</p></div>'
    rows = [(i, f"http://www.a.example/{i}", body(i)) for i in range(12)]
    rows += [(100 + i, f"http://b.example/{i}", body(i)) for i in range(2)]
    rows += [(200 + i, f"http://c.example/{i}", '<div class="story"><p>copied</p></div>') for i in range(30)]
    rows += [(300, None, None), (301, "http://a.example/", ""), (None, "http://www.a.example/n", body(99)), (0, "http://www.a.example/0", body(0))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    out = html_text.html_text(df).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    got = {r.page_id: r.text for r in out}
    assert all(got[i] == f"story {i} text" for i in range(12)) and got[None] == "story 99 text"
    assert all(got[100 + i] == f"Read our site every day story {i} text" for i in range(2))
    assert all(got[200 + i] == "copied" for i in range(30)) and got[300] == got[301] == ""
    assert html_text.html_text(df.limit(0)).count() == 0


# --- pipeline

def test_pipeline_stages(spark, corpus, tmp_path):
    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice("the of and to in is that for it was on thing stone river house light".split()) for _ in range(n))
    rows = [(i, prose(80) + ".", "en", f"s{i % 5}", 0) for i in range(30)]
    rows.append((40, rows[0][1] + " more", "en", "s1", 0))
    passage = " ".join(f"passage{j}" for j in range(60))
    rows += [(41, prose(60) + " " + passage, "en", "s2", 0), (42, prose(60) + " " + passage + " end", "en", "s3", 0)]
    rows += [(43, "JUNK!! ###$$$ %%% *** " * 30, "en", "s4", 0), (44, "too short", "en", "s4", 0), (45, prose(50) + " mail x.y@mail.example.com now", "en", "s0", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in docs.collect()}
    every = {r[0] for r in rows}
    assert set(seen["quality_rules"]) == every - {43, 44}
    assert set(seen["ngram_join"]) == every - {40, 43, 44}
    assert "passage1" in seen["substring_dedup"][41].text and "passage1" not in seen["substring_dedup"][42].text
    assert seen["substring_dedup"][42].text.endswith(" end")
    assert seen["pii"][45].text.endswith("mail [EMAIL] now")
    assert set(seen["packing"]) == set(seen["pii"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])


def test_pipeline_near_copies_by_five_words(spark, tmp_path):
    """One word of 50 differs: 41 of 51 five-word shingles agree (0.804), 43 of 51 four-word ones (0.843). Of 48: 39 of 49 (0.796)."""
    rows = []
    for first, n in ((1, 50), (11, 48)):
        words = [f"w{first}x{j}" for j in range(n)]
        rows += [(first, " ".join(words)), (first + 1, " ".join([*words[:24], "other", *words[25:]]))]
    docs = spark.createDataFrame(rows, DOC)
    near = dict(corpus_pipeline.STAGES)["ngram_join"]
    assert {r.doc_id for r in near(spark, docs, str(tmp_path)).collect()} == {1, 11, 12}


def test_grams_of_a_block_are_told_once():
    """A block's texts come in several batches; each of its grams leaves the task once, and blocks are kept apart."""
    z = zstandard.ZstdCompressor()
    texts = [(1, b"abc abc"), (1, b"abc abc"), (1, None), (2, b"abc abc"), (2, b""), (2, b"xyz")]
    batches = [pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([None if t is None else z.compress(t)], pa.binary())],
                                          names=["block", "packed"]) for b, t in texts]
    got = [(b, g) for out in kneser_ney._block_grams(iter(batches)) for b, g in zip(*(c.to_pylist() for c in out.columns))]
    want = {(b, int(g)) for b, t in texts for g in kneser_ney.grams(t)}
    assert len(got) == len(set(got)) and set(got) == want
    assert list(kneser_ney._block_grams(iter([]))) == []
