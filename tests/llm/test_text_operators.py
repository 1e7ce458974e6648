"""Substring dedup, n-gram join, quality rules and personal data against brute force, and their defined cases."""

import collections
import hashlib
import itertools
import re

from pyspark.sql import functions as F

from rankwell.llm import ngram_join, pii, quality_rules, substring_dedup
from rankwell.llm.frames import attach

DOC = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_substrings(rows, k=50):
    seen, out = {}, {}
    for doc, text in sorted(rows):
        w = WORD.findall(text or "")
        gone, mine = [False] * len(w), []
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            mine.append(key)
            if key in seen:
                gone[i:i + k] = [True] * k
        for key in mine:
            seen.setdefault(key, doc)
        out[doc] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_substring_dedup_matches_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, DOC).repartition(5)
    for k in (50, 12):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(df, min_words=k).collect()}
        assert got == brute_substrings(corpus, k)


def test_substring_dedup_defined_cases(spark, corpus):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, long + "\nmore words"), (2, long + "\nmore words"), (None, long), (3, None)]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, __data string, ranges string")
    out = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(df).collect())
    assert out == [(0, 60, 0), (1, 60, 0), (2, 62, 60), (2, 62, 60), (3, 0, 0)]
    cut = substring_dedup.cut_repeats(df)
    assert cut.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text), r.ranges) for r in cut.collect()) == sorted(
        [("None", long, "b"), ("1", long, "b"), ("2", "more words", "b"), ("2", "more words", "b"), ("3", "None", "b")])
    assert substring_dedup.substring_dedup(spark.createDataFrame([], DOC)).count() == 0
    spans = {r.doc_id: [(s.start, s.end) for s in r.removed] for r in substring_dedup.substring_dedup(df).collect() if r.doc_id}
    assert spans[2] == [(0, 60)] and spans[1] == []


def brute_ngrams(rows, n=4, percent=85):
    sets = {}
    for doc, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[doc] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_ngram_join_matches_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, DOC).repartition(3)
    for n, percent in ((4, 85), (2, 60), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df, n=n, percent=percent).collect()}
        assert got == brute_ngrams(corpus, n, percent)


def test_ngram_join_defined_cases(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(5, text, 1), (3, text, 2), (3, text, 2), (None, text, 3), (None, None, 4), (9, None, 5), (8, "", 6)],
                               "doc_id long, text string, key int")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).collect())
    assert got == sorted([("5", 37, 3), ("3", 37, 3), ("3", 37, 3), ("None", 37, 3), ("None", 0, None), ("9", 0, 9), ("8", 0, 8)], key=str)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "9", "None"]
    assert ngram_join.ngram_join(spark.createDataFrame([], DOC)).count() == 0


def test_keep_one_tells_documents_of_one_id_apart(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(1, one, "a"), (1, two, "b"), (2, one + " more", "c"), (2, "something else entirely of a few words", "d"), (1, one, "e"), (None, two, "f"), (None, None, "g")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, tag string, text_tag int, __kept int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("1", one), ("1", two), ("2", "something else entirely of a few words"), ("None", None)], key=str)


def test_needed_blocks_are_a_lower_bound():
    """Linked sets have as many blocks in common as both need, in all of them and in the probe blocks of any common order."""
    import numpy as np
    rng = np.random.default_rng(2)
    checked = 0
    for percent in (80, 85):
        for size in (9, 30, 70, 200, 900, 3000):
            for _ in range(40):
                a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
                change = int(len(a) * rng.uniform(0, (100 - percent) / 100))
                b = np.unique(np.concatenate((a[rng.permutation(len(a))[change:]], rng.integers(0, 2**63, int(rng.integers(0, change + 1)), dtype=np.uint64))))
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b) == both:
                    continue
                sides = [set(np.concatenate([ngram_join.class_blocks(v, c, percent) for c in ngram_join.set_classes(len(v), percent)]).tolist()) for v in (a, b)]
                needs = [ngram_join.needed_blocks(v, percent) for v in (a, b)]
                assert len(sides[0] & sides[1]) >= max(needs) >= 1
                order = {x: rng.random() for x in sides[0] | sides[1]}
                probes = [set(sorted(s, key=order.get)[:len(s) - n // 2]) for s, n in zip(sides, needs)]
                assert len(probes[0] & probes[1]) >= max(n - n // 2 for n in needs)
                checked += 1
    assert checked > 100


def test_blocks_never_miss_a_link():
    """Any two sets over the threshold agree in a block, whatever they differ in."""
    import numpy as np
    rng = np.random.default_rng(1)
    for size in (7, 9, 14, 25, 60, 200):
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            change = int(len(a) * rng.uniform(0, 0.17))
            b = np.unique(np.concatenate((a[rng.permutation(len(a))[change:]], rng.integers(0, 2**63, int(rng.integers(0, change + 1)), dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            if 100 * both < 85 * (len(a) + len(b) - both) or (len(a) == len(b) == both):
                continue

            def blocks(v):
                cls = int(np.searchsorted(ngram_join._CLASSES, len(v), side="right")) - 1
                out = set(ngram_join.class_blocks(v, cls, 85).tolist())
                if 100 * len(v) >= 85 * int(ngram_join._CLASSES[cls + 1]):
                    out |= set(ngram_join.class_blocks(v, cls + 1, 85).tolist())
                return out
            assert blocks(a) & blocks(b)


def test_quality_features_match_brute_force(spark, corpus):
    rows = corpus + [(500, "a # b*\n\na # b*\n \nx|y <z>"), (501, "UPPER!! CASE!! " * 30), (502, "a b c d e f g h " * 5)]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    for doc, text in rows:
        text = text or ""
        w = WORD.findall(text)
        n = len(w)
        count = collections.Counter(tuple(w[i:i + 8]) for i in range(n - 7))
        rep = {j for i in range(n - 7) if count[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep), n < 20 or 100 * len(rep) > 30 * n)
        assert not (r.base_failed and r.kept)
    assert not got[501].kept


def test_texts_without_common_words_are_rejected(spark):
    """Word salad in plain letters, short and long, and another language, in a language where most texts are prose or most are salad."""
    import random
    rng = random.Random(11)
    stem = lambda: "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(5, 8)))
    pick = lambda lang: rng.choice(quality_rules.COMMON_WORDS[lang]) if rng.random() < 0.21 else stem()
    prose = lambda n, lang="en": " ".join(pick(lang) for _ in range(n))
    salad = lambda n: " ".join(stem() for _ in range(n))
    good = [(i, prose(rng.choice([30, 60, 100, 300, 1000]))) for i in range(120)]
    junk = [(1000 + i, salad(n)) for i, n in enumerate([30, 50, 91, 200, 2000])] + [(2000, prose(400, "de"))]
    most = [(3000 + i, salad(400)) for i in range(150)]
    for rows in (good + junk, good + junk + most):
        df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
        kept = {r.doc_id for r in quality_rules.quality_rules(df).filter("kept").collect()}
        assert not kept & {i for i, _ in junk + most}
        assert len(kept) >= 119
        assert {r.doc_id for r in quality_rules.keep_quality(df).collect()} == kept


def test_js_distance_matches_numpy(spark):
    import numpy as np
    pairs = [([3, 0, 7], [1, 1, 8]), ([5, 5, 0], [0, 0, 9]), ([2, 2, 2], [2, 2, 2])]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    for (a, b), r in zip(pairs, df.select(quality_rules.js_distance(F.col("a"), F.col("b")).alias("d")).collect()):
        p, q = np.array(a) / sum(a), np.array(b) / sum(b)
        m = (p + q) / 2
        kl = lambda x: sum(v * np.log2(v / w) for v, w in zip(x, m) if v)
        assert abs(r.d - np.sqrt(max(0.0, (kl(p) + kl(q)) / 2))) < 1e-12
    empty = spark.createDataFrame([([0, 0], [1, 2])], "a array<long>, b array<long>")
    assert empty.select(quality_rules.js_distance(F.col("a"), F.col("b")).alias("d")).first().d is None


def test_quality_defined_cases(spark):
    schema = "doc_id long, text string, lang string, f string, lower string"
    df = spark.createDataFrame([(None, None, None, "a", "b"), (1, "", "xx", "a", "b"), (1, "", "xx", "a", "b"), (2, "word " * 10 + "other words here", "en", "a", "b")], schema)
    assert sorted(str(r.doc_id) for r in quality_rules.quality_rules(df).collect()) == ["1", "1", "2", "None"]
    assert quality_rules.keep_quality(df).columns == df.columns
    empty = spark.createDataFrame([], schema)
    assert quality_rules.quality_rules(empty).count() == 0 and quality_rules.keep_quality(empty).count() == 0


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


PII_TEXTS = ["+1 2 3-4(5)6.7 89 a@b.c_d@e.f x..@y.z 1.2.3.4.5.6.7.8 0000255.1.1.01 256.1.1.1 4111 1111-1111 1111 😀 z@q.r",
             "9" * 5000 + " " + "a" * 5000 + "@", " a@b " * 3, "", None, "1-" * 3000, "a.b@c." * 50, "+49 (0) 30 1234-567 + +1", "😀a@b.cd😀4539148803436467"]


def test_pii_base_spans_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(PII_TEXTS)), DOC)
    for r in pii.find_pii(df).collect():
        assert [(s.start, s.kind, s.end) for s in r.spans if s.base] == brute_pii(PII_TEXTS[r.doc_id] or "")


def test_addresses_with_zero_parts(spark):
    long = "0" * 3000
    texts = ["10.0.0.1", "0.0.0.0 and 127.0.0.1", "000.1.1.1 192.168.0.1", f"{long}.{long}1.{long}255.0", f"{long}256.0.0.0", "0.0.0.256 00.00.0300.0 1.0.0", "100.200.250.09"]
    df = spark.createDataFrame(list(enumerate(texts)), DOC)
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.base] for r in pii.find_pii(df).collect()}
    assert got == {i: brute_pii(t) for i, t in enumerate(texts)}
    assert [len([s for s in got[i] if s[1] == 1]) for i in range(len(texts))] == [1, 2, 2, 1, 0, 0, 1]
    assert pii.mask_pii(df).filter("doc_id = 1").first().text == "[IP] and [IP]"


def test_pii_added_spans_and_masks(spark):
    texts = ["Please contact Dr. Smith or call (555) 123-4567 now", "the and of it", "mail a@b.org, card 4111 1111 1111 1111", None]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = {r.doc_id: [(pii.KINDS[s.kind], texts[r.doc_id][s.start:s.end]) for s in r.spans] for r in pii.find_pii(df).collect()}
    assert found == {0: [("person", "Dr. Smith"), ("number", "(555) 123-4567")], 1: [], 2: [("email", "a@b.org"), ("card", "4111 1111 1111 1111")], 3: []}
    masked = pii.mask_pii(df)
    assert masked.columns == df.columns
    assert {r.doc_id: r.text for r in masked.collect()} == {
        0: "Please contact [PERSON] or call [NUMBER] now", 1: "the and of it", 2: "mail [EMAIL], card [CARD]", 3: None}
    assert pii.find_pii(spark.createDataFrame([], DOC)).count() == 0


def test_expectation_maximisation_finds_the_reliable_labelers():
    """Votes from labelers of known reliability: the estimates come close, and the posterior follows the good ones."""
    import random
    rng = random.Random(3)
    right = [0.95, 0.85, 0.8, 0.9]
    counts = collections.Counter()
    truth = collections.Counter()
    for _ in range(20000):
        true = rng.random() < 0.4
        votes = tuple((1 if true else 2) if rng.random() < p else (2 if true else 1) for p in right)
        counts[(0, 0, votes)] += 1
        truth[(0, 0, votes)] += true
    rows = sorted((k, s, v, n) for (k, s, v), n in counts.items())
    share, table, posterior = pii.estimate(rows)
    assert abs(share - 0.4) < 0.03
    assert all(abs(table[j][1][1] - p) < 0.03 for j, p in enumerate(right))
    wrong = sum(abs((p >= 0.5) * n - truth[(k, s, v)]) for p, (k, s, v, n) in zip(posterior, rows))
    assert wrong < 0.05 * 20000
    weights = pii.train(rows, posterior)
    assert len(weights) == pii.N_WEIGHTS and weights[4 + len(pii.KINDS) + 1] > 0


def test_attach_splits_hot_keys(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(5000)] + [(9999, None)]
    df = spark.createDataFrame(rows, "id long, k string")
    table = df.filter("k is not null").groupBy("k").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    got = {r.id: r.first for r in attach(df, table, "k", "n", 5000).collect()}
    want = {}
    for i, k in rows:
        if k is not None:
            want.setdefault(k, i)
    assert len(got) == 5001 and all(got[i] == (None if k is None else want[k]) for i, k in rows)


def test_sha_of_the_query_columns(spark, corpus, tmp_path):
    spark.createDataFrame(corpus, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    want = brute_substrings(corpus)
    for r in substring_dedup.op1_substring_dedup(spark, str(tmp_path)).collect():
        n, gone, text = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(text.encode()).hexdigest())
