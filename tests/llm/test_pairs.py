"""Near-duplicate operators against brute force."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbsight.llm import embedding_codes, license_scan, ngram_jaccard, phrase_dedup, simhash_scan
from .conftest import prose


def roots_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    groups = defaultdict(list)
    for i, r in enumerate(roots_of(len(rows), links)):
        groups[r].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return Counter(out)


def test_jaccard_components(docs, no_docs):
    got = Counter(tuple(r) for r in ngram_jaccard.jaccard_components(docs).collect())
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ngram_jaccard.jaccard_components(no_docs).count() == 0


def test_jaccard_chains_and_boundaries(spark):
    """Chains whose ends do not link, sets at and just below 75 %, and a dense group of near copies."""
    rng = random.Random(5)
    rows, base = [], prose(rng, 150).split()
    for k in range(40):  # each differs from the one before in one more place
        base = [*base]
        base[3 * k] = f"n{k}"
        rows.append((100 - k, " ".join(base)))
    word = lambda k: f"w{k}"
    for n in (7, 11, 14, 28, 56):  # n common shingles of n + 4 words, then other endings
        for more in (0, 1, 2, 4, 8, 9, 10):
            rows.append((1000 * n + more, " ".join([word(1000 * n + i) for i in range(n + 4)] + [word(90000 + 100 * n + 10 * more + i) for i in range(more)])))
    dense = prose(rng, 100).split()
    for k in range(60):
        copy = [*dense]
        for _ in range(2):
            copy[rng.randrange(100)] = f"d{rng.randrange(9)}"
        rows.append((5 + 200 * k, " ".join(copy)))
    got = Counter(tuple(r) for r in ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_components(rows)


def test_jaccard_families_in_blocks(spark, monkeypatch):
    """Groups of texts with one core, most pairs of which stay below 75 %, in many row blocks; with ids that repeat or are null."""
    monkeypatch.setattr(ngram_jaccard, "SPARSE", 2)
    monkeypatch.setattr(ngram_jaccard, "ROW_BLOCK", 900)
    monkeypatch.setattr(ngram_jaccard, "PIVOT_ROUNDS", 1)
    rng = random.Random(8)
    rows = []
    for g in range(3):
        core = prose(rng, 90).split()
        for k in range(70):
            copy = [*core]
            for _ in range(1 + k % 4):
                copy[rng.randrange(90)] = f"f{rng.randrange(40)}"
            rows.append((None if k % 9 == 0 else 1000 * g + k // 2, " ".join(copy)))
    got = Counter(tuple(r) for r in ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_components(rows)
    assert 10 < len({r[2] for r in got}) < 120


def test_jaccard_rows_without_an_id_meet_their_own_set_only(spark):
    rng = random.Random(9)
    base = prose(rng, 80).split()
    rows = [(None if k % 2 else 7, " ".join([*base[: k % 60], f"u{k}", *base[k % 60 :]])) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_code", F.xxhash64("text"))
    live = docs.select(F.col("doc_id").alias("rep"), F.col("text_code").alias("rep_code"), F.col("text_code").alias("sig"))
    assert ngram_jaccard._representatives(docs, live).count() == 1000
    got = ngram_jaccard.jaccard_components(docs)
    assert {tuple(r) for r in got.select("doc_id", "component_id").distinct().collect()} == {(None, 7), (7, 7)}


def test_repeated_windows(docs, no_docs, monkeypatch):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    places = Counter(tuple(w[i : i + 35]) for _, w in rows for i in range(len(w) - 34))
    want = Counter()
    for doc, w in rows:
        drop = [False] * len(w)
        for i in range(len(w) - 34):
            if places[tuple(w[i : i + 35])] > 1:
                drop[i : i + 35] = [True] * 35
        kept = b" ".join(x for x, d in zip(w, drop, strict=True) if not d)
        want[doc, len(w), sum(drop), sha256(kept).hexdigest(), kept.decode()] += 1
    assert Counter(tuple(r) for r in phrase_dedup.without_repeats(docs).collect()) == want
    assert phrase_dedup.without_repeats(no_docs).count() == 0
    monkeypatch.setattr(phrase_dedup, "HOT", 1)  # every anchor is hot then
    assert Counter(tuple(r) for r in phrase_dedup.without_repeats(docs).collect()) == want


def test_words_are_coded_once_for_the_anchors_and_not_again(monkeypatch):
    coded, word_codes = [], phrase_dedup.W.word_codes
    monkeypatch.setattr(phrase_dedup.W, "word_codes", lambda words: coded.append(len(words)) or word_codes(words))
    words = [f"w{i}" for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc": [5], "text": [" ".join(words)]})
    (anchors,) = phrase_dedup._anchors([batch])
    found = {n: anchors.column(n).to_pylist() for n in ("key", "start", "size")}
    assert sum(found["size"]) == 200 - phrase_dedup.WINDOW + 1
    lists = {f"{n}s": [found[n]] for n in ("key", "start", "size")}
    (sent,) = phrase_dedup._sent([pa.RecordBatch.from_pydict({"doc": [5], "text": [" ".join(words)], **lists, "hot": [[False] * len(found["key"])]})])
    ends = [s + n - 1 + phrase_dedup.WINDOW for s, n in zip(found["start"], found["size"], strict=True)]
    assert sent.column("text").to_pylist() == [" ".join(words[s:e]).encode() for s, e in zip(found["start"], ends, strict=True)]
    assert sent.column("key").to_pylist() == found["key"] and coded == [200]



def test_contaminations(spark, docs, no_docs, texts):
    rng = random.Random(9)
    items = {i: prose(rng, n) for i, n in enumerate((30, 45, 3, 24, 60))}
    items |= {7: None, 8: "", 9: items[0]}
    words = items[1].split()
    words[20] = "edited"
    rows = [(500, prose(rng, 50) + " " + items[0].upper() + " " + prose(rng, 10)), (501, prose(rng, 9) + " " + " ".join(words)), (502, "a b " + items[2]), (503, items[4][: len(items[4]) * 9 // 10])]
    more = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in simhash_scan.contaminations(more, bench).collect()}

    def brute(text, item):
        a, b = (text or "").encode().lower().split(), (item or "").encode().lower().split()
        if not a or not b:
            return 0.0
        bags = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
        size, want = min(len(a), len(b)), bags(b)
        near = [sum((x & want).values()) / sum((x | want).values()) for x in (bags(a[i : i + size]) for i in range(len(a) - size + 1))]
        return max(near)

    want = {(r.doc_id, str(i)): s for r in more.collect() for i, t in items.items() if (s := brute(r.text, t)) >= 0.75}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    left = simhash_scan.without_benchmark(more, bench)
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in more.collect() if r.doc_id not in {k[0] for k in want})
    assert simhash_scan.contaminations(no_docs, bench).count() == 0
    assert simhash_scan.contaminations(docs, bench.limit(0)).count() == 0


def test_hamming_blocks_find_all():
    rng = np.random.default_rng(0)
    items = simhash_scan.Items([(str(i), f"{i} a b c d e f g".encode()) for i in range(300)])
    items.prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for _ in range(50):
        flips = rng.choice(64, simhash_scan.RADIUS, replace=False)
        wanted = int(rng.integers(300))
        near = items.prints[wanted] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        assert wanted in items.near(8, near)


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(30):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):
                rows.append((k, (centre + rng.normal(size=16) * 0.12).tolist(), label))
                k += 1
    rows += [(k + i, rows[0][1], 0) for i in range(5)] + [(k + 5, [0.0] * 16, 0), (k + 6, None, 0), (k + 7, [float("nan")] * 16, 0), (k + 8, [1.0, None], 0), (k + 9, [1.0, 2.0], 1), (k + 10, [2.0, 4.0], 1), (k + 11, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("weight", embedding_codes.F.lit(1))
    got = {r.vec_id: r for r in embedding_codes.embedding_links(df).collect()}
    usable = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    links = []
    for i, (a, u, x) in enumerate(rows):
        for b, v, y in rows[:i]:
            if x is not None and x == y and usable(u) and usable(v) and len(u) == len(v) and np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.93:
                links.append((a, b))
    count = Counter(x for p in links for x in p)
    root = roots_of(len(rows), links)
    assert len(got) == len(rows)
    assert all(got[i].n_links <= count[i] for i in got) and sum(r.n_links for r in got.values()) >= 0.98 * 2 * len(links)
    assert sum(got[i].component_id == root[i] for i in got) >= 0.98 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert embedding_codes.embedding_links(df.limit(0)).count() == 0


def test_embedding_links_of_repeated_and_null_ids(spark):
    """Vectors, not ids, link: an id with two vectors does not join two groups, and null ids take part."""
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near = lambda v, e: [x + e * (i == 3) for i, x in enumerate(v)]
    rows = [(1, a, 0), (1, b, 0), (2, near(a, 0.05), 0), (3, near(b, 0.05), 0)]
    rows += [(None, a, 1), (7, near(a, 0.05), 1), (None, b, 1), (None, b, 1), (9, near(b, 2.0), 1), (9, near(b, 2.0), 1)]
    got = Counter(tuple(r) for r in embedding_codes.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == Counter([
        (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (None, 1, 7, False), (7, 1, 7, True),
        (None, 1, None, True), (None, 1, None, True), (9, 1, 9, True), (9, 1, 9, True)])


def test_codes_estimate_without_bias():
    """The estimator's mean over random rotations is the inner product."""
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(2, 64))
    u, v = u / np.linalg.norm(u), v / np.linalg.norm(v) * 0.6 + u / np.linalg.norm(u) * 0.5
    v /= np.linalg.norm(v)
    got = []
    for turn in range(400):
        p = embedding_codes.rotation(64, 1000 + turn)
        code = np.where(u @ p > 0, 1.0, -1.0)
        got.append(code @ (v @ p) / (code @ (u @ p)))
    assert abs(np.mean(got) - u @ v) < 0.02


def test_licenses(spark, docs, no_docs):
    rng = random.Random(2)
    names = license_scan.TEMPLATES
    rows = [(i, prose(rng, 40) + "\n" + t.upper() + "\n" + prose(rng, 200)) for i, t in enumerate(names.values())]
    long = names["MIT notice"].split()
    long[20:22] = ["other", "words"]
    rows.append((100, " ".join(long)))
    got = defaultdict(set)
    for r in license_scan.license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].add(r.license)
        assert 0.75 <= r.containment <= 1
    assert all(n in got[i] for i, n in enumerate(names)) and "MIT notice" in got[100]
    assert license_scan.license_matches(docs).count() == 0 and license_scan.license_matches(no_docs).count() == 0


def test_licenses_all_occurrences(spark):
    """Every occurrence is a row; variants of short lines and whole texts are found."""
    rng = random.Random(9)
    names = license_scan.TEMPLATES
    rows = [(1, prose(rng, 30) + " Licensed under the MIT License. " + prose(rng, 50) + " distributed under the MIT license"), (2, (names["MIT notice"] + "\n") * 3)]
    rows += [(3, prose(rng, 20) + names["GPL-3 text"] + prose(rng, 20)), (4, names["BSD-3-Clause text"] + prose(rng, 300) + names["BSD-3-Clause text"]), (5, "Shared under CC BY-SA 4.0.")]
    got = defaultdict(list)
    for r in license_scan.license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id, r.license].append((r.start, r.n_words))
    assert len(got[1, "MIT line: MIT License"]) == 2 and len(got[2, "MIT notice"]) == 3
    assert len(got[3, "GPL-3 text"]) == 1 and len(got[4, "BSD-3-Clause text"]) == 2 and len(got[5, "CC-BY-SA-4.0 line"]) == 1
    for found in got.values():
        found.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(found, found[1:], strict=False))
