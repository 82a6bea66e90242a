"""Classifier, language model, mixing, token files, chat and the pipeline."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kerbsight.llm import chat_roles, huffman, lm_trie, mixing, quality
from .conftest import prose
from .test_pairs import brute_components, roots_of, shingles


# --------------------------------------------------------------------------------- mixing
def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while True:
        rest = total - sum(target[s] for s in order if s not in open_)
        for s in open_:
            target[s] = rest * weight[s] / sum(weight[x] for x in open_)
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
        open_ -= over


def test_mix(docs, no_docs):
    rows = mixing.taken_words(docs).collect()
    sources = defaultdict(list)
    size = defaultdict(int)
    for r in docs.collect():
        n = len((r.text or "").encode().split())
        sources[r.doc_id, n].append(r.source)
        size[r.source] += n
    assert Counter((r.doc_id, r.size) for r in rows) == Counter({k: len(v) for k, v in sources.items()})
    want, taken = brute_targets(size), defaultdict(int)
    by_target = {(size[s], round(want[s], 6)): s for s in size}
    for r in rows:
        s = by_target[r.source_size, round(r.target, 6)]
        taken[s] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    assert sorted(map(str, mixing.taken_words(docs.repartition(5)).collect())) == sorted(map(str, rows))
    assert mixing.taken_words(no_docs).count() == 0


def test_mix_draws(docs):
    draws, _ = mixing.mix(docs, shards=8)
    draws = draws.collect()
    whole = mixing.mixed_documents(docs, 8).collect()
    assert len(whole) == len(draws) and set(whole[0].asDict()) == set(docs.columns)
    assert Counter((r.doc_id, r.source, len((r.text or "").encode().split())) for r in whole) == Counter((r.doc_id, r.source, r.taken) for r in draws)
    assert {r.shard for r in draws} <= set(range(8, 16))


def test_tree_splits_exactly(spark):
    drawn = spark.range(997).select(F.when(F.col("id") < 300, "a").otherwise("b").alias("source"), "id")
    got = mixing.shard_quotas(drawn, 8).collect()
    assert {s: sum(r.quota for r in got if r.source == s) for s in "ab"} == {"a": 300, "b": 697}
    per_shard = defaultdict(int)
    for r in got:
        per_shard[r.shard] += r.quota
    assert len(per_shard) == 8 and max(per_shard.values()) - min(per_shard.values()) <= 1
    assert all(25 <= r.quota <= 50 for r in got if r.source == "a")  # 37.5 expected


# -------------------------------------------------------------------------------- quality
def test_quality(spark, docs, no_docs):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = prose(rng, rng.randrange(20, 200))
        if bad:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", " | "), "ab " * 90, text.replace(" ", "### ")][rng.randrange(4)]
        rows.append((i, text))
        if i % 3:
            marks.append((i, None if i % 50 == 1 else 1 - bad, 0))
    marks += [(7, 1, 0), (10_000, 1, 1), (None, 0, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.quality_scores(table, labels).collect() if r.doc_id is not None and r.doc_id >= 100}
    assert all(r.held_out == (crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for k, r in got.items())
    held = [k for k, r in got.items() if r.held_out]
    assert sum(got[k].predicted == (k % 5 != 0) for k in held) >= 0.97 * len(held)
    assert quality.quality_scores(no_docs, labels).count() == 0
    plain = quality.quality_scores(docs, labels.limit(0)).collect()
    assert len(plain) == docs.count() and {r.predicted for r in plain} == {1}
    kept = quality.keep_good(table.withColumn("lang", F.lit("x")), labels)
    assert kept.columns == ["doc_id", "text", "lang"] and {r.doc_id for r in kept.collect()} >= {k for k, r in got.items() if r.predicted}


def test_pooled():
    assert quality._pooled(np.array([1.0, 0.0, 2.0, 1.0, 5.0]), np.ones(5)).tolist() == [0.5, 0.5, 1.5, 1.5, 5.0]


# --------------------------------------------------------------------------- language model
def brute_lm(rows, frequent=lm_trie.FREQUENT):
    train = [t for d, t in rows if d is None or crc32(str(d).encode()) % 5 != 1]
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    one, two = Counter(), Counter()
    for t in train:
        w = tokens(t)
        one.update(w)
        two.update(zip(["<s>", *w], w, strict=False))
    n, v = sum(one.values()), len(one)
    count = lambda x: len(train) if x == "<s>" else one[x]
    floor = sorted(one.values())[-frequent] if len(one) >= frequent else 1
    out = []
    for d, t in rows:
        w = tokens(t)
        base = score = 0.0
        for before, x in zip(["<s>", *w], w, strict=False):
            p = (one[x] + 0.5) / (n + 0.5 * (v + 1))
            m = 3.0 * max(count(before), floor) ** 0.8
            base += math.log10(p)
            score += math.log10((two[before, x] + m * p) / (count(before) + m))
        out.append((d, d is not None and crc32(str(d).encode()) % 5 == 1, len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_lm(docs, no_docs, monkeypatch, small):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    if small:  # wide words and several chunks
        monkeypatch.setattr(lm_trie, "SHARD", 400)
        monkeypatch.setattr(lm_trie, "CHUNK", 700)
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    got = sorted((tuple(r) for r in lm_trie.lm_scores(docs).collect()), key=key)
    want = sorted(brute_lm(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 and abs(g[6] - w[6]) < 1e-3 * max(1, w[2]) for g, w in zip(got, want, strict=True))
    if not small:
        assert lm_trie.lm_scores(no_docs).count() == 0


def test_lm_rare_contexts(docs, monkeypatch):
    """Contexts beyond the frequent ones have their exact counts."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_lm(rows)
    monkeypatch.setattr(lm_trie, "FREQUENT", 20)
    monkeypatch.setattr(lm_trie, "CHUNK", 700)
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    got = sorted((tuple(r) for r in lm_trie.lm_scores(docs).collect()), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want, key=key)]
    assert all(abs(g[6] - w[6]) < 1e-3 * max(1, w[2]) for g, w in zip(got, sorted(want, key=key), strict=True))


def test_lm_held_out_likelihood(spark):
    """log10 a token of the texts kept out of training at sf0.01: -4.129 by words alone, -3.608 when every context weighed 0.1, -3.526
    with the number of different followers (Witten-Bell) for m(v)."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base, score = lm_trie.lm_scores(table).where("held_out").agg(F.sum("base_score") / F.sum("n_tokens"), F.sum("score") / F.sum("n_tokens")).first()
    assert abs(base + 4.129) < 0.001 and -3.53 < score < -3.50


def test_gains_are_not_cut(tmp_path):
    """Gains beyond those of any table here (10 needs some 1e11 tokens) come back within half a step."""
    words, before = np.arange(3, 9, dtype=np.uint64), np.arange(6, dtype=np.uint64)
    for gains in (np.array([0, 0.5, 9.9, 10.5, 14.25, 17]), np.zeros(6), np.full(6, 1e-5)):
        trie = lm_trie.Trie(words, before, gains, tmp_path)
        assert np.abs(trie.gain(words, before) - gains).max() <= max(1, gains.max()) / 65535 / 2 + 1e-12


def test_one_pair_is_most_of_all_tokens(spark):
    """A pair in nine of ten tokens, against brute force."""
    rows = [(k, "of the " * 400 + f"x{k} y") for k in range(40)] + [(100 + k, prose(random.Random(k), 30)) for k in range(20)]
    key = lambda r: (r[0], r[2])
    got = sorted((tuple(r) for r in lm_trie.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=key)
    want = sorted(brute_lm(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[6] - w[6]) < 1e-3 * w[2] for g, w in zip(got, want, strict=True))


def test_elias_fano(tmp_path):
    rng = np.random.default_rng(2)
    for universe, n in ((1 << 40, 5000), (900, 800), (10, 1), (1 << 30, 0), (5000, 5000)):
        values = np.sort(rng.integers(0, universe, n))
        held = lm_trie.EliasFano(values, universe, tmp_path, f"v{universe}")
        if n:
            assert (held.at(np.arange(n)).astype(np.int64) == values).all()
        ask = np.r_[rng.integers(0, universe, 3000), values, 0]
        place, found = held.successor(ask)
        if n:
            assert (place == np.searchsorted(values, ask)).all() and (found == np.isin(ask, values)).all()
        else:
            assert not found.any()


# ----------------------------------------------------------------------------- token files
def test_token_files(spark, docs, no_docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["<|endoftext|> x<|startoftext|>y", "İstanbul ΣΑΣ ﬁ", "it's 12 o'clock!!! áé", "日本語 テキスト \x85  z", "﻿a\x00b\x1c"]
    table = spark.createDataFrame([(900 + i, t) for i, t in enumerate(odd)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    folder = str(tmp_path / "files")
    huffman.write_ids(table, path, folder)
    tokenizer = Tokenizer.from_file(path)
    rows = sorted(((r.doc_id, r.text) for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in huffman.id_digests(spark, folder).orderBy("start").collect()]
    assert got == want
    read = {r.doc_id: r.ids for r in huffman.read_ids(spark, folder).collect()}
    assert read[900] == [*tokenizer.encode(odd[0], add_special_tokens=False).ids, 1]
    huffman.write_ids(no_docs, path, folder + "0")
    assert huffman.id_digests(spark, folder + "0").count() == 0


def test_any_tokenizer_gives_its_own_ids(spark, docs, tmp_path):
    """One that does not cut at white space takes whole texts; one id with many rows; too large a vocabulary is refused."""
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), f"file:{tmp_path}/ids"
    many = docs.select("doc_id", "text").unionByName(spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("a  row \n of "), "id").alias("text")))
    huffman.write_ids(many, path, folder)
    tokenizer = Tokenizer.from_file(path)
    want = Counter((r.doc_id, *tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1) for r in many.collect())
    rows = huffman.read_ids(spark, folder).orderBy("part", "block", "place").collect()
    assert Counter((r.doc_id, *r.ids) for r in rows) == want
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    # the settings that decide
    import json
    settings = json.loads(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).to_str())
    assert huffman.cuts_at_spaces(settings) and not huffman.cuts_at_spaces(json.loads(tokenizer.to_str()))
    for change in ({"post_processor": {"type": "ByteLevel"}}, {"normalizer": None}, {"pre_tokenizer": None}, {"truncation": {"max_length": 5}},
                   {"added_tokens": [settings["added_tokens"][0] | {"rstrip": True}]}, {"added_tokens": [settings["added_tokens"][0] | {"content": "a b"}]}):
        assert not huffman.cuts_at_spaces(settings | change)


def test_words_stand_for_texts():
    """Random texts of awkward characters: ids by words are those of the whole text, however small the memory."""
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(21)
    odd = list("aZsS09'. \t\n\x0b\r\x1c\x85\xa0\u0301\u0307\u2028İΣςǅﬁ漢🙂|<>") + ["'LL", "<|endoftext|>", "e\u0301", " \u0301", "word ", "\u3000"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", None, " ", "x " * 5000]
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for cached in (0, 50, 100_000):
        lookup = huffman.TextIds(path, cached)
        assert lookup.by_words
        assert [np.frombuffer(lookup.of((x or "").encode()), "<u2").tolist() for x in texts] == want
        assert len(lookup.words) <= max(1, cached)


def test_code_lengths():
    rng = np.random.default_rng(0)
    for n, longest in ((1, 16), (2, 16), (300, 9), (300, 16), (1000, 10)):
        counts = (rng.pareto(0.6, n) * 10 + 1).astype(np.int64)
        lengths = huffman.code_lengths(counts, longest).astype(int)
        assert lengths.max() <= longest and sum(2.0**-lengths) <= 1
        if n == 300 and longest == 16 and n > 1:
            import heapq

            heap, cost = sorted(counts.tolist()), 0
            while len(heap) > 1:
                both = heapq.heappop(heap) + heapq.heappop(heap)
                cost += both
                heapq.heappush(heap, both)
            assert (counts * lengths).sum() >= cost


def test_decode_needs_one_block_only():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.4, 5000) % 3000
    symbols, counts = np.unique(ids, return_counts=True)
    code = huffman.Code(symbols, huffman.code_lengths(counts))
    for part in (ids, ids[:1], ids[:64], ids[:65]):
        bits, steps = code.encode(part)
        assert (code.decode(bits, steps, len(part)) == part).all()


def test_texts_are_tokenised_together(monkeypatch):
    """Each different word of some texts is made once, however small the memory; slices, nulls and a model without suffixes."""
    monkeypatch.setattr(huffman, "RUN", 50)
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(8)
    words = ["Ab", "don't", "x1y22", "née.", "(a)", "…", "Σας", "<|endoftext|>z", "%%%", "'s", "word,", "rare" * 9] + [prose(rng, 1) + "!" for _ in range(90)]
    texts = ["left out", None, "", " \n", *("\t".join(rng.choices(words, k=rng.randrange(60))) for _ in range(200)), "\x1ca\x85 b"]
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
    given = pa.array([t and t.encode() for t in texts], pa.large_binary()).slice(1)
    for cached, suffix in ((0, True), (7, False), (1000, True)):
        lookup, asked = huffman.TextIds(path, cached), []
        lookup.is_last &= suffix
        make = lookup.words.make
        lookup.words.make = lambda new, make=make, asked=asked: asked.extend(new) or make(new)
        ids, sizes = lookup.of_all(given)
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert len(asked) == len(set(asked)) and len(lookup.words) <= max(1, cached)
    runs = list(huffman._slices(given, 500))
    assert [at for at, _ in runs] == [0, *np.cumsum([n for _, n in runs])[:-1]] and sum(n for _, n in runs) == len(given) and len(runs) > 20


def test_blocks_are_coded_and_decoded_side_by_side():
    rng = np.random.default_rng(5)
    symbols, counts = np.arange(0, 9000, 3), (2.0 ** rng.uniform(0, 40, 3000)).astype(np.int64)
    code = huffman.Code(symbols, huffman.code_lengths(counts))
    assert code.length.max() == huffman.LONGEST
    blocks = [rng.choice(symbols, n) for n in (1, 64, 0, 65, 4000)] + [np.full(300, symbols[counts.argmax()])]
    done = [code.encode(b) for b in blocks]
    for ids, (bits, steps) in zip(blocks, done, strict=True):
        want = "".join(f"{code.aligned[i]:016b}"[: code.length[i]] for i in ids)
        assert "".join(map(str, np.unpackbits(np.frombuffer(bits, np.uint8)))) == want.ljust(-len(want) // 8 * -8, "0")
        assert np.frombuffer(steps, "<u2").tolist() == [code.length[ids[k : k + 64]].sum() for k in range(0, len(ids), 64)]
    got = code.decode_all([b for b, _ in done], [s for _, s in done], [len(b) for b in blocks])
    assert (got == np.concatenate(blocks)).all()


# ------------------------------------------------------------------------------------ chat
def test_chat(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(150):
        turns = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * rng.randrange(1, 5)
        for k, role in enumerate(turns):
            ask = "?" if role == "user" else "."
            rows.append((conv, k, role, "\n".join(prose(rng, rng.randrange(3, 30)) + ask for _ in range(rng.randrange(1, 4)))))
    rows += [(None, 0, "user", "x"), (900, None, None, None), (900, 3, "user", ""), (901, 0, "other", "y")] + [(902, 0, "user", "same")] * 3
    rows += [(903, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(1000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("section", F.lit(5))
    got = chat_roles.chat_texts(turns).collect()
    assert len({(r.conv_id, r.section) for r in got}) == len(got) and max(r.n_lines for r in got) < 600
    assert sum(r.conv_id == 903 for r in got) >= 8
    held = [r for r in got if r.held_out and r.conv_id < 900]
    assert sum(r.n_right for r in held) >= 0.9 * sum(r.n_lines for r in held)
    assert chat_roles.chat_texts(turns.limit(0)).count() == 0


def plain_viterbi(model, lines):
    best, back = [], []
    for k, line in enumerate(lines):
        seen = [int(e) for e in model.emit[:, chat_roles.observed(line)]]
        if not k:
            best = [int(s) + e for s, e in zip(model.start, seen)]
            continue
        ways = [[best[i] + int(model.step[i, j]) for i in range(6)] for j in range(6)]
        back.append([w.index(max(w)) for w in ways])
        best = [max(w) + e for w, e in zip(ways, seen)]
    path = [best.index(max(best))]
    for row in reversed(back):
        path.append(row[path[-1]])
    return path[::-1]


def plain_chat(model, lines):
    out, was = [], None
    for line, state in zip(lines, plain_viterbi(model, lines)):
        role, inside = divmod(state, 2)
        if not inside or role != was:
            out += (["<|end|>"] if out else []) + [f"<|{chat_roles.ROLES[role]}|>"]
        was = role
        kind, cut = (0, 0) if inside else chat_roles.marker_of(line)
        if line[cut:] or not kind:
            out.append(line[cut:])
    return "\n".join([*out, "<|end|>"])


@pytest.mark.parametrize("section,fan", [(128, 512), (7, 3)])
def test_chat_is_one_viterbi_pass(spark, section, fan):
    """1,000 turns, 600 rows of one turn number, 900 equal rows and null ids: as plain Viterbi over the whole conversation."""
    rng = random.Random(15)
    roles = ("user", "assistant", "system", "User", None)
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}" + rng.choice(["?", ".", "\nmore\n\n", ""])) for k in range(1000)]
    rows += [(2, 5, rng.choice(roles), prose(rng, rng.randrange(0, 20))) for _ in range(600)]
    rows += [(3, 1, "user", "the same\nagain")] * 900 + [(None, k % 9, rng.choice(roles), f"x{k}" * (k % 40)) for k in range(300)]
    rows += [(4, 0, "user", "long " * 2000), (4, 1, "assistant", None), (5, None, None, None)]
    rows += [(k, t, ("user", "assistant")[t % 2], prose(rng, 6) + ".?"[t % 2]) for k in range(10, 60) for t in range(k % 5 + 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    raw = chat_roles.raw_transcripts(turns, section).cache()
    model = chat_roles.fit(raw)
    kept = defaultdict(list)
    for r in sorted(raw.collect(), key=lambda r: (r.part, r.seq)):
        kept[r.conv_id].append(r)
    lines = {}
    for conv, parts in kept.items():
        assert [p.section for p in parts] == list(range(len(parts))) and [p.last for p in parts] == [False] * (len(parts) - 1) + [True]
        assert all(len(p.roles) == len(p.text.split("\n")) for p in parts)
        lines[conv] = [x for p in parts for x in p.text.split("\n")]
    for conv in (1, 2, 3, None):
        want = Counter(x for r in rows if r[0] == conv for x in (r[3] or "").split("\n")[1:])
        assert not want - Counter(lines[conv])
    assert len(lines[3]) >= 1800 and len(kept[2]) >= 600 // section
    # the model does not depend on where sections end
    number = {s: i for i, s in enumerate(chat_roles.STATES)}
    step = np.zeros((6, 6))
    for conv, parts in kept.items():
        if conv is None or crc32(str(conv).encode()) % 5:
            true = [number.get((x or "").lower()) for p in parts for x in p.roles]
            for i, j in zip(true, true[1:]):
                if i is not None and j is not None:
                    step[i, j] += 1
    assert (chat_roles.Model(np.zeros(6), step, np.zeros((6, 32))).step == model.step).all()
    got = defaultdict(list)
    for r in sorted(chat_roles.formatted(raw, model, fan).collect(), key=lambda r: r.section):
        got[r.conv_id].append(r)
    assert got.keys() == lines.keys()
    for conv, parts in got.items():
        whole = "\n".join(p.text for p in parts)
        assert whole == plain_chat(model, lines[conv]), conv
        assert sum(p.n_lines for p in parts) == len(lines[conv])
        assert sum(p.n_turns for p in parts) == sum(x in ("<|user|>", "<|assistant|>", "<|system|>") for x in whole.split("\n"))


# -------------------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder)
        names.append(name)
        assert docs.columns == before.columns
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert names[0] == "quality" and ids
    out = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in out.collect()} == ids


def test_one_row_of_each_group(spark, docs, no_docs):
    """Rows, not ids: repeated and null ids among near copies and beside them; equal to brute force."""
    rng = random.Random(12)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    one, two, three = (prose(rng, 120).split() for _ in range(3))
    near = lambda words, k: " ".join([*words[: 20 + k], f"other{k}", *words[21 + k :]])
    rows += [(500, " ".join(one), "a"), (501, near(one, 1), "a"), (501, prose(rng, 50), "a"), (501, prose(rng, 60), "b")]
    rows += [(500, prose(rng, 40), "b"), (500, near(one, 2), "b"), (500, " ".join(one), "a"), (500, "", "c"), (500, "", "c")]
    rows += [(None, " ".join(two), "a"), (None, near(two, 3), "a"), (None, near(two, 5), None), (None, prose(rng, 30), "a"), (None, None, "a")]
    rows += [(None, near(three, 4), "a"), (700, " ".join(three), "a"), (699, near(three, 7), "a")]
    table = spark.createDataFrame([(t, s, i) for i, t, s in rows], "text string, source string, doc_id long").repartition(3)
    sets = [shingles(t) for _, t, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    groups = defaultdict(list)
    for row, root in zip(rows, roots_of(len(rows), links), strict=True):
        groups[root].append(row)
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] is not None, r[2] or "")
    want = Counter(min(g, key=order) for g in groups.values())
    got = corpus_pipeline.one_of_each_group(spark, table, "")
    assert got.columns == table.columns
    assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == want
    unique = table.where("doc_id between 20 and 60").dropDuplicates(["doc_id"])
    kept = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, unique, "").collect()}
    assert kept == {r[2] for r in brute_components([(r.doc_id, r.text) for r in unique.collect()])}
    assert corpus_pipeline.one_of_each_group(spark, no_docs, "").count() == 0
