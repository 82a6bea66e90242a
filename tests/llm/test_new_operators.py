"""Ranked block search, quality rules and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from kerbsight.llm import target_ratio, term_blocks, turn_repair
from .conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------------------ ranked search
def brute_ranks(docs, items):
    """(item row number, rank) -> (score, doc_id), from the formula alone."""
    found = [(i, TERM.findall((t or "").translate(SMALL))) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    total, every = len(found), sum(len(t) for _, t in found)
    holding = Counter(x for _, t in found for x in set(t))
    out = []
    for _, text in items:
        asked, scores = TERM.findall((text or "").translate(SMALL)), []
        for i, t in found:
            tf, m = Counter(t), 75 + 25 * len(t) * total // every
            s = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * holding[x] + 1))) * (1_000_000_000 * tf[x] // (1000 * tf[x] + 12 * m))
                for x in asked if x in tf)
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out.append([(-s, i if known else None) for s, known, i in sorted(scores)[:20]])
    return out


@pytest.mark.parametrize("cells, block", [(6_000_000, 32), (40, 2), (2_000, 4)])
def test_block_search(spark, docs, texts, cells, block):
    rng = random.Random(5)
    items = [(k, prose(rng, 12)) for k in range(6)] + [
        (6, texts[1]), (6, texts[0] + " " + texts[0]), (None, "The the THE"), (8, ""), (9, None), (10, "-- ++ \x1c"), (11, "nothing-known"), (12, prose(rng, 900)), (12, "größe;née,X1")]
    bench = spark.createDataFrame([(t, i, 3) for i, t in items], "text string, item_id long, rank int")
    rows = term_blocks.ranked(docs, bench, cells, block).collect()
    want = brute_ranks([(r.doc_id, r.text) for r in docs.collect()], items)
    by_id = defaultdict(list)
    for (i, _), w in zip(items, want, strict=True):
        by_id[i] += [(i, k + 1, d, s) for k, (s, d) in enumerate(w)]
    assert Counter(map(tuple, rows)) == Counter(x for w in by_id.values() for x in w)
    assert rows and max(r["rank"] for r in rows) == 20


def test_block_search_slices(spark, docs, monkeypatch):
    rng = random.Random(6)
    bench = spark.createDataFrame([(k, prose(rng, 9)) for k in range(8)], "item_id long, text string")
    whole = Counter(map(tuple, term_blocks.ranked(docs, bench).collect()))
    monkeypatch.setattr(term_blocks, "SLICE_BYTES", 150)
    assert Counter(map(tuple, term_blocks.ranked(docs, bench).collect())) == whole


def test_block_search_of_nothing(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "lo1 mi2")], "item_id long, text string")
    assert term_blocks.ranked(no_docs, bench).count() == 0
    assert term_blocks.ranked(docs, bench.limit(0)).count() == 0


def test_blocks_are_skipped_only_by_their_bounds():
    """Some lists and blocks are skipped, and the result is that of scoring every document."""
    rng = np.random.default_rng(1)
    topic = rng.integers(0, 6, 600)
    impacts = np.where(rng.random((600, 60)) < np.where(np.arange(60) // 10 == topic[:, None], 0.6, 0.05), rng.integers(1, 10**6, (600, 60)), 0).astype(np.float32)
    terms = np.array([3, 14, 5, 27, 44])
    gains = np.array([9000.0, 7000.0, 500.0, 300.0, 20.0])
    shard = term_blocks.Shard(impacts, [np.arange(60)] * 60)
    scored = 0
    best = term_blocks.Best(1)
    best.names = list(range(600))
    offer = best.offer

    def counted(found, scores):
        nonlocal scored
        scored += len(found)
        offer(found, scores)

    best.offer = counted
    shard.search(terms, gains, best)
    exact = impacts[:, terms].astype(float) @ gains
    assert sorted((-s, i) for s, (_, i) in best.found) == sorted((exact[i], i) for i in heapq.nsmallest(20, range(600), key=lambda i: (-exact[i], i)))
    assert 20 <= scored < (exact > 0).sum()
    for term in terms.tolist():
        groups, tops = shard.list_blocks(term)
        assert sorted(np.concatenate(groups).tolist()) == np.flatnonzero(impacts[:, term]).tolist()
        assert all((tops[b] == impacts[g].max(0)).all() and len(g) <= 2 * term_blocks.BLOCK for b, g in enumerate(groups))


# ------------------------------------------------------------------------------- quality rules
def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def plain_grams(text):
    codes = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) // 2 for w in WORD.findall(text)]
    return [x % 65536 for x in codes] + [(a * 1000003 % 2**31 + b) % 65536 for a, b in zip(codes, codes[1:])]


def test_quality_rules(spark, docs, texts):
    rng = random.Random(8)
    more = {200 + k: prose(rng, 60) for k in range(30)}
    more |= {300 + k: " | ".join(prose(rng, 40).split()) + " ###" for k in range(6)}
    more |= {400: "one two three four five six seven eight nine " * 5 + prose(rng, 200), 401: "a line here\n" * 4 + prose(rng, 30)}
    rows = spark.createDataFrame([(t, i, None, i, "k", 1.0) for i, t in more.items()], docs.schema)
    every = docs.unionByName(rows)
    marks = [(i, 1, 0) for i in range(200, 220)] + [(None, 1, 0), (300, 0, 0), (301, None, 0), (220, 1, 0), (220, 0, 1), (0, 1, 0), (0, 1, 0), (9999, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, kept int")
    trusted = {*range(200, 220), 0}
    all_rows = [(r.doc_id, r.text or "") for r in every.collect()]
    raw, target = Counter(), Counter()
    for i, t in all_rows:
        raw.update(plain_grams(t))
        if i in trusted:
            target.update(plain_grams(t))
    r, t = sum(raw.values()), sum(target.values())
    weight = {b: round(1e6 * math.log((target[b] * (r + 65536) / (n + 1) + 65536) / (t + 65536))) for b, n in raw.items()}
    want = Counter()
    for i, text in all_rows:
        counts, grams = plain_counts(text), plain_grams(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        ratio = sum(weight[g] for g in grams)
        want[(i, *counts, len(grams), ratio, failed, not failed and ratio >= -100_000 * (len(grams) + 50))] += 1
    assert Counter(map(tuple, target_ratio.rule_verdicts(every, labels).collect())) == want
    kept = target_ratio.keep_passing(every, labels)
    assert kept.columns == every.columns
    assert Counter(x.doc_id for x in kept.collect()) == Counter(k[0] for k, n in want.items() for _ in range(n) if k[-1])
    assert any(k[-2] for k in want) and any(k[-1] for k in want) and want.total() == len(all_rows)


def test_quality_rules_without_labels_or_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.ratio == 0 and r.kept == (not r.base_failed) for r in target_ratio.rule_verdicts(docs, labels).collect())
    assert target_ratio.rule_verdicts(no_docs, labels).count() == 0


def test_junk_is_rejected_and_prose_is_kept(spark):
    """Held-out verdicts on the given tables: clean texts stay, most junk goes."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fitted = labels.where("crc32(cast(doc_id as string)) % 5 <> 0")
    rows = target_ratio.rule_verdicts(docs, fitted).join(labels.where("crc32(cast(doc_id as string)) % 5 = 0"), "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert len(good) > 500 and sum(good) / len(good) > 0.99
    assert len(bad) > 50 and sum(bad) / len(bad) < 0.15


def test_windows_with_one_code_are_told_apart(monkeypatch):
    words = [b"w%d" % (i % 23) for i in range(100)] + [b"x%d" % i for i in range(60)]
    exact = target_ratio.repeated_words(words)
    monkeypatch.setattr(target_ratio.W, "run_codes", lambda codes, size: np.zeros(len(codes) - size + 1, np.uint64))
    assert target_ratio.repeated_words(words) == exact == 100


# ----------------------------------------------------------------------------- conversation repair
def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def code(role, text):
    r, t = role.encode(), text.encode()
    return hashlib.md5(b"%d:%b%d:%b" % (len(r), r, len(t), t)).hexdigest()


def plain_repair(rows, rules):
    """Counts, cost, audit and hash of one damaged conversation; audits are compared as whole strings."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), code(r[2], r[3])))
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    seen, faults = set(), []
    for _, _, role, text in rows:
        ink = WORD.findall(text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = {"": (0, "", ())}  # by state: cost, audit, turns left

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit, left) in list(best.items()):
                to, who = ("a", "assistant") if state == "u" else ("u", "user")
                way = (cost + rules.insert, audit + "I", (*left, (who, "")))
                if to not in best or way[:2] < best[to][:2]:
                    best[to] = way
        return best

    best = inserts(best)
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def offer(state, way):
            if state not in after or way[:2] < after[state][:2]:
                after[state] = way

        for state, (cost, audit, left) in best.items():
            offer(state, (cost + rules.delete, audit + "D", left))
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                x = role[:1]
                if (state, x) in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                    offer(x, (cost + more, audit + "K", (*left, (role, text))))
                to, who = ("a", "assistant") if state == "u" else ("u", "user")
                offer(to, (cost + 1 + more, audit + "R", (*left, (who, text))))
        best = inserts(after)
    cost, audit, left = min(best[s] for s in ("", "a") if s in best)
    counts = Counter(faults)
    whole = "\n".join(f"{r}:{t}" for r, t in left)
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()


def brute_audits(rows, rules):
    by = defaultdict(list)
    for r in plain_damage(rows):
        by[r[0]].append(r)
    return {conv: plain_repair(by[conv], rules) for conv in {r[0] for r in rows}}


def made_turns():
    rng = random.Random(12)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "User"]
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "No!", "cut off", "", "  ", None, "What?", "a.b", "é größe.\x0b", "x\xa0"]) if rng.random() < 0.6 else f"{prose(rng, 5)}."
            rows.append((conv, None if rng.random() < 0.08 else turn + rng.randrange(2) * (conv % 3), role, text))
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Hello."), (None, 1, "user", "cut")]
    rows += [(500, 7, "user", "Same.")] * 40 + [(500, 8, "assistant", "Yes.")] * 3 + [(501, None, "user", "Hi."), (501, None, "assistant", "Ho.")]
    rows += [(600, k, "system" if not k else ("user", "assistant")[k % 2], f"Turn {k}." if k % 11 else "cut") for k in range(900)]
    rows += [(601, 5, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(300)]
    return rows


@pytest.mark.parametrize("section, parts, insert, delete", [(512, 1, 5, 2), (1, 4, 5, 2), (3, 7, 1, 3), (64, 3, 2, 4), (64, 3, 5, 2)])
def test_conversation_repair(spark, section, parts, insert, delete):
    """Also with other costs: with the given ones an insertion is never the cheapest edit."""
    rules = turn_repair.Rules(insert=insert, delete=delete, section=section)
    rows = made_turns()
    frame = spark.createDataFrame([(t, r, u, i, 1, "k") for i, u, r, t in rows], "text string, role string, turn long, conv_id long, code int, part string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r[0]: tuple(r)[1:] for r in turn_repair.conversation_audits(frame.repartition(3), rules).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute_audits(rows, rules)
    assert {k: v for k, v in found.items() if want[k] != v} == {} and found.keys() == want.keys()
    assert {x for v in want.values() for x in v[6]} == set("DIKR" if insert < delete else "DKR")


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.conversation_audits(empty).count() == 0
    gone = next(t for t in range(1000) if crc32(f"1:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(1, gone, "user", "Hi.")], empty.schema)
    assert [tuple(r) for r in turn_repair.conversation_audits(one).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("prime", [turn_repair._PRIME, 1, 3])
def test_audits_compare_like_strings(monkeypatch, prime):
    """Also where hashes collide: with a prime of 1 all of them are equal."""
    monkeypatch.setattr(turn_repair, "_PRIME", prime)
    rng = random.Random(4)
    audits, texts = turn_repair.Audits(), [""]
    for _ in range(400):
        parent, piece = rng.randrange(max(0, len(texts) - 30), len(texts)), rng.choice(["D", "K", "DI", "KKD", "D", "R"])
        audits.add(parent, piece)
        texts.append(texts[parent] + piece)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert audits.less(a, b) == (texts[a] < texts[b])
