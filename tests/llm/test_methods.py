"""Each method against a plain version of itself, or held-out data."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import decontaminate, near_dedup, personal, repetition, secrets, suffix_tree
from ledgerlens.llm.queries import ORACLES, QUERIES
from ledgerlens.session import staged

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op2_quality_rank"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    bad = [r.score for r in rows if r.quality == 0]
    good = [r.score for r in rows if r.quality == 1]
    assert len(bad) >= 5 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert np.mean([b < g for b in bad for g in good]) > 0.97


def random_words(rng, n, vocabulary=40):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_long_runs_of_one_word():
    """Matches are listed where they are as long as they get, not for each pair of places."""
    block = decontaminate.Block([(1, "a " * 1_000), (2, "a " * 1_000)], 13)
    began = time.perf_counter()
    (n, hits, items, matches), (short, *_) = decontaminate._search(["a " * 20_000, "a"], block, decontaminate.Settings())
    assert time.perf_counter() - began < 20
    assert (n, len(hits), items, short) == (20_000, 20_000, [1, 2], 1)
    assert max(m["length"] for m in matches) == 1_000 and len(matches) < 2 * (20_000 + 1_000)


def test_longest_matches():
    rng = random.Random(3)
    items = [(i, " ".join(random_words(rng, n))) for i, n in enumerate((40, 20, 13, 12, 3, 1))]
    texts = []
    for _ in range(30):
        words = random_words(rng, rng.randrange(60))
        item = items[rng.randrange(len(items))][1].split()
        a = rng.randrange(len(item))
        texts.append(" ".join(words + item[a:] + random_words(rng, 5)))
    block = decontaminate.Block(items, 13)
    for text, (n, hits, found, matches) in zip(texts, decontaminate._search(texts, block, decontaminate.Settings()), strict=True):
        words, expected, longest, windows = text.split(), set(), set(), set()
        for i, item in items:
            w = item.split()
            need = min(13, len(w))
            for a in range(len(w)):
                for p in range(len(words)):
                    k = 0
                    while p + k < len(words) and a + k < len(w) and words[p + k] == w[a + k]:
                        k += 1
                    if k >= need and (need == 13 or a == 0):
                        expected |= set(range(p, p + need))
                        windows.add(i)
                        if not (p and a and words[p - 1] == w[a - 1]):
                            longest.add((i, a, p, k))
        assert n == len(words) and set(hits) == expected and found == sorted(windows)
        assert {(m["item_id"], m["item_start"], m["doc_start"], m["length"]) for m in matches} == longest


def test_items_in_blocks(spark):
    whole = decontaminate.matched(*[spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark")], name="f")
    cut = decontaminate.matched(
        *[spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark")],
        decontaminate.Settings(block_words=400, shard_words=5000), name="f",
    )
    digest = lambda df: sorted((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"])), len(r.matches)) for r in df.select("doc_id", "f.*").collect())
    assert digest(whole) == digest(cut)


def components(sets, percent):
    root = list(range(len(sets)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("levels", "few"), [(12, 12), (1, 12), (3, 1024)])
def test_large_groups_of_near_copies(spark, levels, few):
    """Nodes far larger than a leaf, with copies on both sides of the threshold, down every way to end a node."""
    rng = random.Random(11)
    bases = [[f"{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    texts = []
    for i in range(330):
        words = list(bases[i % 3])
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [texts[5]] * 20
    s = near_dedup.Settings(shingle=3, percent=85, leaf=12, few=few, block=16, levels=levels)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[i:i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    got = {r.doc_id: r.component_id for r in near_dedup.grouped(df, s).collect()}
    assert [got[i] for i in range(len(texts))] == components(sets, 85)


def test_a_large_node_just_below_the_threshold(spark):
    """Default settings: 1,600 texts alike at about 0.78, and partners of 300 of them just above 0.85. Every link is found."""
    rng = random.Random(23)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(1600):
        words = list(base)
        for at in rng.sample(range(200), 4):
            words[at] = f"v{i}-{at}"
        texts.append(words)
    for i in range(300):
        words, at = list(texts[i]), rng.randrange(3, 180)
        words[at : at + 12] = [f"p{i}-{k}" for k in range(12)]
        texts.append(words)
    sets = [{tuple(t[i : i + 3]) for i in range(len(t) - 2)} for t in texts]
    number = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    has = np.zeros((len(sets), len(number)), np.float32)
    for i, one in enumerate(sets):
        has[i, [number[x] for x in one]] = 1
    common, sizes = (has @ has.T).astype(int), np.array([len(x) for x in sets])
    linked = 100 * common >= 85 * (sizes[:, None] + sizes[None, :] - common)
    label = np.arange(len(sets))
    while True:
        least = np.where(linked, label[None, :], len(sets)).min(1)
        if (least == label).all():
            break
        label = least
    assert linked.sum() - len(sets) >= 600 and 0.7 < np.median(common[:200, :200] / (2 * 198 - common[:200, :200])) < 0.8
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.grouped(df.repartition(8), near_dedup.Settings(shingle=3, percent=85)).collect()}
    assert [got[i] for i in range(len(texts))] == label.tolist()


def test_roots_are_joined_with_a_node_once(spark, monkeypatch):
    """At each level, a member meets its root once before the links of the level and once after them."""
    rng = random.Random(29)
    texts = []
    for i in range(120):
        words = [f"b{k}" for k in range(120)]
        words[rng.randrange(120)] = f"v{i}"
        texts.append((i, " ".join(words)))
    joined, members = spark.sparkContext.accumulator(0), []

    @F.udf("long")
    def counted(root):
        joined.add(1)
        return root

    def populated(*args, real=near_dedup._populated):
        nodes = real(*args)
        members.append(nodes.count())
        return nodes

    def with_roots(rows, roots, real=near_dedup._with_roots):
        return real(rows, roots) if roots is None else real(rows, roots).withColumn("root", counted("root"))

    monkeypatch.setattr(near_dedup, "_populated", populated)
    monkeypatch.setattr(near_dedup, "_with_roots", with_roots)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = near_dedup.grouped(df, near_dedup.Settings(shingle=3, percent=85, leaf=12, few=16)).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1
    assert members[0] >= 1000 and 0 < joined.value <= 2 * sum(members)


def test_full_sets_stay_where_they_are(spark, monkeypatch):
    """Each level joins the full sets with its groups; only the groups' numbers move for it. A compared token is one byte."""
    plans, sizes = [], []

    def links(groups, full, s, real=near_dedup._links):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = groups.select(F.explode("ids").alias("uid")).join(full, "uid")
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        return real(groups, full, s)

    def leaves(nodes, sketches, *args, real=near_dedup._leaf_groups):
        sizes.extend(len(r.sketch) for r in sketches.select("sketch").collect())
        return real(nodes, sketches, *args)

    monkeypatch.setattr(near_dedup, "_links", links)
    monkeypatch.setattr(near_dedup, "_leaf_groups", leaves)
    rng = random.Random(31)
    texts = [random_words(rng, 50, 10_000) for _ in range(20)]
    texts += [[*t[:-1], "other"] for t in texts]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    s = near_dedup.Settings(shingle=3, percent=85)
    got = {r.doc_id: r.component_id for r in near_dedup.grouped(df, s).collect()}
    assert got == {i: i % 20 for i in range(40)}
    assert plans and all(p.count("Exchange hashpartitioning") == 1 for p in plans)
    assert set(sizes) == {s.positions}


def test_stored_tables_leave_no_shuffle_files(spark):
    """What a stored table shuffled is deleted with its statement, not when the driver next collects its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString("|")))
    before = shuffled()
    counts = staged(spark.range(100_000).groupBy((F.col("id") % 1_000).alias("k")).count(), "counts")
    end = time.perf_counter() + 10
    while shuffled() - before and time.perf_counter() < end:
        time.sleep(0.1)
    assert not shuffled() - before
    assert counts.count() == 1_000


def test_long_chain_is_one_group(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.uid: r.root for r in near_dedup.connected(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_repeats_by_suffix_array():
    rng = random.Random(5)
    for _ in range(60):
        docs = [[rng.randrange(3) for _ in range(rng.randrange(40))] for _ in range(3)]
        words = np.array([w for d in docs for w in d], np.int64)
        sizes = np.array([len(d) for d in docs])
        doc = np.repeat(np.arange(3), sizes)
        left = np.cumsum(sizes)[doc] - np.arange(len(words))
        got = repetition.longest_repeats(words, doc, left).tolist()
        expected = []
        for d in docs:
            for i in range(len(d)):
                best = 0
                for j in range(len(d)):
                    k = 0
                    while i != j and max(i, j) + k < len(d) and d[i + k] == d[j + k]:
                        k += 1
                    best = max(best, k)
                expected.append(best)
        assert got == expected


def plain_tree(training, s):
    """The tree over tuples of words, written down from its definition: a function from a text's symbols to its score."""
    seen = Counter(x for text in training for x in text)
    share = lambda x: (seen[x] + s.prior) / (sum(seen.values()) + s.prior * (len(seen) + 1))
    named = {x for x, n in seen.items() if n >= s.least_entry or x == END}
    follows = {}
    for text in training:
        for i, x in enumerate(text):
            for d in range(1, s.depth + 1):
                if i >= d and x in named:
                    follows.setdefault(text[i - d : i], Counter())[x] += 1
    totals = {(x,): n for x, n in seen.items() if n >= s.least_context and x != END}
    candidates, depth = dict(totals), dict(totals)
    for _ in range(s.depth - 1):
        depth = {c + (x,): n for c in depth for x, n in follows.get(c, {}).items() if n >= s.least_context and x != END}
        candidates |= depth
    entries, rest, kept = {}, {}, set()

    def parent(c):
        return next((c[i:] for i in range(1, len(c)) if c[i:] in kept), ())

    def log_share(c, x):
        total = 0.0
        while c:
            if x in entries[c]:
                return total + entries[c][x]
            total, c = total + rest[c], parent(c)
        return total + math.log10(share(x))

    for c in sorted(candidates, key=len):
        up = {x: 10 ** log_share(parent(c), x) for x, n in follows.get(c, {}).items() if n >= s.least_entry}
        own = {x: (follows[c][x] + s.smoothing * p) / (candidates[c] + s.smoothing) for x, p in up.items()}
        left, up_left = (min(1, max(1e-12, 1 - sum(d.values()))) for d in (own, up))
        gain = candidates[c] * (sum(own[x] * math.log(own[x] / up[x]) for x in own) + left * math.log(left / up_left))
        if abs(gain - s.least_gain) < 1e-9:
            raise AssertionError("a tie that rounding decides")
        if gain >= s.least_gain:
            kept.add(c)
            entries[c], rest[c] = {x: math.log10(p) for x, p in own.items()}, math.log10(left / up_left)

    def score(text):
        total = 0.0
        for i, x in enumerate(text):
            found = [text[i - d : i] for d in range(1, s.depth + 1) if i >= d and text[i - d : i] in candidates]
            state = max(found, key=len, default=())
            total += log_share(state if state in kept else parent(state), x)
        return total

    return score, kept


END = suffix_tree.END


def test_suffix_tree_against_a_plain_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: tuple(suffix_tree._symbols(r.text)) for r in docs.collect()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 10 == 0}
    score, kept = plain_tree([t for d, t in texts.items() if d not in held], suffix_tree.Settings())
    assert {len(c) for c in kept} == {1, 2, 3} and len(kept) > 500
    for r in QUERIES["op7_suffix_tree"](spark, "/root/testdata/sf0.001").collect():
        assert r.held_out == (r.doc_id in held) and r.score == pytest.approx(score(texts[r.doc_id]), rel=1e-9, abs=1e-6)


def test_suffix_tree_scores(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    symbols = {d: (t or "").encode().lower().split() + [b" end"] for d, t in docs.items()}
    counts = Counter(s for d, w in symbols.items() if not held(d) for s in w)
    n = sum(counts.values())
    better = []
    for r in QUERIES["op7_suffix_tree"](spark, SF).collect():
        base = sum(math.log10((counts[s] + 0.1) / (n + 0.1 * (len(counts) + 1))) for s in symbols[r.doc_id])
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.held_out == held(r.doc_id)
        assert (r.n_tokens, r.train_tokens) == (len(symbols[r.doc_id]), n)
        assert r.n_known == sum(counts[s] > 0 for s in symbols[r.doc_id])
        if r.held_out:
            better.append(r.score - base)
    assert sum(better) > 0 and np.mean(np.array(better) > 0) > 0.8


def test_suffix_tree_distributions_add_up(spark):
    rng = random.Random(2)
    texts = [" ".join(random_words(rng, 30, 6) + ["a b c d"] * 3 + [f"once{i}"]) for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    s = suffix_tree.Settings(context_share=1e-3, least_gain=2.0)
    counts = {bytes(r.symbol): r.n for r in suffix_tree.symbol_counts(df, s).collect()}
    total = sum(counts.values())
    names = sorted(k for k, n in counts.items() if n >= 2)
    n = np.array([counts[k] for k in names])
    log_root = np.log10((n + 0.1) / (total + 0.1 * (len(counts) + 1)))
    code = suffix_tree._coder(spark.sparkContext.broadcast({k: i for i, k in enumerate(names)}))
    coded = staged(df.select(code("text").alias("c")).select("c.*"), "coded")
    tree = suffix_tree._grown(coded, log_root, n, names.index(b" end"), total, s)
    assert len(tree["depth_end"]) == 3 and tree["retained"].any()
    outside = 1 - (10 ** log_root).sum()
    for context in [-1, *np.flatnonzero(tree["retained"]).tolist()]:
        state = np.full(len(names) + 1, context)
        log = suffix_tree._log_probability(tree, state, np.arange(-1, len(names)))
        assert math.isclose((10 ** log[1:]).sum() + 10 ** log[0] * outside, 1, rel_tol=1e-9)


@pytest.mark.parametrize("others", [10, 300])
def test_suffix_tree_learns_a_passage_in_a_corpus_of_any_size(spark, others):
    rng = random.Random(8)
    passage = "the fox saw nine old crows"
    texts = [passage] * 20 + [" ".join(f"w{rng.randrange(50)}" for _ in range(1000)) for _ in range(others)]
    df = spark.createDataFrame([*enumerate(texts), (-1, passage)], "doc_id long, text string")
    row = suffix_tree.scored(df, F.col("doc_id") >= 0).filter("doc_id = -1").first()
    assert row.score - row.base_score > 5


@pytest.mark.parametrize("group, chunk, depth", [(1_000_000, 1_000_000, 0), (150, 700, 2), (30, 2_000, 3)])
def test_suffix_tree_passes_neither_words_nor_contexts_through_the_driver(spark, monkeypatch, group, chunk, depth):
    """With no broadcast and no gathered table the scores are the plain tree's, whatever contexts have too many places."""
    rng = random.Random(11)
    tails = ["of the old crows", "of the day", "and so of the old crows we sing", ""]
    tail = lambda i: rng.choice(tails).split() * rng.randrange(3) + [f"once{i % 290}"]
    texts = [" ".join(random_words(rng, rng.randrange(40)) + tail(i)) for i in range(400)]
    rows = [*enumerate(texts), (2**60 + 1, None), (None, "of the day"), (None, "of the day")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    symbols = {d: tuple(suffix_tree._symbols(t)) for d, t in rows}
    settings = suffix_tree.Settings(least_gain=4.0, largest_group=group, chunk_codes=chunk)
    score, kept = plain_tree([s for d, s in symbols.items() if d is not None and d % 10], settings)
    assert {len(c) for c in kept} == {1, 2, 3}
    found = []
    pairs = suffix_tree._large_pairs
    monkeypatch.setattr(suffix_tree, "_large_pairs", lambda *args: found.append(pairs(*args)) or found[-1])

    def refused(*args, **more):
        raise AssertionError("a table in the driver")

    monkeypatch.setattr(type(df), "toArrow", refused)
    monkeypatch.setattr(type(df), "toPandas", refused)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refused)
    got = suffix_tree.scored(df, F.col("doc_id") % 10 != 0, settings).collect()
    assert len(found[0][0]) >= depth
    assert Counter((r.doc_id, r.is_training) for r in got) == Counter((d, None if d is None else d % 10 != 0) for d, _ in rows)
    for r in got:
        assert r.n_tokens == len(symbols[r.doc_id]) and r.score == pytest.approx(score(symbols[r.doc_id]), rel=1e-9, abs=1e-6)


KEY = "Xk29fLq8ZpW3vN7tYb4RmC6dQz"
DIGEST = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"


def test_secrets(spark):
    texts = [
        f"use {KEY} now", f"sha256: {DIGEST}", f"bare {DIGEST}", "id 123e4567-e89b-12d3-a456-426614174000 ok",
        "internationalization_of_words_2024 is long", "API_KEY: 'abc' pass", "Secret=\"12345678\"", "AKIA123 AKIAABCDEFGHIJKLMN",
        "paſſword=abcdefghi", "token = token = abcdefghij",
    ]
    scan = secrets.scanner(spark)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", scan("text").alias("s"))
    found = {r.i: [(s.kind, s.known, texts[r.i][s.start:s.end]) for s in r.s] for r in df.collect()}
    assert found[0] == [("random", False, KEY)]
    assert found[1] == [("hex", True, DIGEST)] and found[2] == [("hex", False, DIGEST)]
    assert found[3] == found[4] == found[5] == found[8] == []
    assert found[6] == [("assign", False, 'Secret="12345678')] and found[7] == [("access", False, "AKIAABCDEFGHIJKLMN")]
    assert found[9] == []  # the first match takes the second word, fails, and is not retried
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert {r.i for r in secrets.without_secrets(docs).collect()} == {1, 3, 4, 5, 8, 9}


BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def test_planted_keys_are_found_and_prose_is_not(spark):
    rng = random.Random(4)
    key = lambda n, of=BASE62: "".join(rng.choices(of, k=n))
    kinds = {
        "short": lambda: key(16), "long": lambda: key(32), "letters": lambda: key(26, BASE62[:52]),
        "commit": lambda: f"commit {key(40)}", "uuid": lambda: f"123e4567-e89b-12d3-a456-426614174000{key(24)}",
    }
    prose = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    rows, at = [], []
    for kind, made in kinds.items():
        for i in range(100):
            secret = made().split()[-1]
            before = "the commit " if kind == "commit" else "some words and "
            rows.append(f"{prose[i][:300]} {before}{secret} more of them")
            at.append((kind, secret[-16:]))
    scan = secrets.scanner(spark)
    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string").select("i", scan("text").alias("s"))
    found = {r.i: "".join(rows[r.i][s.start:s.end] for s in r.s) for r in df.collect()}
    caught = Counter(kind for i, (kind, tail) in enumerate(at) if tail in found[i])
    assert all(caught[kind] >= 95 for kind in kinds), caught
    words = ["internationalization", "Donaudampfschifffahrtsgesellschaft", "McDonaldsRestaurant", "IPhoneAndIPad", "getElementByIdentifier",
             "2024-05-17T12:30:00", "00112233-44556677", "ABCDEFGHIJKLMNOPQRST", "/usr/local/share/doc", "123e4567-e89b-12d3-a456-426614174000"]
    plain = spark.createDataFrame([(" ".join([w, "is written in some plain words of a text"]),) for w in words], "text string")
    assert [r.text for r in plain.filter(F.size(scan("text")) > 0).collect()] == []


def test_base_spans_equal_plain_patterns(spark):
    """The base digest of every document against the patterns alone."""
    got = {r.doc_id: r for r in QUERIES["op9_scan_secrets"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        spans = [("assign", *m.span()) for m in re.finditer(
            r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r.text) if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", r.text) if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", r.text) if len(m[0]) >= 32]
        order = sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in order)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(got[r.doc_id].spans.split(","))


def test_contexts_discover_identifiers(spark):
    texts = [f"some words here. please mail to{' ' * (i % 3 + 1)}person{i}@mail.example.com today" for i in range(12)]
    texts += ["we mail to AB-123456-X often", "version 2.0.1234567 of it", "please mail to nobody at all"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.spans] for r in personal.scanned(df).collect()}
    assert found[12] == [("context", "AB-123456-X")] and found[13] == found[14] == []
    assert all(found[i] == [("email", f"person{i}@mail.example.com")] for i in range(12))


def test_common_words_are_no_patterns(spark):
    """A word before eight addresses and nine identifiers is refused where it stands before many other words as well."""
    texts = [f"we wrote of person{i}@mail.example.com, and the account no {i}23456{i} at customer id cust{i}@mail.example.com" for i in range(9)]
    texts += [f"of {w} and of {w} again, a tale of it" for w in ("wind", "rain", "snow", "sun", "fog", "ice")]
    texts += ["the list of AB1234567 is short", "customer id XK-9981-22 was closed", "of QQ7654321"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "context"] for r in personal.scanned(df).collect()}
    assert found[16] == ["XK-9981-22"] and found[15] == found[17] == []


def test_planted_identifiers_and_no_stop_words(spark):
    """Of the given documents: what is accepted, and what two planted contexts discover."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plant = [(10**6 + i, f"{'' if i % 2 else 'dear all, '}member mailbox is user{i}@mail.example.com ok") for i in range(30)]
    plant += [(2 * 10**6 + i, f"member mailbox is M{i}X-{i}7{i}42-{i} ok") for i in range(5)]
    both = docs.unionByName(spark.createDataFrame(plant, docs.schema))
    found = {r.doc_id: [s for s in r.spans if s.kind == "context"] for r in personal.scanned(both).collect()}
    assert all(len(found[2 * 10**6 + i]) == 1 for i in range(5))
    discovered = sum(len(spans) for doc, spans in found.items() if doc < 10**6)
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = Counter(p for doc, spans in found.items() if doc < 10**6 for s in spans for p in personal.patterns_before(texts[doc], s.start)[:1])
    common = Counter(w for t in texts.values() for w in t.lower().split())
    assert all(common[w] < 200 for w in words), (discovered, words)


def test_context_words_are_whole():
    long = "x" * 500
    assert personal.patterns_before(f"a {long} b7 1234", len(f"a {long} b7 ")) == ["b0", f"{long} b0"]
    assert personal.patterns_before(f"{long} 1", len(long) + 1) == [f"^ {long}"] and personal.patterns_before("1", 0) == ["^"]



def test_long_runs_are_read_once():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "999." * 50_000 + "@" * 100_000
    assert personal.base_spans(text) == []


def test_pipeline_stages_against_plain_versions(spark, sql, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, folder), "tested").persist()
        assert out.columns == docs.columns
        docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        for table in ("labels", "benchmark", "pages", "conversations"):
            spark.read.parquet(f"{folder}/{table}.parquet").write.mode("overwrite").parquet(f"{tmp_path}/{table}.parquet")
        before = {r.doc_id: r.text for r in docs.collect()}
        got = Counter(r.doc_id for r in out.collect())
        assert all(before[r.doc_id] == r.text for r in out.collect())
        if name == "quality":
            expected = Counter(r.doc_id for r in QUERIES["op2_quality_rank"](spark, str(tmp_path)).collect() if r.predicted)
        elif name == "secrets":
            plain = {d: secrets._base(t or "") for d, t in before.items()}
            known = lambda d: all(k == "hex" and secrets._is_digest(before[d], s, e) for k, s, e in plain[d])
            expected = Counter(d for d in before if known(d))
        else:
            query, keep = {
                "near_duplicates": ("op5_near_dedup", lambda r: int(r["kept"])),
                "decontamination": ("op3_decontaminate", lambda r: int(not r["contaminated"])),
                "mixing": ("op4_mix_sources", lambda r: r["taken"] // max(1, r["size"])),
            }[name]
            names, rows = sql_parts(sql, str(tmp_path), ORACLES[query])
            expected = Counter({r["doc_id"]: keep(r) for r in (dict(zip(names, row)) for row in rows) if keep(r)})
        assert got == expected
        docs = out


def sql_parts(sql, folder, text):
    """The same SQL over folders of part files."""
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    result = con.execute(text)
    return [d[0] for d in result.description], result.fetchall()
