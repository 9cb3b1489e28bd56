"""Lexical search, periodic runs and shards against brute force."""

import glob
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobmeld.llm import lexical, periodic, sharding
from jobmeld.llm.queries import with_repeats

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def clashing(df, *names):
    """The frame with columns named like those that an operator makes."""
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


# lexical search


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, top):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_words = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        wanted = Counter(terms_of(text))
        scores = []
        for i, c, n in held:
            m = 75 + 25 * n * n_docs // n_words
            score = 0
            for t, k in wanted.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += k * w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out.update((item, r + 1, i, -s) for r, (s, _, i) in enumerate(scores[:top]))
    return out


def random_documents(n, seed, vocabulary=60):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["The", "ÉTÉ", "日本", "a_b", "x-y"]
    weights = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(rnd.choices(words, weights, k=rnd.choice([1, 3, 20, 80]))) for _ in range(n)]
    # copies, as near and exact ones fill whole subtrees
    texts += [texts[0]] * 90 + [texts[1] + " w3"] * 40
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("top", [1, 5, 20])
def test_search_equals_brute_force(spark, docs, monkeypatch, top):
    rows = random_documents(400, top) + [(None, "w1 w2"), (None, "w1 w2"), (7, None), (8, ""), (9, "-- ..")]
    rows += [(1, "w1 w2 w2"), (1, "w1 w2 w2"), (5000, "w5 " * 30000 + "rare")]
    rnd = random.Random(9)
    items = [(k, " ".join(rnd.choices([f"w{j}" for j in range(60)], k=rnd.randint(1, 12)))) for k in range(25)]
    items += [(25, None), (26, ""), (27, "unseen words only"), (28, "rare rare W1"), (28, "rare rare W1"), (None, "w2 été")]
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 10)  # several blocks
    frame = clashing(docs(rows), "rank", "score", "item", "n").repartition(3)
    names = clashing(spark.createDataFrame(items, "item_id long, text string"), "doc_id", "rank", "score")
    got = lexical.rank(frame, names, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == ranked(rows, items, top)


def test_search_leaves_subtrees_out(monkeypatch):
    """Few leaves are opened, and those that are not can't hold a better document: the result is exact."""
    rows = random_documents(3000, 3, vocabulary=400)
    vocabulary = {t: k for k, t in enumerate(sorted({t.encode() for _, x in rows for t in terms_of(x)}))}
    import numpy as np

    counts = [Counter(lexical.terms(t.encode())) for _, t in rows]
    df = Counter(t for c in counts for t in c)
    rank = {t: r for r, t in enumerate(sorted(vocabulary, key=lambda t: (-df[t], t)))}
    n_words = sum(sum(c.values()) for c in counts)
    m = lexical._length_factors([sum(c.values()) for c in counts], len(rows), n_words)
    term = np.array([rank[t] for c in counts for t in c])
    tf = np.array([x for c in counts for x in c.values()])
    trie = lexical.Trie([i for i, _ in rows], m, np.array([len(c) for c in counts]), term, tf, len(rank))
    leaves = [k for k, c in enumerate(trie.children) if not c]
    assert sorted((trie.lo[k], trie.hi[k]) for k in leaves)[0][0] == 0
    assert sum(trie.hi[k] - trie.lo[k] for k in leaves) == len(rows)
    opened = []
    real = np.add.reduceat

    class Counting:
        reduceat = staticmethod(lambda *a: opened.append(1) or real(*a))

    monkeypatch.setattr(lexical.np, "add", Counting)
    best, query = [], [b"w300", b"w250", b"w200"]
    trie.search([(rank[t], lexical.weight(len(rows), df[t])) for t in query], np.zeros(len(rank), np.int64), best, 5)
    want = ranked(rows, [(0, "w300 w250 w200")], 5)
    assert sorted((s, -i) for s, i in best) == sorted((s, i) for _, _, i, s in want)
    assert 0 < len(opened) < len(leaves) / 2


def test_search_of_empty_tables(spark, docs):
    none = docs([]).select("doc_id", "text")
    items = spark.createDataFrame([(1, "a word")], "item_id long, text string")
    assert lexical.rank(none, items).collect() == []
    assert lexical.rank(docs([(1, None)]), items).collect() == []
    assert lexical.rank(docs([(1, "a word")]), items.filter("false")).collect() == []


# periodic runs


def all_runs(words, least=6, exponent=4):
    n, best = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                best.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((a, length, p) for (a, length), p in best.items())


def periodic_words(rnd, n, symbols):
    words = [str(rnd.randrange(symbols)) for _ in range(n)]
    for _ in range(rnd.randrange(3)):
        a = rnd.randrange(n)
        p = 1 + (n - a) // rnd.randint(2, 10)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_brute_force(least, exponent):
    rnd = random.Random(exponent)
    texts = [periodic_words(rnd, rnd.randint(1, 70), rnd.choice([1, 2, 3, 9, 40])) for _ in range(600)]
    found = periodic.document_runs([" ".join(t).encode() for t in texts], least, exponent)
    for words, (_, got) in zip(texts, found, strict=True):
        assert sorted(got) == all_runs(words, least, exponent), words


def test_suffix_tree_extensions():
    rnd = random.Random(4)
    for _ in range(60):
        text = [rnd.randint(1, 3) for _ in range(rnd.randint(2, 40))]
        longest = periodic.Extensions(*periodic.SuffixTree(text, 3).tour())
        suffixes = sorted(range(len(text) + 1), key=lambda i: text[i:])
        assert longest.rank[suffixes].tolist() == list(range(len(text) + 1))
        pairs = [(i, j) for i in range(len(text)) for j in range(i + 1, len(text))]
        import numpy as np

        got = longest.of(*(np.array(x) for x in zip(*pairs)))
        for (i, j), n in zip(pairs, got.tolist()):
            same = 0
            while j + same < len(text) and text[i + same] == text[j + same]:
                same += 1
            assert n == same


def test_found_runs_of_awkward_documents(spark, awkward, docs):
    extra = docs([(20, "la " * 9000), (21, "a\x0bb\x1cc a b\x1cc a\tb\x1cc a b\x1cc a b\x1cc"), (22, "x x x x x"), (23, "x " * 6)])
    frame = clashing(awkward.union(extra), "runs", "start", "length", "collapsed", "n_runs")
    got = periodic.find_runs(frame).collect()
    rows = frame.collect()
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        found = all_runs(words)
        gone = {i for a, n, p in found for i in range(a + p, a + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if found else (None,) * 3
        want[(r["doc_id"], len(found), *best, tuple(found), kept)] += 1
    assert Counter(
        (r.doc_id, r.n_runs, r.start, r.length, r.period, tuple(tuple(x) for x in r.runs), r.collapsed) for r in got
    ) == want
    assert periodic.find_runs(docs([])).collect() == []


def test_repeats_of_chosen_documents(docs):
    rows = [(i, " ".join(f"v{k}" for k in range(i % 37))) for i in range(300)] + [(None, "a b"), (30, None)]
    got = docs(rows).select("doc_id", "text", with_repeats(F.col("text"), F.col("doc_id")).alias("new")).collect()
    changed = 0
    for r in got:
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        words = (r.text or "").split()
        if h % 10 or not words:
            assert r.new == r.text
            continue
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert r.new == " ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])
        changed += 1
    assert changed > 15


# shards


def checked(got, rows, n_shards):
    """Every row once, slots without gaps in the order of the keys, sizes right; returns the bytes of each shard."""
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)
    before = None
    for k in range(n_shards):
        mine = sorted((r for r in got if r.shard == k), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        keys = [-math.inf if r.doc_id is None else r.doc_id for r in mine]
        assert keys == sorted(keys) and (before is None or not keys or before <= keys[0])
        before = keys[-1] if keys else before
    return [sum(r.size for r in got if r.shard == k) for k in range(n_shards)]


def test_shards_end_at_the_nearest_row(docs):
    rnd = random.Random(1)
    rows = [(rnd.randint(-(10**15), 10**15) if i % 3 else i, "é" * rnd.choice([0, 5, 80, 3000])) for i in range(1500)]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(10**18, "far away")]
    got = sharding.shard(clashing(docs(rows), "shard", "slot", "size", "_k", "_row").repartition(5)).collect()
    sizes = checked(got, rows, 8)
    ordered = [len(t.encode()) + 1 for _, t in sorted(rows)]
    sums = [0]
    for s in ordered:
        sums.append(sums[-1] + s)
    ends = [min(range(len(sums)), key=lambda p: (abs(8 * sums[p] - k * sums[-1]), p)) for k in range(9)]
    assert sizes == [sums[b] - sums[a] for a, b in zip(ends, ends[1:])]


@pytest.mark.parametrize("kind", ["one id", "no id", "one row"])
def test_shards_divide_a_frequent_key(docs, monkeypatch, kind):
    """A key with a third of all rows, whether these differ or are copies."""
    monkeypatch.setattr(sharding, "_CHUNK", 50)
    rnd = random.Random(2)
    rows = [(i, "t" * rnd.randint(0, 60)) for i in range(2000)]
    hot = {"one id": lambda k: (700, f"text {k}"), "no id": lambda k: (None, f"text {k}"), "one row": lambda k: (700, "a copy of one text")}
    rows += [hot[kind](k) for k in range(1000)]
    sizes = checked(sharding.shard(docs(rows).repartition(7)).collect(), rows, 8)
    assert max(sizes) - min(sizes) <= 2 * 61


def test_shards_in_parts(docs, monkeypatch):
    monkeypatch.setattr(sharding, "PART_BYTES", 1000)
    rows = [(i, "x" * (i % 40)) for i in range(2500)]
    one = sharding.shard(docs(rows).repartition(3))
    other = sharding.shard(docs(rows).repartition(1))
    checked(one.collect(), rows, 8)
    assert set(map(tuple, one.collect())) == set(map(tuple, other.collect()))
    near = sharding.shard(docs(rows), 5, tolerance=0.05).collect()
    sizes = checked(near, rows, 5)
    assert max(sizes) < 1.11 * min(sizes)


def test_shards_of_awkward_documents(spark, awkward, docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    checked(sharding.shard(awkward, 3).collect(), rows, 3)
    few = [(1, "a"), (2, None)]
    checked(sharding.shard(docs(few)).collect(), few, 8)
    assert sharding.shard(docs([])).collect() == []
    maps = docs(few).withColumn("more", F.create_map(F.lit("k"), "text"))
    assert {r.doc_id: r.more for r in sharding.shard(maps).collect()} == {1: {"k": "a"}, 2: {"k": None}}


def test_shards_as_files(spark, docs, tmp_path):
    rows = [(i, "word " * (i % 9)) for i in range(300)]
    shards = sharding.shard(docs(rows), 4)
    sharding.write(shards, str(tmp_path / "out"))
    assert len(glob.glob(str(tmp_path / "out" / "shard=*"))) == 4
    back = spark.read.parquet(str(tmp_path / "out"))
    checked(back.collect(), rows, 4)
