"""Operators that bring rows together, against brute force; the pipeline; the registered queries."""

import base64
import glob
import hashlib
import math
import os
import random
import re
import shutil
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, spark_rows, sql_rows
from jobmeld.llm import bpe, decontam, hosts, langid, quality, simhash, warc
from jobmeld.llm.components import components
from jobmeld.llm.queries import QUERIES, SQL, URL_RULES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(con, SQL[name])


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# near-duplicates


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randint(100, 400), rnd.randint(100, 400)) for _ in range(180)]
    edges += [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert got == {n: want[n] for n in got} and set(got) >= {x for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def signed(x):
    return int(np.uint64(x).astype(np.int64))


@pytest.mark.parametrize("large", [1000, 3])
def test_links_lose_nothing(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    rnd, fps = random.Random(4), set()
    for _ in range(60):
        centre = rnd.getrandbits(64)
        fps.add(centre)
        for _ in range(rnd.randint(0, 12)):
            bits = [rnd.randrange(64) for _ in range(rnd.randint(1, 5))]
            fps.add(centre ^ sum(1 << b for b in set(bits)))
    # one dense group, one half shared by fingerprints that are far apart
    fps |= {0xABCDEF << 20 ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)}
    fps |= {0x12345678 << 32 | rnd.getrandbits(32) for _ in range(80)}
    fps |= {0, (1 << 64) - 1, 1 << 63, 7}
    near = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    want = roots({signed(x) for x in fps}, [(signed(a), signed(b)) for a, b in near])
    found = simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long")).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 3 for r in found)
    assert roots({signed(x) for x in fps}, [(r.a, r.b) for r in found]) == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_a_large_variant_is_not_compared_in_pairs():
    """A hundred thousand fingerprints with one half, few of them linked: no quadratic time, no link lost."""
    rng = np.random.default_rng(2)
    fps = np.unique(rng.integers(0, 1 << 32, 100_000).astype(np.uint64))
    near = fps[:300] ^ np.uint64(0b100010000000000001)
    start = time.perf_counter()
    a, b = simhash._divided(np.unique(np.concatenate([fps, near])), False, 3)
    assert time.perf_counter() - start < 60
    linked = roots({int(x) for x in [*fps, *near]}, zip(a, b))
    assert all((x ^ y).bit_count() <= 3 for x, y in zip(a, b))
    assert all(linked[int(x)] == linked[int(y)] for x, y in zip(fps[:300], near))


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs, awkward):
    more = docs([(70, "One two"), (71, "one TWO"), (72, "one"), (73, "a b c a b c a b c"), (60, "Éa b"), (61, "éa b")])
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    frame = frame.select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source").union(awkward).union(more)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in frame.collect()]
    fps = {fp for _, fp in rows}
    group = roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for doc, fp in rows:
        if doc is not None:
            least[group[fp]] = min(doc, least.get(group[fp], doc))
    want = Counter((doc, f"{fp:016x}", least.get(group[fp])) for doc, fp in rows)
    found = simhash.near_duplicates(frame)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found.collect()) == want

    stays = simhash.one_of_each(frame.withColumn("k1", F.lit(1)), found)
    kept = stays.collect()
    assert stays.columns == [*frame.columns, "k1"]
    assert Counter(group[brute_fingerprint(r.text)] for r in kept) == Counter(set(group.values()))
    assert all(r.doc_id == least.get(group[brute_fingerprint(r.text)]) for r in kept)
    assert simhash.near_duplicates(docs([])).collect() == []


# decontamination


def brute_hits(rows, items, window=13):
    def words(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    known = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            known.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = Counter()
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in known}:
            for k in range(len(w) - size + 1):
                if items_ := known.get(tuple(w[k : k + size])):
                    found |= items_
                    hit |= set(range(k, k + size))
        ids = tuple(sorted(str(i) for i in found if i is not None))
        out[(doc, len(w), len(hit), len(ids), ids, bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


def decon_rows(docs, benchmark):
    found = decontam.search(docs, benchmark).withColumn("bad", decontam.contaminated())
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.bad) for r in found.collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination(spark, docs, awkward, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    rnd = random.Random(9)
    items = [(i, " ".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 30)))) for i in range(12)]
    items += [(90, None), (91, "..."), (92, "Whale and THE ship"), (None, "same row"), (0, items[0][1]), (10, "text")]
    rows = [(100 + i, " ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 120)))) for i in range(60)]
    rows += [(300 + i, "x. " * i + items[3][1] + "!" + " y" * 20 * i) for i in range(6)]
    frame = awkward.union(docs(rows))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decon_rows(frame, benchmark) == brute_hits([(r.doc_id, r.text) for r in frame.collect()], items)


def test_decontamination_of_tables_and_nothing(spark, docs):
    documents, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_hits(
        [(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in benchmark.collect()]
    )
    assert decon_rows(documents, benchmark) == want
    assert decon_rows(docs([]), benchmark) == Counter()
    assert sum(r[2] for r in decon_rows(documents, benchmark.limit(0))) == 0


def test_proximity(spark, docs):
    item = [(1, "red fox jumps over some lazy dogs while seven quick birds sing loudly")]
    text = "red fox jumps high over some lazy dogs while seven quick birds sing very loudly"
    found = {r.doc_id: r for r in decontam.search(docs([(1, text), (2, text[::-1])]), spark.createDataFrame(item, "item_id long, text string")).collect()}
    assert (found[1].n_near_items, found[1].n_items, found[2].n_near_items) == (1, 0, 0)
    assert (found[1].near_ids, found[2].near_ids, found[1].spans) == (["1"], [], [])


def test_places_of_exact_runs(spark, docs):
    """Clashing columns on either side; spans lie where the words are."""
    items = [(1, " ".join(f"w{i}" for i in range(20))), (2, "Short one"), (None, "no id here")]
    text = "x short ONE, y. " + " ".join(f"w{i}" for i in range(3, 18)) + " z no id here short one"
    frame = docs([(1, text), (2, None), (3, "w3 w4")]).withColumn("n_hit", F.lit("own")).withColumn("item", F.lit("own")).withColumn("pos", F.lit("own"))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("own")).withColumn("w", F.lit("own"))
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in decontam.search(frame, benchmark).collect()}
    assert found == {1: [(1, 2, "2"), (4, 15, "1"), (20, 3, None), (23, 2, "2")], 2: [], 3: []}


def test_decontamination_runs_no_python(spark):
    documents, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontam.search(documents, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# archives


EVIL = warc.MARK + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "http://a.b/", "<p>same</p>"), (2, "http://a.b/2", "<p>same</p>"), (3, None, None), (4, "u", ""),
    (None, "x y\r\nz", "q"), (None, "é", "q"), (5, "h", EVIL), (6, "h", EVIL + warc.MARK + EVIL + "é"),
    (7, "h", "WARC/WARC/1.1\r\n" + warc.MARK * 2), (8, "h", "a\r\n\r\n"), (9, "h", EVIL), (9, "h", EVIL),
    (10, "h", EVIL * 50), (11, "h", "x" * 300_000), (12, "h", "\r\n\r\nWARC/1.1\r"),
]


def brute_pages(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    top = {}
    for i, h in payloads:
        top[h] = max([x for x in (top.get(h), i) if x is not None], default=None)
    out = Counter()
    for i, h in payloads:
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        again = i != top[h]
        out[(i, len(h), digest, "revisit" if again else "response", top[h] if again else None, True)] += 1
    return out


def test_archives(spark):
    frame = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    frame = frame.select((F.col("page_id") + 100).alias("page_id"), "url", "html")
    frame = frame.union(spark.createDataFrame(PAGES, frame.schema)).withColumn("payload", F.lit("clash"))
    want = brute_pages([tuple(r)[:3] for r in frame.collect()])
    assert Counter(tuple(r) for r in warc.round_trip(frame).collect()) == want
    assert warc.round_trip(frame.limit(0)).collect() == []


def test_archives_in_splits(spark, tmp_path):
    """Files of many splits, with marks in payloads across their borders."""
    frame = spark.createDataFrame(PAGES * 3, "page_id long, url string, html string")
    warc.write(frame, str(tmp_path / "written"))
    os.makedirs(tmp_path / "plain")
    for i, f in enumerate(glob.glob(str(tmp_path / "written" / "*.txt"))):
        shutil.copy(f, tmp_path / "plain" / f"{i}.warc")
    conf = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = Counter(tuple(r) for r in warc.read(spark, str(tmp_path / "plain")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_pages(PAGES * 3)


def test_archives_in_other_splits_when_read_again(spark, tmp_path, monkeypatch):
    """The second scan, for records torn by marks in their payload, packs the files otherwise than the first."""
    frame = spark.createDataFrame(PAGES * 3, "page_id long, url string, html string")
    warc.write(frame, str(tmp_path / "written"))
    os.makedirs(tmp_path / "plain")
    for i, f in enumerate(glob.glob(str(tmp_path / "written" / "*.txt"))):
        shutil.copy(f, tmp_path / "plain" / f"{i}.warc")
    conf = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "100"}
    before, rejoined = {k: spark.conf.get(k) for k in conf}, warc._rejoined

    def otherwise(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
        return rejoined(*args)

    monkeypatch.setattr(warc, "_rejoined", otherwise)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = Counter(tuple(r) for r in warc.read(spark, str(tmp_path / "plain")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_pages(PAGES * 3)


# URLs


def test_urls(spark):
    urls = [
        "http://A.Example.NET/en/x?q#f", "https://example.com/de/", "https://example.com/dex", "http://x.org/fr/", "http://net",
        "http://net/", "http://internet/", None, "no url", "", "a://b://c/d", "http://h.example.com?x=/de/", "http:///de/",
        "HTTP://WWW.EXAMPLE.NET/EN/", "http://user@x.example.com:80/de/a",
    ]
    frame = spark.createDataFrame([(i, u, "clash", None) for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, rule string, html string")
    frame = frame.withColumn("host", F.lit("own")).withColumn("bad", F.lit("own"))
    got = {r.page_id: r for r in hosts.judge(frame, URL_RULES).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
        path, best = (m[2] if m else ""), None
        for rule, verdict in URL_RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] if best else ""):
                best = (rule, verdict)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best[0] if best else None)
        assert not best or got[i].verdict == best[1]
    assert hosts.judge(frame.limit(0), URL_RULES).collect() == []


def shrunk(levels, overall):
    """Posterior means down a tree of (children by node, n, bad), one level after the other, as the text book has them."""
    means = {"": overall}
    for nodes in levels:  # node -> (parent, n, bad)
        full = [(n, bad, means[up]) for up, n, bad in nodes.values() if n]
        total, off = sum(n for n, _, _ in full), sum(n * (bad / n - m) ** 2 for n, bad, m in full)
        chance = sum(m * (1 - m) for _, _, m in full)
        k = 1.0
        if full:
            beyond = (off - chance) / total
            k = min(max(chance / len(full) / beyond - 1, 1.0), float(total)) if beyond > 0 else float(total)
        sizes = {x: n + k for x, (_, n, _) in nodes.items()}
        means = {x: (bad + k * means[up]) / (n + k) for x, (up, n, bad) in nodes.items()}
    return means, sizes


def test_url_verdicts_equal_brute_force(spark):
    rnd = random.Random(6)
    good = "<p>" + "word " * 60 + "</p><script>no no</script>"
    thin = "<html><style>" + "x " * 90 + "</style><!-- " + "y " * 90 + "--><p>short</p></html>"
    names = [f"h{i}.{d}" for i in range(12) for d in ("a.example", "b.example", "c.co.uk", "d.co.uk", "e.vn")] + ["", "vn", "co.uk"]
    rows = []
    for h in names:
        share = rnd.choice([0, 0, 0.1, 0.9, 1])
        for _ in range(rnd.randint(1, 25)):
            url = rnd.choice([None, "no url"]) if not h else f"http://{h}/{rnd.choice(['de/', 'en/', 'spam/', 'spamming/'])}{rnd.randint(0, 99)}"
            rows.append((len(rows), url, rnd.choice([thin, None]) if rnd.random() < share else good))
    rules = [("a.example/de/", "block"), ("h1.b.example/", "allow")]
    got = {r.page_id: r for r in hosts.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}
    assert len(got) == len(rows)
    seen = {}
    for i, url, html in rows:
        bad = None if url is None else bool(re.search(r"(^|[^a-z])spam([^a-z]|$)", url)) or html != good
        n, b = seen.get(got[i].host, (0, 0))
        seen[got[i].host] = (n + (bad is not None), b + bool(bad))
    suffix = {h: "co.uk" if h.endswith(".co.uk") else h.split(".")[-1] for h in seen}
    domain = {h: ".".join(h.split(".")[-1 - suffix[h].count(".") - 1 :]) for h in seen}

    def level(name, up):
        out = {}
        for h, (n, b) in seen.items():
            p, m, c = out.get(name(h), (up(h), 0, 0))
            out[name(h)] = (p, m + n, c + b)
        return out

    n, b = (sum(x) for x in zip(*seen.values()))
    levels = [level(suffix.get, lambda h: ""), level(domain.get, suffix.get), level(lambda h: h, domain.get)]
    means, sizes = shrunk(levels, (b + 0.5) / (n + 1))
    blocked = {h for h, r in means.items() if r - 2 * math.sqrt(r * (1 - r) / (sizes[h] + 1)) > 0.5}
    assert blocked and len(blocked) < len(means) / 2
    for r in got.values():
        want = {"a.example/de/": "block", "h1.b.example/": "allow"}.get(r.rule, "block" if r.host in blocked else "allow")
        assert r.verdict == want, r


def test_a_path_rule_is_no_evidence_against_its_host(spark):
    rows = [(i, f"http://example.com/{'de' if i < 80 else 'en'}/{i}", "word " * 60) for i in range(100)]
    got = hosts.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()
    assert {(r.rule, r.verdict) for r in got} == {("example.com/de/", "block"), (None, "allow")}


def test_reputation(spark):
    rows = [("bad.example.com", i >= 2) for i in range(40)] + [("good.example.com", i < 1) for i in range(40)]
    rows += [("few.example.com", True)] * 2 + [(f"h{i}.other.org", i % 2 == 0) for i in range(20)] + [("new.example.com", None)]
    got = {r.host: r for r in hosts.reputation(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert got["bad.example.com"].sure_rate > 0.5 > got["few.example.com"].sure_rate
    assert got["good.example.com"].rate < got["new.example.com"].rate < got["bad.example.com"].rate
    assert got["bad.example.com"].rate < 38 / 40 and got["few.example.com"].rate < 1


# pipeline


def stage_keeps(spark, name, docs):
    """Ids that a stage has to keep of `docs`, by the results of its operator."""
    if name == "quality_rules":
        return {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    if name == "language_id":
        return {r.doc_id for r in langid.identify(docs).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    if name == "near_dedup":
        return {r.component_id for r in simhash.near_duplicates(docs).collect()}
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return {r[0] for r in brute_hits([(r.doc_id, r.text) for r in docs.collect()], benchmark) if not r[-1]}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit("clash")).withColumn("k1", F.lit(1))
    now, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, SF)
        assert now.columns == docs.columns
        now = spark.createDataFrame(now.collect(), docs.schema)
        ids = [r.doc_id for r in now.collect()]
        assert len(ids) == len(set(ids)) and set(ids) == stage_keeps(spark, name, before), name
        sizes.append(now.count())
    assert docs.count() > sizes[0] >= sizes[1] > sizes[2] > sizes[3] > 0
    kept = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    assert sizes[0] == len(kept)
    rows = corpus_pipeline.run(spark, SF).collect()
    digests = bpe.digests(bpe.encode_decode(now, public_tokenizers.path("byte_bpe_50k.json"))).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, digests)) and len(rows) == sizes[-1]


def test_pipeline_awkward(spark, docs, awkward):
    for frame in (awkward, docs([])):
        now = frame.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
        for _, stage in corpus_pipeline.STAGES:
            for given in (now, now.limit(0)):
                stage(spark, given, SF).collect()
