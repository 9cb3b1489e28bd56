"""Operators that read a text at a time, against brute force, a library or held-out rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from jobmeld.llm import bpe, langid, licenses, lmscore, quality, tokenfile

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def everything(spark, awkward):
    tables = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    return tables.union(awkward)


def bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def random_texts(n, seed=5):
    rnd, out = random.Random(seed), []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.4:
            out.append("".join(rnd.choice("aeiouthnrs \n'") for _ in range(rnd.randint(0, 40))))
        elif kind < 0.8:
            spans = [(32, 126), (160, 0x600), (0x4E00, 0x9FFF), (0x10000, 0x1FFFF), (0x80, 0xA0), (0x2000, 0x200F)]
            out.append("".join(chr(rnd.randint(*rnd.choice(spans))) for _ in range(rnd.randint(1, 20))))
        else:
            out.append(rnd.choice("abe0 \t") * rnd.randint(1, 150) + "<|endoftext|>" * rnd.randint(0, 2) + " we'll  x\n\n y")
    return out


def test_bpe_equals_library(library):
    model = bpe.ByteBpe(BYTES)
    texts = random_texts(6000)
    for i in range(0, len(texts), 700):
        part = texts[i : i + 700]
        got = model.encode([t.encode() for t in part])
        for text, ids, back in zip(part, got, model.decode(got)):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert back.decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_check_finds_what_merging_finds(library):
    """The vectorised check of a pair agrees with merging the pair's bytes."""
    model, rnd = bpe.ByteBpe(BYTES), random.Random(3)
    tokens = [t for t in range(50_000) if rnd.random() < 0.05 and model.stands(t)]
    pairs = [(rnd.choice(tokens), rnd.choice(tokens)) for _ in range(3000)]
    a, b = map(np.array, zip(*pairs))
    want = [model.merged(model.bytes_of[x] + model.bytes_of[y]) == [x, y] for x, y in pairs]
    assert model.compatible(a, b).tolist() == want
    assert 0 < sum(want) < len(want)


def test_bpe_long_words(library):
    text = "a" * 20_000 + "é" * 5_000 + "!" * 5_000
    got = bpe.ByteBpe(BYTES).encode([text.encode()])[0]
    assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_query_columns(spark, awkward, library):
    docs = everything(spark, awkward)
    got = bag(bpe.digests(bpe.encode_decode(docs, BYTES)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw, back = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        want[(r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert got == want


# token files


def test_token_files_round_trip(spark, awkward):
    lib, docs = Tokenizer.from_file(WORDS), everything(spark, awkward)
    rows = []
    for r in docs.withColumn("h", F.xxhash64("text")).collect():
        ids = np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        rows.append((r.doc_id, r.h, ids))
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, start = Counter(), 0
    for key, _, ids in rows:
        want[(key, start, len(ids) // 4, zlib.crc32(ids))] += 1
        start += len(ids) // 4
    assert bag(tokenfile.round_trip(docs, WORDS), "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_token_files_many_blocks_and_unknown_keys(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 40)
    monkeypatch.setattr(tokenfile, "BUCKET_KEYS", 50)
    made = docs([(i, "word " * (i % 17)) for i in range(400)])
    out = str(tmp_path / "ids")
    tokenfile.write(made, WORDS, out)
    assert spark.read.parquet(f"{out}/index").count() > 4 and spark.read.parquet(f"{out}/blocks").count() > 20
    keys = spark.range(0, 800, 3).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("nth"))
    got = {r.doc_id: (r.start, len(r.ids) // 4) for r in tokenfile.fetch(spark, out, keys).collect()}
    starts = np.cumsum([0, *(i % 17 + 1 for i in range(400))]).tolist()
    assert got == {i: (starts[i], i % 17 + 1) for i in range(0, 400, 3)}


@pytest.mark.parametrize("key", [7, None])
def test_token_files_of_a_frequent_key(spark, docs, tmp_path, monkeypatch, request, key):
    """A third of all rows share an id, half of them the text as well: tasks share them, and each keeps a key of its own."""
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 200)
    monkeypatch.setattr(tokenfile, "_NUMBERED", 70)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before))
    rows = [(i, "word " * (i % 5)) for i in range(800)] + [(key, f"text {i}" if i % 2 else "a copy") for i in range(400)]
    made = docs(rows).withColumn("nth", F.lit("own")).withColumn("ids", F.lit("own")).repartition(6)
    got = tokenfile.round_trip(made, WORDS).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)]).tolist()[:-1]
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in got), key=lambda k: -1 if k is None else k)
    lib = Tokenizer.from_file(WORDS)
    digests = Counter(zlib.crc32(np.array(lib.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for _, t in rows)
    assert Counter(r.ids_crc32 for r in got) == digests
    tokenfile.write(made, WORDS, str(tmp_path / "out"))
    parts = spark.read.parquet(str(tmp_path / "out" / "blocks")).select("part", F.explode("keys").alias("k"))
    assert parts.filter(F.col("k").eqNullSafe(F.lit(key))).select("part").distinct().count() > 1


def test_token_ids_that_do_not_fit_raise(spark, docs, tmp_path):
    made = docs([(1, "a word")])
    with pytest.raises(Exception, match="does not fit 16 bits"):
        tokenfile.write(made, WORDS, str(tmp_path / "narrow"), end_id=70_000, wide=False)
    tokenfile.write(made, WORDS, str(tmp_path / "wide"), end_id=70_000)
    got = tokenfile.fetch(spark, str(tmp_path / "wide"), docs([(1, None)]).select("doc_id", F.lit(0).alias("nth"))).first()
    assert np.frombuffer(got.ids, "<u4")[-1] == 70_000


def test_encoder_equals_library(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokenfile, "_RUNS", 500)

    rnd = random.Random(8)
    spans = [(32, 126), (160, 0x600), (0x4E00, 0x9FFF), (0x10000, 0x1FFFF), (0x80, 0xA0), (0x2000, 0x200F), (0x300, 0x36F), (0xC0, 0x100)]
    texts = ["".join(rnd.choice("aeiouthnrs \n'.,;!?AÉéß-\"9") for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(chr(rnd.randint(*rnd.choice(spans))) for _ in range(rnd.randint(1, 25))) for _ in range(1500)]
    texts += ["", " ", "\x1c\x85", "<|endoftext|>x", "we'll x.\n\n y,, İİ ﬁ.. Ǆ é. É, a\xa0b", "word " * 20_000]
    for path in (WORDS, BYTES):
        lib, model = Tokenizer.from_file(path), tokenfile.Encoder(path)
        assert model.separable == (path == WORDS)
        for some in (texts, [""], []):
            found = [part for ids, stops in model.encode(pa.array(some, pa.string()), 1) for part in np.split(ids, stops[:-1]) if len(stops)]
            for t, got in zip(some, found, strict=True):
                assert got.tolist() == [*lib.encode(t, add_special_tokens=False).ids, 1], t


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 5000)).astype(np.uint64)
    built = tokenfile.PerfectHash.build(a, b)
    again = tokenfile.PerfectHash.from_bytes(*built.to_bytes())
    assert sorted(again.slots(a, b).tolist()) == list(range(5000))
    none = tokenfile.PerfectHash.build(a[:0], b[:0])
    assert none.slots(a, b).max() == -1


def test_token_files_of_nothing(spark, docs):
    assert tokenfile.round_trip(docs([]), WORDS).collect() == []


# licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_licenses(text):
    words, places, base, labels, score = words_of(text), [], set(), set(), 0.0
    for phrase, label in licenses.BASE:
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    line = " " + " ".join(words) + " "
    for phrase, label in licenses.NOTICES:
        k = len(phrase) // licenses.LETTERS_PER_EDIT
        if regex.search(f"(?:{regex.escape(phrase)}){{e<={k}}}", line):
            labels.add(label)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)),
    )


def test_licenses_equal_brute_force(spark, docs, awkward):
    more = docs(
        [
            (100, "Released UNDER the  MIT-License, under the mit license"),
            (101, "relased undr the mit licence"),
            (102, "cc by nc by nc; CC-BY-NC 4.0"),
            (103, "the gnu genral public licens and a mozila publik license"),
            (104, "apache license, version 2.0; Apache Licence Version 2"),
            (105, "ünder the mit license … under thé mit license"),
            (106, "redistribution and use in source or binary form"),
        ]
    )
    frame = everything(spark, awkward).union(more)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    got = bag(licenses.scan(frame), "doc_id", *names)
    assert got == Counter((r.doc_id, *brute_licenses(r.text)) for r in frame.collect())
    found = {r.doc_id: r for r in licenses.scan(more).collect()}
    assert found[101].labels == "mit" and 0 < found[101].score < 1 and found[100].score == 1
    span = found[101].spans[0]
    assert (span.label, span.first, span.last, span.edits) == ("mit", 1, 4, 2)


# quality


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again))


def test_quality_counts(spark, docs, awkward):
    more = docs([(50, "a b c a b c d a b c"), (51, "x\nx \nx\n\n\ny\ny"), (52, "a a a a"), (53, "é # <b> é\x0bé")])
    frame = everything(spark, awkward).union(more)
    got = bag(quality.judge(frame), "doc_id", *quality.COUNTS)
    assert got == Counter((r.doc_id, *brute_quality(r.text)) for r in frame.collect())


def test_quality_many_kinds_of_words(monkeypatch):
    words = [str(random.Random(i).randint(0, 6)).encode() for i in range(500)]
    want = quality._repeated(words)
    monkeypatch.setattr(quality, "_TOO_MANY", 1)
    assert quality._repeated(words) == want > 0


def test_quality_hosts(spark, docs):
    good = " ".join(f"word{i}" for i in range(60))
    odd = " ".join(f"w{i} #" for i in range(60))
    rows = [(i, "short", None, "bad") for i in range(40)]
    rows += [(100, good, None, "bad"), (101, odd, None, "bad"), (102, odd, None, "fine"), (103, good, None, None)]
    rows += [(200 + i, good, None, "fine") for i in range(40)] + [(300 + i, good, None, f"h{i}") for i in range(5)]
    got = {r.doc_id: (r.host_failed, r.kept) for r in quality.judge(docs(rows)).collect()}
    assert got[100] == (True, True) and got[101] == (True, False)
    assert got[102] == (False, True) and got[103] == (False, True) and got[0] == (True, False)
    assert quality.judge(docs([])).collect() == []


def test_quality_verdicts_by_planted_hosts(spark, docs, awkward):
    """In a whole table, two planted hosts turn the verdicts of their documents, and only theirs; as SQL has it, too."""
    odd, good = " ".join(f"w{i} #" for i in range(60)), " ".join(f"word{i}" for i in range(60))
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    planted = [(10_000 + i, odd if i < 3 else good, None, "trusted") for i in range(400)]
    planted += [(20_000 + i, odd if i < 300 else good, None, "junk") for i in range(400)]
    frame = table.union(docs(planted)).union(awkward).withColumn("kept", F.lit("own")).withColumn("host", F.lit("own")).withColumn("n_words", F.lit(1))
    got = quality.judge(frame).collect()
    assert len(got) == frame.count()
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[10_000 + i].kept and by_id[10_000 + i].strict_failed for i in range(3))
    assert not any(by_id[20_000 + i].kept for i in range(300)) and all(by_id[20_000 + i].kept for i in range(300, 400))
    assert by_id[10_000].host_trusted and by_id[20_000].host_failed
    # brute force over the hosts' shares
    rows = [(r.source, by_id.get(r.doc_id)) for r in frame.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    hosts = {h: [r.base_failed or r.strict_failed for g, r in rows if g == h] for h, _ in rows}
    assert sum(hosts["trusted"]) == 3 and sum(hosts["junk"]) == 300
    for r in got:
        assert r.kept == (not r.base_failed and (r.host_trusted or not r.strict_failed))
    assert quality.judge(frame.limit(0)).collect() == []


def test_quality_junk_of_ordinary_hosts(docs):
    """No host fails the base rules; symbol and repeated-line junk goes, from a mixed host and from one of junk only."""
    good = " ".join(f"word{i}" for i in range(60))
    symbols = " ".join(f"w{i} #" for i in range(60))
    lines = "\n".join(["the same line again"] * 4 + [good])
    rows = [(100 * h + i, good, None, f"h{h}") for h in range(5) for i in range(36)]
    rows += [(100 * h + 50 + i, (symbols, lines)[i % 2], None, f"h{h}") for h in range(5) for i in range(4)]
    rows += [(900 + i, symbols, None, "junk") for i in range(40)]
    got = {r.doc_id: r for r in quality.judge(docs(rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    clean = {i for i, text, *_ in rows if text == good}
    assert all(got[i].kept for i in clean) and not any(got[900 + i].kept for i in range(40))
    assert got[900].host_failed
    rows = [(i, t, None, f"h{i % 5}") for i, t, *_ in rows if i < 900]
    got = {r.doc_id: r for r in quality.judge(docs(rows)).collect()}
    assert {i for i, r in got.items() if r.kept} == clean


# language


def test_language_of_held_out_rows(spark):
    found = langid.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(known, "doc_id").filter("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_more_languages_than_a_matrix_holds(spark, awkward, monkeypatch):
    """Blocks of languages give what one matrix gives, for rows that repeat, ties and texts without a letter as well."""
    docs = everything(spark, awkward).withColumn("best", F.lit("own")).withColumn("share", F.lit("own"))
    twice = docs.filter("lang = 'en' and doc_id < 60").withColumn("lang", F.lit("en again"))
    docs = docs.union(twice).union(docs.filter("doc_id = 5"))
    want = {(r.doc_id, r.r1): r for r in langid.identify(docs).collect()}
    monkeypatch.setattr(langid, "_CELLS", 5000)
    for size in (1, 2):
        monkeypatch.setattr(langid, "BLOCK_LANGS", size)
        got = langid.identify(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            a = want[r.doc_id, r.r1]
            assert r.lang_pred == a.lang_pred and r.score == pytest.approx(a.score, abs=1e-6)


def test_score_equals_brute_force(docs):
    """The whole score: share among the languages, times the fit against the learnt texts of the language."""
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice("abc " if i % 2 else "cde ") for _ in range(rnd.randint(5, 90))), "xy"[i % 2]) for i in range(80)]
    rows += [(100, "zzz qqq", None), (101, "aé", "x"), (102, None, "x"), (103, "12", "y")]
    frame = docs(rows)
    fold = {r.doc_id: r.h for r in frame.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    learnt = [(t, lang) for i, t, lang in rows if not fold[i] and t is not None and lang]
    counts = {x: Counter() for x in "xy"}
    for t, lang in learnt:
        a, c = langid.features(t)
        counts[lang].update(dict(zip(a.tolist(), c.tolist())))
    size = {x: sum(c.values()) + (1 << langid.BITS) for x, c in counts.items()}

    def scores(t):
        a, c = langid.features(t)
        sums = {x: sum(m * math.log((counts[x][k] + 1) / size[x]) for k, m in zip(a.tolist(), c.tolist())) for x in "xy"}
        prior = {x: math.log(sum(lang == x for _, lang in learnt) / len(learnt)) for x in "xy"}
        best = max("xy", key=lambda x: (sums[x] + prior[x], -ord(x)))
        share = 1 / sum(math.exp(sums[x] + prior[x] - sums[best] - prior[best]) for x in "xy")
        return best, share, sums[best] / int(c.sum()), int(c.sum())

    fits = {x: [] for x in "xy"}
    for t, lang in learnt:
        if re.search(r"[^\W\d_]", t) and scores(t)[0] == lang:
            fits[lang].append(scores(t)[2:])
    usual = {}
    for x, seen in fits.items():
        n = sum(g for _, g in seen)
        mean, rows_, inverse = sum(v * g for v, g in seen) / n, len(seen), sum(1 / g for _, g in seen)
        plain, weighted = sum((v - mean) ** 2 for v, _ in seen), sum(g * (v - mean) ** 2 for v, g in seen)
        room = n * inverse - rows_**2
        per = max((plain * n - weighted * rows_) / room, 0.0) if room > 1e-6 * rows_**2 else 0.0
        usual[x] = mean, (rows_ * max((weighted - per * rows_) / n, 0.0) + 10) / (rows_ + 10), per
    for r in langid.identify(frame).collect():
        t = next(t for i, t, _ in rows if i == r.doc_id)
        if t is None or not re.search(r"[^\W\d_]", t):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        best, share, fit, grams = scores(t)
        mean, between, per = usual[best]
        below = (fit - mean) / math.sqrt(between + per / grams)
        assert r.lang_pred == best and r.score == pytest.approx(share / (1 + math.exp(-(below + langid.LEAST_FIT))), abs=1e-5)


def test_language_scores_equal_brute_force(docs):
    frame = docs([(i, t, lang) for i, (t, lang) in enumerate([("aaa bbb", "x"), ("ccc ddd", "y"), ("aab", None), ("12", "x")] * 9)])
    learnt = frame.filter(~langid.held_out(F.col("doc_id")))
    [(langs, logs)] = langid.learn(learnt, F.col("text"), F.col("lang"))
    assert langs == ["x", "y"]
    totals, n = {x: Counter() for x in langs}, Counter()
    for r in learnt.collect():
        if r.lang:
            at, c = langid.features(r.text)
            totals[r.lang].update(dict(zip(at.tolist(), c.tolist())))
            n[r.lang] += 1
    want = []
    for x in langs:
        s = np.log(n[x] / sum(n.values()))
        at, c = langid.features("aab")
        for k, m in zip(at.tolist(), c.tolist()):
            s += m * np.log((totals[x][k] + 1) / (sum(totals[x].values()) + (1 << langid.BITS)))
        want.append(s)
    names, scores = langid.classify([b"aab", b"", b"12"], langs, logs)
    assert names == [langs[int(np.argmax(want))], "und", "und"]
    assert scores[0] == pytest.approx(1 / sum(np.exp(w - max(want)) for w in want)) and scores[1:] == [0, 0]


def test_language_awkward(spark, docs, awkward):
    found = langid.identify(awkward)
    assert found.count() == awkward.count()
    assert {r.lang_pred for r in found.filter("doc_id in (1, 2, 3)").collect()} == {"und"}
    assert [r.lang_pred for r in langid.identify(docs([(1, "text")])).collect()] == ["und"]
    assert langid.identify(docs([])).collect() == []


def test_language_rejects_what_was_not_learnt(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(2)
    alphabets = {
        "cyrillic": "абвгдежзийклмнопрстуфхцчшщ", "greek": "αβγδεζηθικλμνξοπρστ", "arabic": "ابتثجحخدذرزسشص",
        "han": "的一是不了人我在有他这中大来上", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        "letters": "abcdefghijklmnopqrstuvwxyz",
    }
    junk = {
        10**6 + i: " ".join("".join(rng.choices(a, k=60 if name == "base64" else rng.randint(3, 9))) for _ in range(80))
        for i, (name, a) in enumerate(alphabets.items())
    }
    frame = real.union(spark.createDataFrame([(i, t, None) for i, t in junk.items()], real.schema))
    found = langid.identify(frame)
    assert found.drop("r1", "r2").columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r.doc_id: r.score for r in found.collect()}
    assert all(got[i] < 0.5 for i in junk)
    clean = [r.doc_id for r in real.filter("lang is not null and length(text) >= 200").collect()]
    assert len(clean) > 500 and all(got[i] > 0.5 for i in clean)
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, frame, None).collect()}
    assert left >= set(clean) and not left & set(junk)


# language model


def test_score_equals_formula():
    rng = np.random.default_rng(0)
    model = lmscore.new_model(rng.integers(0, 50, lmscore.BUCKETS))
    texts = [rng.integers(1, lmscore.BUCKETS, n).astype("<u2") for n in (7, 0, 1, 5000)]
    n, total = lmscore.score_texts(model, [t.tobytes() for t in texts])
    assert n.tolist() == [7, 0, 1, 5000]
    embed, w1, b1, w2, b2 = model.parts()
    for t, got in list(zip(texts, total))[:3]:
        padded, want = [0, 0, *t.tolist(), 0, 0], 0.0
        for i, own in enumerate(t.tolist()):
            x = np.concatenate([embed[padded[i + 2 + k]] for k in lmscore.REACH])
            z = np.tanh(x @ w1 + b1) @ w2 + b2
            want += z[model.class_of[own]] - np.log(np.exp(z).sum()) + model.log_share[own]
        assert got == pytest.approx(want, rel=1e-4)
    shares = np.bincount(model.class_of, np.exp(model.log_share), lmscore.CLASSES)
    assert shares == pytest.approx(1)


def test_gradient():
    """One step lowers the loss of the batch it is taken on."""
    rng = np.random.default_rng(0)
    ids = [rng.integers(1, 30, 3000).astype("<u2").tobytes()]
    model = lmscore.new_model(np.bincount(np.frombuffer(ids[0], "<u2"), minlength=lmscore.BUCKETS))
    before = lmscore.score_texts(model, ids)[1][0]
    state = np.full(len(model.flat), 1e-8, np.float32)
    for _ in range(5):
        lmscore.train_on(model, ids, state)
    assert lmscore.score_texts(model, ids)[1][0] > before


def test_text_scores_above_its_shuffled_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en'").select("doc_id", "text")
    mixed = docs.select((F.col("doc_id") + 10**6).alias("doc_id"), F.array_join(F.shuffle(F.split("text", r"\s+"), seed=3), " ").alias("text"))
    got = {r.doc_id: r for r in lmscore.score(docs.union(mixed.filter("doc_id % 10 = 0"))).collect()}
    pairs = [(got[i - 10**6], r) for i, r in got.items() if i >= 10**6 and r.n_tokens > 200]
    assert len(pairs) > 20
    assert np.mean([a.mean_log_likelihood - b.mean_log_likelihood for a, b in pairs]) > 0


def test_scores_equal_brute_force(docs, awkward, monkeypatch):
    """Every token of every row, one by one, under the trained network and the words' exact counts."""
    monkeypatch.setattr(lmscore, "_BYTES", 200)
    monkeypatch.setattr(lmscore, "_FREQUENT", 6)
    rnd = random.Random(3)
    words = [*"abcdefgh", "Été", "x" * 90, "X" * 90, "y" * 90]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 25)))) for i in range(60)] + [(5, "a b"), (5, "a b"), (None, "a\x0bb\x1cc")]
    frame = docs(rows).withColumn("r1", F.lit("own")).withColumn("ids", F.lit("own")).withColumn("n", F.lit(1))
    seen = lmscore.tokens(frame).filter("round >= 0").select("round", "r1", "r2", "ids")
    model = lmscore.train(seen)
    cut = {k: lower(t).replace("\x0b", " ").split(" ") for k, (_, t) in enumerate(rows)}
    cut = {k: [w for w in ws if w] for k, ws in cut.items()}
    counts = Counter(w for ws in cut.values() for w in ws)
    in_class = Counter()
    for w, c in counts.items():
        in_class[model.class_of[lmscore.bucket(lmscore._short(w))]] += c
    embed, w1, b1, w2, b2 = model.parts()
    want = []
    for k, (i, _) in enumerate(rows):
        total, ids = 0.0, [lmscore.bucket(lmscore._short(w)) for w in cut[k]]
        padded = [0, 0, *ids, 0, 0]
        for at, (w, own) in enumerate(zip(cut[k], ids)):
            x = np.concatenate([embed[padded[at + 2 + r]] for r in lmscore.REACH])
            z = np.tanh(x @ w1 + b1) @ w2 + b2
            c = model.class_of[own]
            total += z[c] - np.log(np.exp(z).sum()) + np.log(counts[w] / in_class[c])
        want.append((i, len(ids), total))
    got = [(r.doc_id, r.n_tokens, r.log_likelihood) for r in lmscore.score(frame).collect()]
    key = lambda r: (-1 if r[0] is None else r[0], r[1], round(r[2], 2))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-3)


def test_model_does_not_depend_on_the_layout(spark, monkeypatch):
    """Same model, bit by bit, from other partitions, files and tasks, with rows that repeat."""
    monkeypatch.setattr(lmscore, "SHARD_TOKENS", 5000)
    monkeypatch.setattr(lmscore, "_COPIES", 7)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.filter("doc_id = 3").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("k"))
    models = [
        lmscore.train(lmscore.tokens(docs.repartition(n, *by)).filter("round >= 0").select("round", "r1", "r2", "ids"))
        for n, by in ((1, ()), (7, ("text",)), (3, ("doc_id",)))
    ]
    assert np.array_equal(models[0].flat, models[1].flat) and np.array_equal(models[0].flat, models[2].flat)
    assert np.abs(models[0].flat - lmscore.new_model(models[0].class_count[models[0].class_of]).flat).max() > 0


def test_scores_awkward_and_again(docs, awkward):
    first, second = ([tuple(r) for r in lmscore.score(awkward).collect()] for _ in range(2))
    assert sorted(first, key=repr) == sorted(second, key=repr)
    empty = [r for r in first if not r[1]]
    assert len(empty) == 4 and all(r[2] == 0 and r[3] is None for r in empty)
    assert lmscore.score(docs([])).collect() == []


@pytest.mark.parametrize("room", [1 << 16, 2, 0])
def test_words_of_a_bucket_have_counts_of_their_own(docs, monkeypatch, room):
    """Two words that share a bucket differ by their counts, whether those are broadcast or joined."""
    monkeypatch.setattr(lmscore, "_FREQUENT", room)
    rare = next(w for i in range(10**6) if lmscore.bucket(w := b"x%d" % i) == lmscore.bucket(b"frequent"))
    rows = [(i, "frequent words and more of these words") for i in range(40)] + [(40, "frequent"), (41, rare.decode()), (41, rare.decode())]
    frame = docs([*rows, (42, None)])
    counts = Counter(w for _, t in rows for w in t.split())
    assert {bytes(r.word).decode(): r.n for r in lmscore.vocabulary(lmscore.tokens(frame)).collect()} == counts
    got = {r.doc_id: r for r in lmscore.score(frame).collect()}
    assert (got[41].n_tokens, got[42].n_tokens, got[42].log_likelihood) == (1, 0, 0.0)
    assert got[40].log_likelihood - got[41].log_likelihood == pytest.approx(np.log(41 / 2), abs=1e-5)
