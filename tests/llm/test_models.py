"""Classifiers, the language model, WARC archives, URL templates, near duplicates, and the pipeline."""

import io
import math
import os
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from changeflow.llm import jaccard, ngram, packing, quality, queries, toxicity, urls, warc
from changeflow.llm.common import words
from changeflow.session import work_dir

DOCS = "doc_id long, text string"
LARGER = "/root/testdata/sf0.01"


def held_out_accuracy(spark, query, label):
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = query(spark, LARGER).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 20 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    return sum(r["predicted"] == r[label] for r in rows) / len(rows)


def test_quality_learns(spark):
    assert held_out_accuracy(spark, queries.op8_quality_classifier, "quality") >= 0.95


def test_toxicity_learns(spark):
    assert held_out_accuracy(spark, queries.op4_toxicity, "toxic") >= 0.93


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_edge_cases(spark, module):
    nice = [f"a fine sentence number {i} about gardens. And another {i * 7} one of calm." for i in range(40)]
    bad = [f"you are a villain number {i}!!! $$$ buy buy buy now. What an oaf you are {i}!!!" for i in range(40)]
    rows = [(i, t, "mine") for i, t in enumerate(nice + bad)] + [(None, "", "x"), (500, None, "x"), (501, "z " * 200_000, "x")]
    docs = spark.createDataFrame(rows, DOCS + ", score string")
    name = "quality" if module is quality else "toxic"
    label = [(i, int((i < 40) == (module is quality))) for i in range(80)] + [(3, None), (None, 1), (3, 7), (900, 1)]
    labels = spark.createDataFrame([*label, label[0]], f"doc_id long, {name} int")
    model = module.fit(docs, labels, F.lit(True))
    out = {r["doc_id"]: r for r in module.score(docs, model).collect()}
    assert len(out) == 83 and all(0 <= r["score"] <= 1 for r in out.values())
    assert sum(out[i]["predicted"] == y for i, y in label[:80]) >= 76
    kept = module.reject(docs, labels)
    assert kept.columns == docs.columns and {r["score"] for r in kept.collect()} <= {"mine", "x"}
    # Nothing to learn from: nothing is rejected.
    assert module.reject(docs, labels.limit(0)).count() == docs.count()
    assert module.reject(docs.limit(0), labels).count() == 0
    if module is toxicity:
        found = toxicity.score(docs.filter("doc_id = 41"), model, spans=True).first()
        assert found["offending"] and all("!!!" not in found["text"][s["start"] : s["end"]] for s in found["offending"])


# -- language model --------------------------------------------------------


class Loop:
    """Interpolated modified Kneser-Ney over dictionaries."""

    def __init__(self, texts):
        self.tokens = [[*words(t), "</s>"] for t in texts]
        self.pairs = Counter(p for s in self.tokens for p in zip(["<s>", *s], s))
        self.count = Counter(w for s in self.tokens for w in s)
        self.before = Counter(w for _, w in self.pairs)
        self.after = defaultdict(Counter)
        for (a, w), n in self.pairs.items():
            self.after[a][w] = n
        four = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        self.dp, self.dw = ngram.discounts(four(self.pairs)), ngram.discounts(four(self.before))
        self.total = len(self.pairs)

    def p(self, a, w):
        spare = sum(self.dw[min(n, 3)] for n in self.before.values()) / self.total
        n = self.before[w]
        low = (n - self.dw[min(n, 3)]) / self.total + spare / (len(self.count) + 1)
        if a not in self.after:
            return low
        own, size = self.after[a], sum(self.after[a].values())
        back = sum(self.dp[min(n, 3)] for n in own.values()) / size
        return max(own[w] - self.dp[min(own[w], 3)], 0) / size + back * low


@pytest.mark.parametrize("narrow", [ngram.NARROW, 12])  # with 12 some shards need wide counts and some do not
def test_language_model_against_dictionaries(spark, monkeypatch, narrow):
    monkeypatch.setattr(ngram, "NARROW", narrow)
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abcdefghij"), rng.integers(0, 30), p=np.arange(1, 11) / 55)) for _ in range(60)]
    texts += [None, "", "A  b\tC", "unseen words here a b"]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], DOCS + ", score string").repartition(3)
    monkeypatch.setattr(ngram, "SHARD_CHARS", 500)
    model = ngram.train(docs.filter("doc_id < 62"))
    assert model.shards > 1
    wide = [f for f in os.listdir(model.folder) if f.startswith("wide-")]
    assert bool(wide) == (narrow == 12)
    loop = Loop(texts[:62])
    n, v = sum(loop.count.values()), len(loop.count)
    for r in ngram.score(docs, model).collect():
        s = [*words(texts[r["doc_id"]]), "</s>"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(s), sum(w in loop.count for w in s), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((loop.count[w] + 1) / (n + v + 1)) for w in s))
        assert r["score"] == pytest.approx(sum(math.log10(loop.p(a, w)) for a, w in zip(["<s>", *s], s)))
    for a in ("<s>", b"a", b"j", "never"):
        assert sum(loop.p(a, w) for w in [*loop.count, "unknown"]) == pytest.approx(1)
    empty = ngram.train(docs.limit(0))
    assert [r["score"] for r in ngram.score(docs.limit(3), empty).collect()] == [0, 0, 0]
    assert ngram.score(docs.limit(0), model).count() == 0


# -- WARC ------------------------------------------------------------------


def test_warc_round_trip(spark):
    html = ["<p>one</p>", "<p>two</p>", "", None, "é\r\n\r\n\x00 WARC/1.1", "x" * 300_000]
    rows = [(i, f"http://h/{i}", html[i % 6]) for i in range(60)]
    rows += [(None, None, "lonely"), (None, "u", "lonely"), (None, "u", "<p>one</p>"), (59, "http://again", html[5]), (70, "a\nb c", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = warc.read(warc.write(warc.planned(pages), work_dir(spark, "warc"), archive_bytes=2000)).collect()
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(-1 if i is None else i, largest.get(h or "", -1))
    expected = []
    for i, _, h in rows:
        data, top = (h or "").encode(), largest[h or ""]
        revisit = top >= 0 and i != top
        kind, to, body = ("revisit", top, None) if revisit else ("response", None, data)
        expected.append((i, len(data), warc.digest(data), kind, to, body))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]) if r["payload"] is None or len(r["payload"]) else b"") for r in found]
    key = lambda x: tuple(str(y) for y in x)
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert len({r["archive"] for r in found}) > 3
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_reader_checks_what_it_reads():
    payloads = [f"<p>{i} {'word ' * 200}</p>".encode() for i in range(2000)]
    buffer = io.BytesIO()
    buffer.close = lambda: None
    archive = warc.Archive(buffer)
    for i, p in enumerate(payloads):
        archive.add(warc.record(i, "http://h/", p, "response", None, warc.DATE))
    archive.close()
    data = buffer.getvalue()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC
    assert [warc.parse(f).payload for f in warc.frames(io.BytesIO(data), chunk=777)] == payloads
    with pytest.raises(warc.WarcError, match="cut off"):
        list(warc.frames(io.BytesIO(data[:-5])))
    with pytest.raises(warc.WarcError):
        list(warc.frames(io.BytesIO(data[:20])))
    skip = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    plain = zstandard.ZstdCompressor().compress(warc.record(1, None, b"x", "response", None, warc.DATE))
    assert [warc.parse(f).page_id for f in warc.frames(io.BytesIO(plain + skip + plain))] == [1, 1]
    good = warc.record(1, "u", b"payload", "response", None, warc.DATE)
    for bad in (
        good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"payload\r\n", b"payloaX\r\n"), good[:-1], good + b"x",
        good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"urn:page:1", b"urn:pag:1"), good.replace(b"WARC-Type: response", b"WARC-Type: nonsense"),
        good.replace(b"Content-Length: 7", b"Content-Length: 8"), b"nothing",
    ):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)


# -- URL templates ---------------------------------------------------------


def test_url_rules_and_templates(spark):
    cases = [
        ("http://Shop.COM/x?q", "shop.com", "/x", "com/", "allow"), ("http://shop.com", "shop.com", "", None, "allow"),
        ("https://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/1#t", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"), ("http://x.net/esp", "x.net", "/esp", None, "allow"),
        ("http://notcom/", "notcom", "/", None, "allow"), (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://É.com/Ä", "É.com", "/Ä", "com/", "allow"), ("", "", "", None, "allow"),
    ]
    rows = [(i, c[0]) for i, c in enumerate(cases)] + [(None, "http://shop.com/x"), (0, cases[0][0])]
    got = urls.verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["page_id"]][1:]
    assert urls.verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_tree_generalises_and_rejects(spark):
    rules = (("block", "h.org/bad/"), ("allow", "h.org/good/"))
    rows = [f"http://h.org/bad/{w}-story/{i}" for i, w in enumerate(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))]
    rows += [f"http://h.org/good/{i}" for i in range(50)] + [f"http://h.org/odd/{i}" for i in range(50)]
    rows += ["http://h.org/" + "/".join(str(i) for i in range(40))]
    got = urls.verdicts(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules).collect()
    assert {r["template"] for r in got if r["path"].startswith("/bad/")} == {"/bad/*/<n>"}
    assert {r["verdict"] for r in got if r["path"].startswith("/bad/")} == {"block"}
    assert {r["verdict"] for r in got if r["path"].startswith(("/good/", "/odd/"))} == {"allow"}
    assert all(r["purity"] >= urls.BLOCK_SHARE for r in got if r["path"].startswith("/bad/"))


def test_url_templates_without_labels_lean_on_others(spark):
    rules = (("block", "a.org/ads/"), ("allow", "a.org/news/"), ("block", "b.org/x/y/"))
    rows = [f"http://a.org/{p}/{i}" for p in ("ads", "news") for i in range(60)]
    rows += [f"http://b.org/{p}/{i}" for p in ("ads", "news", "other") for i in range(5)]
    rows += [f"http://b.org/x/y/{i}" for i in range(60)] + ["http://b.org/x/z", "http://c.org/x"]
    got = urls.verdicts(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules).collect()
    by_path = {(r["host"], r["path"].rstrip("0123456789/")): r for r in got}
    shares = {k: (r["rule"] is None, r["verdict"]) for k, r in by_path.items()}
    assert shares[("b.org", "/ads")] == (True, "block")  # by the same template of another host
    assert shares[("b.org", "/news")] == (True, "allow")
    assert shares[("b.org", "/other")] == (True, "allow") and by_path[("b.org", "/other")]["purity"] == urls.PRIOR
    assert shares[("b.org", "/x/z")] == (True, "block")  # by the node above it, on its own host
    s = urls.SMOOTHING

    def step(share, blocked, seen):
        return (blocked + s * share) / (seen + s)

    # /ads and /ads/<n> over all hosts, 60 blocked; b.org has no labels there.
    assert by_path[("b.org", "/ads")]["purity"] == pytest.approx(step(step(0.5, 60, 60), 60, 60))
    assert by_path[("a.org", "/news")]["purity"] == pytest.approx(step(step(step(step(0.5, 0, 60), 0, 60), 0, 60), 0, 60))


def test_url_tree_has_no_last_level(spark):
    deep = "/".join("abcdefghijkl")
    rules = (("block", f"h.org/{deep}/bad/"), ("allow", f"h.org/{deep}/good/"))
    rows = [f"http://h.org/{deep}/{p}/item-{chr(97 + i % 26)}{chr(97 + i // 26)}" for p in ("bad", "good") for i in range(100)]
    rows += ["http://h.org/" + "s/" * 3000]
    got = urls.verdicts(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules).collect()
    assert {r["template"] for r in got if "/bad/" in r["path"]} == {f"/{deep}/bad/*"}
    assert {r["template"] for r in got if "/good/" in r["path"]} == {f"/{deep}/good/*"}
    assert all(r["purity"] > 0.9 for r in got if "/bad/" in r["path"]) and all(r["purity"] < 0.1 for r in got if "/good/" in r["path"])


# -- near duplicates -------------------------------------------------------


def brute(rows):
    sets = [set(jaccard.shingles(t).tolist()) for _, t in rows]
    of = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and of[i] != of[j]:
                old, new = of[i], of[j]
                of = [new if x == old else x for x in of]
    low = {c: min((r[0] for r, o in zip(rows, of) if o == c and r[0] is not None), default=None) for c in set(of)}
    return [(r[0], len(s), low[c] if s else r[0]) for r, s, c in zip(rows, sets, of)]


def corpus(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 60))
    texts = []
    for _ in range(12):
        base = list(rng.choice(vocabulary, rng.integers(5, 160)))
        for _ in range(rng.integers(1, 9)):
            t = list(base)
            for _ in range(rng.integers(0, 1 + len(t) // 12)):
                t[rng.integers(len(t))] = f"e{rng.integers(10**6)}"
            texts.append(t)
    texts += [passage + list(rng.choice(vocabulary, rng.integers(1, 60))) for _ in range(40)]
    texts = [" ".join(t) for t in texts] + ["a b", "A  b", "c", "", None, None]
    rows = list(enumerate(texts)) + [(3, texts[3]), (4, texts[9]), (None, texts[5]), (None, "lonely text")]
    rng.shuffle(rows)
    return [(None if i is None else int(i), t) for i, t in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "BATCH_DOCS", 25)
    monkeypatch.setattr(jaccard, "BUCKET_CHARS", 20_000)
    monkeypatch.setattr(jaccard, "ROUNDS", seed)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "x"), (5, text, "x"), (7, text + " zz", "y"), (None, text, "n"), (3, "other words that stay as they are", "z"), (5, "another text for id five of this", "q"), (9, None, "e"), (9, None, "e")]
    docs = spark.createDataFrame(rows, DOCS + ", component_id string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["component_id"] for r in kept.collect()) == ["e", "e", "q", "x", "z"]
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (205, 200), (205, 203), (7, 7)]
    got = {r["node"]: r["component"] for r in jaccard.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 31)} == {0} and got[101] == 100 and got[203] == got[205] == 200
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- pipeline --------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == columns and kept.exceptAll(docs).isEmpty()
        rows = docs.select("doc_id", "text").collect()
        stays = {r["doc_id"] for r in kept.collect()}
        if name == "ngram_jaccard_join":
            assert stays == {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in rows])}
        elif name != "benchmark_decontamination":
            module, label = (quality, "quality") if name == "quality_classifier" else (toxicity, "toxic")
            fold = (3, 1) if module is quality else (5, 0)
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
            train = F.crc32(F.col("doc_id").cast("string")) % fold[0] != fold[1]
            out = module.score(docs, module.fit(docs, labels, train)).collect()
            wanted = 1 if module is quality else 0
            assert stays == {r["doc_id"] for r in out if r["predicted"] == wanted}
        assert 0 < len(stays) < len(rows) or name == "benchmark_decontamination"
        docs = kept
    ids = {r["doc_id"] for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == ids and all(r["offset"] + r["length"] <= packing.LIMIT for r in packed)
    assert sum(r["length"] for r in packed) == sum({r["doc_id"]: r["doc_tokens"] for r in packed}.values())
