"""The operators on odd rows, against brute force, and in round trips."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkweft.llm import ann, chat, components, langid, media, mixing, neardup, packing, secrets, stores, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Mixing.


def mixed(docs, **more):
    return mixing.sampled(mixing.sampling_plan(docs, **more))


def test_mixing_odd_rows(odd, empty):
    rows = mixed(odd).collect()
    assert len(rows) == odd.count()
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted((r.doc_id or -1, len(WORD.findall(r.text or ""))) for r in odd.collect())
    assert all(0 <= r.copies <= 3 for r in rows)
    assert sorted(map(tuple, mixed(odd.repartition(3)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mixed(empty).count() == 0 and mixing.mixed(empty).count() == 0


def levelled(sizes, weights, most):
    """Targets by the words of the contract: capped sources hand what is over to the others, again and again."""
    total, capped = sum(sizes), set()
    while True:
        left, share = total - sum(most * sizes[i] for i in capped), sum(w for i, w in enumerate(weights) if i not in capped)
        target = [most * s if i in capped else left * weights[i] / share for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if target[i] > most * s * (1 + 1e-12)} - capped
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 1000, 30, 7], [5, 5, 5], [1, 1, 1, 1, 1, 100000], [0, 10, 10], [3]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = [r.target for r in mixing.source_targets(rows).orderBy("source").collect()]
    assert got == pytest.approx(levelled(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3))


def test_mix_takes_what_it_should(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37 + 1).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    by = mixed(rows).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 0.02 * r.target + 37 and r.most <= 3 for r in by)


def test_mix_repeats_rows(odd):
    clash = odd.withColumn("size", F.lit(1)).withColumn("rows", F.lit("x")).withColumn("bucket", F.lit("y"))
    out = mixing.mixed(clash)
    assert out.columns == clash.columns
    want = collections.Counter()
    for r in mixed(odd).collect():
        want[(r.doc_id, r.source)] += r.copies
    assert collections.Counter((r.doc_id, r.source) for r in out.collect()) == +want


# WARC.


def test_warc_round_trip(spark, empty):
    big = "x" * 120
    pages = [(3, "http://a/ü b\n", big), (1, "http://b", big), (2, None, None), (4, "http://c", "é" * 60), (1, "http://b", big), (None, "http://n", big), (5, "u", "short"), (6, "u", "short"), (7, "", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("file", F.lit(1)).withColumn("first", F.lit(2))
    index = warc.archive(frame)
    rows = warc.read(index).collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = next(h or "" for p, _, h in pages if p == r.page_id)
        data = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 120 and r.page_id != 4) == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (3, "revisit", 1)]
    some = warc.read(index.where("page_id = 4"), payloads=False).collect()
    assert [r.page_id for r in some] == [4] and "payload" not in some[0].__fields__
    assert warc.read(warc.archive(frame.limit(0))).count() == 0


def test_damaged_record():
    member = warc.record(1, "u", b"abc", "0" * 64, None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(member)


def test_coalesced_reads(tmp_path):
    out = stores.Writer(str(tmp_path), ".bin")
    places = [(*out.add(bytes([i]) * (100 + i)), 100 + i) for i in range(50)]
    out.close()
    reader = stores.Reader()
    assert list(reader.blobs([places[i] for i in (1, 2, 7, 40)])) == [bytes([i]) * (100 + i) for i in (1, 2, 7, 40)]
    with pytest.raises(EOFError):
        list(reader.blobs([(places[0][0], 10_000, 5)]))


# Secrets.


def spans_by_hand(text):
    out = []
    for n, r in enumerate(secrets.BASE + secrets.MORE):
        for m in re.finditer(r.pattern, text):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), n, m.end()))
    return sorted(out)


SECRETS = [
    "", "none", "PassWord: hunter2hunter2", "token=short secret='aaaaaaaaaaaa'", "token=secret=abcdefghijklmnop", "token=secret: abcdefghijklmnop", "api_key=abcdefghijkl api-key=abcdefghijkl APIKEY = ABCDEFGHIJKL", "AKIA" + "A" * 13 + " AKIA" + "B" * 14 + "_AKIAAKIA" + "C" * 12,
    "\U0001f600ü 0123456789abcdef0 g 0123456789abcde", "deadbeef" * 5 + " passwd : \"" + "f" * 40, "ghp_" + "a" * 36 + " x", "-----BEGIN RSA PRIVATE KEY-----", "secret" * 100 + "=" + "x" * 12, "toKen=abcdefghijklmnop", "ſecret=abcdefghijklmnop", "password=" * 3000 + "a" * 20,
]


def test_secrets_like_brute_force(spark, odd, empty):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS)], "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("rules", F.lit(3))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(docs).collect()}
    assert got == {i: spans_by_hand(t) for i, t in enumerate(SECRETS)}
    rows = secrets.scan(odd).collect()
    assert len(rows) == odd.count()
    assert {r.text: [tuple(s) for s in r.spans] for r in rows} == {r.text: spans_by_hand(r.text or "") for r in odd.collect()}
    assert secrets.scan(empty).count() == 0


def test_trigram_queries():
    query = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.BASE + secrets.MORE}
    assert query["hex"] == [] and query["access"] == [frozenset({"aki", "kia"})]
    assert len(query["assign"]) == 6 and frozenset({"tok", "oke", "ken"}) in query["assign"]
    assert secrets.trigram_query("ab|cde") == [] and secrets.trigram_query("(abc|abd)e?") == [frozenset({"abc"}), frozenset({"abd"})]
    for r in secrets.BASE + secrets.MORE:
        for text in SECRETS:
            low = text.lower()
            if query[r.kind] and re.search(r.pattern, text):
                assert any(all(t in low for t in s) for s in query[r.kind])


def test_redaction(spark, odd):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS)], "doc_id long, text string")
    for r in secrets.redacted(docs).collect():
        text, last = "", 0
        for start, _, end in spans_by_hand(SECRETS[r.doc_id]):
            if start >= last:
                text += SECRETS[r.doc_id][last:start] + "[SECRET]"
            last = max(last, end)
        assert r.text == text + SECRETS[r.doc_id][last:]
    assert secrets.redacted(odd).where("text is null").count() == 2


# Nearest neighbours.


def vectors(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int")


def test_nearest_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(60)]
    same = [100.0] + [0.0] * 7
    rows += [(i, same, 1) for i in range(100, 140)] + [(140, same, 2), (140, same, 2)]
    rows += [(200, None, 1), (220, [0.0] * 8, 1), (240, [1.0, None, *[0.0] * 6], 1), (260, [float("nan")] * 8, 1), (280, [float("inf")] * 8, 1), (300, [], 1), (320, [1.0, 2.0], 1), (None, same, 1)]
    got = collections.defaultdict(list)
    for r in ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = {i: np.array(np.array(v, np.float32), np.float64) for i, v, _ in rows if i is not None and (i < 150)}
    assert set(got) == {0, 20, 40, 100, 120, 140}
    for q, found in got.items():
        best = sorted((-float(np.dot(good[q], v)), i) for i, v in good.items() if i != q)[:20]
        assert [x[0] for x in found] == list(range(1, 21))
        assert len({i for _, i in best} & {x[1] for x in found}) >= 18
        assert [x[2] for x in found] == pytest.approx([float(np.dot(good[q], good[x[1]])) for x in found])
        assert [(-x[2], x[1]) for x in found] == sorted((-x[2], x[1]) for x in found)
    assert [x[1] for x in got[140]] == list(range(100, 120))
    assert ann.search(vectors(spark, []), F.lit(True)).count() == 0
    assert [tuple(r)[:3] for r in ann.search(vectors(spark, [(0, [1.0], 1), (1, [2.0], 1)]), F.col("vec_id") == 0).collect()] == [(0, 1, 1)]


def gaussian(n, d):
    return np.random.default_rng(1).normal(size=(n, d))


@pytest.mark.parametrize(
    ("name", "data", "most"),
    [
        ("wide", gaussian(4000, 24) * np.random.default_rng(2).uniform(0.5, 2, (4000, 1)), 0.6),
        ("line", np.c_[np.arange(3000) + 1.0, np.ones(3000)], 0.1),
        ("short line", np.c_[np.arange(40) + 1.0, np.ones(40)], 2),
        ("tight clusters", np.repeat(gaussian(30, 16), 100, 0) + gaussian(3000, 16) * 1e-3, 0.1),
        ("tiny and huge", gaussian(2000, 16) * 10.0 ** np.random.default_rng(3).integers(-150, 150, (2000, 1)), 1.01),
        ("underflow", np.array([[1e-200, 0.0], [1.0, 1.0], [0.0, 1e200], [1.0, 0.0]] * 10), 10),
    ],
)
def test_nearest_are_all_there(spark, name, data, most):
    """Each query gets 20 rows or all candidates, mostly the nearest, for fewer inner products than a scan of all."""
    rows = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(data)], "array<double>")
    found = ann.found(rows, F.col("vec_id") % 20 == 0).persist()
    asked = range(0, len(data), 20)
    products = found.agg(F.sum("products")).first()[0]
    assert products <= most * len(asked) * len(data)
    got = collections.defaultdict(set)
    for r in ann.search(rows, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    found.unpersist()
    wanted = min(20, len(data) - 1)
    assert all(len(got[q]) == wanted and q not in got[q] for q in asked)
    hits = 0
    for q in asked:
        score = (data * data[q]).sum(axis=1)
        score[q] = -np.inf
        least = np.sort(score)[-wanted]
        hits += int((score[list(got[q])] >= least).sum())
    assert hits >= 0.9 * wanted * len(asked)


def test_each_length_is_searched(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(1, 30)] + [(100 + i, [1.0, 2.0, float(i)], 0) for i in range(5)] + [(200, [7.0], 0)]
    got = collections.defaultdict(list)
    for r in ann.search(vectors(spark, rows, "array<double>"), F.lit(True), 3).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got[5] == [29, 28, 27] and got[100] == [101, 102, 103] and 200 not in got and len(got) == 34


def test_graph_search_and_lists():
    """Beam search finds most of the nearest centroids without meeting all; fillers keep to the boundary rule; the floor of lists holds."""
    model = ann.fit(gaussian(40_000, 12), 8.0, per_centroid=8)
    points = model.lifted(gaussian(300, 12)[::-1])
    near, far = model._beam(points, ann.BEAM)
    assert ann.BEAM * model.graph.shape[1] < len(model.centroids) and (np.diff(far, axis=1) >= 0).all()
    best = model._every(points, 4)[0]
    assert np.mean([len(set(a[:8]) & set(b)) / 4 for a, b in zip(near, best, strict=True)]) >= 0.9
    row, lists = ann.replace(model, replicas=4).lists_to_fill(points, 1.1)
    assert set(row) == set(range(300)) and len(row) < 2 * 300 and len(set(zip(row, lists))) == len(row)
    sizes = np.full(len(model.centroids), 3)
    row, lists = ann.replace(model, ratio=0.0, probes=0).lists_to_search(points, sizes, 84)
    assert (np.bincount(row) == 28).all() and len(set(zip(row, lists))) == len(row)
    row, _ = ann.replace(model, ratio=0.0, probes=0).lists_to_search(points[:3], sizes, 10**9)
    assert (np.bincount(row) == len(model.centroids)).all()


# Packing.


def test_cuts():
    assert packing.cuts(5, 8) == [(0, 5)] and packing.cuts(8, 8) == [(0, 8)] and packing.cuts(17, 8) == [(0, 1), (1, 8), (9, 8)]


@pytest.mark.parametrize("seed", range(30))
def test_packing_places_all(seed):
    rng = np.random.default_rng(seed)
    cap = int(rng.choice([10, 64, 2048]))
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, cap + 1, rng.integers(1, 60)), rng.integers(1, 200, 60), strict=False)}
    classes = packing.packing(counts, cap)
    placed = collections.Counter()
    for many, holds in classes:
        assert many > 0 and sum(n * k for n, k in holds) <= cap
        for n, k in holds:
            placed[n] += many * k
    assert placed == counts
    bins = sum(m for m, _ in classes)
    first_fit = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = next((i for i, g in enumerate(first_fit) if g >= n), None)
        if at is None:
            first_fit.append(cap - n)
        else:
            first_fit[at] -= n
    assert bins <= len(first_fit) + 1


def test_packed_sequences(odd, empty):
    rows = packing.packed(odd.withColumn("length", F.lit("x")).withColumn("task", F.lit(1)), keep_ids=True).collect()
    encode = packing.encoder(packing.default_vocabulary())
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append((r.piece, r.start, list(r.ids)))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for s in by_sequence.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    text = {r.doc_id: r.text for r in odd.where("doc_id is not null and doc_id <> 2").collect()}
    for name, body in text.items():
        found = sorted(by_doc[name])
        assert [i for _, _, ids in found for i in ids] == [*encode(body or ""), 0]
        assert [p for p, _, _ in found] == list(range(len(found)))
    assert len(by_doc[2]) == 2 and len(by_doc[None]) == 2
    assert packing.packed(empty).count() == 0


def test_tokens_are_those_of_tokenizers():
    """Every code point in several places, random mixtures, added tokens' strings, and long runs."""
    from tokenizers import Tokenizer

    path = packing.default_vocabulary()
    slow, fast = Tokenizer.from_file(path), packing.encoder(path)
    rng = np.random.default_rng(8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["", " ", "a  b\n\n c\t", "it's we'll don’t", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "x" * 500_000, " " * 300_000 + "y", "\u0000﻿\r\n", "1234567 89"]
    texts += ["".join(f"a{chr(c)}b {chr(c)} 1{chr(c)}\n{chr(c)}{chr(c)}" for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    texts += ["".join(map(chr, rng.choice(points, 40))) + "".join(map(chr, rng.integers(9, 300, 40))) for _ in range(500)]
    for text in texts:
        assert fast(text) == slow.encode(text, add_special_tokens=False).ids, text[:40]


# Toxicity.


def test_toxicity_learns(spark, odd, empty):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshr"), rng.integers(2, 8))) for _ in range(400)]
    bad = ["zorgle", "kwimple", "vuxxit"]
    rows, labels = [], []
    for i in range(900):
        text = list(rng.choice(words, rng.integers(3, 80)))
        toxic = i % 6 == 0
        if toxic:
            text.insert(int(rng.integers(0, len(text))), str(rng.choice(bad)).upper() if i % 4 else bad[i % 3])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (5000, None), (5001, 2)], "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id % 5 <> 0"), marks.where("doc_id is null or doc_id % 5 <> 0"))
    held = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("score", F.lit("clash")), model).where("doc_id % 5 = 0").collect()}
    right = [(s >= 0.5) == (i % 6 == 0) for i, s in held.items()]
    assert np.mean(right) >= 0.97
    scores = [r.score for r in toxicity.score(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.score(empty, model).count() == 0
    blank = {r.score for r in toxicity.score(odd.where("text is null or text = ''"), model).collect()}
    assert len(blank) == 1
    for none in (marks.limit(0), marks.where("toxic = 0"), marks.where("doc_id > 4000")):
        assert all(0 <= r.score <= 1 for r in toxicity.score(odd, toxicity.fit(docs, none)).collect())


def test_toxicity_defined_labels(spark):
    """A document labelled both ways teaches nothing, a label said twice counts once, and of several texts of an id the first is learned from."""
    docs = [(i, f"plain text number {i} " + ("vuxxit" if i % 2 else "garden")) for i in range(60)]
    marks = [(i, i % 2) for i in range(60)]
    fit = lambda d, m: toxicity.fit(spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(m, "doc_id long, toxic int"))
    one = fit(docs, marks)
    two = fit([(3, "zzz last in order"), *docs[::-1], *docs[:9], (99, "garden"), (98, None)], [*marks[::-1], *marks[:7], (99, 0), (99, 1)])
    assert one.intercept == two.intercept and (one.weights == two.weights).all()
    assert np.count_nonzero(one.weights) > 200
    small_ = fit(docs, marks).weights
    assert (small_ == one.weights).all()


def test_toxicity_uses_characters(spark):
    from sparkweft.llm.ngrams import character_sets

    of, gram = character_sets(["абв", "абг", "", "ab"], (3,), 20)
    assert [int((of == i).sum()) for i in range(4)] == [3, 3, 0, 2]  # " аб", "абв", "бв " in characters, not bytes
    assert len(set(gram[of == 0]) & set(gram[of == 1])) == 1
    with_two, _ = character_sets(["x" * 100], (3, 4, 5), 20)
    assert len(with_two) == 9  # blank-x, x only, x-blank for each size


# Languages.


def test_languages(spark, odd, empty):
    rng = np.random.default_rng(4)
    parts = {"aa": ["ba", "lo", "mi", "ta"], "bb": ["sch", "er", "ung", "ge"], "cc": ["ét", "eau", "oi", "que"]}
    rows = [(i, " ".join("".join(rng.choice(parts[k], 3)) for _ in range(rng.integers(4, 40))), k) for i, k in enumerate(rng.choice(list(parts), 600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.where("doc_id % 5 <> 0").union(docs.limit(1).select("doc_id", "text", F.lit(None).cast("string"))))
    assert model.languages == ["aa", "bb", "cc"]
    found = langid.identify(docs.withColumn("lang_pred", F.lit(1)), model).where("doc_id % 5 = 0").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.98 and all(0 <= r.lang_score <= 1 for r in found)
    out = {r.text: (r.lang_pred, r.lang_score) for r in langid.identify(odd, model).collect()}
    assert all(out[t] == ("und", 0.0) for t in (None, "", " \t\n\x0b\x0c\r", "12345 !!! 678"))
    assert all(v[0] in parts for k, v in out.items() if k and re.search("[a-z]", k))
    assert langid.identify(empty, model).count() == 0
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, none).collect()} == {"und"}


def spelled_out(text):
    """A text's vector, n-gram by n-gram."""
    words = " ".join(re.findall(r"[^\W\d_]+", text.lower()))
    total = np.zeros(langid.DIMENSIONS)
    padded = f" {words} " if words else ""
    signs = lambda c: langid.letter_vectors(np.array([0 if c == " " else ord(c)]))[0].astype(float)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        total += np.roll(signs(a), 2) * np.roll(signs(b), 1) * signs(c)
    return total


def test_scores_are_cosines_of_spelled_out_vectors(monkeypatch):
    texts = ["abc abd xyz", "hello, world: abc abc", "zzz", "Привет мир", "日本語 テキスト", "a", "ß ẞ"]
    prototype = np.array([spelled_out("hello world"), spelled_out("привет"), spelled_out("日本語の")])
    prototype /= np.linalg.norm(prototype, axis=1, keepdims=True)
    for dense, step in ((32, 4096), (0, 3), (10**6, 5)):  # by matrices and pair by pair, in one go and in many
        monkeypatch.setattr(langid, "DENSE", dense)
        monkeypatch.setattr(langid, "STEP", step)
        names, score = langid.predicted(texts, langid.Model(["a", "b", "c"], prototype))
        for i, text in enumerate(texts):
            own = spelled_out(text)
            cosine = prototype @ own / np.linalg.norm(own)
            assert names[i] == "abc"[cosine.argmax()] and score[i] == pytest.approx(min(max(cosine.max(), 0), 1), abs=1e-9)


def test_letters_have_vectors_of_their_own():
    points = np.array([c for c in range(0x250) if chr(c).isalpha()] + list(range(0x4E00, 0x4F00)) + list(range(0x391, 0x3C9)) + list(range(0x410, 0x450)))
    vectors_ = langid.letter_vectors(points).astype(np.float32)
    alike = vectors_ @ vectors_.T / langid.DIMENSIONS
    assert set(np.unique(vectors_)) == {-1, 1} and np.abs(alike - np.eye(len(points))).max() < 0.15


def test_many_languages_and_scripts(spark):
    rng = np.random.default_rng(6)
    rows = [(f"l{i:03d}", " ".join("".join(rng.choice(list(map(chr, rng.permutation(np.arange(97, 123))[:6])), 5)) for _ in range(30))) for i in range(520)]
    scripts = {"ru": "съешь ещё этих мягких французских булок", "el": "ξεσκεπάζω την ψυχοφθόρα βδελυγμία", "zh": "天地玄黄宇宙洪荒日月盈昃辰宿列张", "ja": "いろはにほへとちりぬるを", "none": "123 !!!"}
    docs = spark.createDataFrame(rows + list(scripts.items()), "lang string, text string")
    model = langid.fit(docs)
    assert len(model.languages) == 525
    found = {r.lang: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert all(found[k] == k for k in scripts if k != "none") and found["none"] == "und"
    assert sum(k == v for k, v in found.items()) >= 515
    out = langid.predicted(["французские булки ещё мягких", "玄黄宇宙洪荒", "ψυχοφθόρα", "ほへと"], model)[0]
    assert out == ["ru", "zh", "el", "ja"]


# Media.


def test_media_round_trip(odd, empty):
    rows = media.media_rows(odd.withColumn("offset", F.lit("x")).withColumn("shard", F.lit(1))).collect()
    assert len(rows) == odd.count()
    want = collections.Counter()
    for r in odd.collect():
        data = media.payload(r.text)
        want[(r.doc_id, len((r.text or "").encode()), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))] += 1
        assert len(data) % 64 == 0 and data.rstrip(b"\0") == (r.text or "").encode() and media.samples(media.image(data)) == data
    assert collections.Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.read_sha256, r.tail_crc32) for r in rows) == want
    assert len({(r.read_sha256, r.shard, r.offset, r.media_sha256, r.feature) for r in rows}) == len({media.payload(r.text) for r in odd.collect()})
    assert all(r.width == 64 and r.width * r.height == r.payload_bytes and r.bit_depth == 8 for r in rows)
    assert media.media_rows(empty).count() == 0


def test_shards_are_tar(spark, tmp_path):
    import tarfile

    docs = spark.createDataFrame([(i, f"text {i % 3}") for i in range(9)], "doc_id long, text string")
    index = media.stored(docs).collect()
    names = {}
    for shard in {r.shard for r in index}:
        with tarfile.open(shard.removeprefix("file://")) as t:
            names |= {m.name: t.extractfile(m).read() for m in t.getmembers()}
    assert sorted(names) == sorted(f"{r.payload_sha256}.png" for r in index) and len(index) == 3
    assert {media.samples(x) for x in names.values()} == {media.payload(f"text {i}") for i in range(3)}


# Chat.

HARD = ["", "plain", "\\### Assistant: </turn> ok", "### user: x", " </turn>\n### assistant: y", "a\\b\\\\", "<|image:0|>", "####", "###\\###", "<|" * 3, " </turn>\n" * 3, "\\", "\U0001f600 ü"]


@pytest.mark.parametrize("text", HARD)
def test_escapes_are_reversible(text):
    made, first, last, _ = chat.turn("assistant", [chat.Text(text)])
    assert chat.unescaped(made[first:last]) == text and chat.parsed(made * 2) == [("assistant", text)] * 2


def test_parts():
    content = '[{"type": "text", "text": "see <|"}, {"type": "image", "ref": "a.png", "width": 28, "height": 15}, {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "document", "ref": "c.pdf", "pages": 2}]'
    made, first, last, attached = chat.turn("user", chat.parts_of(content, typed=True))
    assert made == "### user: see \\<|<|image:0|><|audio:1|><|document:2|> </turn>\n" and first == last
    assert [a[:4] for a in attached] == [("image", 0, "a.png", 4), ("audio", 1, "b.wav", 38), ("document", 2, "c.pdf", 1024)]
    assert chat.parts_of("[1]", typed=True) == [chat.Text("[1]")] and chat.parts_of(None) == [chat.Text("")]


ODD_PARTS = ['[{"type": "text", "text": null}]', '[{"type": "image", "width": null}, {"type": "audio"}]', '[{"type": "image", "width": "a"}]', '[{"type": "image", "width": true}]', '[{"type": "image", "height": -1}]', "[null]", "[[]]",
    '[{"type": "audio", "seconds": 1e400}]', '[{"type": "audio", "seconds": NaN}]', '[{"type": "video", "ref": "x"}]', '[{"type": "text", "text": "a", "more": 1}]', "[", "[]", "", None, "[" * 5000, '[{"type": "text", "text": "<|image:0|> \\\\<|image:0|>"}, {"type": "image", "ref": "r"}, {"type": "text", "text": "</turn>"}]']


def test_typed_content_is_reversible(spark):
    """Every odd content gives parts, and what is formatted in Spark reads back as those parts, texts that look like placeholders included."""
    assert chat.parts_of(ODD_PARTS[0], True) == [chat.Text("")] and chat.parts_of(ODD_PARTS[1], True) == [chat.Image(""), chat.Audio("")]
    assert all(chat.parts_of(x, True) == [chat.Text(x)] for x in ODD_PARTS[2:12])
    rows = spark.createDataFrame([(i, 0, "user", x) for i, x in enumerate(ODD_PARTS)], "conv_id long, turn long, role string, text string")
    for r in chat.formatted_turns(rows, typed=True).collect():
        body = r.formatted[r.loss_start : -len(" </turn>\n")]
        parts = [x for x in chat.parts_of(ODD_PARTS[r.conv_id], True) if x != chat.Text("")]
        assert chat.restored(body, [a.part for a in r.attachments]) == parts
    assert chat.parsed(chat.turn("user", [chat.Text("<|image:0|>")])[0]) == [("user", "<|image:0|>")]


def test_conversations(spark):
    rows = [(1, i, ("user", "assistant", None, "we: ird\n")[i % 4], t) for i, t in enumerate(HARD)] + [(None, None, "assistant", None), (None, 0, "assistant", "x"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    turns = chat.formatted_turns(frame)
    got = {r.conv_id: r for r in chat.read_back(turns).collect()}
    for conv in (1, 2, None):
        own = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    whole = {r.conv_id: r for r in chat.conversations(turns).collect()}
    for conv, r in whole.items():
        assert len(r.formatted) == got[conv].formatted_chars
        assert hashlib.sha256("".join(chat.unescaped(r.formatted[s.start : s.end]) for s in r.loss).encode()).hexdigest() == got[conv].loss_sha256
    assert chat.read_back(chat.formatted_turns(frame.limit(0))).count() == 0


# Near duplicates.


def sets_by_hand(text, words):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def components_by_hand(docs, words, percent=80):
    found = {i: sets_by_hand(t, words) for i, t in docs}
    parent = {i: i for i in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(found)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(found[a] & found[b])
            if found[a] and found[b] and 100 * both >= percent * len(found[a] | found[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(found[i]), root(i)) for i in ids}


def corpus(copies, near, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(60)]
    base = list(rng.choice(words, 60))
    rows += [" ".join(base)] * copies
    for _ in range(near):
        own = list(base)
        for _ in range(rng.integers(1, 7)):
            own[rng.integers(0, 60)] = str(rng.choice(words))
        rows.append(" ".join(own))
    line = " ".join(rng.choice(words, 12))
    rows += [line + " " + " ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(60)]
    rows += ["", "one", "ONE", "one two", "One  two", " ", None]
    order = rng.permutation(len(rows))
    return [(int(i), rows[j]) for i, j in enumerate(order)]


@pytest.mark.parametrize(("words", "near", "seed"), [(2, 150, 0), (5, 80, 1), (2, 20, 2)])
def test_near_duplicates_like_brute_force(spark, words, near, seed):
    docs = corpus(30, near, seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=words).collect()}
    assert got == components_by_hand(docs, words)


def test_near_duplicates_odd_rows(odd, empty):
    rows = neardup.near_duplicates(odd.withColumn("rep", F.lit(1)).withColumn("key", F.lit(2)), words=2).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[2].component_id, by[2].kept, by[1].kept) == (1, False, True)
    assert all(by[i].component_id == i and by[i].kept for i in (3, 4, 5, 6, 7, 8, 9, 10)) and by[4].n_shingles == by[6].n_shingles == 0
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9, 10]
    twice = neardup.deduplicated(odd.where("doc_id = 2"))
    assert [r.doc_id for r in twice.collect()] == [2]
    assert neardup.deduplicated(empty).count() == 0


def test_components(spark):
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5050)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], StructType().add("a", "long").add("b", "long"))).count() == 0
