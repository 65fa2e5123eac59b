"""Networks, fields, indexes, graphs, labelers and shards."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import bm25_wand, byte_cnn, hnsw, label_shards, pii_weak, queries, toxic_crf
from tickloom.llm.common import read

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, p string, block string"


def rows_of(texts, langs=None, ids=None):
    return [(ids[i] if ids else i, t, (langs or {}).get(i), "s", 1, "x", "y", "z") for i, t in enumerate(texts)]


def plain_network(net, window):
    """The network one filter and one place at a time."""
    hidden, n = [], byte_cnn.FILTERS
    for f in range(n * len(byte_cnn.WIDTHS)):
        width = byte_cnn.WIDTHS[f // n]
        kernel = net.filters[:, f].reshape(max(byte_cnn.WIDTHS), byte_cnn.EMBED)[:width]
        places = range(len(window) - max(byte_cnn.WIDTHS) + 1)
        best = max(float((net.embed[window[i:i + width]] * kernel).sum()) for i in places)
        hidden.append(max(best + float(net.bias[f]), 0.0))
    x = np.array(hidden) @ net.out + net.out_bias
    e = np.exp(x - x.max())
    return e / e.sum()


def test_languages_held_out(spark):
    got = queries.op5_byte_cnn(spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    share = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_languages_do_not_depend_on_files(spark, tmp_path):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    found = []
    for n in (1, 7):
        docs.repartition(n, "source" if n > 1 else "lang").write.parquet(str(tmp_path / str(n)))
        rows = byte_cnn.held_out_languages(spark.read.parquet(str(tmp_path / str(n)))).collect()
        found.append(sorted(map(tuple, rows)))
    # one network; how single precision sums are grouped follows the batches
    assert [r[:3] for r in found[0]] == [r[:3] for r in found[1]]
    assert np.allclose([r[3] for r in found[0]], [r[3] for r in found[1]], rtol=0, atol=1e-6)


def test_probabilities_are_those_of_plain_loops():
    rng = np.random.default_rng(6)
    windows = rng.integers(0, 256, (12, byte_cnn.WINDOW), dtype=np.uint8)
    net = byte_cnn.train(windows, ["a", "b", "c"] * 4)
    for window, got in zip(windows, net.probabilities(windows)):
        assert np.allclose(got, plain_network(net, window), atol=1e-5)


def test_repeated_texts_teach_once(table):
    texts = [("een tekst in deze taal nummer %d" % (i % 40), "nl") for i in range(400)] + [("un texte dans cette langue %d" % i, "fr") for i in range(40)]
    net = byte_cnn.fit(table([*texts, (None, "fr"), ("", "nl"), ("zonder", None)], "text string, lang string"))
    got = byte_cnn.identify(table([(1, "nog een tekst in deze taal", "x", 0.5)] * 2, "doc_id long, text string, lang_pred string, score double"), net).collect()
    assert [r["lang_pred"] for r in got] == ["nl", "nl"]


def test_languages_of_odd_texts(table):
    texts = [None, "", " 12 .,!", "ñandú que los " * 30, "the and with " * 30, "the with and " * 200, "é" * 50_000]
    docs = table(rows_of(texts, {3: "es", 4: "en", 5: "en"}), DOCS)
    out = byte_cnn.identify(docs, byte_cnn.fit(docs))
    assert out.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["und", "und", "und", "es", "en", "en"]
    assert byte_cnn.fit(docs.where("lang is null")) is None
    kept = byte_cnn.known_language(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {3, 4, 5}
    assert byte_cnn.known_language(docs.where("false")).count() == 0
    # without labels only texts without a letter go
    unlabelled = table(rows_of(texts), DOCS)
    assert sorted(r["doc_id"] for r in byte_cnn.known_language(unlabelled).collect()) == [3, 4, 5, 6]


def test_toxicity_held_out(spark):
    got = queries.op3_toxic_crf(spark, "/root/testdata/sf0.1").join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] > 0.8 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) < 0.03 * n[0, 0]


def test_surprise_bounds_the_binomial_tail():
    for share in (0.05, 0.13, 0.5, 0.8):
        for n in (1, 6, 17, 40):
            for k in range(n + 1):
                tail = sum(math.comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k, n + 1))
                assert tail <= math.exp(-toxic_crf.surprise(k, n, share)) + 1e-12
            assert np.isclose(toxic_crf.surprise(n, n, share), -n * math.log(share))


def test_rare_languages_keep_their_words():
    """Twenty toxic texts of one language among a thousand of another; one clean text holds the stem alone."""
    def text(i, *words):
        return f"a{i} b{i} {' '.join(words)} c{i} d{i}".encode().split()

    toxic = [text(i, "scum") for i in range(1000)] + [text(i, f"bomente{'xyzw'[i % 4]}") for i in range(1000, 1020)]
    clean = [text(i, "fine") for i in range(2000, 2990)] + [text(i, "bomente") for i in range(3000, 3010)]
    # as often toxic as clean, and as rare as chance makes it
    even = [text(i, "even") for i in range(4000, 4040)]
    odds = toxic_crf.lexicon_of([(t, 1) for t in toxic + even[:20]] + [(t, 0) for t in clean + even[20:]])
    assert {"=scum", "bomente~"} <= set(odds)
    assert not {"=fine", "=even", "=bomente", "=bomentex"} & set(odds)


def test_training_rows_are_bounded(table, monkeypatch):
    """Many rows of one id: at most the bound of texts is learned from."""
    seen = []
    monkeypatch.setattr(toxic_crf, "learn", lambda rows: seen.append(rows))
    docs = table(rows_of([f"words of text {i}" for i in range(600)], ids=[7] * 600), DOCS)
    labels = table([(7, 0, 1), (7, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    toxic_crf.fit(docs, labels, documents=50)
    assert Counter(y for _, y in seen[0]) == {0: 50, 1: 50} and len({t for t, _ in seen[0]}) == 50


def test_marginals_are_those_of_all_paths():
    crf = toxic_crf.Field({"=bad": 3.0, "=odd": 1.0}, 1.3, -2.0, np.array([[0.5, -0.7], [-0.2, 0.4]]))
    words = "fine bad odd fine fine bad".encode().split()
    scores = np.array([crf.score(w) for w in words])
    total, toxic = 0.0, np.zeros(len(words))
    for path in np.ndindex(*[2] * len(words)):
        value = np.prod([crf.step(s)[a, b] for s, a, b in zip(scores, (0, *path), path)])
        total += value
        toxic += value * np.array(path)
    at, p = crf.marginals(scores)
    assert np.allclose(p, (toxic / total)[at])
    at, p = crf.marginals(np.zeros(100_000))
    assert np.isfinite(p).all()


def test_toxic_spans(table):
    rng = np.random.default_rng(0)
    plain = [" ".join(rng.choice([f"w{i}" for i in range(300)], 40)) for _ in range(80)]
    bad = [t + f" w{i} vile w{i + 1} foul. w{i + 2}" for i, t in enumerate(plain[:40])]
    docs = table(rows_of([*plain, *bad, None, "", "é vile x"]), DOCS)
    labels = table([(i, 0, int(i >= 80)) for i in range(120)] + [(121, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    crf = toxic_crf.fit(docs, labels.where("toxic is not null").select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxic_crf.tag(docs, crf).collect()}
    assert all(got[i]["predicted"] == (80 <= i < 120) for i in range(120))
    assert (got[120]["score"], got[121]["score"]) == (0, 0)
    assert [(s["start"], s["end"]) for s in got[122]["spans"]] == [(2, 6)]
    assert toxic_crf.tag(docs, None).agg(F.max("score")).first()[0] == 0
    assert toxic_crf.held_out_toxicity(docs.where("false"), labels).count() == 0


def test_wand_retrieves_what_all_scores_do():
    rng = np.random.default_rng(2)
    vocabulary = [f"t{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, 20))) for i in range(150)]
    index = bm25_wand.Index(items)
    for _ in range(100):
        own = index.items[rng.integers(150)][1]
        query = sorted({index.number[t] for t in own if rng.random() < 0.6} | set(rng.choice(len(index.number), 60).tolist()))
        scores = Counter()
        for t in query:
            for d, x in zip(index.docs[t], index.impacts[t]):
                scores[d] += x
        assert sorted(d for d, _ in index.retrieve(query)) == sorted(d for d, x in scores.items() if x >= index.threshold - 1e-9)


def test_leaks(table):
    rng = np.random.default_rng(4)
    prose = lambda n: " ".join(rng.choice([f"p{i}" for i in range(2000)], n))
    items = [(i, prose(30) + " what? " + prose(8) + ".") for i in range(40)] + [(90, None), (91, ""), (None, prose(25))]
    texts = [prose(200), items[3][1].upper(), f"{prose(333)} {items[5][1]} {prose(90)}", items[7][1][:60], None, "",
             f"{items[8][1]} {prose(9000)} {items[9][1]}", items[42][1]]
    docs, bench = table(rows_of(texts), DOCS), table(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in bm25_wand.leaks(docs, bench).collect()}
    assert found == {(1, 3), (2, 5), (6, 8), (6, 9), (7, -1)}
    small = [x for x in bm25_wand.indexes(bench, 2000)]
    assert len(small) > 2 and sum(len(x.items) for x in small) == 41
    # partial copies near the threshold are judged alike whatever part an item is in
    part = [(i, " ".join(x[1].split()[:n])) for i, (x, n) in enumerate((items[k], n) for k in range(12, 24) for n in (24, 30, 34, 36))]
    halves = table(rows_of([prose(40) + " " + t + " " + prose(60) for _, t in part]), DOCS)
    whole, cut = ([tuple(r) for r in bm25_wand.leaks(halves, bench, n).orderBy("doc_id", "item_id").collect()] for n in (2 << 20, 2000))
    assert whole == cut and 0 < len(whole) < len(part)
    clean = bm25_wand.without_leaks(docs, bench)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [0, 3, 4, 5]
    assert bm25_wand.leaks(docs, bench.where("false")).count() == 0
    assert bm25_wand.leaks(docs.where("false"), bench).count() == 0


@pytest.mark.parametrize("n", range(1, 13))
def test_short_items_are_found(n):
    rng = np.random.default_rng(n)
    prose = [f"p{i}" for i in rng.integers(0, 2000, 700)]
    item = [f"q{i}" for i in range(n)]
    index = bm25_wand.Index([(1, " ".join(item)), (2, " ".join(f"r{i}" for i in range(30)))])
    for at in (0, 29, 30, 333, 700):
        assert [h.item for h in index.hits(" ".join(prose[:at] + item + prose[at:]))] == [1]
    assert [h.item for h in index.hits(" ".join(item))] == [1]
    apart = [w for x in item for w in (x, "p1", "p2")]
    assert [h.item for h in index.hits(" ".join(prose + apart))] == ([1] if n == 1 else [])


def test_benchmark_leaks_are_the_planted_ones(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    want = {(i, b["item_id"]) for b in read(spark, SF, "benchmark").collect() for i, t in texts.items() if b["text"] in t}
    assert {(r["doc_id"], r["item_id"]) for r in queries.op6_bm25_wand(spark, SF).collect()} == want


def exact(vectors, every=20, top=20):
    good = {i: np.array(v, float) for i, v in vectors if v and None not in v and np.isfinite(v).all() and np.any(v)}
    return {q: sorted(((-float(np.dot(good[q], x)), i) for i, x in good.items() if i != q))[:top] for q in good if q % every == 0}


def test_neighbours(table):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist(), 0) for i in range(1500)]
    rows += [(i, rows[20][1], 0) for i in range(1500, 1540)]  # many copies of a query
    rows += [(1540, None, 0), (1560, [0.0] * 16, 0), (1580, [float("nan")] * 16, 0), (1600, [None] + [1.0] * 15, 0), (1620, [float("inf")] * 16, 0)]
    got = hnsw.digest(table(rows, "vec_id long, embedding array<float>, label int")).collect()
    want = exact([(i, None if v is None or None in v else np.float32(v).tolist()) for i, v, _ in rows])
    assert {r["query_id"] for r in got} == set(want)
    hits = 0
    for q, near in want.items():
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        hits += len({r["vec_id"] for r in own} & {i for _, i in near})
    assert hits >= 0.95 * 20 * len(want)
    assert [r["vec_id"] for r in sorted(got) if r["query_id"] == 20] == list(range(1500, 1520))


def test_repeated_rows_are_asked_once(table):
    """Every row twice, and one query id with two unlike vectors."""
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(301)]
    got = defaultdict(list)
    for r in hnsw.digest(table(vectors * 2, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    found = hits = 0
    for q, best in exact(vectors).items():
        assert len(got[q]) == 20 and len(set(got[q])) == 10
        hits += len(set(got[q]) & {i for _, i in best[:10]})
        found += 10
    assert hits >= 0.95 * found
    once = hnsw.digest(table([*vectors, vectors[20]], "vec_id long, embedding array<float>")).where("query_id = 20").collect()
    assert sorted(r["rank"] for r in once) == list(range(1, 21)) and len({r["vec_id"] for r in once}) == 20
    other = rng.normal(size=8).astype(np.float32).tolist()
    both = hnsw.digest(table([*vectors, (20, other)], "vec_id long, embedding array<float>")).where("query_id = 20").collect()
    assert sorted(r["rank"] for r in both) == sorted([*range(1, 21)] * 2)


def test_few_or_no_vectors(table):
    few = table([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (40, [0.5, 0.5], 0)], "vec_id long, embedding array<float>, label int")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in hnsw.digest(few).collect())
    assert got == [(0, 1, 1, 0.5), (0, 2, 40, 0.5), (40, 1, 0, 0.5), (40, 2, 1, 0.5)]
    assert hnsw.digest(few.where("false")).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return kind == "email" or 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def test_strict_spans(table):
    texts = ["a@b.c_d@e.f x@y x@y.z.", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.255", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111-",
             "+1 (988) 555-2485 +12 +1234567 +12345678 +1-2-3((((", "é😀a.b@c.de +49 30 1234567", None, "", "9" * 20_000,
             "a@a@a.b@c.d", "x" * 50_000 + "@b.co", "%%@-.-", "tel: 555-123-4567 Mr. Smith", " ".join(f"a1@b{i}.com" for i in range(500))]
    docs = table(rows_of([*texts, texts[0]]), DOCS)
    got = {r["doc_id"]: r for r in pii_weak.digest(docs).collect()}
    assert len(got) == len(texts) + 1
    for r in pii_weak.personal_data(docs).collect():
        text = [*texts, texts[0]][r["doc_id"]] or ""
        want = [(k, m.start(), m.end()) for k in BASE for m in re.finditer(BASE[k], text) if passes(k, m.group())]
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] == want
        assert [got[r["doc_id"]][f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]
        assert set(",".join("%s:%d:%d" % x for x in want).split(",")) - {""} <= set(got[r["doc_id"]]["spans"].split(","))
    assert pii_weak.digest(docs.where("false")).count() == 0


def test_estimated_labelers():
    rng = np.random.default_rng(6)
    seen = Counter()
    for _ in range(4000):
        y = rng.random() < 0.4
        votes = [int(y if rng.random() < q else not y) if rng.random() < 0.9 else -1 for q in (0.95, 0.8, 0.9, 0.7)]
        seen[tuple(votes), y] += 1
    patterns = [{"kind": "card", "size": 0, "n": sum(seen[v, y] for y in (False, True)), **dict(zip(pii_weak.LABELERS, v))} for v in {v for v, _ in seen}]
    belief = pii_weak.estimate(patterns)
    right = sum(seen[tuple(p[x] for x in pii_weak.LABELERS), b > 0.5] for p, b in zip(patterns, belief))
    assert right > 0.93 * 4000
    weights = pii_weak.classifier(patterns, belief)
    assert weights["form=1"] > weights["form=0"]


@pytest.mark.parametrize("texts,copies", [(["a"] * 300 + [f"u{i}" for i in range(500)], 1), ([f"g{i // 5}" for i in range(403)], 81), ([f"x{i}" for i in range(17)], 0)])
def test_shards_are_even_and_keep_groups(table, texts, copies):
    got = label_shards.shard_rows(table(rows_of(texts), DOCS)).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == len(texts) and max(sizes.values()) - min(sizes.get(t, 0) for t in range(8)) <= 1
    for t in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == t) == list(range(sizes[t]))
    held = Counter((texts[r["doc_id"]], r["shard"]) for r in got)
    split = Counter(t for t, _ in held)
    if copies == 1:  # larger than a shard: it fills whole ones
        assert sorted(held["a", t] for t in range(8) if held["a", t]) == [100, 100, 100]
    elif copies:
        assert sum(1 for t in split if split[t] > 1) <= 0.6 * copies  # no room at all to move in


def fewest_cuts(sizes, shards, total):
    """The fewest groups cut by any layout of groups of these sizes, tried one after another."""
    room = [total // shards + (t < total % shards) for t in range(shards)]
    for cut in range(len(sizes) + 1):
        for split in itertools.combinations(range(len(sizes)), cut):
            loads = {tuple(room)}
            for i, n in enumerate(sizes):
                if i not in split:
                    loads = {tuple(sorted(x - n * (j == k) for j, x in enumerate(load))) for load in loads for k in range(shards) if load[k] >= n}
            if loads:  # what is cut fills the rest row by row
                return cut
    return len(sizes)


@pytest.mark.parametrize("groups,alone", [([5] * 400, 100), ([8] * 200, 40)])
def test_no_group_is_cut_where_all_fit(table, groups, alone):
    texts = [f"g{i}" for i, n in enumerate(groups) for _ in range(n)] + [f"alone {i}" for i in range(alone)]
    got = label_shards.shard_rows(table(rows_of(texts), DOCS)).collect()
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert sum(1 for x in by_text(got, texts).values() if len(x) > 1) == 0


@pytest.mark.parametrize("sizes,alone", [([3, 3, 2, 2, 2], 4), ([6, 5, 4, 3], 6), ([4, 4, 4], 0), ([2] * 6, 3), ([7, 2, 2], 5)])
def test_small_cases_are_cut_as_little_as_can_be(table, sizes, alone):
    texts = [f"g{i}" for i, n in enumerate(sizes) for _ in range(n)] + [f"alone {i}" for i in range(alone)]
    got = label_shards.shard_rows(table(rows_of(texts), DOCS), shards=3).collect()
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.get(t, 0) for t in range(3)) <= 1
    cut = sum(1 for x in by_text(got, texts).values() if len(x) > 1)
    assert cut == fewest_cuts(sizes, 3, len(texts))


def by_text(rows, texts):
    held = defaultdict(set)
    for r in rows:
        held[texts[r["doc_id"]]].add(r["shard"])
    return held


def test_shards_of_odd_rows(table):
    rows = [(None, None), (1, ""), (1, ""), (2, "é"), (None, "é")]
    got = label_shards.shard_rows(table(rows, "doc_id long, text string")).collect()
    assert sorted(r["size"] for r in got) == [1, 1, 1, 3, 3]
    assert label_shards.shard_rows(table([], "doc_id long, text string")).count() == 0


def test_pipeline(spark, table, tmp_path):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in read(spark, SF, "documents").limit(300).collect()]
    rows += [(9001, None, None, None, None), (9002, "", "en", None, 0), rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    read(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = read(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        path = str(tmp_path / f"s{stage.__name__}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in ran) == sorted(r["doc_id"] for r in docs.collect())
    assert {r["doc_id"] for r in ran} <= {r[0] for r in rows} and not {9001, 9002} & {r["doc_id"] for r in ran}
    assert max(Counter(r["doc_id"] for r in ran).values()) <= 2


def test_pipeline_of_nothing(spark, table, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    read(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
