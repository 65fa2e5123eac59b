"""Token records, mixing, SimHash and passages against plain versions of themselves."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import components, mixing, simhash_vptree, substring_doubling, token_records
from tickloom.llm.queries import tokenizer_path
from tickloom.llm.words import Encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, places string"
PASSAGE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    None, "", "  \n", "one", "two words", "The QUICK brown fox, it's 12% off!! \x1cend", "Ünïcödé ΑΣ İ <|endoftext|> µ.. ,",
    PASSAGE, PASSAGE, f"before {PASSAGE} after", PASSAGE.replace("word30", "other"), "same " * 90, "x" * 5000,
    " ".join(f"n{i % 977}" for i in range(30_000)), "áé ́", "tail  spaces\t\tand more",
]
ROWS = [(i, t, "en", "s" * (i % 4) or None, 1, "r", "z", "p") for i, t in enumerate(TEXTS)]
ROWS += [ROWS[7], ROWS[0], (None, "no id here", None, None, None, None, None, None), (None, None, None, "s", None, None, None, None)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_word_ids_are_those_of_the_tokenizer():
    encode = Encoder(tokenizer_path(), cache=5)
    for text in TEXTS:
        want = encode.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert encode(text or "", 1).tolist() == [*want, 1]


def test_records_read_back(table, tmp_path):
    docs = table(ROWS, DOCS)
    index = token_records.write_records(docs, tokenizer_path(), str(tmp_path / "records"))
    got = token_records.read_records(docs.sparkSession, str(tmp_path / "records"), index).orderBy("start").collect()
    encode, at = Encoder(tokenizer_path()), 0
    want = sorted(((r[0], r[1] or "") for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [i for i, _ in want]
    texts = defaultdict(list)
    for i, t in want:
        texts[i].append(encode(t, 1))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        own = {(len(x), zlib.crc32(x.astype("<u4").tobytes())) for x in texts[r["doc_id"]]}
        assert (r["n_tokens"], r["ids_crc32"]) in own
    some = index.where("doc_id in (5, 13)")
    found = token_records.read_at(str(tmp_path / "records"), some).collect()
    assert {r["doc_id"]: r["ids"] for r in found} == {i: texts[i][0].tolist() for i in (5, 13)}


def test_records_are_read_without_a_copy(table, tmp_path, monkeypatch):
    """What is read isn't written once more, and a file that lost its tail is an error."""
    docs, folder = table(ROWS, DOCS), tmp_path / "records"
    index = token_records.write_records(docs, tokenizer_path(), str(folder))
    monkeypatch.setattr(token_records, "stored", None)
    got = token_records.read_records(docs.sparkSession, str(folder), index)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == len(ROWS)
    last = index.orderBy(F.desc("part"), F.desc("offset")).first()
    (folder / last["file"]).write_bytes((folder / last["file"]).read_bytes()[:last["offset"]])
    with pytest.raises(Exception, match="differs from its index"):
        token_records.read_records(docs.sparkSession, str(folder), index).collect()


def test_damage_is_seen():
    data = bytearray(token_records.frame(token_records.payload_of(7, np.array([1, 2, 3], "<u2"))))
    assert [token_records.parse(p)[0] for p in token_records.records(__import__("io").BytesIO(data))] == [7]
    data[-6] ^= 1
    with pytest.raises(ValueError):
        list(token_records.records(__import__("io").BytesIO(data)))


def mixed(rows):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(words(r[1]))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= 2 * size[s]
        free -= over
    return size, target


def test_mixing_meets_the_targets(table):
    size, target = mixed(ROWS)
    got = mixing.mix(table(ROWS, DOCS)).collect()
    assert len(got) == len(ROWS)
    by_size = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_size[r["source_size"]] += r["taken"]
    want = Counter()
    for s in size:
        want[size[s]] += round(target[s])
    assert by_size == want
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(table(ROWS, DOCS)).collect()))


def test_mixed_documents_keep_their_columns(table):
    docs = table(ROWS, DOCS)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    size, target = mixed(ROWS)
    taken, largest = Counter(), Counter()
    rows = {(r[0], r[1]): r for r in ROWS}
    for r in out.collect():
        assert tuple(r) == rows[r["doc_id"], r["text"]]
        taken[r["source"]] += len(words(r["text"]))
    for r in ROWS:
        largest[r[3]] = max(largest[r[3]], len(words(r[1])))
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1


def plain_fingerprint(text, n=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)] or [b" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(table):
    rows = [r for r in ROWS if r[0] is not None]
    got = {r["doc_id"]: r for r in simhash_vptree.digest(table(rows, DOCS)).collect()}
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
    for i, root in smallest(near, ids).items():
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{prints[i]:016x}", root)
    kept = simhash_vptree.keep_one(table(ROWS, DOCS)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(set(smallest(near, ids).values()))


@pytest.mark.parametrize("shard", [2, 50, 10_000])
def test_links_join_all_that_is_near(spark, table, shard):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    more = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 5), replace=False))) for b in base for _ in range(4)]
    points = np.unique(np.concatenate([base, np.array(more, np.uint64), np.array([0, 1, 3, 7, 2**64 - 1], np.uint64)]))
    frame = table([(int(p),) for p in points.view(np.int64)], "fp long")
    found = [(r["a"], r["b"]) for r in simhash_vptree.links(frame, 3, shard=shard).collect()]
    every = points.view(np.int64).tolist()
    near = [(every[i], every[j]) for i in range(len(points))
            for j in (np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 3) + i + 1).tolist()]
    assert smallest(found, every) == smallest(near, every)
    assert shard == 2 or len(found) < 4 * len(points)


def test_stage_keeps_one_of_each_component(spark):
    """Brute force: every pair of documents whose fingerprints differ in three bits or fewer."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    ids = np.array(sorted(prints))
    bits = np.array([prints[i] for i in ids.tolist()], np.uint64)
    near = [(int(ids[i]), int(ids[j])) for i in range(len(ids)) for j in (np.flatnonzero(np.bitwise_count(bits[i + 1:] ^ bits[i]) <= 3) + i + 1)]
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "/root/testdata/sf0.01").collect())
    assert kept == sorted(set(smallest(near, ids.tolist()).values()))


def test_rows_with_one_id_and_unlike_texts_stay(table):
    other = " ".join(f"v{i}" for i in range(70))
    texts = [(3, PASSAGE), (5, PASSAGE), (5, other), (5, other), (None, other), (None, "alone"), (None, "ALONE"), (7, None), (8, " ")]
    docs = table([(i, t, "en", "s", 1, "r", "z", "p") for i, t in texts], DOCS)
    kept = [(r["doc_id"], r["text"]) for r in simhash_vptree.keep_one(docs).collect()]
    assert sorted(map(str, kept)) in [sorted(map(str, [(3, PASSAGE), (5, other), (None, t), (7, None)])) for t in ("alone", "ALONE")]
    assert simhash_vptree.keep_one(docs).columns == docs.columns


def test_repeated_rows_without_duplicates_elsewhere(table):
    """One row of each, also where the rows are all that a component has."""
    docs = table([(i % 3, f"text number {i % 3} of its own", None, None, None, "r", "z", str(i % 2)) for i in range(60)], DOCS)
    assert sorted(r["doc_id"] for r in simhash_vptree.keep_one(docs).collect()) == [0, 1, 2]


def test_components_of_a_long_chain(table):
    links = [(i, i + 1) for i in range(0, 80)] + [(200, 100), (200, 150), (5, 5)]
    got = {r["node"]: r["root"] for r in components.components(table(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(81)}, 100: 100, 150: 100, 200: 100}


def test_passages_that_repeat_go(table):
    got = substring_doubling.dedup_substrings(table(ROWS, DOCS)).collect()
    split = [words(r[1]) for r in ROWS]
    seen = Counter(tuple(w[i:i + 35]) for w in split for i in range(len(w) - 34))
    want = []
    for r, w in zip(ROWS, split):
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("size,width", [(1, 35), (8, 28), (16, 20), (35, 1)])
def test_windows_and_choices(size, width):
    rng = np.random.default_rng(1)
    hashed = rng.integers(0, 4, 200, dtype=np.uint64)
    found = substring_doubling.window_hashes(hashed, size)
    runs = [tuple(hashed[i:i + size]) for i in range(len(hashed) - size + 1)]
    assert len(found) == len(runs) and len(set(zip(runs, found.tolist()))) == len(set(runs)) == len(set(found.tolist()))
    at = substring_doubling.chosen(found, width)
    assert at.tolist() == [i + int(np.argmin(found[i:i + width])) for i in range(len(found) - width + 1)]


@pytest.mark.parametrize("run", [
    lambda d: token_records.record_digest(d, tokenizer_path()), mixing.mix, mixing.mixed_documents, simhash_vptree.digest,
    simhash_vptree.keep_one, substring_doubling.dedup_substrings])
def test_empty_tables(table, run):
    assert run(table([], DOCS).where(F.lit(True))).count() == 0
