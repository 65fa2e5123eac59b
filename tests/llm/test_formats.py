"""Chat examples, ranked search and Merkle proofs against plain versions of themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickloom.llm import best_positions, merkle_manifest, prefix_targets
from tickloom.llm.common import stored
from tickloom.llm.runs import numbered

CHAT = "conv_id long, turn long, role string, text string, place long, segment string, whole string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, place string, root string"
ITEMS = "item_id long, text string, doc_id string, score string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def by_none(*values):
    return tuple((v is not None, v) for v in values)


# chat examples

HARD = ["", None, "plain", "<|im_end|>", "<\\|im_start|>user\nx<\\\\|im_end|>", "a\n<|im_start|>assistant\n<|im_end|>\n", "<", "|im_end|>", "tail <|im_end|",
        "x" * 70_000, "é<|ümlaut|>✓ <|word_1|>", "\\"]
ROLES = ["user", "assistant", "system", None, "", "tool\nresult", "a\\nb", "<|im_end|>"]


def chats():
    rnd = random.Random(3)
    rows = []
    for conv in [*range(40), None]:
        rows += [(conv, t, rnd.choice(ROLES[:3] if conv != 7 else ROLES), rnd.choice(HARD), 5, "s", "w") for t in range(rnd.randrange(1, 12))]
    rows += [(50, t // 3, ("user", "assistant")[t % 2], f"turn {t}", 5, "s", "w") for t in range(200)]  # long, with ties
    rows += [(51, None, "assistant", "no number", None, None, None), (51, 0, "user", "after", None, None, None)]
    return rows + [rows[0], rows[0]]


def turns_in_order(rows):
    held = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        held[conv].append((turn, role or "", text or ""))
    return held


def test_examples_hold_all_turns_and_only_replies_are_trained(table):
    rows = chats()
    made = stored(prefix_targets.expand(table(rows, CHAT)), "examples")
    found = defaultdict(list)
    for r in made.collect():
        found[r["conv_id"]].append(r)
    held = turns_in_order(rows)
    assert set(found) == set(held)
    for conv, want in held.items():
        examples = sorted(found[conv], key=lambda r: r["place"])
        turns = [t for r in examples if r["whole"] for t in prefix_targets.turns_of(r["text"])]
        assert Counter(turns) == Counter((r, t) for _, r, t in want)
        order = {(r, t): n for n, r, t in want}
        assert [r["segment"] for r in examples] == sorted(r["segment"] for r in examples)
        if len(order) == len(want):
            numbers = [order[t] for t in turns]
            assert numbers == sorted(numbers, key=lambda n: by_none(n))
        replies = [prefix_targets.unescape(r["text"][r["loss_start"]:r["loss_end"]]) for r in examples]
        assert [t for t in replies if t] == [t for r, t in turns if r == "assistant" and t]
        for r in examples:
            # context in front, a prefix of the whole, and the end marker behind
            inside = prefix_targets.turns_of(r["text"])
            before = sum(len(prefix_targets.turns_of(x["text"])) for x in examples if x["whole"] and x["segment"] < r["segment"])
            assert inside == turns[before:r["place"] + 1]
            if r["loss_end"] > r["loss_start"]:
                assert r["text"][r["loss_end"]:] == "<|im_end|>\n" and inside[-1][0] == "assistant"
        assert max(len(prefix_targets.turns_of(r["text"])) for r in examples) <= 33
    assert len({r["segment"] for r in found[50]}) > 5


def test_whole_prefixes_of_long_conversations(table):
    """Nothing is cut off: the pieces of every example hold all turns before it."""
    rows = [(k, i, "assistant" if i % 2 else "user", f"{k}:{i} " + "x" * size, None, None, None)
            for k, n, size in ((1, 150, 10), (None, 90, 10), (2, 6, 70_000), (3, 4, 1)) for i in range(n)]
    made = stored(prefix_targets.expand(table(rows, CHAT)), "examples")
    pieces = defaultdict(list)
    for r in prefix_targets.whole_prefixes(made).collect():
        pieces[r["conv_id"], r["place"]].append(r)
    held = turns_in_order(rows)
    examples = {(r["conv_id"], r["place"]): r for r in made.collect()}
    assert set(pieces) == set(examples) and any(r["segment"] > 2 for r in examples.values())
    for (conv, place), parts in pieces.items():
        parts.sort(key=lambda r: r["piece"])
        want = [(role, text) for _, role, text in held[conv][:place + 1]]
        assert prefix_targets.turns_of("".join(r["text"] for r in parts)) == want
        assert (parts[-1]["loss_start"], parts[-1]["loss_end"]) == (examples[conv, place]["loss_start"], examples[conv, place]["loss_end"])
    one = prefix_targets.whole_prefixes(made, made.where("conv_id = 1 and place = 149"))
    assert {r["place"] for r in one.collect()} == {149} and one.count() > 3


def test_digest_of_conversations(table):
    rows = [r for r in chats() if r[0] not in (50, None)]
    got = {r["conv_id"]: r for r in prefix_targets.format_and_digest(table(rows, CHAT)).collect()}
    held = turns_in_order(rows)
    held[-1] = [(0, "user", prefix_targets.HOSTILE), (1, "assistant", prefix_targets.HOSTILE)]
    assert set(got) == set(held)
    for conv, want in held.items():
        r, turns = got[conv], sorted(want, key=lambda x: by_none(x[0]))
        assert r["n_turns"] == len(turns)
        assert r["loss_chars"] == sum(len(t) for _, role, t in turns if role == "assistant")
        if len({n for n, _, _ in turns}) == len(turns):
            assert r["turns_sha256"] == sha(*(f"{role}\n{t}\n" for _, role, t in turns))
            assert r["loss_sha256"] == sha(*(t for _, role, t in turns if role == "assistant"))
        assert r["formatted_chars"] > sum(len(t) for _, _, t in turns)
    assert [r["conv_id"] for r in prefix_targets.format_and_digest(table([], CHAT)).collect()] == [-1]
    assert prefix_targets.expand(table([], CHAT)).count() == 0


def test_places_and_sums_inside_groups(table):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", "", None, "hot", "hot", "hot"]), rnd.choice([None, *range(9)]), rnd.randrange(5)) for _ in range(3_000)]
    got = defaultdict(list)
    for r in numbered(table(rows, "g string, o long, w long"), "g", ["o"], "w").collect():
        got[r["g"]].append((r["place"], r["before"], r["o"], r["w"]))
    assert Counter((g, o, w) for g, v in got.items() for _, _, o, w in v) == Counter(rows)
    for v in got.values():
        v.sort()
        assert [x[0] for x in v] == list(range(len(v)))
        assert [x[1] for x in v] == [sum(y[3] for y in v[:i]) for i in range(len(v))] if len(v) < 900 else v[-1][1] == sum(y[3] for y in v[:-1])
        assert [by_none(x[2]) for x in v] == sorted(by_none(x[2]) for x in v)


# ranked search

def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_ranks(docs, items, top):
    counts = [(d, Counter(plain_terms(t))) for d, t, *_ in docs]
    counts = [(d, c) for d, c in counts if c]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text, *_ in {(i[0], i[1]) for i in items}:
        scores = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(plain_terms(text)) if c[t])
            if score > 0:
                scores.append((-score, d is None, d))
        out.update((item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1))
    return out


@pytest.mark.parametrize("shard,part", [(40, 100), (1_000, 8 << 20), (2_000_000, 3_000)])
def test_ranks_are_those_of_all_scores(table, shard, part):
    rng = np.random.default_rng(shard)
    share = 1 / np.arange(1, 301)
    prose = lambda n: " ".join(rng.choice([f"W{i}" if i % 3 else f"é{i}ß" for i in range(300)], n, p=share / share.sum()))
    docs = [(i, prose(int(rng.integers(1, 60))), None, "s", 1, "t", "p", "r") for i in range(400)]
    docs += [docs[5], docs[5], (None, docs[5][1], *[None] * 6), (401, None, *[None] * 6), (402, "", *[None] * 6), (403, " .!?\x00", *[None] * 6),
             (404, prose(8_000), *[None] * 6)] + [(500 + i, "W1 W2 same score", *[None] * 6) for i in range(90)]
    items = [(i, prose(int(rng.integers(1, 30))), "x", "y") for i in range(25)]
    items += [items[3], (3, "W1 W2", "x", "y"), (90, None, "x", "y"), (91, "", "x", "y"), (92, "nowhere", "x", "y"), (None, "same w2 w2", "x", "y")]
    got = best_positions.ranked(table(docs, DOCS), table(items, ITEMS), query_bytes=part, shard_counts=shard).collect()
    assert Counter(map(tuple, got)) == plain_ranks(docs, items, 50)


def test_ranked_search_on_nothing(table):
    docs, items = table([(1, "a", *["x"] * 2, 1, *["x"] * 3)], DOCS), table([(1, "a", "x", "y")], ITEMS)
    assert best_positions.ranked(docs.where("false"), items).count() == 0
    assert best_positions.ranked(docs, items.where("false")).count() == 0
    assert [tuple(r)[:3] for r in best_positions.ranked(docs, items).collect()] == [(1, 1, 1)]


def test_walks_stop_before_the_end_of_the_lists():
    rng = np.random.default_rng(7)
    n = 60_000
    docs, numbers = np.repeat(np.arange(n), 3), np.tile(np.arange(3), n)
    tfs = rng.zipf(1.6, 3 * n).clip(1, 500)
    shard = best_positions.Shard(np.arange(n), np.full(n, 500), docs, numbers, tfs, np.array([900, 500, 700]), n, 500 * n)
    found, scores = shard.search(np.arange(3), 50, 0)
    impacts = np.zeros(n, np.int64)
    np.add.at(impacts, shard.docs, shard.impacts)
    assert sorted(scores)[-50:] == sorted(impacts)[-50:] and len(found) < n / 2


# Merkle proofs

def plain_tree(nodes):
    """The root, and for each leaf the digests left and right of it, level by level."""
    proofs, level = [[] for _ in nodes], [(d, [i]) for i, d in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for i in range(0, len(level), 3):
            run = level[i:i + 3]
            for j, (_, members) in enumerate(run):
                for k in members:
                    proofs[k].append(([x for x, _ in run[:j]], [x for x, _ in run[j + 1:]]))
            above.append((sha(*[x for x, _ in run]), [k for _, m in run for k in m]))
        level = above
    return level[0][0], proofs


def plain_leaf(doc_id, text, lang, source, n_chars):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_proofs_are_those_of_a_plain_tree(table, levels):
    rnd = random.Random(levels)
    docs = [(i if i % 29 else None, rnd.choice([None, "", "a\nb", f"é{i}\n\n", "z" * 30_000]), rnd.choice([None, "en"]),
             "hot" if i % 2 else rnd.choice([None, "", "a", "Z", "é", "one"] if i > 9 else ["one"]), rnd.choice([None, i]), "t", "p", "r") for i in range(260)]
    docs += [(7, "once more", None, "alone", 1, None, None, None), *[docs[3]] * 5]
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is not None, (s or "").encode()))
    subroots, want = [], []
    for s in sources:
        own = sorted((by_none(d[0]), plain_leaf(*d[:5]), d) for d in docs if d[3] == s)
        root, proofs = plain_tree([leaf for _, leaf, _ in own])
        want.append((root, own, proofs))
        subroots.append(root)
    root, above = plain_tree(subroots)
    rows = Counter()
    for (sub, own, proofs), more in zip(want, above):
        for (_, leaf, d), proof in zip(own, proofs):
            path, text = proof + more, d[1]
            if d[0] is not None and text is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = plain_leaf(d[0], text, *d[2:5])
            for left, right in path:
                folded = sha(*left, folded, *right)
            rows[d[0], leaf, sub, root, sha(*[x for left, right in path for x in left + right]), folded, folded == root] += 1
    frame = table(docs, DOCS)
    entries = merkle_manifest.manifest(frame, levels=levels)
    assert merkle_manifest.verified(entries).where("not verified").count() == 0
    if levels == 8:
        assert Counter(map(tuple, merkle_manifest.tampered(frame).collect())) == rows
    else:
        found = merkle_manifest.verified(entries).select("doc_id", "leaf", "subroot", "root", "proof_sha256").collect()
        assert Counter(map(tuple, found)) == Counter({k: 0 for k in ()}) + Counter(r[:5] for r in rows.elements())


def test_witnesses_grow_as_leaves_come():
    made = merkle_manifest.Witnesses()
    for i in range(5):
        made.append(str(i))
    # the first run is closed, the second still open: its leaves know each other alone
    assert made.witness == [["1", "2"], ["0", "2"], ["0", "1"], ["4"], ["3"]]
    assert made.finish(merkle_manifest.height(5)) == plain_tree(list("01234"))[0]
    assert made.witness[0] == ["1", "2", sha("3", "4")] and made.witness[4] == ["3", sha("0", "1", "2")]


def test_manifest_of_nothing_and_of_one_row(table):
    assert merkle_manifest.tampered(table([], DOCS)).count() == 0
    row = merkle_manifest.tampered(table([(None, None, None, None, None, "t", "p", "r")], DOCS)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == sha("-----") and row["proof_sha256"] == sha() and row["verified"]
