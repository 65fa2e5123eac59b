"""Toxic spans by a linear-chain conditional random field.

Tokens are clean or toxic. Each token has a score from a lexicon of forms and word
beginnings that labelled documents use far more often when they are toxic; the field
weighs that score, a bias and the change between states. Its training tokens are labelled
at a distance: tokens of the lexicon in toxic documents are toxic, all others clean.
Forward-backward gives the probability of each token, and these give the offending
offsets and the document's score.

Most tokens are not in the lexicon and share one matrix; its powers lead across a run
of them at once, so the exact chain is walked from one scored token to the next.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.byte_cnn import fold
from tickloom.llm.common import blocks

#: Bounds of the training sample: documents of each label, characters of one.
LABEL_DOCUMENTS, DOCUMENT_CHARS = 2000, 20_000
#: Places of one training text that the field learns from, at most.
TEXT_PLACES = 4
#: A feature belongs to the lexicon from this log odds on, seen in so many toxic texts, each
#: time between other words: copies count once. Chance would give so uneven a share of the
#: feature's own texts with a probability of at most exp(-LEAST_SURPRISE), whatever the
#: number of other texts, so a language with few toxic texts keeps its words.
LEAST_ODDS, LEAST_TEXTS, LEAST_SURPRISE = 3.0, 6, 11.0
#: Toxic texts from which on these bounds count in full.
FEW_TEXTS = 40
BEGINNINGS = (4, 5, 6, 7, 8)
#: Tokens on either side of a scored one in training.
CONTEXT = 12
THRESHOLD = 0.7
_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?\"'()[]{}<>*_-"
CACHE_TOKENS = 300_000


def features(token: bytes) -> list[str]:
    word = token.decode().lower().strip(_EDGES)
    return [f"={word}", *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)] if word else []


@dataclass
class Field:
    lexicon: dict[str, float] = field(default_factory=dict)
    weight: float = 1.0
    bias: float = -4.0
    change: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    cache: dict = field(default_factory=dict)

    def score(self, token: bytes) -> float:
        found = self.cache.get(token)
        if found is None:
            if len(self.cache) >= CACHE_TOKENS:
                self.cache.clear()
            found = self.cache[token] = max((self.lexicon.get(f, 0.0) for f in features(token)), default=0.0)
        return found

    def step(self, score: float) -> np.ndarray:
        """exp of what a token with ``score`` adds, by state before and state at it."""
        return np.exp(self.change + np.array([0.0, self.bias + self.weight * score]))

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all scored tokens and their neighbours, and P(toxic) at them."""
        hits = np.flatnonzero(scores)
        n = len(scores)
        at = np.unique(np.clip(np.concatenate([hits - 1, hits, hits + 1]), 0, n - 1)) if len(hits) else np.zeros(1, np.int64)
        plain = self.step(0.0)
        values, vectors = np.linalg.eig(plain)
        inverse, ratio = np.linalg.inv(vectors), values / np.abs(values).max()

        def across(run: int) -> np.ndarray:  # a power, up to a factor
            return ((vectors * ratio**run) @ inverse).real

        steps = [self.step(s) for s in scores[at]]
        gaps = np.diff(at, prepend=-1) - 1
        forward, state = [], np.array([1.0, 0.0])  # before the first token all is clean
        for gap, m in zip(gaps.tolist(), steps):
            state = (state @ across(gap) if gap else state) @ m
            state = state / state.sum()
            forward.append(state)
        back = across(n - 1 - int(at[-1])) @ np.ones(2)
        found = np.empty(len(at))
        for i in range(len(at) - 1, -1, -1):
            both = forward[i] * back
            found[i] = both[1] / both.sum()
            back = steps[i] @ back
            back = (across(int(gaps[i])) @ back if gaps[i] else back)
            back = back / back.sum()
        return at, np.clip(found, 0, 1)


def document_score(p: np.ndarray) -> float:
    """Probability that the most suspicious token is toxic."""
    return float(p.max())


def surprise(toxic: int, n: int, share: float) -> float:
    """Chernoff bound on ``-ln`` of the chance that ``toxic`` or more of ``n`` texts are toxic
    where each is with probability ``share``."""
    seen = toxic / n
    if seen <= share:
        return 0.0
    rest = (1 - seen) * math.log((1 - seen) / (1 - share)) if toxic < n else 0.0
    return n * (seen * math.log(seen / share) + rest)


def lexicon_of(texts: list[tuple[list[bytes], int]]) -> dict[str, float]:
    """Log odds of the features that toxic texts use, by the contexts they stand in."""
    known: dict[bytes, list[str]] = {}
    total = [sum(1 for _, y in texts if y == k) for k in (0, 1)]
    least = min(LEAST_TEXTS, 2 + total[1] * (LEAST_TEXTS - 2) // FEW_TEXTS)
    unlikely = LEAST_SURPRISE * min(1.0, total[1] / FEW_TEXTS)
    seen: Counter = Counter()
    for words, y in texts:
        distinct = set(words)
        for w in [w for w in distinct if w not in known]:
            known[w] = features(w)
        if y:
            seen.update({f for w in distinct for f in known[w]})
    often = {f for f, n in seen.items() if n >= least}
    contexts: tuple[dict, dict] = ({f: set() for f in often}, {f: set() for f in often})
    forms: dict[str, Counter] = {f: Counter() for f in often}
    for words, y in texts:
        done: set[str] = set()  # a text counts once for a feature, with the first place
        for i, w in enumerate(words):
            for f in known[w]:
                if f in often and f not in done:
                    done.add(f)
                    forms[f][known[w][0]] += y
                    contexts[y][f].add((words[i - 1] if i else b"", words[i + 1] if i + 1 < len(words) else b""))
    odds = {}
    for f in often:
        toxic, clean = len(contexts[1][f]), len(contexts[0][f])
        # a beginning needs several forms: one alone stands for itself
        common = forms[f].most_common(1)[0][1]
        if toxic >= least and (f.startswith("=") or 2 * common <= forms[f].total()):
            value = math.log((toxic + 0.1) / (total[1] + 0.2)) - math.log((clean + 0.1) / (total[0] + 0.2))
            if value >= LEAST_ODDS and surprise(toxic, toxic + clean, total[1] / sum(total)) >= unlikely:
                odds[f] = value
    return odds


def learn(rows: list[tuple[str, int]], rounds: int = 100) -> Field | None:
    """A field from (text, label) rows; None if one of the labels is missing."""
    tokens = [(text.encode().split(), y) for text, y in rows]
    if len({y for _, y in tokens}) < 2:
        return None
    odds = lexicon_of(tokens)
    crf = Field(odds)
    xs, ys, width = [], [], 2 * CONTEXT + 1
    for words, y in tokens:
        scores = np.array([crf.score(w) for w in words])
        hits = np.flatnonzero(scores)
        middles = hits[:TEXT_PLACES].tolist() if len(hits) else [len(words) // 2]
        for m in middles:
            part = scores[max(0, m - CONTEXT): m + CONTEXT + 1]
            padded = np.zeros(width)
            padded[: len(part)] = part
            xs.append(padded)
            ys.append((padded > 0) & (y == 1))
    x, gold = np.array(xs), np.array(ys).astype(int)
    slope2 = np.zeros(6)
    for i in range(rounds):
        params = np.array([crf.weight, crf.bias, *crf.change.ravel()])
        slope = _slope(crf, x, gold) / len(x) - 1e-3 * params
        slope2 = 0.9 * slope2 + 0.1 * slope**2
        params = params + 0.1 * slope / (np.sqrt(slope2 / (1 - 0.9 ** (i + 1))) + 1e-6)
        crf.weight, crf.bias, crf.change = params[0], params[1], params[2:].reshape(2, 2)
    crf.cache = {}
    return crf


def _slope(crf: Field, x: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """Gradient of the log likelihood: features of the labels less expected features."""
    n, length = x.shape
    emit = np.stack([np.zeros_like(x), crf.bias + crf.weight * x], axis=-1)
    m = np.exp(emit[:, :, None, :] + crf.change)
    forward, back = np.empty((length, n, 2)), np.ones((length, n, 2))
    state = np.repeat([[1.0, 0.0]], n, axis=0)
    for t in range(length):
        state = np.einsum("ni,nij->nj", state, m[:, t])
        state /= state.sum(1, keepdims=True)
        forward[t] = state
    for t in range(length - 2, -1, -1):
        b = np.einsum("nij,nj->ni", m[:, t + 1], back[t + 1])
        back[t] = b / b.sum(1, keepdims=True)
    prior = np.concatenate([np.repeat([[[1.0, 0.0]]], n, axis=1), forward[:-1]])
    pair = prior[:, :, :, None] * m.transpose(1, 0, 2, 3) * back[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    toxic = pair[:, :, :, 1].sum(2).T
    before = np.concatenate([np.zeros((n, 1), int), gold[:, :-1]], axis=1)
    held = np.stack([((before == i) & (gold == j)).sum() for i in (0, 1) for j in (0, 1)])
    return np.concatenate([[((gold - toxic) * x).sum(), (gold - toxic).sum()], held - pair.sum((0, 1)).ravel()])


def fit(docs: DataFrame, labels: DataFrame, documents: int = LABEL_DOCUMENTS, chars: int = DOCUMENT_CHARS) -> Field | None:
    """Learns from at most ``documents`` distinct texts of each label: those with the
    smallest hashes among texts of at most ``chars`` characters. ``docs`` has doc_id and
    text, ``labels`` doc_id and toxic (0, 1). Repeated rows, and texts that repeat under one
    label, count once; a row without an id has no label."""
    short = docs.where(F.char_length("text") <= chars)
    hashed = short.select("doc_id", F.xxhash64("text").alias("h")).join(labels, "doc_id")
    distinct = hashed.groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("toxic").orderBy("h")
    picked = distinct.withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents)
    # two labels times ``documents`` rows at most, also where many rows share an id or a text
    found = short.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(picked), ["doc_id", "h"])
    rows = found.groupBy("toxic", "n").agg(F.min("text").alias("text")).collect()
    return learn([(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: (r["toxic"], r["n"], r["text"]))])


def tag(docs: DataFrame, crf: Field | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, spans (start, end, p) of ``docs`` (doc_id, text).

    Spans are offsets in code points, end exclusive, of tokens with P(toxic) of one half
    or more. Null and empty texts, and all texts where nothing was learned, score 0.
    Repeated rows each come back; other columns are ignored.
    """
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]):
        for batch, texts in blocks(batches):
            scores, spans = [], []
            for text in texts:
                data = (text or "").encode()
                words = data.split()
                if crf is None or not words:
                    scores.append(0.0)
                    spans.append([])
                    continue
                at, p = crf.marginals(np.fromiter(map(crf.score, words), np.float64, len(words)))
                scores.append(document_score(p))
                bad = {int(i): float(v) for i, v in zip(at, p) if v >= 0.5}
                spans.append([(len(data[:m.start()].decode()), len(data[:m.end()].decode()), bad[i])
                              for i, m in enumerate(_TOKEN.finditer(data)) if i in bad] if bad else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.array([[dict(zip(("start", "end", "p"), s)) for s in found] for found in spans], spans_type)],
                ["doc_id", "score", "predicted", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, score double, predicted int, spans array<struct<start: long, end: long, p: double>>")


def held_out_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans; labels of the held-out fold teach nothing."""
    out = fold(F.col("doc_id"), 3, 1)
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    crf = fit(docs.where(~out), known.where(~out))
    return tag(docs, crf).select("doc_id", out.alias("held_out"), "score", "predicted", "spans")
