"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths run over windows of fixed length, each
filter keeps its largest response in a window, and a softmax layer maps these to
languages. The network is trained in numpy on the driver, on a bounded sample of windows
of labelled texts, and sent to the tasks, which apply it to every window of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import blocks

#: Bytes of a window, values of an embedded byte, filters of each width.
WINDOW, EMBED, WIDTHS, FILTERS = 256, 6, (2, 3, 4), 8
#: Bounds of the training sample: windows of one text, and of one language.
TEXT_WINDOWS, LANGUAGE_WINDOWS = 3, 1500
UNKNOWN = "und"


def windows_of(data: bytes, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last one padded with zeros, and their bytes."""
    n = -(-len(data) // length)
    flat = np.zeros(n * length, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    sizes = np.full(n, length)
    if n:
        sizes[-1] = len(data) - (n - 1) * length
    return flat.reshape(n, length), sizes


@dataclass
class ByteNetwork:
    languages: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # (widest * EMBED) x all filters; zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """The embedded bytes under the filters at every place of every window."""
        wide = max(WIDTHS)
        seen = np.lib.stride_tricks.sliding_window_view(self.embed[windows], wide, axis=1)
        return np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(-1, wide * EMBED)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        places = windows.shape[1] - max(WIDTHS) + 1
        response = (self.columns(windows) @ self.filters).reshape(len(windows), places, -1)
        return np.maximum(response.max(axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray, block: int = 512) -> np.ndarray:
        parts = [self.pooled(windows[i:i + block]) @ self.out + self.out_bias for i in range(0, len(windows), block)]
        return softmax(np.concatenate(parts))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: list[str], steps: int = 500, batch: int = 64, seed: int = 5) -> ByteNetwork:
    """Adam on the cross entropy of single windows."""
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(seed)
    wide, n = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.repeat(np.arange(wide)[:, None] < np.repeat(WIDTHS, FILTERS)[None, :], EMBED, axis=0)
    net = ByteNetwork(
        languages, rng.normal(0, 1, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 0.3, (wide * EMBED, n)) * mask).astype(np.float32), np.zeros(n, np.float32),
        rng.normal(0, 0.1, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    names = ("embed", "filters", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(y), batch)
        x, places = windows[pick], windows.shape[1] - wide + 1
        cols = net.columns(x)
        response = (cols @ net.filters).reshape(batch, places, n)
        at = response.argmax(axis=1)
        top = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] + net.bias
        hidden = np.maximum(top, 0)
        d_out = softmax(hidden @ net.out + net.out_bias)
        d_out[np.arange(batch), y[pick]] -= 1
        d_out /= batch
        d_hidden = (d_out @ net.out.T) * (top > 0)
        # only the place of the largest response learns
        seen = cols.reshape(batch, places, -1)[np.arange(batch)[:, None], at]
        d_filters = np.einsum("bn,bnk->kn", d_hidden, seen) * mask
        d_seen = (d_hidden[:, :, None] * net.filters.T[None]).reshape(batch, n, wide, EMBED)
        under = x[np.arange(batch)[:, None, None], at[:, :, None] + np.arange(wide)]
        d_embed = np.zeros_like(net.embed)
        np.add.at(d_embed, under, d_seen)
        slopes = {"embed": d_embed, "filters": d_filters, "bias": d_hidden.sum(0), "out": hidden.T @ d_out, "out_bias": d_out.sum(0)}
        rate = 0.02 * min(1, 2 * (1 - step / (steps + 1)))
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * slopes[k]
            second[k] = 0.99 * second[k] + 0.01 * slopes[k] ** 2
            change = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
            setattr(net, k, (getattr(net, k) - change).astype(np.float32))
    return net


def fit(labelled: DataFrame, text_windows: int = TEXT_WINDOWS, language_windows: int = LANGUAGE_WINDOWS) -> ByteNetwork | None:
    """A network for the languages of ``labelled`` (text, lang), None if it has no text.

    Of each text at most ``text_windows`` evenly spread windows take part, of each
    language ``language_windows``: where there are more, hashes thin them out in the scan
    to a few times that number, and the smallest of these hashes stay. The hashes are those
    of text and window, so the sample doesn't depend on how the rows lie in files; a text
    that repeats counts once for a language.
    """
    known = labelled.where("lang is not null").select("lang", "text", F.xxhash64("text").alias("row"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("row", 0.02).alias("n")).collect()}
    if not counts:
        return None
    def cut(batches: Iterator[pa.RecordBatch]):
        for batch, texts in blocks(batches):
            langs, found = [], []
            for lang, row, text in zip(batch.column("lang").to_pylist(), batch.column("row").to_pylist(), texts):
                windows, _ = windows_of((text or "").encode())
                for i in sorted(set(np.linspace(0, len(windows) - 1, text_windows).astype(int).tolist())) if len(windows) else []:
                    langs.append(lang)
                    found.append((row, i, windows[i].tobytes()))
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()))]],
                ["lang", "row", "i", "window"])

    # a text has one window at least unless it is empty
    share = {k: min(1.0, 8 * language_windows / n) for k, n in counts.items()}
    kept = F.create_map(*[F.lit(x) for k in sorted(share) for x in (k, int(share[k] * (1 << 30)))])
    cuts = known.mapInArrow(cut, "lang string, row long, i int, window binary").withColumn("h", F.xxhash64("row", "i", "window"))
    thin = cuts.where(F.pmod("h", F.lit(1 << 30)) < kept[F.col("lang")]).select("lang", "h", "window").distinct()
    order = Window.partitionBy("lang").orderBy("h", "window")
    rows = thin.withColumn("n", F.row_number().over(order)).where(F.col("n") <= language_windows).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["n"]))
    return train(np.stack([np.frombuffer(r["window"], np.uint8) for r in rows]), [r["lang"] for r in rows])


def identify(docs: DataFrame, net: ByteNetwork | None, prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the columns ``prediction`` and ``score`` to ``docs``, by the column ``text``.

    The score is the mean probability over the bytes of the whole text. Null texts, and
    texts without a letter, are ``und`` with score 0; so is every text where nothing was
    learned. Own columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in (prediction, score)]
    if net is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias(prediction), F.lit(0.0).alias(score))
    inner = docs.select(*kept)

    def apply(batches: Iterator[pa.RecordBatch]):
        for batch, texts in blocks(batches, chars=1_000_000):
            cut = [windows_of((t or "").encode()) for t in texts]
            counts = np.array([len(s) for _, s in cut])
            best, high = np.full(len(texts), -1), np.zeros(len(texts))
            full = np.flatnonzero(counts)
            if len(full):
                p = net.probabilities(np.concatenate([w for w, _ in cut]))
                weight = np.concatenate([s for _, s in cut])
                starts = (np.cumsum(counts) - counts)[full]
                mean = np.add.reduceat(p * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
                best[full] = mean.argmax(axis=1)
                high[full] = mean.max(axis=1)
            names = [net.languages[i] if i >= 0 else UNKNOWN for i in best]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.clip(high, 0, 1))],
                                             [*batch.schema.names, prediction, score])

    schema = inner.withColumns({prediction: F.lit(UNKNOWN), score: F.lit(0.0)}).schema
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return inner.mapInArrow(apply, schema).withColumns({
        prediction: F.when(known, F.col(prediction)).otherwise(UNKNOWN),
        score: F.when(known, F.col(score)).otherwise(0.0)})


def known_language(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (text, lang and others) in a language that their labels teach.

    Texts without a letter go, and texts whose best language has a probability below
    ``least``. Where no row has a language, only texts without a letter go.
    """
    net = fit(docs.select("text", "lang"))
    named, sure = (fresh(docs, n) for n in ("prediction", "probability"))
    kept = F.col("text").rlike(r"\p{L}") if net is None else (F.col(named) != UNKNOWN) & (F.col(sure) >= least)
    return identify(docs, net, named, sure).where(kept).select(*docs.columns)


def fresh(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def fold(doc_id: Column, folds: int, held: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == held


def held_out_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; texts of the held-out fold teach nothing."""
    out = fold(F.col("doc_id"), 4, 2)
    net = fit(docs.where(~out).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), net).select("doc_id", out.alias("held_out"), "lang_pred", "score")
