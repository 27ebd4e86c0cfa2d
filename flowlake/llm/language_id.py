"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in windows of fixed length. Two gated recurrent
layers run over each window, one forward and one backward; their joined state
gives every byte position a distribution over the languages. A document's
probabilities are the mean over all its positions. Training is plain numpy:
backpropagation through time with Adam on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_bytes, row_groups, short_batches

UNDETERMINED = "und"


@dataclass
class BiGru:
    """Weights of both directions (axis 0: forward, backward) and of the output layer."""

    labels: list[str]
    wx: np.ndarray  # 2, 256, 3H: update, reset and candidate inputs of each byte
    wh: np.ndarray  # 2, H, 3H
    wo: np.ndarray  # 2, H, K
    bo: np.ndarray  # K


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def loss_and_gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over all positions of windows x (n, T) with label indexes y, and its gradients by p.

    Backpropagation through time: the states of the forward pass are kept and walked back.
    """
    (b_n, t_n), h_n, like = x.shape, p["wh"].shape[1], p["wx"].dtype
    both = np.stack([x, x[:, ::-1]])  # direction, row, time
    h = np.zeros((2, b_n, h_n), like)
    kept, states = [], np.empty((t_n, 2, b_n, h_n), like)
    for t in range(t_n):
        a = np.stack([p["wx"][0][both[0, :, t]], p["wx"][1][both[1, :, t]]])
        g = h @ p["wh"]
        zr = _sigmoid(a[..., :2 * h_n] + g[..., :2 * h_n])
        z, r = zr[..., :h_n], zr[..., h_n:]
        c = np.tanh(a[..., 2 * h_n:] + r * g[..., 2 * h_n:])
        kept.append((h, z, r, c, g[..., 2 * h_n:]))
        h = c + z * (h - c)
        states[t] = h
    hf, hb = states[:, 0], states[::-1, 1]  # both by position
    logits = hf @ p["wo"][0] + hb @ p["wo"][1] + p["bo"]
    logits -= logits.max(-1, keepdims=True)
    e = np.exp(logits)
    d = e / e.sum(-1, keepdims=True)
    loss = -np.log(d[:, np.arange(b_n), y]).mean()
    d[:, np.arange(b_n), y] -= 1
    d /= b_n * t_n
    grad = {"bo": d.sum((0, 1)), "wx": np.zeros_like(p["wx"]), "wh": np.zeros_like(p["wh"]),
            "wo": np.stack([np.einsum("tbh,tbk->hk", s, d) for s in (hf, hb)])}
    dstate = np.stack([d @ p["wo"][0].T, (d @ p["wo"][1].T)[::-1]], axis=1)
    dh = np.zeros((2, b_n, h_n), like)
    for t in range(t_n - 1, -1, -1):
        dh = dh + dstate[t]
        before, z, r, c, gc = kept[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (before - c) * z * (1 - z)
        dr = dc * gc * r * (1 - r)
        dx = np.concatenate([dz, dr, dc], -1)
        dg = np.concatenate([dz, dr, dc * r], -1)
        for way in (0, 1):
            np.add.at(grad["wx"][way], both[way, :, t], dx[way])
        grad["wh"] += before.transpose(0, 2, 1) @ dg
        dh = dh * z + dg @ p["wh"].transpose(0, 2, 1)
    return float(loss), grad


def train_bigru(windows: np.ndarray, targets: np.ndarray, labels: list[str], hidden: int = 8,
                steps: int = 350, batch: int = 128, rate: float = 0.02, seed: int = 7) -> BiGru:
    """Fit by backpropagation through time; windows: (n, T) bytes, targets: label index of each.

    Batches draw every label equally often, so rare languages count as much as
    common ones. Deterministic for given input.
    """
    rng = np.random.default_rng(seed)
    h_n, k_n = hidden, len(labels)
    p = {"wx": rng.normal(0, 0.3, (2, 256, 3 * h_n)).astype(np.float32),
         "wh": rng.normal(0, 0.5 / np.sqrt(h_n), (2, h_n, 3 * h_n)).astype(np.float32),
         "wo": rng.normal(0, 0.5 / np.sqrt(h_n), (2, h_n, k_n)).astype(np.float32),
         "bo": np.zeros(k_n, np.float32)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    pools = [np.flatnonzero(targets == k) for k in range(k_n)]
    pools = [(k, pool) for k, pool in enumerate(pools) if len(pool)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(pool, -(-batch // len(pools))) for _, pool in pools])
        x, y = windows[pick], targets[pick]
        _, grad = loss_and_gradients(p, x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        pace = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k in p:
            g = grad[k] * min(1.0, 1.0 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.99 * v2[k] + 0.01 * g * g
            p[k] -= pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-6)
    return BiGru(list(labels), p["wx"], p["wh"], p["wo"], p["bo"])


class Scorer:
    """Forward passes of a trained network over many windows at once."""

    def __init__(self, model: BiGru):
        h = self.h = model.wh.shape[1]
        halve = np.ones(3 * h, np.float32)
        halve[:2 * h] = 0.5  # sigmoid(x) = (1 + tanh(x / 2)) / 2
        self.wx = [np.ascontiguousarray((model.wx[d] * halve).T) for d in (0, 1)]
        self.wh = [np.ascontiguousarray((model.wh[d] * halve).T) for d in (0, 1)]
        self.wo = np.concatenate([model.wo[0], model.wo[1]]).T.copy()
        self.bo = model.bo[:, None]
        self.k = len(model.labels)

    def window_sums(self, windows: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """Sum over the positions of each window (n, T) of its label distribution: (n, K).

        lengths: real bytes of each window where it is shorter than T; the
        state stays zero outside of them and such positions count nothing.
        """
        n, t_n = windows.shape
        h_n = self.h
        x = np.ascontiguousarray(windows.T).astype(np.intp)
        states = np.empty((t_n, 2 * h_n, n), np.float32)
        a, g = np.empty((3 * h_n, n), np.float32), np.empty((3 * h_n, n), np.float32)
        for way in (0, 1):
            h = np.zeros((h_n, n), np.float32)
            for t in (range(t_n) if way == 0 else range(t_n - 1, -1, -1)):
                np.take(self.wx[way], x[t], axis=1, out=a, mode="clip")
                np.matmul(self.wh[way], h, out=g)
                zr = a[:2 * h_n]
                zr += g[:2 * h_n]
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                c = g[2 * h_n:]
                c *= zr[h_n:]
                c += a[2 * h_n:]
                np.tanh(c, out=c)
                h -= c
                h *= zr[:h_n]
                h += c
                if lengths is not None:
                    h *= lengths > t
                states[t, way * h_n:(way + 1) * h_n] = h
        e = np.matmul(self.wo, states)
        e += self.bo
        e -= e.max(1, keepdims=True)
        np.exp(e, out=e)
        e /= e.sum(1, keepdims=True)
        if lengths is not None:
            e *= (np.arange(t_n)[:, None] < lengths)[:, None, :]
        return e.sum(0).T

    def documents(self, buf: np.ndarray, offsets: np.ndarray, width: int = 128, rows: int = 1024) -> np.ndarray:
        """Mean label distribution over all bytes of each document: (n, K)."""
        size = np.diff(offsets)
        n = len(size)
        total = np.zeros((n, self.k))
        whole = size // width
        owner = np.repeat(np.arange(n), whole)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(whole) - whole, whole)
        start = offsets[owner] + nth * width
        inside = np.arange(width)
        for lo in range(0, len(owner), rows):
            s = start[lo:lo + rows]
            sums = self.window_sums(buf[s[:, None] + inside])
            np.add.at(total, owner[lo:lo + rows], sums)
        rest = np.flatnonzero(size % width)
        if len(rest):
            order = rest[np.argsort(size[rest] % width, kind="stable")]
            for lo in range(0, len(order), rows):
                docs = order[lo:lo + rows]
                length = (size[docs] % width).astype(np.int64)
                width_here = int(length.max())
                at = np.minimum((offsets[docs] + whole[docs] * width)[:, None] + inside[:width_here], len(buf) - 1)
                total[docs] += self.window_sums(buf[at], length)
        return total / np.maximum(size, 1)[:, None]


def fit_language_model(docs: DataFrame, sample_rows: int = 4000, sample_bytes: int = 512, width: int = 64,
                       **training) -> BiGru | None:
    """Train on at most ``sample_rows`` labelled rows, ``sample_bytes`` of each.

    Only rows with a text, a lang and a doc_id whose crc32 (of the id as text)
    is not divisible by 5 are learned from. Every language gives an equal part
    of the sample (one row at least), or all its rows if it has fewer: those with the smallest hash
    of (doc_id, text), which are the same for any partitioning and drawn evenly
    over the whole table. Long texts give the bytes in their middle. None when
    no row qualifies.
    """
    text, doc_id = F.col("text"), F.col("doc_id").cast("long")
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out(doc_id) & doc_id.isNotNull()).select(
        F.xxhash64(doc_id, text).alias("h"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    part = max(1, sample_rows // len(counts))
    # only rows that can be among the smallest hashes are sorted; three times as many as are needed
    least = {lang: int(-2 ** 63 + 3 * part / n * (2 ** 64 - 1)) for lang, n in counts.items() if n > 3 * part}
    if least:
        below = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("lang")]
        rows = rows.filter(below.isNull() | (F.col("h") <= below))
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - sample_bytes) / 2)).cast("int")
    rows = rows.filter(text.rlike(r"\p{L}")).select(
        "h", "lang", F.substring(F.col("text"), middle, F.lit(sample_bytes)).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = (rows.withColumn("place", place).where(F.col("place") <= part)
            .orderBy("h", "lang", "text").select("lang", "text").collect())
    labels = sorted({r.lang for r in rows})
    if not labels:
        return None
    windows, targets = [], []
    for r in rows:
        raw = r.text.encode()[:sample_bytes]
        for lo in range(0, len(raw), width):
            part = raw[lo:lo + width]
            if len(part) * 2 >= width or lo == 0:
                windows.append((part * (width // len(part) + 1))[:width])
                targets.append(labels.index(r.lang))
    matrix = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, width).astype(np.intp)
    return train_bigru(matrix, np.array(targets), labels, **training)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 5 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labels_and_scores(scorer: Scorer, labels: list[str], column) -> tuple[np.ndarray, np.ndarray]:
    """Best label and its probability of each text of an Arrow column (null or empty: undetermined, 0)."""
    buf, offsets = arrow_bytes(column)
    lang, score = np.full(len(column), UNDETERMINED, object), np.zeros(len(column))
    names = np.array(labels, object)
    for lo, hi in row_groups(offsets, 1 << 20):
        own = offsets[lo:hi + 1] - offsets[lo]
        probs = scorer.documents(buf[offsets[lo]:offsets[hi]], own)
        best = probs.argmax(1)
        some = np.diff(own) > 0
        lang[lo:hi][some] = names[best[some]]
        score[lo:hi][some] = np.clip(probs[np.arange(len(best)), best][some], 0, 1)
    return lang, score


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def language_id(docs: DataFrame, model: BiGru | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Texts that are null or have no letter, and every text when there is no
    model, are ``und`` with score 0. Repeated rows get equal results. Only
    doc_id and text are read; lang, source and doc_id are no inputs of a
    prediction, other columns may have any name.
    """
    short_batches(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"),
                       F.when(_has_letter(), F.col("text")).alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            n = batch.num_rows
            lang, score = (labels_and_scores(scorer, model.labels, batch.column("text")) if scorer
                           else ([UNDETERMINED] * n, np.zeros(n)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: BiGru | None, min_score: float = 0.4) -> DataFrame:
    """Rows whose language the network tells with at least ``min_score``; all columns unchanged.

    Without a model (no labelled row) no language can be told and no row stays.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            if scorer and batch.num_rows:
                lang, score = labels_and_scores(scorer, model.labels, batch.column("text"))
                yield batch.filter(pa.array((lang != UNDETERMINED) & (score >= min_score)))

    short_batches(docs.sparkSession)
    return docs.filter(_has_letter()).mapInArrow(keep, docs.schema)
