"""Operator 3: document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded from two
hashed embedding bags (whole lower-cased words; 3-grams of character classes, which see
case, digits and marks) and a tanh layer. Gated attention, softmax(w . (tanh(V h) *
sigmoid(U h))), weighs the passages; the weighted sum goes to a logistic output. All
parts are learned together from document labels, by Adam on hand-written gradients in
numpy, in one task on at most ``FIT_DOCS`` labelled documents (the documented bound),
chosen by a hash of their ids. Scoring runs over every whole text in Arrow batches.

Defined results: a null or blank text is one empty passage, whose encoding is learned
like any other; a label that is null is not used; of several labels of one document
the largest counts; with no usable label every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import batched, crc_mod5, crc_mod5_py, texts

PASSAGE = 64
WORDS, SHAPES, DIM, HIDDEN, GATE = 1 << 15, 1 << 13, 12, 24, 12
FIT_DOCS = 2000


@cache
def _classes() -> np.ndarray:
    """Class of every code point: blank 0, lower 1, upper 2, digit 3, other 4; ASCII marks are their own class."""
    t = np.full(0x110000, 4, dtype=np.uint32)
    for i in range(0x3000):
        c = chr(i)
        if c.isspace():
            t[i] = 0
        elif c.islower():
            t[i] = 1
        elif c.isupper():
            t[i] = 2
        elif c.isdigit():
            t[i] = 3
        elif i < 128:
            t[i] = i + 5
    return t


def _hash(x: np.ndarray, size: int) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(16)
    x = x * np.uint32(0x85EBCA6B)
    return (x >> np.uint32(32 - size.bit_length() + 1)).astype(np.int64)


def encoded(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word rows and the passages' first word; class 3-gram rows and the passages' first 3-gram."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text or text.isspace():
        return *none, *none
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    k = _classes()[c]
    ink = k != 0
    first = np.flatnonzero(ink & np.concatenate(([True], ~ink[:-1])))
    low = np.where(k == 2, c | np.uint32(32), c)
    with np.errstate(over="ignore"):
        # words: every code times a power of its place, summed between word starts
        start = np.zeros(len(c), np.int64)
        start[first] = first
        place = np.arange(len(c)) - np.maximum.accumulate(start)
        powers = np.multiply.accumulate(np.full(64, 0x01000193, np.uint32), dtype=np.uint32)
        words = _hash(np.add.reduceat(np.where(ink, low * powers[place & 63], 0).astype(np.uint32), first, dtype=np.uint32), WORDS)
        kk = np.concatenate((k[:1] * 0, k, k[:1] * 0)).astype(np.uint32)
        shapes = _hash((kk[:-2] * np.uint32(256) + kk[1:-1]) * np.uint32(256) + kk[2:], SHAPES)
    heads = np.arange(0, len(words), PASSAGE)
    at = first[heads].copy()
    at[0] = 0
    return words, heads, shapes, at


def _means(table: np.ndarray, rows: np.ndarray, heads: np.ndarray) -> np.ndarray:
    n = np.diff(np.append(heads, len(rows)))
    return np.add.reduceat(table.take(rows, axis=0), heads, axis=0) / n[:, None].astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    make = lambda *s, scale: r.normal(0, scale, s).astype(np.float32)
    return {"words": make(WORDS, DIM, scale=0.05), "shapes": make(SHAPES, DIM, scale=0.3), "w1": make(2 * DIM, HIDDEN, scale=0.4),
            "b1": np.zeros(HIDDEN, np.float32), "v": make(HIDDEN, GATE, scale=0.3), "u": make(HIDDEN, GATE, scale=0.3),
            "a": make(GATE, scale=0.3), "out": make(HIDDEN, scale=0.2), "b": np.zeros(1, np.float32)}


def forward(m: dict, x: np.ndarray) -> tuple[float, dict]:
    """Score of one bag of encoded passages; the rest of the values serve the gradients."""
    h = np.tanh(x @ m["w1"] + m["b1"])
    t, g = np.tanh(h @ m["v"]), _sigmoid(h @ m["u"])
    s = (t * g) @ m["a"]
    s = np.exp(s - s.max())
    s /= s.sum()
    z = s @ h
    return float(_sigmoid(z @ m["out"] + m["b"])[0]), {"h": h, "t": t, "g": g, "s": s, "z": z}


def passages(m: dict, text: str | None, bag=None) -> np.ndarray:
    words, wh, shapes, sh = bag if bag is not None else encoded(text)
    if not len(words):
        return np.zeros((1, 2 * DIM), np.float32)
    return np.concatenate((_means(m["words"], words, wh), _means(m["shapes"], shapes, sh)), axis=1)


def score(m: dict, text: str | None) -> float:
    return forward(m, passages(m, text))[0]


def fit(rows: list[tuple[str | None, int]], epochs: int = 4, rate: float = 0.01, batch: int = 16, seed: int = 5) -> dict:
    m = new_model(seed)
    if not rows:
        m["out"][:] = 0
        return m
    m["b"][0] = np.log((sum(y for _, y in rows) + 1) / (sum(1 - y for _, y in rows) + 1))
    bags = [encoded(t) for t, _ in rows]
    mom = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            docs = order[i:i + batch]
            grad = {k: np.zeros_like(v) for k, v in m.items()}
            for d in docs:
                x = passages(m, None, bags[d])
                p, c = forward(m, x)
                e = (p - rows[d][1]) / len(docs)
                h, t, g, s = c["h"], c["t"], c["g"], c["s"]
                grad["out"] += e * c["z"]
                grad["b"] += e
                dz = e * m["out"]
                ds = h @ dz
                ds = s * (ds - s @ ds)
                grad["a"] += (t * g).T @ ds
                dt, dg = ds[:, None] * m["a"] * g * (1 - t * t), ds[:, None] * m["a"] * t * g * (1 - g)
                grad["v"] += h.T @ dt
                grad["u"] += h.T @ dg
                dh = (s[:, None] * dz + dt @ m["v"].T + dg @ m["u"].T) * (1 - h * h)
                grad["w1"] += x.T @ dh
                grad["b1"] += dh.sum(axis=0)
                words, wh, shapes, sh = bags[d]
                if len(words):
                    dx = dh @ m["w1"].T
                    for name, r, heads, part in (("words", words, wh, dx[:, :DIM]), ("shapes", shapes, sh, dx[:, DIM:])):
                        n = np.diff(np.append(heads, len(r)))
                        # rows that repeat in a passage are counted before the table is touched
                        key, k = np.unique(np.repeat(np.arange(len(heads)), n) * len(m[name]) + r, return_counts=True)
                        of, row = np.divmod(key, len(m[name]))
                        np.add.at(grad[name], row, (part[of].astype(np.float32) * (k / n[of])[:, None].astype(np.float32)))
            step += 1
            for k, gr in grad.items():
                a, b = mom[k]
                a *= 0.9
                a += 0.1 * gr
                b *= 0.99
                b += 0.01 * gr * gr
                m[k] -= (rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return m


def to_bytes(m: dict) -> bytes:
    buf = io.BytesIO()
    np.savez(buf, **m)
    return buf.getvalue()


def from_bytes(blob: bytes) -> dict:
    z = np.load(io.BytesIO(blob))
    return {k: z[k] for k in z.files}


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_docs: int = FIT_DOCS) -> dict:
    """Fit on at most ``fit_docs`` labelled documents outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where(F.col("y").isNotNull() & (crc_mod5(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("y").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
    sample = texts(docs).join(F.broadcast(chosen), "doc_id")  # at most fit_docs rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [f for f in frames if len(f)]
        if frames:
            rows = pd.concat(frames, ignore_index=True).sort_values(["doc_id", "text"], kind="stable").head(fit_docs)
            rows = [(t if isinstance(t, str) else None, int(y)) for t, y in zip(rows["text"], rows["y"], strict=True)]
            yield pd.DataFrame({"model": [to_bytes(fit(rows))]})

    got = sample.repartition(1).mapInPandas(run, "model binary").collect()
    return from_bytes(bytes(got[0]["model"])) if got else fit([])


def scored(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; one without an id isn't held out."""
    shared = docs.sparkSession.sparkContext.broadcast(to_bytes(model))  # a size fixed by the constants above

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = from_bytes(shared.value)
        for f in batched(frames):
            s = [score(m, t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "score": s, "predicted": [int(x >= threshold) for x in s],
                                "held_out": [not pd.isna(d) and crc_mod5_py(d) == 0 for d in f["doc_id"]]})

    out = texts(docs).mapInPandas(run, "doc_id long, score double, predicted int, held_out boolean")
    return out.select("doc_id", "held_out", "score", "predicted")
