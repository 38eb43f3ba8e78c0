"""Operator 9: language identification.

Averaged hashed subword embeddings with a linear softmax, trained by stochastic
gradient descent in numpy, with temperature-calibrated confidence and rejection.

A text is lower-cased, every run of non-letters becomes one boundary, and each
character 2-, 3- and 4-gram of the result is hashed to an embedding. The mean of the
embeddings goes through a linear softmax. The model is fitted in one task on at most
``per_lang`` documents of each language (the documented bound), chosen by a hash of
their ids; it is applied to every whole text in Arrow batches, without a shuffle.
A text is rejected if the calibrated probability says that another language is more
likely than not, or if it is unlike all that was learned: the share of its n-grams that
training has seen lies below ``FAMILIAR`` times the least share among the texts kept back
of all languages. So texts in scripts that no language has go, whatever the softmax says;
a language not learned whose n-grams mostly occur in learned ones is not told apart.
After fitting, embeddings and softmax weights fold into one table of logits per n-gram.

Defined results: a null text, or one without any letter, is ``und`` with score 0 and
is rejected; repeated rows are scored each; an empty table gives an empty result; with
no usable training row everything is ``und``. Further columns are ignored.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import crc_mod5, free_others, texts

BUCKETS, DIM, ORDERS = 1 << 17, 8, (2, 3, 4)
PER_LANG = 300
FAMILIAR = 0.5
UNKNOWN = "und"


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter; its lower case where that is one code point."""
    alpha = np.zeros(0x110000, dtype=bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            alpha[i] = True
            if len(x := c.lower()) == 1:
                lower[i] = ord(x)
    return alpha, lower


def ngrams(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed n-grams of the text; empty if it has no letter."""
    if not text:
        return np.empty(0, dtype=np.int64)
    alpha, lower = _letters()
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    keep = alpha[c]
    if not keep.any():
        return np.empty(0, dtype=np.int64)
    c = np.concatenate(([32], np.where(keep, lower[c], 32), [32])).astype(np.uint32)
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    out, h = [], c
    for n in range(2, max(ORDERS) + 1):
        h = h[:len(c) - n + 1] * np.uint32(0x01000193) ^ c[n - 1:] * np.uint32(0x9E3779B1)
        if n in ORDERS and len(h):
            x = h + np.uint32(n)
            x ^= x >> np.uint32(15)
            out.append(((x * np.uint32(0x85EBCA6B)) >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64))
    return np.concatenate(out)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, str]], epochs: int = 4, rate: float = 0.5, batch: int = 32, seed: int = 7) -> dict:
    """``rows``: (text, language). A fifth of them is kept back for the temperature and the least share of seen n-grams."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in rows})
    at = {lang: i for i, lang in enumerate(langs)}
    bags, y = [], []
    for text, lang in rows:
        f, n = np.unique(ngrams(text), return_counts=True)
        if len(f):
            bags.append((f, (n / n.sum()).astype(np.float32)))
            y.append(at[lang])
    if not bags:
        return {"langs": [], "table": np.zeros((BUCKETS, 1), np.float32), "bias": np.zeros(1), "temperature": 1.0,
                "seen": np.zeros(BUCKETS, bool), "familiar": 0.0}
    y = np.array(y)
    order = rng.permutation(len(bags))
    held, train = (order[::5], np.setdiff1d(order, order[::5])) if len(bags) >= 10 else (order, order)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, b = rng.normal(0, 0.3, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    sq = np.zeros(BUCKETS, np.float32)  # squared gradients by row, for the step size
    share = np.bincount(y[train], minlength=len(langs)).clip(1)
    weight = (share.mean() / share)[y].astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in range(0, len(train), batch):
            docs = train[i:i + batch] if epoch == 0 else rng.choice(train, batch)
            f = np.concatenate([bags[d][0] for d in docs])
            v = np.concatenate([bags[d][1] for d in docs])
            doc = np.repeat(np.arange(len(docs)), [len(bags[d][0]) for d in docs])
            mean = np.zeros((len(docs), DIM), np.float32)
            np.add.at(mean, doc, emb[f] * v[:, None])
            err = _softmax(mean @ w + b)
            err[np.arange(len(docs)), y[docs]] -= 1
            err *= weight[docs][:, None] / len(docs)
            back = err @ w.T
            w -= 20 * step * mean.T @ err
            b -= step * err.sum(axis=0)
            g = back[doc] * v[:, None]
            np.add.at(sq, f, (g * g).sum(axis=1))
            np.add.at(emb, f, -step * 0.3 * g / np.sqrt(sq[f] + 1e-10)[:, None])
    table = (emb @ w).astype(np.float32)
    logits = np.array([(table[bags[d][0]] * bags[d][1][:, None]).sum(axis=0) for d in held]) + b
    scales = np.geomspace(0.01, 5, 80)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(held)), y[held]].clip(1e-12)).mean() for t in scales]
    seen = np.zeros(BUCKETS, bool)
    seen[np.concatenate([bags[d][0] for d in train])] = True
    least = min(float(bags[d][1][seen[bags[d][0]]].sum()) for d in held)
    return {"langs": langs, "table": table, "bias": b, "temperature": float(scales[int(np.argmin(loss))]),
            "seen": seen, "familiar": FAMILIAR * least}


def judged(model: dict, text: str | None, reject_below: float = 0.5) -> tuple[str, float, bool]:
    """(language, calibrated probability, rejected); of equal probabilities the first language by name."""
    f = ngrams(text)
    if not len(f) or not model["langs"]:
        return UNKNOWN, 0.0, True
    logits = model["table"].take(f, axis=0).mean(axis=0, dtype=np.float64) + model["bias"]
    p = _softmax((logits / model["temperature"])[None, :])[0]
    i = int(p.argmax())
    unlike = model["seen"].take(f).mean() < model["familiar"]
    return model["langs"][i], float(p[i]), bool(p[i] < reject_below or unlike)


def predict(model: dict, text: str | None) -> tuple[str, float]:
    return judged(model, text)[:2]


def _to_bytes(model: dict) -> bytes:
    buf = io.BytesIO()
    np.savez(buf, table=model["table"], bias=model["bias"], temperature=model["temperature"], langs=np.array(model["langs"], dtype=str),
             seen=np.packbits(model["seen"]), familiar=model["familiar"])
    return buf.getvalue()


def _from_bytes(blob: bytes) -> dict:
    z = np.load(io.BytesIO(blob))
    return {"langs": [str(x) for x in z["langs"]], "table": z["table"], "bias": z["bias"], "temperature": float(z["temperature"]),
            "seen": np.unpackbits(z["seen"]).astype(bool), "familiar": float(z["familiar"])}


def fitted(docs: DataFrame, per_lang: int = PER_LANG, lang_col: str = "lang") -> dict:
    """Fit in one task on at most ``per_lang`` documents of each language outside the held-out fold."""
    t = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(lang_col).alias("lang"))
    usable = t.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod5(F.col("doc_id")) != 0))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang)
    sample = usable.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f for f in frames], ignore_index=True)
        rows = rows.sort_values(["doc_id", "lang", "text"], kind="stable").groupby("lang").head(per_lang)
        yield pd.DataFrame({"model": [_to_bytes(fit(list(zip(rows["text"], rows["lang"], strict=True))))]})

    got = sample.repartition(1).mapInPandas(_or_empty(run), "model binary").collect()
    return _from_bytes(bytes(got[0]["model"])) if got else fit([])


def _or_empty(run):
    def f(frames):
        frames = [x for x in frames if len(x)]
        if frames:
            yield from run(iter(frames))
    return f


def judging(spark: SparkSession, model: dict, reject_below: float = 0.5):
    """A column function: text to ``struct<lang_pred, score, rejected>``.

    ``score`` is the calibrated probability of the prediction; see the head of this
    module for what is rejected.
    """
    shared = spark.sparkContext.broadcast(_to_bytes(model))  # BUCKETS x languages: bounded

    @F.pandas_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        free_others("language")
        m = _from_bytes(shared.value)
        for b in batches:
            yield pd.DataFrame([judged(m, t, reject_below) for t in b], columns=["lang_pred", "score", "rejected"])

    return judge


def identified(docs: DataFrame, model: dict, reject_below: float = 0.5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row; one without an id isn't held out."""
    t = texts(docs).withColumn("j", judging(docs.sparkSession, model, reject_below)(F.col("text")))
    return t.select("doc_id", F.coalesce(crc_mod5(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "j.lang_pred", "j.score", "j.rejected")


def accepted(docs: DataFrame, model: dict, reject_below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language isn't rejected, with all their columns."""
    mark = f"__j{uuid.uuid4().hex}"
    return docs.withColumn(mark, judging(docs.sparkSession, model, reject_below)(F.col("text"))).where(~F.col(f"{mark}.rejected")).drop(mark)
