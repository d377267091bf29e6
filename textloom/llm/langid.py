"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into runs of ``RUN``. One gated recurrent layer reads each
run forwards and one backwards; at every byte the two states together give
probabilities of the languages. A document's probabilities are the means over all its
bytes. The network is trained in numpy by backpropagation through time on a bounded
sample, ``SAMPLE`` documents for each language, drawn by a hash of doc_id; all bytes of
all texts are labelled.

Defined cases: null text and text without letters give ``und`` and score 0; without any
labelled row to learn from every text does; rows with null lang teach nothing; of equally
probable languages the first by name is taken; repeated rows each give a row; null doc_id is
kept and learnt from; of rows that share doc_id and language one teaches; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm import _text
from textloom.sizes import spread

HIDDEN = 6
RUN = 128
SAMPLE = 300
STEPS, BATCH, TRAIN_RUN, RATE = 450, 192, 64, 0.02
#: Parts of a language in which its sample is sought first.
SALTS = 8
#: Columns of runs worked on together.
COLUMNS = 2048
#: Letters are what Unicode calls so, here as in Spark's expressions.
LETTER = regex.compile(r"\p{L}")


def _gates(h: np.ndarray, g: np.ndarray, u: np.ndarray, n: int) -> np.ndarray:
    """The next state, in place; g: input part (3n, B), u: state part."""
    zr = g[: 2 * n]
    zr += u[: 2 * n]
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    c = g[2 * n :]
    u[2 * n :] *= zr[n:]
    c += u[2 * n :]
    np.tanh(c, out=c)
    h -= c
    h *= zr[:n]
    h += c
    return h


class Network:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 2):
        rng = np.random.default_rng(seed)
        self.langs, self.n = langs, hidden
        f32 = lambda *s, k: rng.normal(0, k, s).astype(np.float32)
        # update and reset gates are halved: sigmoid(x) = (1 + tanh(x / 2)) / 2
        self.w = {f"{p}{d}": f32(*s, k=k) for d in "fb" for p, s, k in (("W", (3 * hidden, 256), 0.3), ("U", (3 * hidden, hidden), 0.3))}
        self.w |= {"V": f32(len(langs), 2 * hidden, k=0.3), "b": np.zeros((len(langs), 1), np.float32)}

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of the languages over the bytes of each (non-empty) text."""
        n, w, L = self.n, self.w, len(self.langs)
        sizes = np.array([len(t) for t in texts])
        runs = -(-sizes // RUN)
        raw = np.zeros((runs.sum(), RUN), np.uint8)
        ends = np.cumsum(runs)
        for t, a, m in zip(texts, ends - runs, runs):
            raw[a : a + m].reshape(-1)[: len(t)] = np.frombuffer(t, np.uint8)
        many = np.full(len(raw), RUN)
        many[ends - 1] = sizes - (runs - 1) * RUN
        order = np.argsort(-many, kind="stable")
        sums = np.zeros((len(raw), L), np.float32)
        for lo in range(0, len(raw), COLUMNS):
            cols = order[lo : lo + COLUMNS]
            x, long = np.ascontiguousarray(raw[cols].T), many[cols]
            # runs are sorted by length: those that reach byte t are the first live[t]
            live = (long[None, :] > np.arange(RUN)[:, None]).sum(axis=1)
            top = int(long[0])
            states = np.zeros((top, n, len(cols)), np.float32)
            h = np.zeros((n, len(cols)), np.float32)
            for t in range(top):
                h = _gates(h, w["Wf"][:, x[t]], w["Uf"] @ h, n)
                states[t] = h
            h = np.zeros((n, len(cols)), np.float32)
            total = np.zeros((L, len(cols)), np.float32)
            for t in range(top - 1, -1, -1):
                k = live[t]
                h[:, :k] = _gates(h[:, :k].copy(), w["Wb"][:, x[t, :k]], w["Ub"] @ h[:, :k], n)
                p = w["V"][:, :n] @ states[t, :, :k]
                p += w["V"][:, n:] @ h[:, :k]
                p += w["b"]
                np.exp(p, out=p)  # weights are bounded by decay: no overflow
                p /= p.sum(axis=0)
                total[:, :k] += p
            sums[cols] = total.T
        return np.add.reduceat(sums.astype(np.float64), ends - runs, axis=0) / sizes[:, None]

    def gradient(self, x: np.ndarray, lab: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the bytes of a batch and its gradients, through time.
        ``x``: bytes (T, B), ``lab``: language of each column, ``mask``: 1 where a byte is."""
        w, n, (T, B) = self.w, self.n, x.shape
        kind = w["V"].dtype
        kept = {}
        for d in "fb":
            h, hs = np.zeros((n, B), kind), []
            for t in range(T) if d == "f" else range(T - 1, -1, -1):
                g, u = w["W" + d][:, x[t]], w["U" + d] @ h
                zr = 0.5 * np.tanh(g[: 2 * n] + u[: 2 * n]) + 0.5
                c = np.tanh(g[2 * n :] + zr[n:] * u[2 * n :])
                new = (c + zr[:n] * (h - c)) * mask[t]
                hs.append((t, h, zr, c, u[2 * n :], new))
                h = new
            kept[d] = hs
        both = np.zeros((T, 2 * n, B), kind)
        for t, *_, h in kept["f"]:
            both[t, :n] = h
        for t, *_, h in kept["b"]:
            both[t, n:] = h
        logit = np.einsum("lh,thb->tlb", w["V"], both) + w["b"]
        logit -= logit.max(axis=1, keepdims=True)
        p = np.exp(logit)
        total = p.sum(axis=1, keepdims=True)
        loss = float(((np.log(total[:, 0]) - logit[:, lab, np.arange(B)]) * mask).sum() / mask.sum())
        p /= total
        p[:, lab, np.arange(B)] -= 1
        p *= mask[:, None, :] / mask.sum()
        grad = {"V": np.einsum("tlb,thb->lh", p, both), "b": p.sum(axis=(0, 2))[:, None]}
        down = np.einsum("lh,tlb->thb", w["V"], p)
        for d, part in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            dh, U = np.zeros((n, B), kind), w["U" + d]
            dU, dg = np.zeros_like(U), np.zeros((T, 3 * n, B), kind)
            for t, h, zr, c, uc, _ in reversed(kept[d]):
                dh = (dh + down[t, part]) * mask[t]
                z, r = zr[:n], zr[n:]
                dc = dh * (1 - z) * (1 - c * c)
                dg[t, :n] = dh * (h - c) * z * (1 - z) * 2
                dg[t, n : 2 * n] = dc * uc * r * (1 - r) * 2
                dg[t, 2 * n :] = dc
                du = np.concatenate((dg[t, : 2 * n], dc * r))
                dU += du @ h.T
                dh = dh * z + U.T @ du
            flat = dg.transpose(1, 0, 2).reshape(3 * n, -1)
            grad["W" + d] = np.stack([np.bincount(x.ravel(), weights=row, minlength=256) for row in flat]).astype(kind)
            grad["U" + d] = dU
        return loss, grad

    def fit(self, texts: list[bytes], y: np.ndarray, steps: int = STEPS, seed: int = 4) -> None:
        rng, w = np.random.default_rng(seed), self.w
        by = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in "ab")
        T, B = TRAIN_RUN, BATCH
        for step in range(1, steps + 1):
            x, lab = np.zeros((T, B), np.uint8), rng.integers(0, len(by), B)
            mask = np.zeros((T, B), np.float32)
            for j, k in enumerate(lab):
                t = texts[rng.choice(by[k])]
                a = int(rng.integers(0, max(1, len(t) - T + 1)))
                part = t[a : a + T]
                x[: len(part), j], mask[: len(part), j] = np.frombuffer(part, np.uint8), 1
            _, grad = self.gradient(x, lab, mask)
            grad["V"] = grad["V"] + 1e-5 * w["V"]
            rate = RATE * min(1, step / 20) * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                w[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)


def train(docs: DataFrame, learn, sample: int = SAMPLE, seed: int = 9) -> Network | None:
    """A network for the values of ``lang``; ``learn`` is a condition on doc_id."""
    order = F.xxhash64(F.lit(seed), "doc_id")
    marked = docs.filter(F.col("lang").isNotNull() & learn & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).select("doc_id", F.col("lang").cast("string").alias("lang"))
    # the first of each language, from the first of each of SALTS parts of it
    first = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(order, "doc_id"))
    some = marked.withColumn("salt", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(SALTS))).withColumn("i", first("salt")).filter(F.col("i") <= sample)
    few = F.broadcast(some.withColumn("i", first()).filter(F.col("i") <= sample).select("doc_id", "lang").distinct())  # sample rows a language at most
    found = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    # one text with letters where rows share doc_id and language: sample texts a language at most
    one = F.min(F.struct(F.xxhash64(F.lit(seed), "text").alias("at"), "text")).alias("one")
    met = found.join(few, found.doc_id.eqNullSafe(few.doc_id) & (found.lang == few.lang)).filter(found.text.rlike(r"\p{L}"))
    rows = met.groupBy(found.doc_id, found.lang).agg(one).select("one.text", "lang", "one.at").orderBy("at", "lang").select("text", "lang").toArrow()
    langs = rows.column("lang").to_pylist()
    names = sorted(set(langs))
    if not names:
        return None
    texts = rows.column("text").cast(pa.large_binary()).to_pylist()
    model = Network(names)
    if len(names) > 1:
        model.fit(texts, np.array([names.index(x) for x in langs]))
    return model


def predict(docs: DataFrame, model: Network | None) -> DataFrame:
    """doc_id, lang_pred, score, probabilities (in the order of ``model.langs``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in _text.slices(batches, 1_000_000):
            texts = b.column(1).to_pylist()
            own = [i for i, t in enumerate(texts) if m and t and LETTER.search(t)]
            lang, score, probs = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
            if own:
                p = m.probabilities([texts[i].encode() for i in own])
                for i, row, k in zip(own, p, p.argmax(axis=1)):
                    lang[i], score[i], probs[i] = m.langs[k], float(min(1.0, row[k])), row.tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang), pa.array(score, pa.float64()), pa.array(probs, pa.list_(pa.float64()))], names=["doc_id", "lang_pred", "score", "probabilities"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, probabilities array<double>")


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return predict(docs, train(docs, ~_held_out())).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_language_id": op2_language_id}
