"""Operator 2: language id by a bidirectional gated recurrent network.

The network reads bytes. Two GRUs, one per direction, meet in a linear layer
that labels every position; the probabilities of a document are the mean over
its positions. It is trained on the driver with numpy by backpropagation
through time, on excerpts of a bounded sample of labelled rows
(``TRAIN_DOCS`` a language, ``EXCERPT`` characters each, chosen by hash): the
sample's size is a parameter, not the data's. Prediction reads every byte of
every text: texts are cut into chunks that run side by side, and each
direction starts ``WARM`` bytes outside its chunk.

Defined results: a text that is null or has no letter is ``und`` with score 0
(as is every text when there is nothing to learn from); rows without a
language are predicted but not learnt from; repeated rows get the same result;
an empty table gives an empty one. Language, source and id are never inputs of
a prediction; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.llm.common import read_table, slices

HIDDEN = 12
#: Labelled rows per language, and characters of each, that training may see.
TRAIN_DOCS = 300
EXCERPT = 600
STEPS, BATCH, SPAN, RATE = 260, 128, 80, 0.012
SEED = 5
PAD = 256
CHUNK, WARM, AT_ONCE = 128, 16, 2048
UNKNOWN = "und"
#: Documents whose best language is less likely than this are rejected.
LEAST_SCORE = 0.4


# ------------------------------------------------------------------- network

def new_params(n_langs: int, hidden: int, rng) -> dict[str, np.ndarray]:
    p = {}
    for d in "fb":                                     # forward, backward
        p[f"Eg{d}"] = rng.normal(0, 0.3, (257, 2 * hidden))
        p[f"En{d}"] = rng.normal(0, 0.3, (257, hidden))
        p[f"Ug{d}"] = rng.normal(0, hidden ** -0.5, (hidden, 2 * hidden))
        p[f"Un{d}"] = rng.normal(0, hidden ** -0.5, (hidden, hidden))
        p[f"bn{d}"] = np.zeros(hidden)
    p["W"] = rng.normal(0, hidden ** -0.5, (2 * hidden, n_langs))
    p["b"] = np.zeros(n_langs)
    return {k: v.astype(np.float32) for k, v in p.items()}


def gru_step(p, d: str, x: np.ndarray, h: np.ndarray):
    """One step for a column of bytes: the new state and what BPTT needs."""
    k = h.shape[1]
    gates = p[f"Eg{d}"].take(x, axis=0)
    gates += h @ p[f"Ug{d}"]
    gates *= 0.5
    np.tanh(gates, out=gates)                          # sigmoid by tanh
    gates *= 0.5
    gates += 0.5
    z, r = gates[:, :k], gates[:, k:]
    u = h @ p[f"Un{d}"]
    u += p[f"bn{d}"]
    n = r * u
    n += p[f"En{d}"].take(x, axis=0)
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, u, n


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    e /= e.sum(axis=-1, keepdims=True)
    return e


def loss_and_grads(p, codes: np.ndarray, target: np.ndarray):
    """Mean cross-entropy over the positions of ``codes`` (time, batch), and
    its gradients by backpropagation through time."""
    steps, batch = codes.shape
    k = p["Unf"].shape[0]
    kept, states = {}, {}
    for d in "fb":
        h, trace = np.zeros((batch, k), np.float32), []
        states[d] = np.empty((steps, batch, k), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            new, *rest = gru_step(p, d, codes[t], h)
            trace.append((t, h, *rest))
            states[d][t] = h = new
        kept[d] = trace
    both = np.concatenate([states["f"], states["b"]], axis=2)
    probs = softmax(both @ p["W"] + p["b"])
    live = (codes != PAD)[..., None]
    n = max(1, int(live.sum()))
    right = probs[:, np.arange(batch), target]
    loss = float(-(np.log(right + 1e-9) * live[..., 0]).sum() / n)
    dlog = probs.copy()
    dlog[:, np.arange(batch), target] -= 1
    dlog *= live / n
    grads = {"W": np.tensordot(both, dlog, ([0, 1], [0, 1])), "b": dlog.sum((0, 1))}
    dboth = dlog @ p["W"].T
    one_hot = np.zeros((steps * batch, 257), np.float32)
    one_hot[np.arange(steps * batch), codes.ravel()] = 1
    for i, d in enumerate("fb"):
        dstate = dboth[:, :, i * k:(i + 1) * k]
        dgates, dn_in = np.zeros((steps, batch, 2 * k), np.float32), np.zeros((steps, batch, k), np.float32)
        gUg, gUn = np.zeros_like(p[f"Ug{d}"]), np.zeros_like(p[f"Un{d}"])
        gbn, dh = np.zeros_like(p[f"bn{d}"]), np.zeros((batch, k), np.float32)
        for t, h, z, r, u, n_ in reversed(kept[d]):
            dh = dh + dstate[t]
            dpre = dh * (1 - z) * (1 - n_ * n_)
            du = dpre * r
            dg = dgates[t]
            dg[:, :k] = dh * (h - n_) * z * (1 - z)
            dg[:, k:] = dpre * u * r * (1 - r)
            dn_in[t] = dpre
            gUg += h.T @ dg
            gUn += h.T @ du
            gbn += du.sum(0)
            dh = dh * z + dg @ p[f"Ug{d}"].T + du @ p[f"Un{d}"].T
        grads |= {f"Ug{d}": gUg, f"Un{d}": gUn, f"bn{d}": gbn,
                  f"Eg{d}": one_hot.T @ dgates.reshape(-1, 2 * k), f"En{d}": one_hot.T @ dn_in.reshape(-1, k)}
    return loss, grads


def fit(texts: list[bytes], labels: list[int], n_langs: int, hidden: int = HIDDEN, steps: int = STEPS,
        batch: int = BATCH, span: int = SPAN, rate: float = RATE, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on random spans of the texts, languages drawn evenly."""
    rng = np.random.default_rng(seed)
    p = new_params(n_langs, hidden, rng)
    arrays = [np.frombuffer(t, np.uint8).astype(np.int64) for t in texts]
    by_lang = [[i for i, x in enumerate(labels) if x == lang and len(arrays[i])] for lang in range(n_langs)]
    by_lang = [(lang, rows) for lang, rows in enumerate(by_lang) if rows]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        codes, target = np.full((span, batch), PAD, np.int64), np.empty(batch, np.int64)
        for col in range(batch):
            target[col], rows = by_lang[rng.integers(len(by_lang))]
            doc = arrays[rows[rng.integers(len(rows))]]
            at = int(rng.integers(max(1, len(doc) - span // 2)))
            part = doc[at:at + span]
            lead = int(rng.integers(WARM)) if at == 0 else 0       # what a text's edge looks like
            codes[lead:lead + len(part), col] = part[:span - lead]
        _, grads = loss_and_grads(p, codes, target)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        lr = rate * min(1.0, 4 * (1 - (step - 1) / steps))
        for k, g in grads.items():
            g = g * scale
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= (lr * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return p


def document_probs(p, texts: list[bytes]) -> np.ndarray:
    """(documents, languages): mean position probabilities, every byte read."""
    k, n_langs = p["Unf"].shape[0], len(p["b"])
    gap = b"\0" * WARM
    flat = np.frombuffer(gap + gap.join(texts) + gap + bytes(CHUNK), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = WARM + np.cumsum(size + WARM) - (size + WARM)
    n_chunks = -(-size // CHUNK)
    doc = np.repeat(np.arange(len(texts)), n_chunks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    start, end = begin[doc] + nth * CHUNK, (begin + size)[doc]
    sums = np.zeros((len(texts), n_langs))
    # longest first: at any step the chunks that reach so far are the first ones,
    # and what a chunk reads does not depend on its neighbours
    reach = np.minimum(end - start, CHUNK + WARM)
    order = np.argsort(-reach, kind="stable")
    for a in range(0, len(order), AT_ONCE):
        rows = order[a:a + AT_ONCE]
        s, b = start[rows], begin[doc[rows]]
        span = int(min(reach[rows[0]], CHUNK))
        active = np.searchsorted(-reach[rows], WARM - np.arange(span + 2 * WARM), "left").tolist()
        pos = s[None, :] + np.arange(-WARM, span + WARM)[:, None]
        codes = flat[np.minimum(pos, len(flat) - 1)].astype(np.int64)
        codes[(pos >= end[rows]) | (pos < b)] = PAD
        logits = np.zeros((span, len(rows), n_langs), np.float32)
        h = np.zeros((len(rows), k), np.float32)
        for t in range(WARM + span):
            n = active[t]
            h = gru_step(p, "f", codes[t, :n], h[:n])[0]
            if t >= WARM:
                logits[t - WARM, :n] = h @ p["W"][:k]
        h = np.zeros((0, k), np.float32)
        for t in range(span + 2 * WARM - 1, WARM - 1, -1):
            n = active[t]
            if n > len(h):
                h = np.concatenate([h, np.zeros((n - len(h), k), np.float32)])
            h = gru_step(p, "b", codes[t, :n], h)[0]
            if t < WARM + span:
                logits[t - WARM, :n] += h @ p["W"][k:]
        logits += p["b"]
        np.exp(np.clip(logits, -30, 30, out=logits), out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        logits *= (codes[WARM:WARM + span] != PAD)[..., None]
        np.add.at(sums, doc[rows], logits.sum(axis=0))
    return sums / np.maximum(size, 1)[:, None]


# ------------------------------------------------------------------ operator

def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_lang: int = TRAIN_DOCS, excerpt: int = EXCERPT) -> dict | None:
    """Model from labelled rows of ``df``; None if there are none. What comes
    to the driver is at most ``per_lang`` excerpts of each language."""
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                     F.xxhash64(F.col(id_col), F.lit(SEED)).alias("h")).filter(
        "lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    langs = sorted(counts)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, 1.5 * per_lang / counts[lang]))])
    some = rows.filter(F.pmod("h", F.lit(1_000_000)) < F.try_element_at(share, F.col("lang")) * 1_000_000)
    at = F.pmod(F.shiftright("h", 20), F.greatest(F.length("text") - excerpt, F.lit(1)))
    picked = (some.select("lang", F.substr("text", (at + 1).cast("int"), F.lit(excerpt)).alias("part"), "h")
              .orderBy("h").limit(2 * per_lang * len(langs)).collect())
    texts, labels, held = [], [], dict.fromkeys(langs, 0)
    for r in sorted(picked, key=lambda r: (r["h"], r["lang"], r["part"])):
        if held[r["lang"]] < per_lang:
            held[r["lang"]] += 1
            texts.append(r["part"].encode("utf-8", "replace"))
            labels.append(langs.index(r["lang"]))
    return {"langs": langs, "params": fit(texts, labels, len(langs))}


def predict(df: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, lang_out, score_out) of every row; ``keep`` may name the
    text."""
    names = [id_col, *keep]
    src = df.select(*[F.col(c) for c in dict.fromkeys([*names, text_col])],
                    F.col(text_col).cast("string").rlike(r"\p{L}").alias("__letters"))
    shared = df.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{n}` {src.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text_col):
                texts, letters = part.column(text_col), part.column("__letters").to_pylist()
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                rows = [i for i, x in enumerate(letters) if x] if model else []
                if rows:
                    probs = document_probs(model["params"], texts.cast(pa.binary()).take(pa.array(rows)).to_pylist())
                    for i, best, s in zip(rows, probs.argmax(1), probs.max(1)):
                        lang[i], score[i] = model["langs"][best], float(min(1.0, s))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64())], [*names, lang_out, score_out])

    return src.mapInArrow(run, f"{kinds}, `{lang_out}` string, `{score_out}` double")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those not held out."""
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return predict(docs, train(docs.filter("not held_out")), keep=("held_out",))
