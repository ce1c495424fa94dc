"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WINDOW`` bytes, each read from both ends by a small gated
recurrent layer. Every byte gets a probability per language; the mean over all bytes of
the whole text decides. The network is trained in numpy by backpropagation through
time on a bounded sample of labelled texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WINDOW = 128
HIDDEN = 8
DOCS_PER_LANGUAGE = 200  # bound of the training sample
WINDOWS_PER_DOC = 4
STEPS = 150
BATCH = 128
RATE = 0.03
LANES = 2048  # windows read side by side
UNKNOWN = "und"


def layer(rng: np.random.Generator, hidden: int) -> dict[str, np.ndarray]:
    """``x``: input of each byte to the reset, update and candidate gates; ``u``, ``b``: the recurrent part."""
    scale = 1 / np.sqrt(hidden)
    return {
        "x": rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32),
        "u": rng.uniform(-scale, scale, (3 * hidden, hidden)).astype(np.float32),
        "b": np.zeros((3 * hidden, 1), dtype=np.float32),
    }


@dataclass
class Network:
    languages: list[str]
    forward: dict[str, np.ndarray]
    backward: dict[str, np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def new_network(languages: list[str], hidden: int = HIDDEN, seed: int = 1) -> Network:
    rng = np.random.default_rng(seed)
    out = rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
    return Network(languages, layer(rng, hidden), layer(rng, hidden), out, np.zeros((len(languages), 1), np.float32))


def read(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, hidden, lanes) of one direction over bytes ``x`` (time, lanes).

    Where ``mask`` is 0 the state stays 0, so padding before a text's first byte has no effect.
    ``trace`` collects what backpropagation needs.
    """
    hidden = p["u"].shape[1]
    steps, lanes = x.shape
    # sigmoid(v) = tanh(v / 2) / 2 + 1 / 2: one tanh serves both gates
    half = np.where(np.arange(3 * hidden) < 2 * hidden, 0.5, 1.0).astype(np.float32)[:, None]
    table, u, b = p["x"] * half, p["u"] * half, p["b"] * half
    states = np.zeros((steps + 1, hidden, lanes), dtype=np.float32)
    full = mask.all(axis=1)
    gx, gh = np.empty((2, 3 * hidden, lanes), dtype=np.float32)
    for t in range(steps):
        h = states[t]
        np.take(table, x[t], axis=1, out=gx, mode="clip")
        np.matmul(u, h, out=gh)
        gh += b
        gates = gx[: 2 * hidden]
        gates += gh[: 2 * hidden]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        reset, update, new = gx[:hidden], gx[hidden : 2 * hidden], gx[2 * hidden :]
        if trace is not None:
            trace.append((reset.copy(), update.copy(), gh[2 * hidden :].copy()))
        reset *= gh[2 * hidden :]
        new += reset
        np.tanh(new, out=new)
        if trace is not None:
            trace[-1] += (new.copy(),)
        after = states[t + 1]
        np.subtract(h, new, out=after)
        after *= update
        after += new
        if not full[t]:
            after *= mask[t]
    return states[1:]


def unread(
    p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, states: np.ndarray, trace: list, grad: np.ndarray
) -> dict[str, np.ndarray]:
    """Gradients of one direction from ``grad`` of its states, back through time."""
    hidden = p["u"].shape[1]
    out = {k: np.zeros_like(v) for k, v in p.items()}
    flow = np.zeros_like(states[0])
    for t in range(len(x) - 1, -1, -1):
        before = states[t - 1] if t else np.zeros_like(flow)
        reset, update, recurrent, new = trace[t]
        flow = (flow + grad[t]) * mask[t]
        d_new = flow * (1 - update) * (1 - new * new)
        d_update = flow * (before - new) * update * (1 - update)
        d_reset = d_new * recurrent * reset * (1 - reset)
        d_x = np.concatenate([d_reset, d_update, d_new])
        d_h = np.concatenate([d_reset, d_update, d_new * reset])
        out["u"] += d_h @ before.T
        out["b"] += d_h.sum(axis=1, keepdims=True)
        one_hot = np.zeros((x.shape[1], 256), dtype=np.float32)
        one_hot[np.arange(x.shape[1]), x[t]] = 1
        out["x"] += d_x @ one_hot
        flow = flow * update + p["u"].T @ d_h
    return out


def probabilities(net: Network, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(language, time, lanes): the probability of each language at each byte."""
    both = np.concatenate([read(net.forward, x, mask), read(net.backward, x[::-1], mask[::-1])[::-1]], axis=1)
    logits = np.matmul(net.out, both) + net.bias
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits.transpose(1, 0, 2)


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and mask (time, windows) of all windows of all texts, and each window's text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    per = -(-sizes // width)
    owner = np.repeat(np.arange(len(texts)), per)
    total = int(per.sum()) * width
    flat, mask = np.zeros(total, np.uint8), np.zeros(total, np.float32)
    first = (np.cumsum(per) - per) * width
    source = np.frombuffer(b"".join(texts), dtype=np.uint8)
    place = np.arange(len(source)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    flat[place], mask[place] = source, 1
    return flat.reshape(-1, width).T, mask.reshape(-1, width).T, owner


def train(samples: dict[str, list[bytes]], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 1) -> Network:
    """A network from windows of each language, by Adam on the mean loss over all bytes."""
    languages = sorted(samples)
    net = new_network(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    x, mask, owner = windows([w for k in languages for w in samples[k]], WINDOW)
    label = np.repeat(np.arange(len(languages)), [len(samples[k]) for k in languages])[owner]
    params = {"out": net.out, "bias": net.bias}
    params |= {f"f{k}": v for k, v in net.forward.items()} | {f"b{k}": v for k, v in net.backward.items()}
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    by_class = [np.flatnonzero(label == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(own, max(1, BATCH // len(languages))) for own in by_class])
        xs, ms, target = np.ascontiguousarray(x[:, pick]), mask[:, pick], label[pick]
        traces: tuple[list, list] = ([], [])
        fwd = read(net.forward, xs, ms, traces[0])
        bwd = read(net.backward, xs[::-1], ms[::-1], traces[1])
        both = np.concatenate([fwd, bwd[::-1]], axis=1)
        logits = np.matmul(net.out, both) + net.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[:, target, np.arange(len(pick))] -= 1
        p *= ms[:, None, :] / ms.sum()
        d_both = np.matmul(net.out.T, p)
        grads = {"out": np.einsum("tln,thn->lh", p, both), "bias": p.sum(axis=(0, 2))[:, None]}
        own = unread(net.forward, xs, ms, fwd, traces[0], d_both[:, :hidden])
        grads |= {f"f{k}": v for k, v in own.items()}
        own = unread(net.backward, xs[::-1], ms[::-1], bwd, traces[1], d_both[::-1, hidden:])
        grads |= {f"b{k}": v for k, v in own.items()}
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def classify(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each non-empty text: the language's index, its mean probability, and the share of bytes labelled so."""
    x, mask, owner = windows(texts, WINDOW)
    pooled = np.zeros((len(texts), len(net.languages)))
    votes = np.zeros_like(pooled)
    for i in range(0, x.shape[1], LANES):
        lanes = slice(i, i + LANES)
        xs, ms, own = np.ascontiguousarray(x[:, lanes]), np.ascontiguousarray(mask[:, lanes]), owner[lanes]
        p = probabilities(net, xs, ms)
        top = p.max(axis=0)
        np.add.at(pooled, own, (p * ms).sum(axis=1).T)
        np.add.at(votes, own, ((p >= top) * ms).sum(axis=1).T)
    size = np.array([len(t) for t in texts])
    best = pooled.argmax(axis=1)
    row = np.arange(len(texts))
    return best, pooled[row, best] / size, votes[row, best] / size


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, per_doc: int = WINDOWS_PER_DOC
) -> dict[str, list[bytes]]:
    """Windows by language: up to ``per_doc``, evenly spaced, of ``per_language`` texts of the lowest hash.

    Spark keeps the lowest per task before it shuffles, so the driver and any task see
    at most ``per_language`` texts of a language.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    few = (
        usable.select("lang", "text", "doc_id", F.xxhash64("doc_id").alias("h"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= per_language)
    )
    octets = F.encode("text", "UTF-8")
    size = F.length(octets)
    step = F.greatest(F.lit(WINDOW), F.floor(size / per_doc).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.least(step * (per_doc - 1), size - WINDOW)), step)
    cut = few.select("lang", F.transform(starts, lambda s: F.substring(octets, s + 1, F.lit(WINDOW))).alias("parts"))
    out: dict[str, list[bytes]] = {}
    for row in cut.orderBy("lang").collect():
        out.setdefault(row["lang"], []).extend(bytes(p) for p in row["parts"])
    return out


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, labelled_share) of every row of ``docs`` (doc_id, text).

    ``und`` with score 0 where the text is NULL or has no letter, and for all if nothing was
    learned. Only the text is an input. Repeated rows and NULL ids are predicted each.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, lang_pred string, score double, labelled_share double"

    def run(batches):
        for batch in batches:
            names = np.full(len(batch), UNKNOWN, dtype=object)
            score, share = np.zeros(len(batch)), np.zeros(len(batch))
            usable = np.flatnonzero(batch["lettered"].to_numpy(bool))
            if net is not None and len(usable):
                texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"].iloc[usable]]
                at = 0
                while at < len(texts):  # a few megabytes at a time, or one longer text
                    end, size = at, 0
                    while end < len(texts) and (end == at or size + len(texts[end]) <= 4_000_000):
                        size += len(texts[end])
                        end += 1
                    best, mean, votes = classify(net, texts[at:end])
                    rows = usable[at:end]
                    names[rows] = np.array(net.languages, dtype=object)[best]
                    score[rows], share[rows] = np.clip(mean.round(6), 0, 1), votes.round(6)
                    at = end
            yield batch[["doc_id", "held_out"]].assign(lang_pred=names, score=score, labelled_share=share)

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), lettered.alias("lettered"))
    return rows.mapInPandas(run, schema)


def identify(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """``predict`` with a network trained on the rows of ``docs`` that are not held out."""
    samples = training_sample(docs, per_language)
    return predict(docs, train(samples) if samples else None)
