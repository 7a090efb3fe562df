"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads UTF-8 bytes in segments of ``SEGMENT`` bytes, forwards and backwards; at
every position both hidden states give a distribution over the languages, and a document's
probabilities are the mean of its positions' log probabilities, renormalised. Training is
backpropagation through time with Adam over a bounded sample: ``per_language`` documents of
each language, chosen by the hash of their ids, and ``windows`` segments spread over each.
Prediction reads every byte of every document; all segments of a batch step together.

Defined results: a null text, and one without a letter, is ``und`` with score 0; so is every
document if there was nothing to learn from. Null ids and labels are never learned from.
Repeated rows get the same answer; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 64
HIDDEN = 6
PER_LANGUAGE = 400
WINDOWS = 4
EPOCHS = 6
BATCH = 128
RATE = 0.02
SEQUENCES_AT_ONCE = 512
BYTES_AT_ONCE = 1 << 21
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PAD = 256  # an input row of its own for positions behind the end of a text


def _fresh(rng: np.random.Generator, classes: int, hidden: int) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = {}
    for side in "fb":
        net[f"x_{side}"] = normal(257, 3 * hidden, scale=0.3)  # input weights and biases of each byte
        net[f"u_{side}"] = normal(hidden, 2 * hidden, scale=hidden**-0.5)  # update and reset gates
        net[f"c_{side}"] = normal(hidden, hidden, scale=hidden**-0.5)  # candidate state
    net["out"] = normal(2 * hidden, classes, scale=hidden**-0.5)
    net["bias"] = np.zeros(classes, np.float32)
    return net


def _states(net: dict, side: str, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (position, sequence, unit) over ``codes`` (position, sequence)."""
    table, u, c = net[f"x_{side}"], net[f"u_{side}"], net[f"c_{side}"]
    hidden = c.shape[0]
    steps, count = codes.shape
    out = np.empty((steps, count, hidden), np.float32)
    state = np.zeros((count, hidden), np.float32)
    order = range(steps) if side == "f" else range(steps - 1, -1, -1)
    for t in order:
        x = table[codes[t]]
        gates = state @ u
        gates += x[:, :2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:, :hidden], gates[:, hidden:]
        candidate = (r * state) @ c
        candidate += x[:, 2 * hidden:]
        np.tanh(candidate, out=candidate)
        before = state
        state = candidate - before
        state *= z
        state += before
        out[t] = state
        if keep is not None:
            keep.append((t, before, z, r, candidate))
    return out


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(-1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(-1, keepdims=True))


def gradients(net: dict, codes: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over real positions, and its gradient by every weight."""
    hidden = net["c_f"].shape[0]
    tapes: dict[str, list] = {"f": [], "b": []}
    states = np.concatenate([_states(net, side, codes, tapes[side]) for side in "fb"], -1)
    log_p = _log_softmax(states @ net["out"] + net["bias"])
    real = (codes != _PAD).astype(np.float32)
    count = max(1.0, float(real.sum()))
    loss = -float((np.take_along_axis(log_p, target[None, :, None], 2)[..., 0] * real).sum()) / count
    delta = np.exp(log_p)
    delta[:, np.arange(len(target)), target] -= 1
    delta *= real[..., None] / count
    grad = {k: np.zeros_like(v) for k, v in net.items()}
    grad["out"] = np.einsum("tbh,tbc->hc", states, delta)
    grad["bias"] = delta.sum((0, 1))
    to_states = delta @ net["out"].T
    for side, cut in (("f", slice(0, hidden)), ("b", slice(hidden, None))):
        u, c = net[f"u_{side}"], net[f"c_{side}"]
        carried = np.zeros_like(to_states[0, :, cut])
        for t, before, z, r, candidate in reversed(tapes[side]):
            d_state = to_states[t, :, cut] + carried
            d_candidate = d_state * z * (1 - candidate**2)
            d_mixed = d_candidate @ c.T
            d_gates = np.concatenate([d_state * (candidate - before) * z * (1 - z), d_mixed * before * r * (1 - r)], 1)
            grad[f"c_{side}"] += (r * before).T @ d_candidate
            grad[f"u_{side}"] += before.T @ d_gates
            np.add.at(grad[f"x_{side}"], codes[t], np.concatenate([d_gates, d_candidate], 1))
            carried = d_state * (1 - z) + d_mixed * r + d_gates @ u.T
    return loss, grad


def _segments(texts: list[bytes], segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Codes (position, segment) of whole texts, and the text each segment belongs to."""
    sizes = np.array([-(-len(t) // segment) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    codes = np.full(len(owner) * segment, _PAD, np.int16)
    at = 0
    for text, size in zip(texts, sizes.tolist(), strict=True):
        codes[at:at + len(text)] = np.frombuffer(text, np.uint8)
        at += size * segment
    return np.ascontiguousarray(codes.reshape(-1, segment).T), owner


def train(samples: list[tuple[bytes, int]], classes: int, seed: int = 7, hidden: int = HIDDEN, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = _fresh(rng, classes, hidden)
    codes, owner = _segments([text for text, _ in samples])
    target = np.array([label for _, label in samples])[owner]
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    step, steps = 0, max(1, epochs * -(-len(owner) // BATCH))
    for _ in range(epochs):
        order = rng.permutation(len(owner))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin:begin + BATCH]
            _, grad = gradients(net, codes[:, chosen], target[chosen])
            rate = RATE * (1 - step / steps)
            step += 1
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                scale = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                net[k] -= rate * (first[k] / (1 - 0.9**step)) / scale
    return net


class Runner:
    """Position scores of a trained network, for many sequences in step, in fixed buffers.

    A unit is a row, so that every elementwise step runs over contiguous sequences.
    """

    def __init__(self, net: dict, count: int = SEQUENCES_AT_ONCE, segment: int = SEGMENT):
        hidden = net["c_f"].shape[0]
        self.hidden, self.count = hidden, count
        # 1 / (1 + exp(-x)) and 2 / (1 + exp(-2 x)) - 1: the factors are folded into the weights
        sign = np.repeat(np.float32([-1, -2]), [2 * hidden, hidden])
        self.sides = [
            (np.ascontiguousarray((net[f"x_{s}"] * sign).T), np.ascontiguousarray(-net[f"u_{s}"].T), np.ascontiguousarray(-2 * net[f"c_{s}"].T))
            for s in "fb"
        ]
        self.out = np.ascontiguousarray(net["out"].T)
        self.bias = net["bias"][:, None]
        self.states = np.zeros((segment, 2 * hidden, count), np.float32)
        self.x = np.empty((3 * hidden, count), np.float32)
        self.g = np.empty((2 * hidden, count), np.float32)
        self.c = np.empty((hidden, count), np.float32)

    def _run(self, side: int, codes: np.ndarray) -> None:
        hidden, (table, gate, to_candidate) = self.hidden, self.sides[side]
        x, g, c = self.x, self.g, self.c
        x_gates, x_candidate = x[:2 * hidden], x[2 * hidden:]
        z, r = g[:hidden], g[hidden:]
        before = np.zeros_like(c)
        for t in range(len(codes) - 1, -1, -1) if side else range(len(codes)):
            np.take(table, codes[t], axis=1, out=x, mode="clip")
            np.matmul(gate, before, out=g)
            g += x_gates
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            r *= before
            np.matmul(to_candidate, r, out=c)
            c += x_candidate
            np.exp(c, out=c)
            c += 1
            np.divide(2, c, out=c)
            c -= 1
            c -= before
            c *= z
            after = self.states[t, side * hidden:(side + 1) * hidden]
            np.add(before, c, out=after)
            before = after

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Sum over the positions of log probabilities (language, sequence); codes (position, sequence)."""
        with np.errstate(over="ignore"):
            self._run(0, codes)
            self._run(1, codes)
        s = np.matmul(self.out, self.states)
        s += self.bias
        s -= s.max(1, keepdims=True)
        s -= np.log(np.exp(s).sum(1, keepdims=True))
        if (codes == _PAD).any():
            s *= (codes != _PAD)[:, None]
        return s.sum(0)


def probabilities(runner: Runner, texts: list[bytes]) -> np.ndarray:
    """Pooled language probabilities of every text (text, language)."""
    codes, owner = _segments(texts)
    total = np.zeros((len(texts), len(runner.bias)))
    for begin in range(0, len(owner), runner.count):
        part = codes[:, begin:begin + runner.count].astype(np.int64)
        size = part.shape[1]
        if size < runner.count:
            part = np.pad(part, ((0, 0), (0, runner.count - size)), constant_values=_PAD)
        np.add.at(total, owner[begin:begin + size], runner.scores(part).T[:size])
    mean = total / np.maximum([[len(t)] for t in texts], 1)
    p = np.exp(mean - mean.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "lang",
    per_language: int = PER_LANGUAGE, windows: int = WINDOWS,
) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Learn from rows where ``learn`` holds: the languages in order, and the network."""
    usable = docs.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).alias("text"),
    ).where(F.col("text").rlike(r"\p{L}"))
    # A language's rows are thinned by the hash of their ids to a few times the number wanted,
    # so that the ranking sees a bounded number of rows of each, however many there are.
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    counts = usable.groupBy("label").agg(F.count("*").alias("n")).collect()
    common = [F.when(F.col("label") == r["label"], 4 * per_language / r["n"]) for r in counts if r["n"] > 4 * per_language]
    if common:
        usable = usable.where(chance < F.coalesce(*common, F.lit(2.0)))
    by_hash = Window.partitionBy("label").orderBy(chance, "key")
    # Only segments travel: ``windows`` of them, evenly spread over the text.
    size = F.length("text")
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(windows - 1)),
        lambda w: F.substring(F.col("text"), (w * F.greatest(size - SEGMENT, F.lit(0)) / max(1, windows - 1)).cast("int") + 1, F.lit(SEGMENT)),
    )
    chosen = (
        usable.withColumn("text", spread)
        .withColumn("place", F.row_number().over(by_hash)).where(f"place <= {per_language}")
    )
    rows = [(r["label"], r["key"], r["text"]) for r in chosen.collect()]
    rows.sort(key=lambda r: (r[0], r[1]))
    languages = sorted({lang for lang, _, _ in rows})
    samples = [(part.encode()[:SEGMENT], languages.index(lang)) for lang, _, parts in rows for part in dict.fromkeys(parts) if part]
    return languages, train(samples, len(languages)) if samples else None


def language(languages: list[str], net: dict | None, text: str = "text") -> Column:
    """A struct of lang_pred and score for a column of texts."""
    names = np.array(languages, object)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        runner = None if net is None else Runner(net)
        for batch in batches:
            lang = np.full(len(batch), UNKNOWN, object)
            score = np.zeros(len(batch))
            bodies = [x if isinstance(x, str) else "" for x in batch]
            known = [i for i, body in enumerate(bodies) if net is not None and _LETTER.search(body)]
            at = 0
            while at < len(known):
                group, size = [], 0
                while at < len(known) and (not group or size < BYTES_AT_ONCE):
                    group.append(known[at])
                    size += len(bodies[known[at]])
                    at += 1
                p = probabilities(runner, [bodies[i].encode() for i in group])
                lang[group] = names[p.argmax(1)]
                score[group] = p.max(1)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return F.pandas_udf(run, "lang_pred string, score double")(F.col(text))


def predict(docs: DataFrame, languages: list[str], net: dict | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row."""
    found = docs.select(F.col(key), language(languages, net, text).alias("found"))
    return found.select(key, "found.lang_pred", "found.score")


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
