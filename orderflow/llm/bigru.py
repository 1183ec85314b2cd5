"""Language identification by a bidirectional gated recurrent network.

The network reads bytes.  One gated recurrent layer runs forward, one
backward over a window of ``WINDOW`` bytes; from both states at a position a
softmax layer labels that position.  A document is cut into windows over its
whole text, every byte is labelled once, and the mean of the positions'
probabilities is the document's.

It is trained in numpy by backpropagation through time with Adam, on a
bounded sample of labelled documents: ``TEXTS`` distinct texts of each
language, of each at most ``WINDOWS`` windows spread over the whole text.
Documents are then predicted where they lie, without a shuffle.

All arrays are (units, windows), so that the gates of a layer are contiguous
rows and a step over many windows is one small matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import keyed

#: Bytes that a layer reads from one zero state.
WINDOW = 128
#: Units of each direction.
UNITS = 8
#: The training sample: distinct texts of a language, windows of a text, bytes of a window.
TEXTS, WINDOWS, TRAIN_WINDOW = 384, 8, 64
EPOCHS, MINIBATCH, RATE, SEED = 4, 128, 0.01, 13
#: Languages that may be learned.
MOST_LANGUAGES = 1024
#: Windows that are run at a time.
AT_ONCE = 2048
#: Language of texts without a letter, and where no language was learned.
UNDETERMINED = "und"
PAD = 0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _new_layer(rng: np.random.Generator, units: int) -> dict[str, np.ndarray]:
    scale = 1 / np.sqrt(units)
    return {"inputs": rng.normal(0, 0.3, (3 * units, 256)).astype(np.float32),  # a column a byte
            "gates": rng.uniform(-scale, scale, (2 * units, units)).astype(np.float32),
            "new": rng.uniform(-scale, scale, (units, units)).astype(np.float32)}


def _run_layer(layer: dict, x: np.ndarray, keep: bool = False):
    """States (steps, units, windows) of a layer over bytes (steps, windows);
    ``keep``: also what backpropagation needs."""
    steps, n = x.shape
    units = len(layer["new"])
    states = np.empty((steps, units, n), np.float32)
    kept = []
    h = np.zeros((units, n), np.float32)
    for t in range(steps):
        given = np.take(layer["inputs"], x[t], axis=1)
        gates = layer["gates"] @ h
        gates += given[:2 * units]
        _sigmoid(gates)
        update, reset = gates[:units], gates[units:]
        back = layer["new"] @ h
        new = reset * back
        new += given[2 * units:]
        np.tanh(new, out=new)
        if keep:
            kept.append((h, gates, back, new))
        # h = new + update * (h - new)
        state = states[t]
        np.subtract(h, new, out=state)
        state *= update
        state += new
        h = state
    return (states, kept) if keep else states


def _back_through_time(layer: dict, x: np.ndarray, kept: list, d_states: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of a layer, given those of its states."""
    units, n = d_states.shape[1:]
    grad = {k: np.zeros_like(v) for k, v in layer.items()}
    d_given = np.empty((len(x), 3 * units, n), np.float32)
    d_h = np.zeros((units, n), np.float32)
    for t in range(len(x) - 1, -1, -1):
        before, gates, back, new = kept[t]
        update, reset = gates[:units], gates[units:]
        d_h += d_states[t]
        d_new = d_h * (1 - update) * (1 - new * new)
        d_gates = np.concatenate([d_h * (before - new), d_new * back])
        d_gates *= gates * (1 - gates)
        d_back = d_new * reset
        d_given[t, :2 * units], d_given[t, 2 * units:] = d_gates, d_new
        grad["gates"] += d_gates @ before.T
        grad["new"] += d_back @ before.T
        d_h = d_h * update + layer["gates"].T @ d_gates + layer["new"].T @ d_back
    order = np.argsort(x.ravel(), kind="stable")
    found, first = np.unique(x.ravel()[order], return_index=True)
    grad["inputs"][:, found] = np.add.reduceat(d_given.transpose(1, 0, 2).reshape(3 * units, -1)[:, order], first, axis=1)
    return grad


@dataclass
class BiGru:
    """A trained network; ``languages`` in the order of its outputs."""

    languages: list[str]
    forward: dict[str, np.ndarray]
    backward: dict[str, np.ndarray]
    out: dict[str, np.ndarray]

    @classmethod
    def new(cls, languages: list[str], units: int = UNITS, seed: int = SEED) -> "BiGru":
        rng = np.random.default_rng(seed)
        out = {"weights": rng.normal(0, 0.1, (len(languages), 2 * units)).astype(np.float32),
               "bias": np.zeros((len(languages), 1), np.float32)}
        return cls(languages, _new_layer(rng, units), _new_layer(rng, units), out)

    def _probabilities(self, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """(steps, languages, windows) of states of both directions."""
        units = ahead.shape[1]
        p = np.matmul(self.out["weights"][:, :units], ahead)
        p += np.matmul(self.out["weights"][:, units:], behind)
        p += self.out["bias"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each position of bytes (steps, windows)."""
        return self._probabilities(_run_layer(self.forward, x), _run_layer(self.backward, x[::-1])[::-1])

    def loss_and_gradients(self, x: np.ndarray, wanted: np.ndarray):
        """Mean cross entropy over the positions that are not padding, and
        the gradients.  ``wanted``: each window's language."""
        ahead, kept_ahead = _run_layer(self.forward, x, keep=True)
        behind, kept_behind = _run_layer(self.backward, x[::-1], keep=True)
        p = self._probabilities(ahead, behind[::-1])
        counts = (x != PAD).astype(np.float32)
        counts /= max(1, counts.sum())
        windows = np.arange(x.shape[1])
        loss = -float((np.log(np.maximum(p[:, wanted, windows], 1e-9)) * counts).sum())
        p[:, wanted, windows] -= 1
        p *= counts[:, None, :]
        units = ahead.shape[1]
        weights = self.out["weights"]
        grad_out = {"weights": np.concatenate([np.einsum("tln,tun->lu", p, s, optimize=True) for s in (ahead, behind[::-1])], axis=1),
                    "bias": p.sum(axis=(0, 2))[:, None]}
        d_ahead = np.matmul(weights[:, :units].T, p)
        d_behind = np.matmul(weights[:, units:].T, p)[::-1]
        return loss, (_back_through_time(self.forward, x, kept_ahead, d_ahead),
                      _back_through_time(self.backward, x[::-1], kept_behind, d_behind), grad_out)

    def fit(self, x: np.ndarray, wanted: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> "BiGru":
        """Adam over shuffled minibatches of windows (a column each); every
        language has the same weight, by repeating windows of rarer ones."""
        rng = np.random.default_rng(seed)
        parts = (self.forward, self.backward, self.out)
        first = [{k: np.zeros_like(v) for k, v in p.items()} for p in parts]
        second = [{k: np.zeros_like(v) for k, v in p.items()} for p in parts]
        of = [np.flatnonzero(wanted == i) for i in range(len(self.languages))]
        most, step = max(map(len, of)), 0
        for epoch in range(epochs):
            order = np.concatenate([rng.permutation(np.resize(rng.permutation(o), most)) for o in of])
            rng.shuffle(order)
            for at in range(0, len(order), MINIBATCH):
                some = order[at:at + MINIBATCH]
                _, grads = self.loss_and_gradients(x[:, some], wanted[some])
                size = np.sqrt(sum(float((g * g).sum()) for grad in grads for g in grad.values()))
                step += 1
                scale = min(1, 1 / max(size, 1e-9))  # gradients longer than 1 are shortened
                now = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for p, m, v, grad in zip(parts, first, second, grads):
                    for k, g in grad.items():
                        g *= scale
                        m[k] += 0.1 * (g - m[k])
                        v[k] += 0.001 * (g * g - v[k])
                        p[k] -= (now * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, data: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """Mean probabilities (texts, languages) of texts that lie in ``data``
        between ``bounds``; all positions count; no bytes give equal ones."""
        lengths = np.diff(bounds)
        n_windows = -(-lengths // window)
        text = np.repeat(np.arange(len(lengths)), n_windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        starts = bounds[:-1][text] + nth * window
        sizes = np.minimum(window, bounds[1:][text] - starts)
        sums = np.zeros((len(lengths), len(self.languages)))
        step = np.arange(window)[:, None]
        order = np.argsort(-sizes, kind="stable")  # windows of alike sizes together
        for at in range(0, len(order), AT_ONCE):
            some = order[at:at + AT_ONCE]
            inside = step[:int(sizes[some[0]])] < sizes[some]
            x = np.where(inside, data[np.where(inside, starts[some] + step[:len(inside)], 0)], PAD)
            p = self.label(x)
            p *= inside[:, None, :]
            np.add.at(sums, text[some], p.sum(axis=0).T)
        return np.where(lengths[:, None] > 0, sums / np.maximum(lengths, 1)[:, None], 1 / max(1, len(self.languages)))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_windows(df: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     texts: int = TEXTS, windows: int = WINDOWS, size: int = TRAIN_WINDOW) -> DataFrame:
    """(lang, bytes): windows of at most ``texts`` distinct texts of each
    language, of those rows of ``df`` for which ``learned`` holds.

    A text is drawn by its hash, so the sample does not depend on the order of
    the rows; a share is drawn in all tasks first, so that no language's texts
    meet in one place.
    """
    rows = df.where(F.coalesce(learned, F.lit(False)) & F.col(lang_col).isNotNull() & has_letter(F.col(text_col)))
    rows = keyed(rows, lang=lang_col, text=text_col).withColumn("lang", F.col("lang").cast("string"))
    rows = rows.withColumn("rank", F.xxhash64("text"))
    share = rows.groupBy("lang").agg((F.lit(2.0 * texts + 64) / F.approx_count_distinct("rank")).alias("share")) \
        .limit(MOST_LANGUAGES + 1).collect()
    if len(share) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the network has an output for each")
    share = df.sparkSession.createDataFrame(share, "lang string, share double")
    drawn = rows.join(F.broadcast(share), "lang").where(F.pmod("rank", F.lit(1 << 31)) < F.col("share") * (1 << 31))
    drawn = drawn.groupBy("lang", "rank").agg(F.first("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))
    drawn = drawn.withColumn("nth", nth).where(F.col("nth") <= texts).select("lang", F.encode("text", "UTF-8").alias("bytes"))
    n = F.octet_length("bytes")
    count = F.least(F.lit(windows), F.ceil(n / F.lit(size)))
    start = F.floor(F.col("i") * F.greatest(n - size, F.lit(0)) / F.greatest(F.col("count") - 1, F.lit(1)))
    return drawn.withColumn("count", count).withColumn("i", F.explode(F.sequence(F.lit(0), (count - 1).cast("int")))) \
        .select("lang", F.substring("bytes", (start + 1).cast("int"), F.lit(size)).alias("bytes"))


def train(df: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> BiGru:
    """The network, trained on the driver on the bounded sample (at most
    TEXTS * WINDOWS * TRAIN_WINDOW bytes a language).  Without any learned
    row it has no languages."""
    rows = sorted((r.lang, bytes(r.bytes)) for r in training_windows(df, learned, id_col, text_col, lang_col).collect())
    languages = sorted({lang for lang, _ in rows})
    net = BiGru.new(languages)
    if len(languages) < 2:
        return net
    x = np.full((TRAIN_WINDOW, len(rows)), PAD, np.uint8)
    for i, (_, data) in enumerate(rows):
        x[:len(data), i] = np.frombuffer(data, np.uint8)
    return net.fit(x, np.array([languages.index(lang) for lang, _ in rows]))


def identify(df: DataFrame, net: BiGru, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score) for every row: the language with the highest mean
    probability over all bytes of the whole text, and that probability.

    Texts that are null or have no letter are ``und`` with score 0, and so is
    every text if the network knows no language.  Repeated rows come back as
    often as they came; an empty table gives no rows; other columns are not
    read, whatever their names.
    """
    rows = keyed(df, id=id_col, text=text_col).withColumn("letters", has_letter(F.col("text")))
    languages = net.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = np.full(b.num_rows, UNDETERMINED, object), np.zeros(b.num_rows)
            letters = np.asarray(b.column("letters").to_numpy(zero_copy_only=False), bool)
            if languages and letters.any():
                texts = b.column("text").filter(pa.array(letters)).cast(pa.large_binary())
                _, offsets, data = texts.buffers()
                bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
                p = net.pooled(np.frombuffer(data, np.uint8), bounds)
                best = p.argmax(axis=1)
                lang[letters] = np.array(languages, object)[best]
                score[letters] = p[np.arange(len(best)), best]
            yield pa.record_batch([b.column("id"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))], names=["id", "lang", "score"])

    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, lang string, score double")
