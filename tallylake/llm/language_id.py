"""Language identification with a byte convolutional network, trained in numpy.

Bytes (A-Z in lower case) are embedded; filters of several widths slide over windows of a
fixed length; each filter's maximum in the window goes to a softmax over the languages. A
text's windows cover it from end to end, and its prediction is the mean of theirs, by the
bytes they hold. For applying it, embedding and filters are multiplied into one table per
filter tap, so a window costs a lookup per byte and tap.

The network is fitted on a bounded sample of the labelled training rows, ``sample_docs``
divided over the languages, ``sample_windows`` windows of each text at most, evenly spaced
over it. The sample is drawn by a hash of the id and doesn't depend on partitions.

Defined cases: a NULL text or one without a letter is ``und`` with score 0, as is everything
when no row is labelled; a NULL id counts as an empty one where rows are divided; repeated
rows are predicted each; an empty table gives an empty result; columns besides id, text and
label aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 256
WIDTHS = (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1  #: Neighbours share bytes, so no run of bytes is cut.
#: Windows in work at a time.
BATCH = 128

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class Network:
    labels: list[str]
    embed: np.ndarray  #: 256 x dimensions
    taps: np.ndarray  #: widest filter x dimensions x filters; zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray  #: filters x labels
    shift: np.ndarray

    def tables(self) -> np.ndarray:
        return np.einsum("bd,tdf->tbf", self.embed, self.taps).astype(np.float32)

    def pooled(self, windows: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's maximum over each window, and where it is."""
        total = tables[0][windows[:, :STRIDE]]
        for t in range(1, len(tables)):
            total += tables[t][windows[:, t : t + STRIDE]]
        at = total.argmax(1)
        return np.take_along_axis(total, at[:, None], 1)[:, 0] + self.bias, at

    def chances(self, windows: np.ndarray, tables: np.ndarray) -> np.ndarray:
        total = tables[0][windows[:, :STRIDE]]
        for t in range(1, len(tables)):
            total += tables[t][windows[:, t : t + STRIDE]]
        return softmax(np.maximum(total.max(1) + self.bias, 0) @ self.out + self.shift)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """Starts of the windows that cover a text."""
    return np.arange(max(1, -(-(len(text) - (WINDOW - STRIDE)) // STRIDE))) * STRIDE


def train(labels: list[str], windows: np.ndarray, answers: np.ndarray, epochs: int = 12, filters: int = 8, dimensions: int = 8, rate: float = 0.01, seed: int = 1) -> Network:
    """Fit by Adam on cross-entropy; every language weighs the same."""
    rng = np.random.default_rng(seed)
    wide, n = max(WIDTHS), filters * len(WIDTHS)
    within = np.repeat(WIDTHS, filters)[None, :] > np.arange(wide)[:, None]
    net = Network(
        labels,
        rng.normal(0, 0.5, (256, dimensions)),
        rng.normal(0, 0.5, (wide, dimensions, n)) * within[:, None],
        np.zeros(n),
        rng.normal(0, 0.3, (n, len(labels))),
        np.zeros(len(labels)),
    )
    weight = len(answers) / (len(labels) * np.maximum(np.bincount(answers, minlength=len(labels)), 1))
    names = ("embed", "taps", "bias", "out", "shift")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(answers))
        for k in range(0, len(order), 64):
            rows = order[k : k + 64]
            own, wanted = windows[rows], answers[rows]
            raw, at = net.pooled(own, net.tables())
            hidden = np.maximum(raw, 0)
            error = softmax(hidden @ net.out + net.shift)
            error[np.arange(len(rows)), wanted] -= 1
            error *= weight[wanted][:, None] / len(rows)
            back = (error @ net.out.T) * (raw > 0)
            grad = {"out": hidden.T @ error, "shift": error.sum(0), "bias": back.sum(0), "embed": np.zeros_like(net.embed), "taps": np.zeros_like(net.taps)}
            for t in range(wide):  # only the bytes under the maxima matter
                by_byte = np.zeros((256, n))
                np.add.at(by_byte, (own[np.arange(len(rows))[:, None], at + t], np.arange(n)[None, :]), back)
                grad["embed"] += by_byte @ net.taps[t].T
                grad["taps"][t] = net.embed.T @ by_byte * within[t]
            step += 1
            pace = rate * 0.5 * (1 + np.cos(np.pi * (epoch + k / len(order)) / epochs))
            for name in names:
                first[name] = 0.9 * first[name] + 0.1 * grad[name]
                second[name] = 0.999 * second[name] + 0.001 * grad[name] ** 2
                scaled = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - pace * scaled)
    for name in names:
        setattr(net, name, getattr(net, name).astype(np.float32))
    return net


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _sample(windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = windows_of(text)
                for k in sorted({int(x) for x in np.linspace(0, len(starts) - 1, min(windows, len(starts)))}):
                    part = text[starts[k] : starts[k] + WINDOW].translate(_FOLD)
                    rows.append({"key": key, "label": label, "part": part.ljust(WINDOW, b"\0")})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.int64()), ("label", pa.string()), ("part", pa.binary())]))

    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_docs: int = 2000, sample_windows: int = 4, **options) -> Network | None:
    """A network from about ``sample_docs`` of the rows that have a label and a text with a letter; None if there are none."""
    rows = docs.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("key"), F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("binary").alias("text")
    ).filter(F.col("label").isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row per language
    if not counts:
        return None
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, sample_docs / len(counts) / n)).otherwise(share)
    drawn = rows.filter(F.pmod("key", F.lit(1_000_003)) < share * 1_000_003)
    taken = drawn.mapInArrow(_sample(sample_windows), "key long, label string, part binary").collect()
    taken = sorted((r["label"], r["key"], bytes(r["part"])) for r in taken)
    labels = sorted({label for label, _, _ in taken})
    if not labels:
        return None
    windows = np.frombuffer(b"".join(p for _, _, p in taken), np.uint8).reshape(-1, WINDOW)
    return train(labels, windows, np.array([labels.index(label) for label, _, _ in taken]), **options)


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text.decode())


def scores(net: Network, texts: list[bytes], tables: np.ndarray | None = None) -> np.ndarray:
    """A row of chances per text, the mean over its windows by the bytes they add."""
    tables = net.tables() if tables is None else tables
    spans = np.arange(WINDOW)
    starts, weights, parts, at = [], [], [], 0
    for text in texts:
        own = windows_of(text)
        size = int(own[-1]) + WINDOW
        parts.append(text.translate(_FOLD).ljust(size, b"\0"))
        starts.append(own + at)
        weights.append(np.minimum(np.maximum(len(text) - own, 1), STRIDE))
        at += size
    data = np.frombuffer(b"".join(parts), np.uint8)
    first = np.cumsum([0, *(len(s) for s in starts)])[:-1]
    starts, weights = np.concatenate(starts), np.concatenate(weights)
    found = np.empty((len(starts), len(net.labels)))
    for k in range(0, len(starts), BATCH):
        found[k : k + BATCH] = net.chances(data[starts[k : k + BATCH, None] + spans], tables)
    return np.add.reduceat(found * weights[:, None], first) / np.add.reduceat(weights, first)[:, None]


def _predict(broadcast, block_bytes: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = broadcast.value
        tables = net and net.tables()
        for batch in batches:
            label, score, block, held = ["und"] * batch.num_rows, np.zeros(batch.num_rows), [], 0

            def judge(block):
                if block:
                    found = scores(net, [t for _, t in block], tables)
                    for (row, _), own in zip(block, found, strict=True):
                        label[row], score[row] = net.labels[int(own.argmax())], min(1.0, float(own.max()))

            for row, value in enumerate(batch.column(1)):
                text = value.as_py()
                if net is None or text is None or not has_letter(text):
                    continue
                block.append((row, text))
                held += len(text)
                if held >= block_bytes:
                    judge(block)
                    block, held = [], 0
            judge(block)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label), pa.array(score)], ["id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` of every row, from its whole text alone."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_predict(model), schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> DataFrame:
    """Fit on the rows that aren't held out, and predict all."""
    net = fit(docs.filter(~held_out(F.col(id_col))), id_col, text_col, label_col, **options)
    found = predict(docs, net, id_col, text_col)
    return found.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
