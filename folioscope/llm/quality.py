"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is labelled good or bad from features of itself and of the lines before and after it. Forward-backward
marginals, weighted by line length, add up to the document's share of bad text, which a logistic curve turns into a
score.

Fitting. A bounded sample, about SAMPLE labelled documents of each class from the training folds, chosen by a hash of
doc_id, with their whole texts. Three quarters of it fit the field: weights and transitions climb one objective, the mean
over documents of log p(line labels | lines) / lines, less a quadratic penalty. Lines of a good document are good. Those
of a bad one are bad at first; a first fit then tells which of them look good all the same, and the second fit, which
counts, has those as good: so bad documents hold changes of label, from which the transitions learn. The other quarter
fits the curve.

Defined results: null text is one empty line and gets a score like any text. Labels other than 0 and 1 are left out.
Without labels of both classes every score is the share of label 1 (1.0 if there is no label). A doc_id labelled twice
counts once, with its worse label. Rows with the same doc_id, null too, are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, id_and_text, text_rows

SAMPLE = 1500
ROUNDS = 150
PENALTY = 1e-4

# Characters that prose uses, and marks that it seldom uses.
_PROSE_MARKS = ".,;:'\"!?()-"
_ODD_MARKS = "#$%&*@^_~|<>{}[]\\/+="

_KINDS = ("letter", "upper", "digit", "blank", "prose", "odd", "pipe", "shout")


def _class_table() -> np.ndarray:
    """Bits of _KINDS for each code point below 0x3000 (higher ones count as letters)."""
    table = np.zeros(0x3001, np.uint8)
    for code in range(0x3000):
        char = chr(code)
        bits = char.isalpha() | char.isupper() << 1 | char.isdigit() << 2 | char.isspace() << 3
        bits |= (char in _PROSE_MARKS) << 4 | (char in _ODD_MARKS) << 5 | (char == "|") << 6 | (char == "!") << 7
        table[code] = bits
    table[0x3000] = 1
    return table


_TABLE: list[np.ndarray] = []


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of features for each line, lines per text, and the length of each line."""
    if not _TABLE:
        _TABLE.append(_class_table())
    lines = [t.split("\n") for t in texts]
    per_text = np.array([len(x) for x in lines])
    repeated, variety = [], []
    for held in lines:
        seen: set[str] = set()
        for line in held:
            repeated.append(line in seen and bool(line))
            seen.add(line)
            words = line.split(" ")
            variety.append(len(set(words)) / len(words))
    flat = np.frombuffer("\n".join("\n".join(x) for x in lines).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", np.uint32)
    kinds = _TABLE[0][np.minimum(flat, 0x3000)]
    ends = np.flatnonzero(flat == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    counts = np.stack([np.add.reduceat((kinds >> k & 1).astype(np.int64), starts) for k in range(len(_KINDS))], 1)
    counts[:, 3] -= 1  # the line's end is a blank
    size = np.maximum(length, 1)[:, None]
    share = counts / size
    words = counts[:, 3] + 1
    per_word = counts[:, 0] / words
    steps = [
        np.log1p(length) / 8,
        *(share[:, k] for k in range(len(_KINDS))),
        *(counts[:, k] / words for k in (5, 6, 7)),
        counts[:, 1] / np.maximum(counts[:, 0], 1),
        (counts[:, 1] > 0.6 * np.maximum(counts[:, 0], 1)),
        np.minimum(per_word, 20) / 10,
        per_word > 6,
        per_word < 2.5,
        np.array(repeated),
        np.array(variety),
        np.array(variety) < 0.5,
        length == 0,
        length < 20,
        counts[:, 5] / words > 0.3,
        counts[:, 6] / words > 0.2,
        counts[:, 7] / words > 0.3,
    ]
    return np.stack([np.asarray(s, np.float32) for s in steps], 1), per_text, length


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """A line's features, those of the line before and after it (zeros at the ends of a text), and a one."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    ends = np.cumsum(per_text)
    before[ends - per_text] = 0
    after[ends - 1] = 0
    return np.concatenate([features, before, after, np.ones((len(features), 1), np.float32)], 1)


def marginals(emission: np.ndarray, transition: np.ndarray, per_text: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: P(bad) of each line, expected transitions, and log normalisers.

    emission: log potentials (lines x 2); transition: 2 x 2 log potentials; weight: of each chain's transitions.
    """
    weight = np.ones(len(per_text)) if weight is None else weight
    order = np.argsort(-per_text, kind="stable")
    sizes, weight = per_text[order], weight[order]
    first = (np.cumsum(per_text) - per_text)[order]
    longest = int(sizes[0])
    alive = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(longest + 1)]  # chains longer than t
    alpha = np.empty_like(emission)
    weights = np.exp(transition)
    z = np.zeros(len(per_text))
    at = first
    top = emission[at].max(1)
    now = np.exp(emission[at] - top[:, None])
    norm = now.sum(1)
    now /= norm[:, None]
    z += np.log(norm) + top
    alpha[at] = now
    for t in range(1, longest):
        n = alive[t]
        at = first[:n] + t
        top = emission[at].max(1)
        now = (now[:n] @ weights) * np.exp(emission[at] - top[:, None])
        norm = now.sum(1)
        now /= norm[:, None]
        z[:n] += np.log(norm) + top
        alpha[at] = now
    bad = np.empty(len(emission))
    pairs = np.zeros((2, 2))
    beta = np.ones((len(per_text), 2))
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        both = alpha[at] * beta[:n]
        bad[at] = both[:, 1] / both.sum(1)
        if t:
            e = emission[at]
            right = np.exp(e - e.max(1, keepdims=True)) * beta[:n]
            joint = alpha[at - 1][:, :, None] * weights[None] * right[:, None, :]
            pairs += (joint * (weight[:n] / joint.sum((1, 2)))[:, None, None]).sum(0)
            left = right @ weights.T
            beta[:n] = left / left.sum(1, keepdims=True)
    unsorted = np.empty_like(z)
    unsorted[order] = z
    return bad, pairs, unsorted


def objective(x: np.ndarray, per_text: np.ndarray, truth: np.ndarray, w: np.ndarray, transition: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean over documents of log p(truth | lines) / lines, less the penalty, and its gradients.
    truth: 1 for a bad line."""
    emission = np.stack([np.zeros(len(x)), x @ w], 1)
    weight = 1 / (per_text * len(per_text))
    bad, pairs, z = marginals(emission, transition, per_text, weight)
    each = np.repeat(weight, per_text)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(per_text) - 1] = False
    inner = np.flatnonzero(inner)  # lines that another line of their text follows
    steps = np.zeros((2, 2))
    np.add.at(steps, (truth[inner], truth[inner + 1]), each[inner])
    value = (each * emission[:, 1] * truth).sum() + (steps * transition).sum() - weight @ z
    value -= PENALTY / 2 * ((w**2).sum() + (transition**2).sum())
    return float(value), x.T @ ((truth - bad) * each) - PENALTY * w, steps - pairs - PENALTY * transition


def climb(x: np.ndarray, per_text: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the bad label and transition potentials that climb the objective (Adam steps)."""
    values = [np.zeros(x.shape[1]), np.zeros((2, 2))]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, ROUNDS + 1):
        _, *grads = objective(x, per_text, truth, *values)
        for value, grad, m, v in zip(values, grads, first, second, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return values[0], values[1]


def line_labels(x: np.ndarray, per_text: np.ndarray, labels: np.ndarray, w: np.ndarray) -> np.ndarray:
    """1 for the lines of bad documents that look bad on their own by the first fit; all of them where none does."""
    bad_document = np.repeat(1 - labels, per_text)
    looks = ((x @ w >= 0) & (bad_document == 1)).astype(np.int64)
    some = np.add.reduceat(looks, np.cumsum(per_text) - per_text) > 0
    return np.where(np.repeat(some, per_text), looks, bad_document)


def fit(features: np.ndarray, per_text: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The field's weights and transitions. labels: 1 for a good document."""
    x = with_neighbours(features, per_text).astype(np.float64)
    w, _ = climb(x, per_text, np.repeat(1 - labels, per_text))
    return climb(x, per_text, line_labels(x, per_text, labels, w))


def bad_share(features: np.ndarray, per_text: np.ndarray, length: np.ndarray, w: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Length-weighted mean of P(bad) for each document."""
    x = with_neighbours(features, per_text)
    bad, _, _ = marginals(np.stack([np.zeros(len(x)), x @ w], 1), transition, per_text)
    starts = np.cumsum(per_text) - per_text
    weight = length + 1.0
    return np.add.reduceat(bad * weight, starts) / np.add.reduceat(weight, starts)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _curve(x: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one variable, by Newton steps."""
    a, b = 0.0, 0.0
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        grad = design.T @ (weight * (labels - p)) - np.array([1e-3 * a, 0])
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess, grad)
        a, b = a + step[0], b + step[1]
    return float(a), float(b)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, marks = batch.column("quality").to_pylist(), batch.column("held").to_pylist()
        at = 0
        for ids, texts in text_rows([batch]):
            rows = []
            for text in texts:
                features, _, length = line_features([text])
                rows.append(np.concatenate([features, length[:, None]], 1).astype("<f4").tobytes())
            part = slice(at, at + len(ids))
            yield pa.record_batch([pa.array(labels[part], pa.int32()), pa.array(marks[part], pa.bool_()), pa.array(rows, pa.binary())], names=["quality", "held", "lines"])
            at += len(ids)


def train(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> dict:
    """The fitted model. Its sample is bounded by SAMPLE; the sampled texts are whole."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    known = known.where(crc_mod(F.col("doc_id"), folds) != held)
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    if set(sizes) != {0, 1}:
        return {"constant": 1.0 if 1 in sizes or not sizes else 0.0}
    share = F.when(F.col("quality") == 0, min(1.0, SAMPLE / sizes[0])).otherwise(min(1.0, SAMPLE / sizes[1]))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    sample = sample.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0)
    found = id_and_text(docs).join(F.broadcast(sample), "doc_id").mapInArrow(_pack, "quality int, held boolean, lines binary").toArrow()  # about 2 * SAMPLE rows
    truth, held_back = np.array(found.column("quality").to_pylist()), np.array(found.column("held").to_pylist(), bool)
    if len(set(truth.tolist())) < 2:
        return {"constant": sizes[1] / sum(sizes.values())}
    columns = line_features([""])[0].shape[1] + 1
    rows = [np.frombuffer(b, "<f4").reshape(-1, columns) for b in found.column("lines").to_pylist()]
    if len(set(truth[held_back].tolist())) < 2 or len(set(truth[~held_back].tolist())) < 2:
        held_back = np.zeros(len(truth), bool)  # too few for a held-back part of both classes
    own, later = np.flatnonzero(~held_back), np.flatnonzero(held_back)
    features, per_text, _ = _joined(rows, own)
    w, transition = fit(features, per_text, truth[own])
    later = later if len(later) else own
    x = -_logit(bad_share(*_joined(rows, later), w, transition))
    weight = np.array([sizes[int(t)] / max(1, (truth[later] == t).sum()) for t in truth[later]])
    a, b = _curve(x, truth[later], weight / weight.mean())
    return {"w": w, "transition": transition, "a": a, "b": b}


def _joined(rows: list[np.ndarray], which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, lines per text and line lengths of some of the sampled documents."""
    flat = np.concatenate([rows[k] for k in which.tolist()])
    return flat[:, :-1], np.array([len(rows[k]) for k in which.tolist()]), flat[:, -1]


def predict(texts: list[str], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    features, per_text, length = line_features(texts)
    x = -_logit(bad_share(features, per_text, length, model["w"], model["transition"]))
    return 1 / (1 + np.exp(-np.clip(model["a"] * x + model["b"], -30, 30)))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, kept: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = train(docs, labels, folds, held)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches, 2_000_000):
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(predict(texts, model), pa.float64())], names=["doc_id", "score"])

    found = id_and_text(docs).mapInArrow(score, "doc_id long, score double")
    return found.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score of at least 0.5, with all their columns, scored where they are read."""
    model = train(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.record_batch([pa.array(range(batch.num_rows), pa.int64()), pa.array(["" if t is None else t for t in batch.column("text").to_pylist()])], names=["doc_id", "text"])
            good = np.concatenate([predict(texts, model) for _, texts in text_rows([plain], 2_000_000)] or [np.zeros(0)])
            yield batch.filter(pa.array(good >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
