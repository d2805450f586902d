"""Secret scans: a character convolutional network over candidates and the text around them.

Candidates are the matches of three base patterns and every other long run of key characters that holds a digit. The
network (characters by class, one convolution, maximum and mean over places, one logistic unit) sees a candidate with
CONTEXT characters on each side, a long one in overlapping windows that cover it whole. It is trained with numpy on labelled findings, calibrated on held-back ones, and its
threshold is the largest that still finds RECALL of those. Base matches are always findings; the network adds others
(kind `model`) and gives every finding its score. Patterns and network run where the texts are read: the model is a few
thousand numbers, and nothing is shuffled.

Defined results: null text is empty and has no finding. Places are code points. Rows with the same doc_id, null too, are
scanned one by one. Of findings with one start the kind listed first stands first. Time is in proportion to the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, text_rows

# The base patterns of the contract, in the order of their kinds.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "model")

#: Other candidates: runs of key characters, 20 or more, with at least one digit.
OTHER = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_DIGIT = re.compile(r"[0-9]")
# Only texts with one of these can hold an assignment.
_SIGN = re.compile(r"[:=]")

CONTEXT = 16
WIDTH = 72
STRIDE = 20
FILTERS = 24
SPAN = 5
RECALL = 0.98
EXAMPLES = 3000
ROUNDS = 12

_CLASSES = "abcdefghijklmnopqrstuvwxyz"


def _class_of(char: str) -> int:
    """0 padding, 1-26 small letters, 27 capitals beyond F, 28 capitals A-F, 29 digits, then marks by group."""
    if "a" <= char <= "z":
        return 1 + ord(char) - 97
    if "A" <= char <= "Z":
        return 28 if char <= "F" else 27
    if "0" <= char <= "9":
        return 29
    for k, group in enumerate((" \t\n", "\"'`", "=:", "+/", "_-", ".,;", "@", "()[]{}<>")):
        if char in group:
            return 30 + k
    return 38


N_CLASSES = 39
_TABLE = np.array([_class_of(chr(c)) for c in range(256)], np.int8)


def windows(texts: list[str], spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers (windows x WIDTH) of the spans (text number, start, end), and where each span's windows begin.

    A span that fits has one window, with its context. A longer one is covered whole by windows STRIDE apart, the last
    of them at its end; what stands around a window is its context, inside the span or out of it."""
    inside = WIDTH - 2 * CONTEXT
    places, first = [], []
    for k, start, end in spans:
        first.append(len(places))
        if end - start <= inside:
            places.append((k, start, end))
        else:
            places += [(k, at, at + inside) for at in range(start, end - inside, STRIDE)]
            places.append((k, end - inside, end))
    out = np.zeros((len(places), WIDTH), np.int8)
    for row, (k, start, end) in zip(out, places, strict=True):
        piece = texts[k][max(0, start - CONTEXT) : start].rjust(CONTEXT, "\n") + texts[k][start : end + CONTEXT]
        codes = np.minimum(np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32), 255)
        row[: len(codes)] = _TABLE[codes]
    return out, np.array(first, np.int64)


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.kernel = rng.normal(0, 0.15, (SPAN, N_CLASSES, FILTERS))
        self.bias = np.zeros(FILTERS)
        self.out = rng.normal(0, 0.2, 2 * FILTERS)
        self.base = np.zeros(1)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rectified convolution (rows x places x filters). A one-hot input makes it a sum of looked-up rows."""
        places = WIDTH - SPAN + 1
        total = sum(self.kernel[j][x[:, j : j + places]] for j in range(SPAN)) + self.bias
        return np.maximum(total, 0), np.concatenate([np.maximum(total, 0).max(1), np.maximum(total, 0).mean(1)], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._hidden(part)[1] @ self.out + self.base for part in np.array_split(x, max(1, len(x) // 512))]) if len(x) else np.zeros(0)

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of spans: a span is as suspicious as its most suspicious window."""
        if not len(first):
            return np.zeros(0)
        return self._calibrated(np.maximum.reduceat(self.raw(x), first))

    def _calibrated(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        values = [self.kernel, self.bias, self.out, self.base]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        step = 0
        for _ in range(ROUNDS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 128):
                rows = order[at : at + 128]
                hidden, pooled = self._hidden(x[rows])
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.base, -30, 30)))
                error = (p - y[rows]) / len(rows)
                places = hidden.shape[1]
                into = np.repeat((error[:, None] * self.out[FILTERS:])[:, None, :] / places, places, 1)
                top = hidden.argmax(1)
                r, f = np.arange(len(rows))[:, None], np.arange(FILTERS)[None]
                into[r, top, f] += error[:, None] * self.out[:FILTERS]
                into *= hidden > 0
                kernel = np.zeros_like(self.kernel)
                for j in range(SPAN):
                    one_hot = np.eye(N_CLASSES)[x[rows][:, j : j + places].ravel()]
                    kernel[j] = one_hot.T @ into.reshape(-1, FILTERS)
                grads = [kernel + 1e-4 * self.kernel, into.sum((0, 1)), pooled.T @ error + 1e-4 * self.out, np.array([error.sum()])]
                step += 1
                for v, g, m, s in zip(values, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    v -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> None:
        """A logistic curve over held-back spans, then the largest threshold with the asked recall on them."""
        raw = np.maximum.reduceat(self.raw(x), first)
        scale, shift = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(scale * raw + shift, -30, 30)))
            scale -= 0.05 * (float(((p - y) * raw).mean()) + 1e-3 * scale)
            shift -= 0.05 * float((p - y).mean())
        self.scale, self.shift = scale, shift
        found = np.sort(self._calibrated(raw)[y == 1])
        self.threshold = float(found[int((1 - RECALL) * len(found))])


def labelled_findings(count: int = EXAMPLES, seed: int = 3) -> tuple[list[str], list[tuple[int, int, int]], np.ndarray]:
    """Made-up texts with one candidate each, and its label: keys in the ways programs write them, against identifiers,
    numbers, paths and long words in running text."""
    rng = np.random.default_rng(seed)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed_case = letters + letters.upper() + digits

    def some(alphabet: str, low: int, high: int) -> str:
        return "".join(alphabet[k] for k in rng.integers(0, len(alphabet), rng.integers(low, high)))

    def pick(*choices: str) -> str:
        return choices[rng.integers(0, len(choices))]

    def word() -> str:
        return some(letters, 2, 9)

    def prose() -> str:
        return " ".join(word() for _ in range(rng.integers(1, 5))) + pick(" ", ". ", ": ", ", ")

    texts, spans, labels = [], [], []
    for k in range(count):
        if k % 2:
            body = pick(some(mixed_case + "+/", 24, 48), some(mixed_case, 20, 44), some("0123456789abcdef", 32, 64), "AKIA" + some(letters.upper() + digits, 16, 17), "ghp_" + some(mixed_case, 36, 37), some(mixed_case + "_-", 24, 60), some(mixed_case + "+/", 30, 44) + "=")
            name = pick("key", "token", "secret", "auth", "client_secret", "credential", "pwd", "access_key", "signature", "bearer")
            before = pick(f'{name} = "', f"{name}: ", f"{name}=", f"{name.upper()}='", f'"{name}": "', f"Authorization: Bearer ", f"{prose()}{name} ", prose())
            after = pick('"', "'", "\n", " ", "") + prose()
        else:
            body = pick(
                some(digits, 20, 30),
                "-".join(word() for _ in range(5)) + some(digits, 1, 3),
                "/".join(word() for _ in range(5)) + some(digits, 1, 3),
                "_".join(word() for _ in range(4)) + "_" + some(digits, 1, 5),
                "".join(word() for _ in range(5)) + some(digits, 1, 2),
                f"{some(digits, 4, 5)}-{some(digits, 2, 3)}-{some(digits, 2, 3)}-{word()}-{word()}-{word()}",
                "".join(word().capitalize() for _ in range(5)) + some(digits, 1, 3),
            )
            before, after = pick(prose(), f"see {word()} ", "https://", f"{word()}/", "("), pick(" ", ".", ")", "\n") + prose()
        lead = prose() + before
        texts.append(lead + body + after)
        spans.append((k, len(lead), len(lead) + len(body)))
        labels.append(k % 2)
    return texts, spans, np.array(labels)


@lru_cache(maxsize=1)
def trained() -> Network:
    texts, spans, labels = labelled_findings()
    cut = len(spans) * 3 // 4
    x, first = windows(texts, spans[:cut])
    network = Network()
    network.fit(x, np.repeat(labels[:cut], np.diff(np.append(first, len(x)))))
    network.calibrate(*windows(texts, spans[cut:]), labels[cut:])
    return network


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost and non-overlapping in each kind."""
    found = []
    if _SIGN.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def other_candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of key characters that no base match touches. base is sorted; one pass over both lists."""
    found = []
    at, reach = 0, 0  # base matches begun before the end of this run, and how far those reach
    for m in OTHER.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start() and _DIGIT.search(m.group()):
            found.append((m.start(), m.end()))
    return found


_FINDING = "doc_id long, findings array<struct<kind:string,start:int,end:int,score:double>>"
_KIND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def scan_texts(texts: list[str], network: Network) -> list[list[dict]]:
    """The findings of each text, in order of start and kind."""
    spans: list[tuple[int, int, int]] = []
    kinds: list[int] = []
    for k, text in enumerate(texts):
        base = base_matches(text)
        for start, kind, end in base:
            spans.append((k, start, end))
            kinds.append(kind)
        for start, end in other_candidates(text, base):
            spans.append((k, start, end))
            kinds.append(3)
    scores = network.score(*windows(texts, spans))
    out: list[list[tuple]] = [[] for _ in texts]
    for (k, start, end), kind, score in zip(spans, kinds, scores.tolist(), strict=True):
        if kind < 3 or score >= network.threshold:
            out[k].append((start, kind, end, score))
    return [[{"kind": KINDS[kind], "start": s, "end": e, "score": score} for s, kind, e, score in sorted(found)] for found in out]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and findings (kind, start, end, score) of every row."""
    network = trained()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches):
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(scan_texts(texts, network), _KIND)], names=["doc_id", "findings"])

    return id_and_text(docs).mapInArrow(rows, _FINDING)
