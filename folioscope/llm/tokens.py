"""Token ids of whole texts by a public tokenizer, each distinct word encoded once.

Neither vocabulary here has a token that reaches over a space between two visible characters, so the ids of a text are
the ids of its space-separated words one after another. Texts for which that is not plain go to the tokenizer whole.
"""

from __future__ import annotations

import os
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: A space next to other white space, or at an end: there a byte-level vocabulary may join spaces.
_JOINED_SPACES = rf"\x20{_SPACE}|{_SPACE}\x20|^\x20|\x20$"
_LATIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"
_LARGE = partial(pa.scalar, type=pa.large_string())
_MARKS = ".,;:!?|#%&*$"


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places starts[0], starts[0] + 1, ... of runs of these sizes, one run after another."""
    total = int(sizes.sum())
    kind = np.int32 if total + int(starts.max(initial=0)) < 1 << 31 else np.int64  # the narrower is much faster
    return np.arange(total, dtype=kind) + np.repeat((starts - (np.cumsum(sizes) - sizes)).astype(kind), sizes)


class Encoder:
    """path: a tokenizer file. spaces: whether words keep the space before them (byte-level vocabularies)."""

    def __init__(self, path: str, most: int = 750_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.spaces = bool(self.tokenizer.encode("a a", add_special_tokens=False).ids != self.tokenizer.encode("a", add_special_tokens=False).ids * 2)
        self.mark = "\n" if self.spaces else " |"
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.most = most
        #: Known words and where their ids are. The word "" has none: it is a text without words, or stands between
        #: spaces that are dropped.
        self.words = pa.array([""], pa.large_string())
        self.sizes, self.flat = np.zeros(1, np.int64), np.zeros(0, self.kind)
        self.used = np.zeros(0, np.int64)  # words of the last run

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _latin(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of Latin letters, one after another, and how many each has. They are encoded as one text with a
        mark between them that is always one token of its own, and parted at the mark."""
        flat, sizes = [], []
        for at in range(0, len(words), 4000):
            part = words[at : at + 4000]
            text = "".join(f" {w}{self.mark}" for w in part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(ids == self.mark_id)
            if len(ends) != len(part):
                raise ValueError("the tokenizer joins words with the mark")
            sizes.append(np.diff(ends, prepend=-1) - 1)
            flat.append(ids[ids != self.mark_id])
        return _joined(flat, self.kind), _joined(sizes, np.int64)

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._plain([w[1:] if w[:1] == "\n" else f" {w}" for w in words] if self.spaces else words)
        return _joined(found, self.kind), np.array([len(x) for x in found], np.int64)

    def _rows(self, asked: pa.Array, latin: np.ndarray) -> np.ndarray:
        """The numbers of words in the table of known ones; new ones are encoded and added. When the table is full it
        shrinks to the words of the last run."""
        if len(self.words) > self.most:
            keep = np.unique(np.append(self.used, 0))
            starts = np.cumsum(self.sizes) - self.sizes
            self.flat = self.flat[_spread(starts[keep], self.sizes[keep])]
            self.words, self.sizes = self.words.take(pa.array(keep)), self.sizes[keep]
        at = pc.fill_null(pc.index_in(asked, value_set=self.words), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            missing = np.concatenate([missing[latin[missing]], missing[~latin[missing]]])
            new, cut = asked.take(pa.array(missing)), int(latin[missing].sum())
            words = new.to_pylist()
            parts = [self._latin(words[:cut]), self._others(words[cut:])]
            at[missing] = len(self.words) + np.arange(len(missing))
            self.words = pa.concat_arrays([self.words, new])
            self.flat = np.concatenate([self.flat, *(p[0] for p in parts)])
            self.sizes = np.concatenate([self.sizes, *(p[1] for p in parts)])
        self.used = at
        return at

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of self.kind.

        Arrow splits the texts at spaces and numbers their distinct words; only those pass through Python. A word of
        Latin letters and the marks after it are apart in both vocabularies, so each is looked up on its own."""
        if not texts:
            return []
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, _JOINED_SPACES).to_numpy(zero_copy_only=False) if self.spaces else np.zeros(len(texts), bool)
        plain = pc.if_else(pa.array(odd), "", column) if odd.any() else column
        lists = pc.split_pattern(plain, " ")
        words, firsts = lists.flatten(), lists.offsets.to_numpy()[:-1]
        stems = pc.utf8_rtrim(words, characters=_MARKS)
        numbered = stems.dictionary_encode()
        is_latin = pc.match_substring_regex(numbered.dictionary, _LATIN).to_numpy(zero_copy_only=False)
        stem_at = numbered.indices.to_numpy()
        marks = (pc.binary_length(words).to_numpy() - pc.binary_length(stems).to_numpy()).astype(np.int64)
        whole = (marks > 0) & (~is_latin[stem_at] | (marks > 7))
        if self.spaces:
            whole[firsts] = True  # no space before them; no other word starts with white space
        whole_at = np.flatnonzero(whole)
        taken = words.take(pa.array(whole_at))
        if self.spaces:
            lead = np.zeros(len(words), bool)
            lead[firsts] = True
            taken = pc.if_else(pa.array(lead[whole_at]), pc.binary_join_element_wise(_LARGE("\n"), taken, _LARGE("")), taken)
        taken = taken.dictionary_encode()
        marks[whole] = 0

        # Numbers of distinct pieces: stems, whole words, runs of marks, and last the empty piece. A stem that only
        # whole words have is not asked for; the empty word stands in for it.
        count = len(numbered.dictionary)
        used = np.zeros(count, bool)
        used[stem_at[~whole]] = True
        asked = pa.concat_arrays([pc.if_else(pa.array(used), numbered.dictionary, _LARGE("")), taken.dictionary])
        rows = self._rows(asked, np.concatenate([is_latin, np.zeros(len(taken.dictionary), bool)]))
        runs, run_at, marked = self._runs(words, marks)
        ends = self._plain(runs)
        where = np.empty((len(words), 2), np.int64)
        where[:, 0] = rows[stem_at]
        where[whole_at, 0] = rows[count + taken.indices.to_numpy()]
        where[:, 1] = 0
        where[marked, 1] = len(self.words) + run_at

        flat = np.concatenate([self.flat, *ends])
        sizes = np.concatenate([self.sizes, np.array([len(x) for x in ends], np.int64)])
        starts = np.cumsum(sizes) - sizes
        at = where.ravel()
        size = sizes[at]
        out = flat[_spread(starts[at], size)].tobytes()
        ends = np.cumsum(np.add.reduceat(size, 2 * firsts)) * self.kind.itemsize
        found = [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        odd_at = np.flatnonzero(odd).tolist()
        for k, ids in zip(odd_at, self._plain([texts[k] for k in odd_at]), strict=True):
            found[k] = ids.tobytes()
        return found

    @staticmethod
    def _runs(words: pa.Array, marks: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct runs of up to seven marks at the ends of words, the number of each word's run, and those words."""
        _, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int64)[words.offset + 1 : words.offset + 1 + len(words)]
        letters = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        marked = np.flatnonzero(marks)
        end, left = ends[marked], marks[marked]
        key = np.zeros(len(marked), np.uint64)
        for j in range(int(left.max(initial=0))):
            more = left > j
            key[more] |= letters[end[more] - 1 - j].astype(np.uint64) << np.uint64(8 * j)
        keys, at = np.unique(key, return_inverse=True)
        return [int(k).to_bytes(8, "big").lstrip(b"\0").decode() for k in keys], at, marked


@lru_cache(maxsize=4)
def encoder(path: str, most: int = 750_000) -> Encoder:
    """One encoder a Python worker. It keeps about `most` words, some 40 bytes each, and those of one run."""
    return Encoder(path, most)
