"""Encode whole texts with a public tokenizer, Arrow batch by Arrow batch.

Vocabulary files that drop white space never let a token cross it, so a text's ids are the ids of its
words in order. Each distinct word of a batch is looked up once, and a worker remembers the ids of words in two halves of
``MEMO_BYTES`` together: when the younger half is full the older one is dropped, and words that are used again
move to the younger. New words are encoded in runs, parted by a special token, which words never touch. All this changes speed and never ids.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from farelake.llm.kept import kept

MEMO_BYTES = 48 << 20
#: Words in a run, and runs encoded at a time: what the tokenizer gives takes some hundred bytes for each id.
RUN, RUNS = 64, 256
#: Characters of text that are split into words at a time.
SLICE_CHARS = 2 << 20
#: The same where words are looked up: the more at once, the fewer look-ups.
ENCODE_CHARS = 4 << 20


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` from ``starts``, end to end."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class Memo:
    """Words and their ids, each end to end in one array: a dictionary of strings would take five times as much."""

    def __init__(self):
        self.words = pa.array([], pa.large_string())
        self.ends = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    @property
    def bytes(self) -> int:
        return self.words.nbytes + self.ends.nbytes + self.flat.nbytes

    def find(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in ``places`` end to end, and how many each has."""
        starts = np.where(places > 0, self.ends[places - 1], 0)
        sizes = self.ends[places] - starts
        return gathered(self.flat, starts, sizes), sizes

    def add(self, words: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Remember words that are not there yet."""
        self.words = pa.concat_arrays([self.words, words])
        self.ends = np.concatenate((self.ends, len(self.flat) + np.cumsum(sizes)))
        self.flat = np.concatenate((self.flat, flat))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young, self.old = Memo(), Memo()
        # A special token that cannot overlap itself.
        marks = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        apart = lambda m: not any(m.startswith(m[k:]) for k in range(1, len(m)))
        self.mark = next(((m, i) for m, i in sorted(marks) if m and apart(m)), None)

    @classmethod
    def at(cls, path: str) -> "Encoder":
        """The encoder of this worker for the vocabulary at ``path``."""
        return kept(("encoder", path), lambda: cls(path))

    def _ids_of(self, texts: list[str]):
        """The ids of each text, a few texts at a time."""
        for i in range(0, len(texts), RUNS):
            for e in self.tokenizer.encode_batch_fast(texts[i:i + RUNS], add_special_tokens=False):
                yield np.array(e.ids, np.uint32)

    def _new(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``words`` in some order, their ids end to end, and how many each has."""
        mark, number = self.mark or ("", -1)
        plain = [w for w in words if mark and mark[0] not in w]
        rest = [w for w in words if not mark or mark[0] in w]
        order, parts, sizes = [], [], []
        runs = [plain[i:i + RUN] for i in range(0, len(plain), RUN)]
        for run, flat in zip(runs, self._ids_of([mark.join(run) for run in runs])):
            cuts = np.flatnonzero(flat == number)
            if len(cuts) != len(run) - 1:
                rest += run
                continue
            order += run
            parts.append(flat[flat != number])
            sizes.append(np.diff(np.concatenate(([-1], cuts, [len(flat)]))) - 1)
        for word, flat in zip(rest, self._ids_of(rest)):
            order.append(word)
            parts.append(flat)
            sizes.append(np.array([len(flat)]))
        return order, np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct ``words`` end to end, and how many each has."""
        if self.young.bytes > MEMO_BYTES // 2:
            self.young, self.old = Memo(), self.young
        places = self.young.find(words)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            lacking = words.take(pa.array(missing))
            before = self.old.find(lacking)
            again = before >= 0
            self.young.add(lacking.filter(pa.array(again)), *self.old.ids(before[again]))
            order, flat, sizes = self._new(lacking.filter(pa.array(~again)).to_pylist())
            self.young.add(pa.array(order, pa.large_string()), flat, sizes)
            places[missing] = self.young.find(lacking)
        return self.young.ids(places)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` end to end, and each text's number of ids. A null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        per_text = np.diff(split.offsets.to_numpy())
        if len(words) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ids, sizes = self.word_ids(words.dictionary)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(ids))
        flat = lists.take(words.indices).flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(sizes[words.indices.to_numpy()])))
        bounds = ends[np.concatenate(([0], np.cumsum(per_text)))]
        return flat, np.diff(bounds)


def slices(batch: pa.RecordBatch, text: int = 1, chars: int = SLICE_CHARS):
    """``batch`` in runs of rows of at most ``chars`` bytes of text, at least one row each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + chars, "right")))
        yield batch.slice(start, stop - start)
        start = stop
