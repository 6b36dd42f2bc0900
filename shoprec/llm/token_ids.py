"""Token ids of whole columns of texts, encoded by distinct words.

A byte-level BPE never merges across a break before white space, so a text is cut at its single
spaces and each distinct word is encoded once. A text in which a space stands next to other white
space is encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa

#: Id behind the last one of each document.
END = 2
#: Distinct words, and ids of them, that a worker remembers; it starts anew beyond either.
WORDS, IDS = 400_000, 8_000_000
_WHITE = r"\x09-\x0d\x1c-\x1f\x{85}\p{Z}"
#: A space beside other white space.
_ODD = f" [{_WHITE}]|[{_WHITE}] "


class Encoder:
    """Ids by the vocabulary of a tokenizer file; `path` is the file of the `tokenizers` library.

    If the file of the same vocabulary for the `tiktoken` library lies beside it, that library does
    the merges, with equal results and a sixth of the time; `tokenizers` does all other encoding.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True  # their strings in a text are ordinary text
        self.by_words = isinstance(self.coder.pre_tokenizer, pre_tokenizers.ByteLevel) and self.coder.normalizer is None
        if self.by_words and not self._plain():
            self.by_words = False
        self.quick, self.length = self._quick(path) if self.by_words else (None, np.empty(0, np.int64))
        self._forget()

    def _plain(self) -> bool:
        """Whether words are cut alike in a text and alone (no space is put before a text)."""
        probe = lambda t: self.coder.encode(t, add_special_tokens=False).ids
        return probe("a b\nc") == [*probe("a"), *probe(" b\nc")] and probe("a ") == [*probe("a"), *probe(" ")]

    @staticmethod
    def _quick(path: str) -> tuple[Callable[[str], list[int]] | None, np.ndarray]:
        try:
            import public_tokenizers
            import tiktoken

            with open(path[: -len("json")] + "tiktoken", "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        except (ImportError, OSError):
            return None, np.empty(0, np.int64)
        coder = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            length[number] = len(token)
        return coder.encode_ordinary, length

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.edge = np.zeros(1 << 12, np.int64)  # ends of the entries in `flat`, the first at 0
        self.entries = 0
        self._add(np.array([END], np.uint32), np.array([1]))

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """New entries with these ids; returns the number of the first one."""
        at, first = int(self.edge[self.entries]), self.entries
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(sizes) >= len(self.edge):
            self.edge = np.concatenate([self.edge, np.zeros_like(self.edge)])
        self.flat[at : at + len(ids)] = ids
        self.edge[first + 1 : first + 1 + len(sizes)] = at + np.cumsum(sizes)
        self.entries += len(sizes)
        return first

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are encoded for themselves, and how many each has."""
        if self.quick:
            lists = [self.quick(t) for t in texts]
        else:
            lists = [e.ids for e in self.coder.encode_batch(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.array([i for x in lists for i in x], np.uint32), sizes

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words with a space before each. One call does all: cuts lie before the spaces."""
        if not self.quick or "" in words:
            return self._each([" " + w for w in words])
        joined = " " + " ".join(words)
        ids = np.array(self.quick(joined), np.uint32)
        ends = np.cumsum(pa.compute.binary_length(pa.array(words)).to_numpy().astype(np.int64) + 1)
        found = np.searchsorted(np.cumsum(self.length[ids]), ends) + 1
        return ids, np.diff(found, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, each text's followed by END, and where each begins (one more)."""
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        if not self.by_words:
            ids, sizes = self._each(texts.to_pylist())
            sizes = sizes + 1
            edges = np.concatenate(([0], np.cumsum(sizes)))
            return np.insert(ids, np.cumsum(sizes - 1), END).astype(np.uint32), edges
        if len(self.code) > WORDS or self.edge[self.entries] > IDS:
            self._forget()
        texts = texts.cast(pa.large_string())
        odd = pa.compute.match_substring_regex(texts, _ODD)
        parts = pa.compute.split_pattern(pa.compute.if_else(odd, "", texts), " ")
        edges = parts.offsets.to_numpy().astype(np.int64)
        edges -= edges[0]
        heads = edges[:-1]
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        inner = np.ones(len(codes), bool)
        inner[heads] = False
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        used = np.zeros(len(words), bool)
        used[codes[inner]] = True
        new = np.flatnonzero(used & (number < 0))
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            first = self._add(*self._words(fresh))
            number[new] = first + np.arange(len(new))
            self.code.update((w, k) for k, w in enumerate(fresh, first) if len(w) < 64)
        entry = number[codes]
        # The first part has no space before it; a text that is encoded whole has that part only.
        kept, odd = self.entries, odd.to_numpy(zero_copy_only=False)
        whole = texts.filter(pa.array(odd)).to_pylist()
        starts = pa.compute.take(coded.dictionary, pa.array(codes[heads])).to_pylist()
        for k, text in zip(np.flatnonzero(odd).tolist(), whole, strict=True):
            starts[k] = text
        entry[heads] = self._add(*self._each(starts)) + np.arange(n)
        entry = np.insert(entry, edges[1:], 0)  # END
        begin, sizes = self.edge[entry], self.edge[entry + 1] - self.edge[entry]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1])]
        self.entries = kept  # entries of single texts are not remembered
        bounds = np.concatenate(([0], ends[edges[1:] + np.arange(n)]))
        return ids, bounds
