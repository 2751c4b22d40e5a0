"""Token ids by a tokenizer file, each distinct word of a batch looked up once.

For a byte-level tokenizer that splits before words and keeps one leading blank with its word, a blank or a newline
between two characters that are no white space always starts a new piece, and so does a full stop or comma between a letter
and white space or the end. Texts without doubled, leading or trailing white space are therefore cut there by Arrow,
a batch at a time, and only the distinct words of a batch meet the library or the table of known words; other texts, texts that hold
an added token and those of other tokenizers go to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Before a word that has no blank before it.
BARE = "\x01"
SPACE = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"


class WordEncoder:
    """Encodes whole texts as the library does; ``most`` words (and one batch) bound the table of known words, which begins anew when full."""

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, "rb") as f:
            kind = json.load(f)
        cut = kind.get("pre_tokenizer") or {}
        self.by_words = not kind.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        odd = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join([SPACE + "{2}", "^" + SPACE, SPACE + "$", BARE, *odd])
        self.blank = np.zeros(self.library.get_vocab_size(), bool)
        self.blank[[i for t, i in self.library.get_vocab().items() if t.startswith("\u0120")]] = True  # how byte-level vocabularies write a blank
        self.most = most
        self.forget()

    def forget(self) -> None:
        """Empty the table; a task calls this at its end, so that its worker has the memory for other work."""
        self.known: dict[str, int] = {}
        self.sizes, self.ids, self.used = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint32), 0
        self.starts = np.zeros(1 << 12, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[str], n: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.known)
        while first + len(words) > len(self.sizes):
            self.sizes, self.starts = np.append(self.sizes, np.zeros_like(self.sizes)), np.append(self.starts, np.zeros_like(self.starts))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.sizes[first : first + len(words)] = n
        self.starts[first : first + len(words)] = self.used + np.cumsum(n) - n
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))

    def _learn(self, words: list[str]) -> np.ndarray:
        """The place of each word in the table."""
        if len(self.known) > self.most:
            self.forget()
        known = self.known
        new = [w for w in words if w not in known]
        bare = [w for w in new if w[0] == BARE]
        spaced = [w for w in new if w[0] != BARE]
        for i in range(0, len(bare), 4096):
            found = self.whole([w[1:] for w in bare[i : i + 4096]])
            self._add(bare[i : i + 4096], np.fromiter(map(len, found), np.int64, len(found)), np.fromiter((x for ids in found for x in ids), np.uint32))
        for i in range(0, len(spaced), 4096):
            part = spaced[i : i + 4096]
            ids = np.array(self.whole([" " + " ".join(part)])[0], np.uint32)  # a word's first token, and no other, begins with the blank
            first = np.flatnonzero(self.blank[ids])
            if len(first) != len(part):
                raise ValueError("the tokenizer does not split before blanks")
            self._add(part, np.diff(first, append=len(ids)), ids)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(which, words, ends)``: the places of the texts cut, their words' places in the table, and where each text's words end."""
        a = pa.array(texts, pa.large_string())
        fit = np.flatnonzero(pc.and_(pc.invert(pc.match_substring_regex(a, self.odd)), pc.greater(pc.binary_length(a), 0)).to_numpy(zero_copy_only=False)) if self.by_words else np.empty(0, np.int64)
        a = pc.replace_substring_regex(a.take(pa.array(fit)), r"(\pL)([.,])([ \n]|$)", r"\1 " + BARE + r"\2\3")
        large = pa.scalar(BARE, pa.large_string()), pa.scalar("", pa.large_string())
        a = pc.binary_join_element_wise(large[0], pc.replace_substring(a, "\n", f" {BARE}\n {BARE}"), large[1])
        parts = pc.split_pattern(a, " ")
        coded = parts.values.dictionary_encode()
        words = self._learn(coded.dictionary.to_pandas().tolist())[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
        return fit, words, np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        fit, words, ends = self._cut(texts)
        n = self.sizes[words]
        stop = np.cumsum(n)
        ids = self.ids[np.repeat(self.starts[words] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
        out: list = [None] * len(texts)
        for k, own in zip(fit.tolist(), np.split(ids, stop[ends[:-1] - 1]) if len(fit) else [], strict=True):
            out[k] = own
        rest = [k for k, x in enumerate(out) if x is None]
        for k, own in zip(rest, self.whole([texts[k] for k in rest]), strict=True):
            out[k] = np.array(own, np.uint32)
        return out

    def counts(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has."""
        fit, words, ends = self._cut(texts)
        total = np.concatenate([[0], np.cumsum(self.sizes[words])])
        out = np.full(len(texts), -1, np.int64)
        out[fit] = np.diff(total[np.concatenate([[0], ends])])
        rest = np.flatnonzero(out < 0).tolist()
        out[rest] = [len(x) for x in self.whole([texts[k] for k in rest])]
        return out


def slices(texts: list[str], most_chars: int = 4_000_000):
    """``(first, last)`` of runs of ``texts`` of about ``most_chars`` characters, so that a batch of long texts is not held at once."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > most_chars:
            yield first, k
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def file_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
