"""Exact ids of the ``tokenizers`` library, with each distinct word encoded once.

Neither vocabulary lets a token cross a border between a non-space and a space, and what
follows such a border doesn't depend on what precedes it. So a text may be cut there, and
equal pieces get equal ids. Texts in which two white-space characters meet, and those that hold the string of an added
token (in any case of letters), go to the library whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# any two of these in a row: every character that Python or Unicode calls white space
_SPACES = "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    """The pattern that cuts a text into words before the merges of the rank files."""
    import public_tokenizers
    return public_tokenizers.PATTERN


class WordCache:
    """``lead_space``: a word carries the space before it (byte-level BPE); else white space is dropped.

    At most ``max_words`` words are remembered, as one Arrow column; beyond that the memory starts anew.
    """

    def __init__(self, path: str, lead_space: bool, max_words: int = 1_500_000):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.added = "(?i)" + "|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values())
        self.lead, self.max_words = lead_space, max_words
        # a word's first id begins with the space, or its last id carries the mark of a word's end
        self.border = np.zeros(max(self.tok.get_vocab().values()) + 1, bool)
        for t, i in self.tok.get_vocab().items():
            self.border[i] = t.startswith("\u0120") if lead_space else t.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _batch(self, texts: list[str]) -> list:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list:
        """Words of letters only are one piece each: encoded as one text, their ids fall apart at the borders."""
        text = " ".join(words)
        ids = np.array(self._batch([" " + text if self.lead else text])[0], np.uint32)
        at = np.flatnonzero(self.border[ids])
        if len(at) != len(words):
            return self._batch([" " + w for w in words] if self.lead else words)
        return np.split(ids, at[1:] if self.lead else at[:-1] + 1)

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        got = [g for k in range(0, len(plain), 500) for g in self._together(plain[k:k + 500])]
        got += self._batch([" " + w for w in other] if self.lead else other)
        size = np.fromiter(map(len, got), np.int32, len(got))
        if got:
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size, dtype=np.int64) - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, *(np.asarray(g, np.uint32) for g in got)])
            self.words = pa.concat_arrays([self.words, pa.array(plain + other, pa.large_string())])

    def _rows(self, words: pa.Array) -> np.ndarray:
        if len(self.words) > self.max_words:
            self._forget()
        at = pc.index_in(words, value_set=self.words).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.isnan(at)) if at.dtype.kind == "f" else ()
        if len(new):
            known, rest = len(self.words), words.take(pa.array(new))
            self._learn(pc.unique(rest).to_pylist())
            at[new] = known + pc.index_in(rest, value_set=self.words.slice(known)).to_numpy()
        return at.astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more at the end). Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = {}                       # texts that the library encodes as they are
        odd = pc.match_substring_regex(texts, self.added) if self.added != "(?i)" else pa.array(np.zeros(len(texts), bool))
        if self.lead:
            odd = pc.or_(odd, pc.match_substring_regex(texts, _SPACES + _SPACES))
        hit = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(hit):
            whole = dict(zip(hit.tolist(), self._batch([texts[int(i)].as_py() for i in hit])))
            texts = pc.if_else(odd, "", texts)
        parts = pc.split_pattern(texts, " ") if self.lead else pc.ascii_split_whitespace(texts)
        ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        flat = parts.flatten()
        start, size = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int32)
        heads, extra = ends[:-1], np.zeros(0, np.uint32)
        if self.lead and len(heads):     # the first piece of a text has no space before it
            got = self._batch(flat.take(pa.array(heads)).to_pylist())
            extra = np.fromiter((i for g in got for i in g), np.uint32)
            n = np.fromiter(map(len, got), np.int32, len(got))
        at = self._rows(flat)
        start, size = self.start[at], self.size[at]
        if self.lead and len(heads):
            start[heads], size[heads] = len(self.ids) + np.cumsum(n) - n, n
        upto = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        take = np.repeat((start - upto[:-1]).astype(np.int32), size)
        take += np.arange(upto[-1], dtype=np.int32)
        ids = (np.concatenate([self.ids, extra]) if len(extra) else self.ids)[take]
        offs = upto[ends]
        if whole:
            each = [np.array(whole[i], np.uint32) if i in whole else ids[offs[i]:offs[i + 1]] for i in range(len(offs) - 1)]
            offs = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
            ids = np.concatenate(each)
        return ids, offs


_CACHES: dict = {}


def cached(path: str, lead_space: bool) -> WordCache:
    """One per Python worker: workers serve many tasks."""
    key = (path, lead_space)
    if key not in _CACHES:
        _CACHES[key] = WordCache(path, lead_space)
    return _CACHES[key]


def slices(batch: pa.RecordBatch, col: str = "text", chars: int = 12_000_000):
    """Parts of a batch with at most about ``chars`` bytes of text (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(size), 0
    while at < len(size):
        base = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, base + chars, "right")))
        yield batch.slice(at, end - at)
        at = end
