"""Token ids of whole texts by a public tokenizer file, inside Pandas UDFs.

The tokenizer's pre-tokens never cross white space, so a text's ids are its
white-space chunks' ids in a row. Chunks repeat a lot; each worker keeps the
ids of the chunks it met first, in two bounded tables (chunks, and words below
punctuation), and the tokenizer itself only sees what neither table holds.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

#: Bound of each worker's tables, in entries.
MAX_ENTRIES = 120_000

#: Letters whose lower case is one letter and that no normal form changes,
#: then ASCII marks without the apostrophe (which starts pre-tokens of its own).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*$%&#|)]*)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Maps a text to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one pre-token each: encoded together, cut after each word's last token."""
        if not words:
            return []
        ids = self._ids(" ".join(words))
        cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. New chunks of a group of texts are encoded together."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size < 1 << 20):
                size += len(texts[end])
                end += 1
            out += self._group(texts[at:end])
            at = end
        return out

    def _new(self, chunks: set[str]) -> dict[str, bytes]:
        plain, out, words = [], {}, self.words
        wanted: dict[str, None] = {}
        for c in chunks:
            m = _PLAIN.fullmatch(c)
            if m:
                word, marks = m[1].lower(), m[2]
                plain.append((c, word, marks))
                if word not in words:
                    wanted[word] = None
                if marks not in words:
                    wanted[marks] = None
            else:
                out[c] = self._ids(c).tobytes()
        found = dict(zip(wanted, self._words(list(wanted)), strict=True))
        for c, word, marks in plain:
            out[c] = (found.get(word) or words[word]) + (words[marks] if marks in words else found[marks])
        words.update(islice(found.items(), max(0, MAX_ENTRIES - len(words))))
        self.chunks.update(islice(out.items(), max(0, MAX_ENTRIES - len(self.chunks))))
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        got = [list(map(self.chunks.get, parts)) for parts in split]
        gaps = [[k for k, x in enumerate(ids) if x is None] if None in ids else [] for ids in got]
        new = {parts[k] for parts, own in zip(split, gaps, strict=True) for k in own}
        if new:
            more = self._new(new)
            for parts, ids, own in zip(split, got, gaps, strict=True):
                for k in own:
                    ids[k] = more[parts[k]]
        return [b"".join(ids) for ids in got]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and tokenizer file."""
    return Encoder(path)
