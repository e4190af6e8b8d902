"""Token ids of whole texts by a public tokenizer file.

The tokenizer drops white space and cuts what is between into runs of letters, digits
and marks; its merges never leave a run. So a text of ASCII and Latin-1 letters is
cut into runs here and their ids are looked up; only runs not met lately go through
the merges. Words with other characters or a special token go through the whole
tokenizer. Two generations of known runs and words are kept per worker and the older
one is let go when the newer is full, which changes nothing but time.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

from tokenizers import Tokenizer

END_OF_DOCUMENT = 0
_GENERATION = 250_000
# What str.split() cuts at but the tokenizer may not: such texts go through it whole.
_OTHER_SPACES = re.compile("[\x1c-\x1f\x85]")
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
# The file's own cut, for lower-case ASCII and Latin-1 letters.
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_RUN_OF_MARKS = re.compile(r"[^\sa-zß-öø-ÿ0-9][.,]|[.,][^\sa-zß-öø-ÿ0-9]")
# Byte-level vocabularies write bytes as characters: the printable ones of Latin-1 as
# they are, the others in order from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = {
    byte: 256 + n for n, byte in enumerate(b for b in range(256) if b not in _SHOWN)
}


def is_plain(text: str) -> bool:
    return "<|" not in text and _PLAIN.fullmatch(text) is not None


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Lately(dict):
    """A store of two generations."""

    def __init__(self) -> None:
        super().__init__()
        self.before: dict[str, bytes] = {}

    def recall(self, key: str) -> bytes | None:
        """A value of the older generation, moved to the newer."""
        found = self.before.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key: str, value: bytes) -> None:
        if len(self) >= _GENERATION:
            self.before = dict(self)
            self.clear()
        self[key] = value


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = _Lately()
        self.runs = _Lately()

    def _run(self, run: str) -> bytes:
        found = self.runs.get(run) or self.runs.recall(run)
        if found is None:
            shown = run if run.isascii() else run.encode().decode("latin-1").translate(_HIDDEN)
            found = _packed([token.id for token in self.model.tokenize(shown)])
            self.runs.keep(run, found)
        return found

    def _plain(self, text: str) -> bytes:
        text = text.lower()
        if not _RUN_OF_MARKS.search(text):  # full stops and commas are runs of their own
            text = text.replace(".", " . ").replace(",", " , ")
        words = text.split()
        found = list(map(self.runs.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    # most words are one run
                    found[i] = b"".join(map(self._run, _RUNS.findall(words[i])))
        return b"".join(found)

    def _other(self, words: list[str]) -> bytes:
        """Words with characters that are not looked up by runs."""
        found = {}
        for word in set(words):
            known = self.words.get(word) or self.words.recall(word)
            if known is None and is_plain(word):
                known = self._plain(word)
            if known is not None:
                found[word] = known
        unknown = list(set(words).difference(found))
        encoded = self.tokenizer.encode_batch_fast(unknown, add_special_tokens=False)
        for word, one in zip(unknown, encoded, strict=True):
            found[word] = _packed(one.ids)
            self.words.keep(word, found[word])
        return b"".join(map(found.__getitem__, words))

    def ids(self, text: str) -> bytes:
        if is_plain(text):
            return self._plain(text)
        if _OTHER_SPACES.search(text):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return self._other(text.split())

    def document(self, text: str | None) -> bytes:
        """Ids of a text, then the end-of-document id."""
        return self.ids(text or "") + _packed([END_OF_DOCUMENT])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One store per worker process."""
    return WordIds(path)
