"""Token ids by the tokenizers library, one call per distinct word and worker."""

from __future__ import annotations

import os

import numpy as np

from tidemark.llm.bpe import WordIds, byte_chars


class LibraryIds(WordIds):
    """``special=False`` takes the texts of special tokens as ordinary text, so that their ids occur
    only where the caller puts them."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        super().__init__(path)
        if not special:
            self.split.cut = _Never()
        self.model = self.split.tok.model
        # the characters that stand for bytes, of those that do not stand for themselves
        self.shown = {b: c for b, c in enumerate(byte_chars()) if chr(b) != c}

    def resolve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words are split and normalised already, so the library's model takes each as it is, with
        bytes written as the vocabulary writes them."""
        encode, shown = self.model.tokenize, self.shown
        ids: list[int] = []
        counts = []
        for w in words:
            found = encode(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(shown))
            counts.append(len(found))
            ids += [t.id for t in found]
        return np.array(ids, np.int32), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


class _Never:
    @staticmethod
    def split(text: str) -> list[str]:
        return [text]
