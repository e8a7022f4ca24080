"""Word-cached encoding with the public word BPE vocabulary."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

from lectern.llm.common import KEPT

#: Words whose ids a worker keeps. Reaching it, the worker starts anew.
CACHED_WORDS = 400_000
#: Longer words are encoded each time, so that the cache stays small.
CACHED_BYTES = 64


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters that no normal form changes and whose case is folded one by one, and signs that follow a word.
PLAIN = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff]+)([.,!?;:]*)")


class WordEncoder:
    """Ids of whole texts (UTF-8) as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space before it merges, so no id spans ASCII white space, and a text's ids are
    the ids of its words in turn. Each word is encoded once and then found in a cache. It also parts letters
    from signs and folds case, so a word of plain letters is found without its case and the signs after it,
    and merged by the model alone, as nothing before the merges would change it."""

    def __init__(self, path: str, cached: int = CACHED_WORDS) -> None:
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.cores: dict[str, bytes] = {"": b""}
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printed]
        self.shown = {b: chr(b) for b in printed} | {b: chr(256 + n) for n, b in enumerate(rest)}  # of byte-level vocabularies

    def encode(self, texts: Iterable[bytes]) -> Iterable[bytes]:
        for text in texts:
            words = text.split()
            if len(self.known) > self.cached:
                self.known.clear()
            if len(self.cores) > self.cached:
                self.cores = {"": b""}
            known, passing, odd = self.known, {}, []
            for word in set(words).difference(known):
                plain = PLAIN.fullmatch(word.decode("utf-8", "replace").lower()) if len(word) <= CACHED_BYTES else None
                if plain:
                    known[word] = self.core(plain[1]) + self.core(plain[2])
                else:
                    odd.append(word)
            for at in range(0, len(odd), 20_000):
                part = [w.decode("utf-8", "replace") for w in odd[at : at + 20_000]]
                found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                for word, ids in zip(odd[at : at + 20_000], found, strict=True):
                    (known if len(word) <= CACHED_BYTES else passing)[word] = array("I", ids.ids).tobytes()
            if passing:
                yield b"".join([known[w] if w in known else passing[w] for w in words])
            else:
                yield b"".join(map(known.__getitem__, words))

    def core(self, text: str) -> bytes:
        if (ids := self.cores.get(text)) is None:
            merged = self.merge(text if text.isascii() else "".join(map(self.shown.__getitem__, text.encode())))
            ids = self.cores[text] = array("I", [t.id for t in merged]).tobytes()
        return ids


#: One encoder a worker, by path and words kept.
_encoders: dict[tuple[str, int], WordEncoder] = {}
KEPT["tokens"] = _encoders.clear


def encoder(path: str, cached: int = CACHED_WORDS) -> WordEncoder:
    if (path, cached) not in _encoders:
        _encoders[path, cached] = WordEncoder(path, cached)
    return _encoders[path, cached]
