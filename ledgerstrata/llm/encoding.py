"""Token ids of whole texts with a public tokenizer, word by word.

The tokenizers of this kind cut a text into words before they merge, so the ids
of a text are the ids of its words in order. Words repeat, so each worker keeps
the ids of the words it has met and asks the library only for new ones. The cut
points are those where the library's own word pattern always cuts:

* ``spaced``: a single space or line feed between two characters that are not
  white space; the space goes to the word after it, the line feed is a word of
  its own (byte-level vocabularies);
* ``dropped``: every space and line feed (vocabularies that drop white space).
"""

from __future__ import annotations

import gc
import re
import sys
import types
from array import array

from ledgerstrata.llm.common import give_back

WORD_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
ODD_SPACE = re.compile(r"[^\S \n]")
# Marks a key that stands for its text as it is; other keys of spaced
# vocabularies stand for a space and the word, or begin with their line feed.
PLAIN = "\r"
# Words kept per worker, at about 200 bytes each; later new words are encoded each time.
KEPT_WORDS = 300_000
KEPT_LENGTH = 48


def _kept() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    name = "_ledgerstrata_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].values = {}
    return sys.modules[name].values


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte.

    Printable bytes stand for themselves; the others are numbered from 256 on.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, words: str, kept_words: int = KEPT_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if words not in ("spaced", "dropped"):
            raise ValueError(words)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.spaced = words == "spaced"
        self.kept_words = kept_words
        self.known: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str, words: str, kept_words: int = KEPT_WORDS) -> "WordEncoder":
        kept, name = _kept(), (path, words, kept_words)
        if name not in kept:
            kept[name] = cls(path, words, kept_words)
        return kept[name]

    def _keys(self, text: str) -> list[str]:
        """The words of a text as keys of ``known``."""
        if not self.spaced:
            return text.replace("\n", " ").split(" ")
        if (
            "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or ODD_SPACE.search(text)
        ):
            return [PLAIN + part for part in WORD_CUT.split(text)]
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = PLAIN + keys[0]
        return keys

    def _parts(self, key: str) -> tuple[str, ...]:
        """Simpler keys whose ids, in order, are the ids of ``key``.

        After a letter a tail of full stops and commas is a word of its own for
        the library, and the dropping vocabularies ignore case.
        """
        if not self.spaced:
            stem = key.rstrip(".,")
            # The last letter must still be one in lower case.
            if not stem or not stem[-1].lower().isalpha():
                stem = key
            tail = key[len(stem) :]
            stem = stem.lower() if stem.isascii() else stem
            return (stem, tail) if tail else (stem,)
        if key[0] == "\n":
            return PLAIN + "\n", *self._parts(PLAIN + key[1:])
        stem = key.rstrip(".,")
        if len(stem) == len(key) or not stem[-1:].isalpha():
            return (key,)
        return stem, PLAIN + key[len(stem) :]

    def _ids(self, keys: list[str]) -> list[bytes]:
        """The library's ids of keys that :meth:`_parts` does not take apart.

        Words of Latin letters go straight to its merge model, as neither
        normalising nor word cutting would change them.
        """
        out, whole, places = [], [], []
        for key in keys:
            plain = self.spaced and key[:1] == PLAIN
            word = key[1:] if plain else key
            if word.isalpha() and max(word) < "\u0250" and (self.spaced or word == word.lower()):
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(self.letters)
                if self.spaced and not plain:
                    word = self.letters[0x20] + word
                out.append(array("I", [token.id for token in self.model.tokenize(word)]).tobytes())
            else:
                places.append(len(out))
                whole.append(word if plain or not self.spaced else " " + word)
                out.append(b"")
        found = self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)
        for place, one in zip(places, found):
            out[place] = array("I", one.ids).tobytes()
        return out

    def _learn(self, keys: list[str]) -> dict[str, bytes]:
        """The ids of keys that are not known; keeps them while there is room."""
        known = self.known
        parts = [self._parts(key) for key in keys]
        missing = list({part for some in parts for part in some if part not in known})
        fresh = dict(zip(missing, self._ids(missing)))
        learned = {}
        for key, some in zip(keys, parts):
            learned[key] = b"".join([fresh[p] if p in fresh else known[p] for p in some])
        for found in (fresh, learned):
            if len(known) < self.kept_words:
                known.update((key, ids) for key, ids in found.items() if len(key) <= KEPT_LENGTH)
        return learned

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, special tokens not added."""
        # Long lists of strings hold no cycles; walking them for some costs a fifth of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        lookup = self.known.get
        rows, gaps = [], []
        for text in texts:
            keys = self._keys(text)
            found = list(map(lookup, keys))
            rows.append(found)
            if None in found:
                places = [i for i, ids in enumerate(found) if ids is None]
                gaps.append((found, places, [keys[i] for i in places]))
        if gaps:
            learned = self._learn(list({key for _, _, keys in gaps for key in keys}))
            for found, places, keys in gaps:
                for i, key in zip(places, keys):
                    found[i] = learned[key]
        return [b"".join(found) for found in rows]


def encode_batches(batches, encoder: WordEncoder, group_bytes: int = 8 << 20):
    """``(id, ids as bytes)`` per row of Arrow batches of (id, text); NULL text is empty."""
    for batch in batches:
        keys, texts, size = [], [], 0
        for key, text in zip(batch.column(0), batch.column(1)):
            keys.append(key.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= group_bytes:
                yield from zip(keys, encoder.encode(texts))
                keys, texts, size = [], [], 0
        yield from zip(keys, encoder.encode(texts))
    give_back()
