"""Token ids of whole texts by the tokenizers library, with a bounded memory of chunks met before.

Both public vocabularies cut a text at white space before anything else, so the
ids of a text are those of its chunks one after another. ``ChunkEncoder`` has
the library encode every distinct chunk once and joins what it remembers. Texts
for which cutting is not plainly exact go through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

from .common import MEMORIES

MEMORY_CHUNKS = 1_500_000
LONGEST_CHUNK = 64


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    """The library's tokenizer of a public vocabulary, one thread, no truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    path = name if os.path.sep in name else tokenizer_path(name)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


def _pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class ChunkEncoder:
    """ids(texts): little-endian unsigned 32-bit ids of each text, as ``encode(text, add_special_tokens=False)``.

    spaces: how the vocabulary treats white space. "kept": a space belongs to
    the word after it (byte-level vocabularies); "dropped": white space only
    separates words and case is ignored (word vocabularies).
    """

    # a space after other white space may be merged with it; "<|" may begin a special token
    _KEPT_WHOLE = re.compile(r"\s |<\|")
    # outside of these, normal forms, letter case and white space need the library's own rules
    _DROPPED_WHOLE = re.compile("[^\t\n\r -~¡-įı-ň" + "Ŋ-ſ]|<\\|")

    def __init__(self, name: str, spaces: str | None = None):
        self.tokenizer = load_tokenizer(name)
        self.dropped = (spaces or ("dropped" if "word_" in os.path.basename(name) else "kept")) == "dropped"
        self.lead, self.lead_letter = ("", "") if self.dropped else (" ", "\u0120")  # a space, as byte-level letter
        self.memory: dict[str, bytes] = {}
        self.remembered = MEMORY_CHUNKS
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.line = self.encode(["\n"])[0]
        self.marks = dict(zip(".,;:!?", self.encode(list(".,;:!?"))))

    def chunks(self, text: str) -> list[str] | None:
        """What a text's spaces separate; None where it has to be encoded whole."""
        if self.dropped:
            return None if self._DROPPED_WHOLE.search(text) else text.lower().split()
        return None if self._KEPT_WHOLE.search(text) else text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        return [_pack(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _chunk(self, chunk: str, lead: bool = True) -> bytes:
        """Ids of one chunk, after a space if the vocabulary keeps them and ``lead``.

        A plain word goes straight to the library's byte-pair model, as do the
        parts of two lines of which the second begins without white space.
        """
        word, tail = chunk, b""
        if not self.dropped and "\n" in chunk:
            first, second = chunk.split("\n", 1)
            if first and second and not first[-1].isspace() and not second[0].isspace():
                known = self.memory.get(first) if lead else None
                first = self._chunk(first, lead) if known is None else known
                return first + self.line + self._chunk(second, False)
        if word[-1:] in self.marks and word[:-1].isalpha():
            word, tail = word[:-1], self.marks[word[-1]]
            known = self.memory.get(word) if lead else None
            if known is not None:
                return known + tail
        if not word.isalpha():
            return self.encode([self.lead + chunk if lead else chunk])[0]
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return _pack([t.id for t in self.model.tokenize(self.lead_letter + word if lead else word)]) + tail

    def ids(self, texts: list[str]) -> list[bytes]:
        memory, out = self.memory, []
        for text in texts:
            chunks = self.chunks(text)
            if chunks is None:
                out.append(self.encode([text])[0])
                continue
            start = b""
            if self.lead:  # no space stands before the first one
                start = self._chunk(chunks[0], False)
                del chunks[0]
            new = {c: self._chunk(c) for c in set(chunks).difference(memory)}
            if new and len(memory) < self.remembered:
                # what comes first is what is common; memory stays bounded
                memory.update({c: ids for c, ids in new.items() if len(c) <= LONGEST_CHUNK})
            if all(map(memory.__contains__, new)):
                out.append(start + b"".join(map(memory.__getitem__, chunks)))
            else:
                out.append(start + b"".join([new[c] if c in new else memory[c] for c in chunks]))
        return out


_encoders: dict[str, ChunkEncoder] = {}


def encoder(name: str, remembered: int | None = None) -> ChunkEncoder:
    """This process's encoder of a vocabulary, which remembers up to ``remembered`` chunks (some 200 bytes each).

    It and what it remembers are kept between the tasks of a worker, until the
    worker turns to an operator that reads texts in another way.
    """
    if name not in _encoders:
        _encoders[name] = ChunkEncoder(name)
        MEMORIES.append(_encoders[name].memory)
    _encoders[name].remembered = remembered or MEMORY_CHUNKS
    return _encoders[name]
