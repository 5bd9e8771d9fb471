"""Token ids of whole texts by the tokenizers library, remembering the ids of chunks."""

import codecs
import re
import string
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from riskloom.llm.common import forgetters

END_ID = 1
#: Chunks remembered by one worker; beyond it the memory is emptied and filled anew.
REMEMBERED = 800_000
#: What may follow a word without a blank and never belongs to it; an apostrophe may ("don't").
_STOPS = string.punctuation.replace("'", "")
_BORDER = re.compile(r"(?<=\S)([ \n])(?=\S)")
_OTHER_BLANK = re.compile(r"[^\S \n]")


def _plain_blanks(text: str) -> bool:
    """Whether all white space is a single blank or line end between two other characters."""
    return bool(text) and not (text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text
                               or " \n" in text or "\n " in text or _OTHER_BLANK.search(text))


def _bytes_of(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters():
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(others)) for b in range(256))


class _Memory(dict):
    """Ids by chunk. One that is asked for and not known is learned, so that a text takes one look-up a chunk."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, chunk):
        ids = self[chunk] = self.learn(chunk)
        return ids


class ChunkEncoder:
    """Gives the ids of a text as little-endian unsigned 32-bit bytes.

    A tokenizer that first splits at white space gives a text the ids of its chunks one
    after the other. Chunks are encoded by the library once and looked up afterwards; a word of letters
    goes straight to the library's merging model, anything else through the whole tokenizer.

    ``blanks_dropped``: white space only separates (word-end vocabularies, which also lower the case), so
    every blank and line end is a border. Otherwise (byte-level vocabularies) a blank belongs to the
    chunk after it, a line end is a token of its own, and only a single one
    between two other characters is a border; a text with other blanks is cut at such borders only.
    """

    def __init__(self, path: str, blanks_dropped: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.blanks_dropped = blanks_dropped
        self.letters = _byte_letters()
        self.first = _Memory(lambda chunk: self._learn(self.first, chunk, ""))
        self.later = _Memory(lambda chunk: self._learn(self.later, chunk, " "))

    def _library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return _bytes_of(found.ids)

    def _word(self, word: str, before: str) -> bytes:
        """Ids of a word, with the blank before it if there is one."""
        if word.isascii() and word.isalpha():
            if self.blanks_dropped:
                lower = word.lower()
                if lower != word:
                    return self.first[lower]
            elif before:
                word = self.letters[32] + word
            return _bytes_of([t.id for t in self.model.tokenize(word)])
        if not word.isalpha() or not unicodedata.is_normalized("NFC", word):
            return self._library(before + word)
        if self.blanks_dropped:
            word = "".join([c.lower() for c in word])
            if not word.isalpha():
                return self._library(before + word)
        letters, _size = codecs.charmap_decode((before + word).encode(), "strict", self.letters)
        return _bytes_of([t.id for t in self.model.tokenize(letters)])

    def _learn(self, memory: dict, chunk: str, before: str) -> bytes:
        """Ids of a chunk. Between a letter and the stops at the end there is always a border."""
        body = chunk.rstrip(_STOPS)
        if body and len(body) < len(chunk) and body[-1].isalpha():
            return memory[body] + self.first[chunk[len(body):]]
        return self._word(chunk, before)

    def _bound(self):
        if len(self.first) + len(self.later) > REMEMBERED:
            self.first.clear()
            self.later.clear()

    def encode(self, text: str) -> bytes:
        self._bound()
        return self._words(text) if self.blanks_dropped else self._lines(text)

    def encode_all(self, texts: pa.Array):
        """The ids of many texts one after the other, and where those of each text end.

        If every blank is a border, the different chunks of all texts are looked up once.
        """
        if not self.blanks_dropped:
            found = [np.frombuffer(self.encode(t), "<u4") for t in texts.to_pylist()]
            return np.concatenate([np.empty(0, "<u4"), *found]), np.cumsum([len(f) for f in found], dtype=np.int64)
        self._bound()
        chunks = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = chunks.flatten().dictionary_encode()
        known = list(map(self.first.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
        flat = pa.array(known, pa.large_binary()).take(coded.indices)
        bounds = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1) // 4 if len(flat) else np.zeros(1, np.int64)
        last = np.cumsum(pc.list_value_length(chunks).to_numpy(zero_copy_only=False), dtype=np.int64)
        return np.frombuffer(flat.buffers()[2] or b"", "<u4", int(bounds[-1])), bounds[last]

    def _words(self, text: str) -> bytes:
        return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))

    def _lines(self, text: str) -> bytes:
        if not _plain_blanks(text):
            return self._bordered(text)
        out, first, later = [], self.first, self.later
        for i, line in enumerate(text.split("\n")):
            head, *chunks = line.split(" ")
            if i:
                out.append(first["\n"])
            out.append(first[head])
            out.extend(map(later.__getitem__, chunks))
        return b"".join(out)

    def _bordered(self, text: str) -> bytes:
        """A text with blanks in a row or at its ends: only single ones between two other characters are borders."""
        parts = _BORDER.split(text)
        out = [self._library(parts[0])]
        for separator, chunk in zip(parts[1::2], parts[2::2], strict=True):
            out += (self._library("\n"), self._library(chunk)) if separator == "\n" else (self._library(" " + chunk),)
        return b"".join(out)


_ENCODERS: dict = {}
forgetters[__name__] = _ENCODERS.clear


def encoder(path: str, blanks_dropped: bool) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path, blanks_dropped)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)
