"""Token ids of whole texts by the tokenizers library, each distinct word encoded once a worker.

The tokenizer file splits a text into words that are encoded independently, so the ids of a text
are the ids of its words in order.  Words are looked up in a bounded table; those missing are
encoded together by the library.  Texts with characters for which Python's and the library's
Unicode rules could differ, and texts that hold a special token, go to the library whole.

Many texts are split together: their characters become one byte each, words begin where the class of
characters changes, and Arrow's dictionary of the words leaves each distinct one to be looked up once.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import filterfalse, pairwise

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Characters up to here need no normal form; letters and numbers among them are listed from the Unicode database.
_LAST = 0x17F
#: Words in the table; it is emptied when full (some 150 MB a worker).
TABLE_WORDS = 700_000
#: Characters that are split together.
BLOCK = 4_000_000


def default_path() -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ranges(kind: str) -> str:
    """A character class of the characters of one Unicode category up to _LAST."""
    return "".join(re.escape(chr(c)) for c in range(_LAST + 1) if unicodedata.category(chr(c))[0] == kind)


#: Characters that this module handles itself: printable ones, tab and line ends, without the dotted capital I.
UNUSUAL = re.compile(f"[^\t\n\r\x20-\x7e\xa1-įı-{chr(_LAST)}]")
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_ranges('L')}]+|[{_ranges('N')}]|[^\\s{_ranges('L')}{_ranges('N')}]+")

#: One byte for each lower-case character that this module handles: 0 for blanks, and OTHER for all that it leaves to the library.
OTHER = 255
_BLANKS = "\t\n\r "
_LETTERS = " " + "".join(sorted({chr(c).lower() for c in range(_LAST + 1) if not UNUSUAL.match(chr(c))} - set(_BLANKS)))
_BYTES = np.full(1 << 16, OTHER, np.uint8)
for _c in range(_LAST + 1):
    if not UNUSUAL.match(chr(_c)):
        _BYTES[_c] = 0 if chr(_c) in _BLANKS else _LETTERS.index(chr(_c).lower())
_LATIN = _BYTES[:256].tobytes()
#: The class of each such byte: 0 blank, 1 letter, 2 number, 3 any other.
_LETTER, _NUMBER = 1, 2
_CLASSES = bytes([0, *[{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(c)[0], 3) for c in _LETTERS[1:]]]).ljust(256, b"\3")
_APOSTROPHE, _SHORT, _LONG = _LETTERS.index("'"), [_LETTERS.index(c) for c in "stmd"], [[_LETTERS.index(c) for c in x] for x in ("re", "ve", "ll")]


def letter_bytes(text: str) -> bytes:
    """The text in lower case, a byte for a character."""
    try:
        return text.encode("latin-1").translate(_LATIN)
    except UnicodeEncodeError:
        return _BYTES[np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")].tobytes()


def split_bytes(block: bytes) -> tuple[np.ndarray, pa.Array]:
    """Where the words of ``letter_bytes`` begin, and the words: those that ``WORD`` finds."""
    letters, kinds = np.frombuffer(block + b"\0\0\0", np.uint8), np.frombuffer(block.translate(_CLASSES) + b"\0\0\0", np.uint8)
    inner = kinds != 0
    begins = kinds == _NUMBER
    begins[0] = inner[0]
    begins[1:] |= (kinds[1:] != kinds[:-1]) & inner[1:]
    at = np.flatnonzero(letters == _APOSTROPHE)
    at = at[begins[at]]
    one, two = letters[at + 1], letters[at + 2]
    short = np.isin(one, _SHORT)
    long = np.logical_or.reduce([(one == a) & (two == b) for a, b in _LONG])
    begins[at[short | long] + 1] = False
    ends = np.concatenate([at[short] + 2, at[long] + 3])
    begins[ends[kinds[ends] == _LETTER]] = True
    data = letters[inner]
    offsets = np.append(np.flatnonzero(begins[inner]), len(data)).astype(np.int32)
    return np.flatnonzero(begins), pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _parts(values: pa.BinaryArray) -> tuple[np.ndarray, bytes]:
    """Offsets and data of a whole Arrow array without nulls."""
    _, offsets, data = values.buffers()
    return np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1], data.to_pybytes() if data else b""


class Encoder:
    """Encodes whole texts to little-endian unsigned 32-bit ids.

    ``path`` names a tokenizers file of BPE with an end-of-word suffix, lower case and split by
    the rule of ``WORD``; any other file is encoded by the library throughout.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.strings = [""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.strings[k] = token
        self.ends = np.array([bool(self.suffix) and t.endswith(self.suffix) for t in self.strings])
        split = json.dumps(spec["pre_tokenizer"], ensure_ascii=False)
        self.known = bool(self.suffix) and r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in split and "Lowercase" in json.dumps(spec["normalizer"])
        self.table: dict[str, bytes] = {}
        self.byte_table: dict[bytes, bytes] = {}

    def plain(self, text: str) -> bool:
        """Whether the text can be split here, word by word."""
        return self.known and not UNUSUAL.search(text) and not self.special.search(text)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each of these words, by the library in one call."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            raise ValueError("the tokenizer does not encode words independently")
        raw, ends = ids.tobytes(), (4 * cuts).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode_text(self, text: str) -> bytes:
        """The ids of a text that ``plain`` refuses."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.plain(text):
            return self.encode_text(text)
        words = WORD.findall(text.lower())
        table = self.table
        if missing := list(set(filterfalse(table.__contains__, words))):
            if len(table) + len(missing) > TABLE_WORDS:
                table.clear()
                missing = list(set(words))
            table.update(zip(missing, self.encode_words(missing), strict=True))
        return b"".join(map(table.__getitem__, words))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each of these texts, in order, split together in blocks of BLOCK characters; no more is held at once."""
        held: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if size + len(text) > BLOCK:
                yield from self._encode_block(held)
                held, size = [], 0
            if len(text) > BLOCK:
                yield self._encode_long(text)
            else:
                held.append(text)
                size += len(text)
        yield from self._encode_block(held)

    def _encode_long(self, text: str) -> bytes:
        """The ids of one text, split in parts that end at blanks."""
        if not self.plain(text):
            return self.encode_text(text)
        out, at = [], 0
        while at < len(text):
            end = len(text) if len(text) - at <= BLOCK else max(text.rfind(c, at + 1, at + BLOCK) for c in _BLANKS)
            if end < 0:
                end = min((k for c in _BLANKS if (k := text.find(c, at + BLOCK)) >= 0), default=len(text))
            out += self._encode_split([letter_bytes(text[at:end])])
            at = end
        return b"".join(out)

    def _encode_block(self, texts: list[str]) -> list[bytes]:
        found: list[bytes | None] = []
        split = []
        for text in texts:
            letters = letter_bytes(text) if self.known and not self.special.search(text) else None
            if letters is None or OTHER in letters:
                found.append(self.encode_text(text) if text else b"")
            else:
                found.append(None)
                split.append(letters)
        ids = iter(self._encode_split(split))
        return [next(ids) if x is None else x for x in found]

    def _encode_split(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts as ``letter_bytes`` gives them."""
        begins, words = split_bytes(b"\0".join(texts))
        if not len(words):
            return [b""] * len(texts)
        words = words.dictionary_encode()
        offsets, data = _parts(words.dictionary)
        cuts = offsets.tolist()
        ids = self._look_up([data[a:b] for a, b in pairwise(cuts)])
        offsets, data = _parts(pa.array(ids, pa.binary()).take(words.indices))
        last = np.cumsum([len(x) + 1 for x in texts])
        cuts = [0, *offsets[np.searchsorted(begins, last)].tolist()]
        return [data[a:b] for a, b in pairwise(cuts)]

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words as bytes of ``letter_bytes``."""
        table = self.byte_table
        if missing := list(filterfalse(table.__contains__, words)):
            if len(table) + len(missing) > TABLE_WORDS:
                table.clear()
                missing = words
            table.update(zip(missing, self.encode_words(codecs.charmap_decode(b"\0".join(missing), "strict", _LETTERS)[0].split(" ")), strict=True))
        return list(map(table.__getitem__, words))


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, kind: type[Encoder] = Encoder) -> Encoder:
    """The worker's encoder for this file; made once a process."""
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]
