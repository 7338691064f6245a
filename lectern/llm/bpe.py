"""BPE encoding and decoding by dynamic programming over prefixes.

The BPE encoding of a word is found without replaying its merges.  An automaton with suffix links
over all tokens names, for every prefix of the word, the tokens that end there.  Exactly one of
them is the last token of the prefix's encoding: the one that either spans the whole prefix or
whose pair with the last token of the rest is compatible, i.e. that BPE would leave as it is.
These last tokens are stored, and following them back from the end gives the ids.
"""

from __future__ import annotations

import hashlib
import json

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from lectern.llm.common import map_rows
from lectern.llm.tokens import Encoder, encoder

#: Pairs whose compatibility is remembered.
PAIRS = 400_000
#: Stands for the end of a word, in place of the suffix of the vocabulary.
END = "\n"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(other)) for b in range(256)]


class PrefixEncoder(Encoder):
    """An ``Encoder`` whose words are encoded by the dynamic program; the library only splits unusual texts."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        vocabulary, merges = model["vocab"], [tuple(m) for m in model["merges"]]
        if not self.suffix:
            raise ValueError("a vocabulary with an end-of-word suffix is needed")
        self.letters = byte_letters()
        made = {a + b: (a, b) for a, b in merges}
        # Tokens in the order in which BPE prefers them: those of no merge, then by rank.
        order = [t for t in vocabulary if t not in made] + list(dict.fromkeys(a + b for a, b in merges))
        place = {t: k for k, t in enumerate(order)}
        self.ids = [vocabulary[t] for t in order]
        self.left, self.right = list(range(len(order))), list(range(len(order)))
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in merges:
            k = place[a + b]
            self.left[k], self.right[k] = place[a], place[b]
            self.merged[place[a], place[b]] = k
        self.pairs: dict[tuple[int, int], bool] = {}
        reached = [t not in made for t in order]
        for k, t in enumerate(order):
            if t in made:
                a, b = self.left[k], self.right[k]
                reached[k] = reached[a] and reached[b] and self._kept(a, b, first=False)
        automaton = ahocorasick.Automaton()
        for k, t in enumerate(order):
            if reached[k]:
                own = t[: -len(self.suffix)] + END if t.endswith(self.suffix) else t
                automaton.add_word(own, (k, len(own)))
        automaton.make_automaton()
        self.matches = automaton.iter

    def _kept(self, a: int, b: int, first: bool = True) -> bool:
        """Whether BPE keeps the pair (a, b): undoing both tokens' merges, latest first, no earlier merge across the border exists."""
        limit, merged, left, right = len(self.left), self.merged, self.left, self.right
        while True:
            if first and merged.get((a, b), limit) < limit:
                return False
            first = True
            if a > b:
                limit, a = a, right[a]
                if a == limit:
                    limit, b = b + 1, left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    limit, a = a, right[a]
                    if a == limit:
                        return True

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._kept(a, b)
        return known

    def encode_letters(self, word: str) -> list[int]:
        """The ids of one word in byte letters."""
        text = word + END
        last = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        for end, (token, length) in self.matches(text):
            at = end + 1
            if last[at] < 0 and ((start := at - length) == 0 or last[start] >= 0 and self.compatible(last[start], token)):
                last[at], size[at] = token, length
        at, ids = len(text), []
        while at:
            if last[at] < 0:
                raise ValueError(f"no token ends the prefix {text[:at]!r}")
            ids.append(self.ids[last[at]])
            at -= size[at]
        return ids[::-1]

    def encode_words(self, words: list[str]) -> list[bytes]:
        letters = self.letters
        return [np.array(self.encode_letters("".join([letters[b] for b in w.encode()])), dtype="<u4").tobytes() for w in words]

    def encode_text(self, text: str) -> bytes:
        ids: list[int] = []
        at = 0
        for m in [*self.special.finditer(text), None]:
            part = self.tokenizer.normalizer.normalize_str(text[at : m.start() if m else len(text)])
            for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                ids += self.encode_letters(word)
            if m:
                ids.append(self.tokenizer.token_to_id(m.group()))
                at = m.end()
        return np.array(ids, dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        """As the library decodes without a decoder: the tokens, special ones too, joined by spaces."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every whole text: (id_col, ids binary of unsigned 32-bit, decoded string).

    A null or empty text has no ids and decodes to the empty string.  Rows are kept as they are,
    repeated ids and null ids included; other columns are not read.
    """

    def rows(state, keys, texts):
        ids = [state(t) for t in texts]
        return keys, ids, [state.decode(x) for x in ids]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), rows, f"`{id_col}` {kind}, ids binary, decoded string", lambda: encoder(path, PrefixEncoder))


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """The digests of ``encode_documents``, taken where the ids are made: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null or empty text has no ids, and the digests are those of nothing.  Repeated rows and null
    ids stay as they are; other columns are not read; an empty table gives no rows.
    """

    def rows(state, keys, texts):
        ids = [state(t) for t in texts]
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return keys, [len(x) // 4 for x in ids], [sha(x) for x in ids], [sha(state.decode(x).encode()) for x in ids]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), rows, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", lambda: encoder(path, PrefixEncoder))
