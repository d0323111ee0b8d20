"""Token ids of a byte-pair vocabulary with word ends, through ranks.

A blank, which no word holds, stands for the end of a word in the ranks. Ids of such a
vocabulary stand in the order of merges, so that they serve as ranks. Texts are cut at
blanks, which no special string holds either. What a task has met between two blanks is
remembered, and what is new in some texts is coded at once.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import regex
import tiktoken

from visitlake.llm.token_counts import TokenCounter, byte_characters

END_OF_WORD = " "
#: Pieces between blanks that a worker remembers, and the longest of them in characters.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64
#: Characters of the texts that are coded together, but for one longer text.
TOGETHER = 1_000_000


class WordCoder:
    """Ids of whole texts, four bytes each, as the ``tokenizers`` library gives them without added tokens."""

    def __init__(self, path: str):
        self.rules = TokenCounter(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        ending, vocab = told["model"]["end_of_word_suffix"], told["model"]["vocab"]
        self.special = {t["content"]: struct.pack("<I", t["id"]) for t in told["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(byte_characters())}

        def spelled(token: str) -> bytes:
            whole = token.removesuffix(ending)
            return bytes(map(byte_of.__getitem__, whole)) + (END_OF_WORD.encode() if whole != token else b"")

        ranks = {spelled(token): number for token, number in vocab.items() if token not in self.special}
        if any(vocab[a + b] != 512 + k for k, (a, b) in enumerate(told["model"]["merges"])):
            raise ValueError("ids do not stand in the order of merges")
        self.ranks = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(rf"{self.rules.pattern.pattern}|\n")
        self.break_id = ranks[b"\n" + END_OF_WORD.encode()]
        # characters whose order or kind may differ between Python's tables and the library's
        self.unsure = self.rules.newer | np.array([unicodedata.combining(chr(c)) != 0 for c in range(0x110000)])
        self.known: dict[str, bytes] = {"": b""}

    def merged(self, words: list[str]) -> np.ndarray:
        """Ids of words, one after the other."""
        return self.ranks.encode_to_numpy("".join([w + END_OF_WORD for w in words])).astype("<u4")

    def is_plain(self, text: str) -> bool:
        """Whether a text has no special string and needs no rules but lower case and the words' pattern."""
        if any(s in text for s in self.rules.special_starts):
            return False
        if text.isascii():
            return True
        return not self.unsure[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any() and unicodedata.is_normalized("NFC", text)

    def by_rules(self, piece: str) -> bytes:
        """Ids of a piece as the library's own rules cut it."""
        parts, names = [piece], iter(())
        if self.rules.special:
            parts, names = self.rules.special.split(piece), iter(self.rules.special.findall(piece))
        ids = b""
        for k, part in enumerate(parts):
            cut = self.rules.library.pre_tokenizer.pre_tokenize_str(self.rules.library.normalizer.normalize_str(part))
            words = [bytes(map(self.rules.byte_of.__getitem__, p)).decode("utf-8") for p, _ in cut]
            ids += (self.special[next(names)] if k else b"") + self.merged(words).tobytes()
        return ids

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces without line breaks."""
        found = {}
        if not self.is_plain("\n".join(pieces)):
            found = {p: self.by_rules(p) for p in pieces if not self.is_plain(p)}
            pieces = [p for p in pieces if p not in found]
        if pieces:
            ids = self.merged(self.words.findall(self.rules.lower("\n".join(pieces))))
            ends = np.flatnonzero(ids == self.break_id)
            whole = ids.tobytes()
            begins, ends = [0, *(4 * ends + 4).tolist()], [*(4 * ends).tolist(), len(whole)]
            found.update((p, whole[a:b]) for p, a, b in zip(pieces, begins, ends, strict=True))
        return found

    def code(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        coded: list[bytes] = []
        held: list[list[str]] = []
        size = 0
        for k, text in enumerate(texts):
            held.append(text.replace("\n", " ").replace("\t", " ").split(" "))
            size += len(text)
            if size > TOGETHER or k == len(texts) - 1:
                coded.extend(self._coded(held))
                held, size = [], 0
        return coded

    def _coded(self, held: list[list[str]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = {"": b""}
        known = self.known
        new = list(set().union(*held).difference(known))
        if not new:
            return [b"".join(map(known.__getitem__, pieces)) for pieces in held]
        found = self.learn(new)
        long = {p: found.pop(p) for p in new if len(p) > LONGEST_REMEMBERED}
        known.update(found)
        if not long:
            return [b"".join(map(known.__getitem__, pieces)) for pieces in held]
        return [b"".join([known[p] if p in known else long[p] for p in pieces]) for pieces in held]


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)
