"""Token ids of whole texts with a word-level memory.

A tokenizer of the rules below drops white space and never joins ids across it, so a
text's ids are its words' ids, one after the other. Words repeat; each task keeps the ids
of the words it has met (a bounded number of them) and asks the tokenizer for the others.
The rules are read from the tokenizer's file; one of any other rules encodes each text
whole, by itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Words a task remembers before it starts afresh: bounds its memory, changes no result.
REMEMBERED = 600_000
# Words of these characters only are split by the tokenizer into runs of letters, single
# digits and runs of signs, and lower-cased letter by letter.
_SIMPLE = re.compile(r"[a-zA-Z0-9À-ÖØ-öø-ÿ!\"#$%&()*+,./:;=?@\[\]^_`{}~-]+\Z")
_RUN = re.compile(r"[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")
_SPACES = re.compile("[\x20\x09-\x0d]+")
# How such a tokenizer's file states its rules.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_ODD_SPACES = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> list[str]:
    """The letters that byte-level vocabularies use for the 256 bytes (a public rule)."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in printable}, 0
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(256 + extra), extra + 1
    return [letters[b] for b in range(256)]


def by_words(rules: dict) -> bool:
    """Whether a tokenizer file's rules are those that this module takes apart."""
    def parts(name: str, inner: str) -> list:
        given = rules.get(name) or {}
        return given.get(inner, []) if given.get("type") == "Sequence" else [given]

    split, *then = parts("pre_tokenizer", "pretokenizers")
    model = rules.get("model") or {}
    return (parts("normalizer", "normalizers") == _NORMALIZERS and split.get("pattern") == {"Regex": _WORDS}
            and split.get("invert") is True and split.get("behavior") == "Removed" and len(then) == 1
            and (then[0].get("type"), then[0].get("add_prefix_space"), then[0].get("use_regex")) == ("ByteLevel", False, False)
            and model.get("type") == "BPE" and not model.get("dropout") and not model.get("byte_fallback")
            and model.get("unk_token") is None)


class WordEncoder:
    """``encode(text)``: ids of the whole text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_words = by_words(json.loads(self.tokenizer.to_str()))
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if not self.by_words:
            return self._whole(text)
        words = [w for w in _SPACES.split(text) if w] if _ODD_SPACES.search(text) else text.split()
        found = list(map(self.words.get, words))
        if None in found:
            if len(self.words) > REMEMBERED:
                self.words.clear()
            if len(self.runs) > REMEMBERED:
                self.runs.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self.words.get(words[i]) or self._word(words[i])
        return b"".join(found)

    def _word(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            run = word.lower()
            ids = self.runs.get(run) or self._run(run)
        elif _SIMPLE.match(word):
            ids = b"".join([self.runs.get(r) or self._run(r) for r in _RUN.findall(word.lower())])
        else:
            ids = self._whole(word)
        self.words[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        self.runs[run] = ids
        return ids
