"""Token ids of whole texts, by public tokenizer files.

Texts of common characters go through one table of merges (tiktoken), all others through the tokenizers library itself.
Both give the same ids: a table of merges that joins whatever two neighbours make a token differs from one that names
its pairs only where a token, cut into bytes, is not put together again by its own pairs. Such tokens can never come
out of the library, so they are left out of the table.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Characters whose class and lower case do not depend on the version of Unicode a library follows.
_COMMON = re.compile("[^\t\n\r -~¡-¿À-ɏͰ-ͷͺ-Ϳ΄-ԯḀ-ỿ‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣]")
#: Of these, what lower-casing letter by letter, normal form C and the classes below all agree on.
_LATIN = re.compile("[^\t\n\r -~¡-©«-±´¶-¸»¿À-ÖØ-öø-įı-ž‐-‧‰-›]")
#: Word pattern of byte-level vocabularies: a fixed value of their format.
_BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE, _LETTER, _DIGIT, _MARK, _SHORT = range(5)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes with: printable ones as they are, the rest from 256 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in same]
    return {**{chr(b): b for b in same}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _own_pairs_join(parts: list[bytes], rank: dict[tuple[bytes, bytes], int]) -> int:
    """How many parts are left once the pairs have been joined, the lowest rank first."""
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), 1 << 60))
        if (parts[best], parts[best + 1]) not in rank:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return len(parts)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _MARK, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    kind[48:58] = _DIGIT
    kind[65:91] = kind[97:123] = kind[0xC3:0xC6] = _LETTER
    return kind


_KIND, _FOLD = _byte_classes(), np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def ended_words(text: str) -> str:
    """Every word with a zero character after it, white space gone: letters, single digits, other marks, 's and the like.

    Lower-cased text of _LATIN characters only.
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    kind = _KIND[raw]
    if not text.isascii():  # the bytes of one character are of one class
        inner = (raw & 0xC0) == 0x80
        kind = kind[np.maximum.accumulate(np.where(inner, 0, np.arange(len(raw))))]
    last = np.ones(len(raw), bool)
    last[:-1] = (kind[1:] != kind[:-1]) | (kind[:-1] == _DIGIT)
    if "'" in text:
        kind = kind.copy()
        after = np.append(raw, np.zeros(2, np.uint8))
        for at in np.flatnonzero(raw == 39).tolist():
            if at and kind[at - 1] == _MARK:
                continue
            one, two = after[at + 1], after[at + 1 : at + 3].tobytes()
            n = 1 if one in b"stmd" else 2 if two in (b"re", b"ve", b"ll") else 0
            if n:
                kind[at : at + n + 1] = _SHORT
                last[at : at + n] = False
                last[at + n] = True
                if at:
                    last[at - 1] = True
    keep = kind != _SPACE
    last &= keep
    place = np.cumsum(keep) + np.cumsum(last) - last
    out = np.zeros(int(keep.sum() + last.sum()), np.uint8)
    out[place[keep] - 1] = raw[keep]
    return out.tobytes().decode()


class Encoder:
    """Texts to arrays of uint32 ids, equal to encoding each whole text with the library.

    path: a tokenizers file. specials: special tokens' strings in a text are those tokens; else they are plain text.
    """

    def __init__(self, path: str, specials: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not specials
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, names)), re.IGNORECASE) if names and specials else None
        self.words = spec["model"].get("end_of_word_suffix") or ""
        self.table = self.ids = None
        if self._known(spec):
            self._build(spec["model"])

    def _known(self, spec: dict) -> bool:
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            return False
        if not self.words:
            return spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        steps = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        pattern = [s.get("pattern", {}).get("Regex") for s in split.get("pretokenizers", [])]
        return steps == ["NFC", "Replace", "Lowercase"] and pattern == [r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", None]

    def _build(self, model: dict) -> None:
        import tiktoken

        letters, end = byte_alphabet(), b"\0" if self.words else b""

        def raw(token: str) -> bytes:
            stem = token.removesuffix(self.words) if self.words else token
            return bytes(letters[c] for c in stem) + (end if stem != token else b"")

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = [(raw(a), raw(b)) for a, b in pairs]
        rank = {pair: i for i, pair in reversed(list(enumerate(pairs)))}
        singles = [bytes([b]) for b in range(256)]
        # A word's end is no part of its own: its last byte takes it up before all else.
        ranks = {s + end: i for i, s in enumerate(singles)} if end else {}
        for (a, b), i in rank.items():
            token = a + b
            parts = [token[i : i + 1] for i in range(len(token))]
            if end and token.endswith(end):
                parts[-2:] = [token[-2:]]
            if _own_pairs_join(parts, rank) == 1:
                ranks[token] = 256 + i
        ranks |= {s: 256 + len(pairs) + i for i, s in enumerate(singles)}
        ids = {raw(t): i for t, i in model["vocab"].items()}
        self.ids = np.zeros(512 + len(pairs), np.uint32)
        for token, i in ranks.items():
            self.ids[i] = ids.get(token, 0)
        pattern = r"[^\x00]+\x00" if end else _BYTE_LEVEL
        self.table = tiktoken.Encoding("table", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> np.ndarray:
        """The library's own way."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if not text:
            return np.empty(0, np.uint32)
        plain = text.isascii()
        if self.table is None or (self.special and "<|" in text and self.special.search(text)) or _odd(text, plain, bool(self.words)):
            return self.whole(text)
        if self.words:
            text = ended_words(text.lower())
        return self.ids[np.array(self.table.encode_ordinary(text), np.int64)]


#: Control characters that a text of plain ASCII may hold.
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def _odd(text: str, plain: bool, words: bool) -> bool:
    if plain:
        return _CONTROL.search(text) is not None
    return (_LATIN if words else _COMMON).search(text) is not None


_open: dict[tuple, Encoder] = {}


def encoder(path: str, specials: bool = True) -> Encoder:
    """One per worker process, so that its table outlives a task."""
    key = (path, specials)
    if key not in _open:
        _open[key] = Encoder(path, specials)
    return _open[key]
