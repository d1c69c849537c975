"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once per worker.

A text is cut where the tokenizer never joins across: at white space for a tokenizer that drops it, before a
single space for a byte-level one, and for both between an ASCII letter and an ASCII sign or digit, apostrophes apart. Arrow
finds the distinct pieces of a batch, plain words and signs for the most part, the library's model gives the ids of those
not met before, and numpy lines them up. A text in which such cuts could differ from the library's reading (its
special strings, runs of white space, control characters) is given to the library whole, as are all texts of a tokenizer
whose file is of neither kind. The memory of a worker is bounded: of ``MOST_PIECES`` pieces it forgets the half that
was of no use for longest.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_PIECES = 600_000
_LONGEST_KEPT = 64

# What the two kinds of tokenizer file say of their pre-tokens.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters and numbers below U+0180, where case, normal form and classes are simple; no apostrophe, which starts contractions.
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
_LETTER_SIGN, _SIGN_LETTER = "([A-Za-z])([!-&(-@\\[-`{-~])", "([!-&(-@\\[-`{-~])([A-Za-z])"
_PLAIN = re.compile("[ \\t\\n\\r!-&(-~¡-įı-ſ]+")
_LETTERS_ALONE = re.compile(f" ?[{_LETTERS.replace('ø-ſ', 'ø-įı-ſ')}]+")
_WHITE = re.compile("[\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_PLAIN_WORD = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
_PLAIN_BYTE = re.compile(rf" ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if visible, else the next free one."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SPACE = _byte_signs()[0x20]
_SIGNS = str.maketrans({chr(b): c for b, c in _byte_signs().items()})


class Encoder:
    """Ids of texts as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.kind = _kind(spec)
        special = [re.escape(t["content"]) for t in spec.get("added_tokens") or []]
        odd = {"white": r"[\x1c-\x1f]", "space": r" \s|\s |\x00|[\x{a0}\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"}
        self.whole = "|".join([odd.get(self.kind, ""), *special]) if self.kind else None
        self.special = "|".join(special)
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.plain: dict[str, bytes] = {}
        self.parts: dict[str, list[str]] = {}
        # Pieces met before: their places in ``at``, which says where their ids lie in ``flat``, and when they were last of use.
        self.pieces: dict[str, int] = {}
        self.flat, self.at = np.zeros(0, self.dtype), np.zeros(1, np.int64)
        self.used, self.round = np.zeros(0, np.int32), 0

    def library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.dtype) for x in found]

    def _ids(self, token: str) -> bytes:
        """Ids of one plain pre-token."""
        if token.isascii() and token.isprintable():
            text = token.replace(" ", _SPACE)
        else:
            text = token.encode().decode("latin-1").translate(_SIGNS)
        return array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()

    def _plain(self, token: str) -> bytes:
        """Ids of a plain pre-token within a longer piece."""
        ids = self.plain.get(token)
        if ids is None:
            ids = self._ids(token)
            if len(token) <= _LONGEST_KEPT:
                if len(self.plain) >= MOST_PIECES:
                    self.plain = {}
                self.plain[token] = ids
        return ids

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of pieces not met before."""
        found: list[bytes | None] = []
        white, plain = self.kind == "white", self._plain
        for word in words:
            if _LETTERS_ALONE.fullmatch(word):
                found.append(self._ids(word.lower() if white else word))
            elif _PLAIN.fullmatch(word):
                parts = _PLAIN_WORD.findall(word.lower()) if white else _PLAIN_BYTE.findall(word)
                found.append(b"".join(map(plain, parts)))
            else:
                found.append(None if word else b"")
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self.library([words[i] for i in rest]) if rest else (), strict=True):
            found[i] = ids.tobytes()
        return found

    def _places(self, distinct: list[str]) -> tuple[np.ndarray, int]:
        """Places of pieces in ``at``, those not met before put there; and how many pieces are to be kept of all."""
        known = self.pieces.get
        places = np.array([known(x, -1) for x in distinct], np.int64)
        missing = np.flatnonzero(places < 0)
        if not len(missing):
            return places, len(self.used)
        # Long ones last, so that they can be dropped after use.
        missing = missing[np.argsort([len(distinct[i]) > _LONGEST_KEPT for i in missing], kind="stable")]
        new = [distinct[i] for i in missing]
        ids = self._learn(new)
        first = len(self.used)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), self.dtype)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
        places[missing] = np.arange(first, first + len(new))
        keep = sum(len(x) <= _LONGEST_KEPT for x in new)
        self.pieces.update(zip(new[:keep], range(first, first + keep), strict=True))
        return places, first + keep

    def _forget(self, keep: int) -> None:
        """Drop the pieces from ``keep`` on; of more than ``MOST_PIECES``, those that were of no use for longest."""
        self.used, self.at = self.used[:keep], self.at[: keep + 1]
        self.flat = self.flat[: self.at[-1]]
        if keep <= MOST_PIECES:
            return
        stay = np.sort(np.argsort(-self.used, kind="stable")[: MOST_PIECES // 2])
        sizes = np.diff(self.at)
        mask = np.zeros(keep, bool)
        mask[stay] = True
        self.flat = self.flat[np.repeat(mask, sizes)]
        self.at = np.concatenate([[0], np.cumsum(sizes[stay])])
        self.used = self.used[stay]
        moved = np.cumsum(mask) - 1
        self.pieces = {x: int(moved[i]) for x, i in self.pieces.items() if mask[i]}

    def cut(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """Pieces of each text, and the places of texts left without because only the library may cut them."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, self.whole)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(whole):
            texts = pc.if_else(odd, "", texts)
        sign = " " if self.kind == "white" else "\0"
        for pattern in (_LETTER_SIGN, _SIGN_LETTER):
            texts = pc.replace_substring_regex(texts, pattern, f"\\1{sign}\\2")
        if self.kind == "white":
            return pc.utf8_split_whitespace(texts), whole
        return pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0"), whole

    def cut_all(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
        """Pieces of each text, how many special strings it holds besides, and the places of texts that are left to the library.

        Where white space parts words, special strings are one token each and part them as well, and a text with control
        characters that only Arrow takes for white space is cut by the tokenizer's own, so no text is left to the library.
        """
        texts = texts.fill_null("")
        none = np.zeros(len(texts), np.int64)
        if self.kind != "white":
            return self.cut(texts)[0], none, self.cut(texts)[1]
        if self.special:
            none = pc.count_substring_regex(texts, self.special).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = pc.replace_substring_regex(texts, self.special, " ") if none.any() else texts
        lists, odd = self.cut(texts)
        if len(odd):
            own = [[p for p in _WHITE.split(x) if p] for x in texts.take(odd).to_pylist()]
            order = np.arange(len(texts))
            order[odd] = len(texts) + np.arange(len(odd))
            lists = pa.concat_arrays([lists, pa.array(own, lists.type)]).take(pa.array(order))
        return lists, none, odd[:0]

    def pre_tokens(self, piece: str) -> list[str]:
        """The tokenizer's pre-tokens of a piece, in the signs of its vocabulary."""
        found = self.parts.get(piece)
        if found is None:
            if _PLAIN.fullmatch(piece):
                plain = _PLAIN_WORD.findall(piece.lower()) if self.kind == "white" else _PLAIN_BYTE.findall(piece)
                found = [p.encode().decode("latin-1").translate(_SIGNS) for p in plain]
            else:
                norm = self.tokenizer.normalizer
                text = norm.normalize_str(piece) if norm else piece
                found = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            if len(self.parts) > MOST_PIECES:
                self.parts = {}
            if len(piece) <= _LONGEST_KEPT:
                self.parts[piece] = found
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has. Null counts as empty."""
        if self.kind is None:
            return _joined(self.library(texts.fill_null("").to_pylist()), self.dtype)
        lists, whole = self.cut(texts)
        coded = lists.flatten().dictionary_encode()
        self.round += 1
        places, keep = self._places(coded.dictionary.to_pylist())
        self.used[places] = self.round
        use = places[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = np.diff(self.at)[use]
        ends = np.cumsum(sizes)
        # Each id's place: where its piece starts, plus how far it lies in the piece.
        start = (self.at[use] - (ends - sizes)).astype(np.int32)
        out = self.flat[np.repeat(start, sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        self._forget(keep)
        offsets = lists.offsets.to_numpy()
        ends = np.concatenate([[0], ends])
        counts = ends[offsets[1:]] - ends[offsets[:-1]]
        if not len(whole):
            return out, counts
        parts = np.split(out, np.cumsum(counts)[:-1])
        for i, got in zip(whole, self.library(texts.take(whole).to_pylist()), strict=True):
            parts[i] = got
        return _joined(parts, self.dtype)


def _joined(parts: list[np.ndarray], dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), counts


def _kind(spec: dict) -> str | None:
    """``white``: white space is dropped and parts words; ``space``: byte-level, a space goes with what follows."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if spec.get("post_processor") or (spec.get("model") or {}).get("type") != "BPE" or spec["model"].get("dropout"):
        return None
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens") or []):
        return None
    if not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "space"
    parts = pre.get("pretokenizers") or [{}]
    steps = [n.get("type") for n in norm.get("normalizers") or []]
    if steps == ["NFC", "Replace", "Lowercase"] and parts[0].get("type") == "Split" and len(parts) == 2:
        if parts[0]["pattern"] == {"Regex": _WORD_SPLIT} and parts[0].get("invert") and parts[0]["behavior"] == "Removed":
            return "white"
    return None


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
