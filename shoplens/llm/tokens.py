"""Encoding texts with a public byte-level BPE tokenizer file.

A text is cut before every single space that a non-space follows.  The
tokenizer's own pattern always starts a new piece there, so the ids of the
parts, concatenated, are the ids of the whole text; words repeat, and a cache
holds the ids of those seen before.  ``tests/llm`` compares whole texts with
the library's own result."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import take_over

DEFAULT_FILE = "byte_bpe_50k.json"
#: A space that no word follows; such texts are cut by the slower pattern.
_ODD = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
#: Letters of Latin scripts, and what the usual byte-level pattern cuts words of
#: printable ASCII, such letters and single line ends into.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\n")
_PIECES_KEPT = 100_000
_MARKS = 1 << 23


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_LETTER_OF = {b: c for c, b in byte_letters().items()}
_SPACE = _LETTER_OF[ord(" ")]


class Encoder:
    """Encodes lists of texts; one per Python worker and file."""

    def __init__(self, path: str, cache_words: int = 400_000, longest_cached: int = 32):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: Ids of words after a space, and of words that begin a text: those of
        #: late, and those before them.
        self.inner: list[dict[str, bytes]] = [{}, {}]
        self.first: list[dict[str, bytes]] = [{}, {}]
        self.cache_words, self.longest = cache_words, longest_cached
        #: Marks of the words met so far, and how many.
        self.met, self.n_met = bytearray(_MARKS), 0
        #: The library's model takes one piece at a time, without the cost of a
        #: whole encoding; only where the pieces are cut as ``_PIECES`` does.
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        pattern = self.tokenizer.pre_tokenizer
        cut = json.loads(pattern.__getstate__()) if pattern is not None else {}
        self.usual = (
            self.tokenizer.normalizer is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
        )

    def plain(self, texts: list[str]) -> list[list[int]]:
        """Ids as the library itself gives them."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @cached_property
    def _whole(self) -> re.Pattern:
        """What makes a word go to the library whole: signs that ``_PIECES`` is
        not made for, more than one white space, special tokens."""
        return re.compile("|".join([rf"[^!-~{_LATIN}\n]", r"\A\n", r"\n\n", *map(re.escape, self.special)]))

    def _of_words(self, words: list[str], space: str) -> list[list[int]]:
        """Ids of words, each with ``space`` before it."""
        return [array("I", ids).tolist() for ids in self._coded(words, space)]

    def _coded(self, words: list[str], space: str) -> list[bytes]:
        """As ``_of_words``, the ids as 32-bit integers."""
        if not self.usual:
            return [array("I", ids).tobytes() for ids in self.plain([space + w for w in words])]
        out, left = [], []
        if len(self.pieces) > _PIECES_KEPT:
            self.pieces.clear()
        pieces, longest, tokenize, whole = self.pieces, self.longest, self.model.tokenize, self._whole.search
        plain_letters = not any(t.isalpha() for t in self.special)
        for k, word in enumerate(words):
            single = word.isalpha()  # a piece by itself, and kept as a word
            if not (single and plain_letters and word.isascii()) and (not word or whole(word)):
                left.append(k)
                out.append(b"")
                continue
            data = []
            for piece in (space + word,) if single else _PIECES.findall(space + word):
                known = pieces.get(piece)
                if known is None:
                    if piece.isascii() and piece != "\n":
                        letters = piece.replace(" ", _SPACE)
                    else:
                        letters = piece.encode("utf-8").decode("latin-1").translate(_LETTER_OF)
                    known = array("I", [t.id for t in tokenize(letters)]).tobytes()
                    if not single and len(piece) <= longest:
                        pieces[piece] = known
                data.append(known)
            out.append(data[0] if len(data) == 1 else b"".join(data))
        for k, ids in zip(left, self.plain([space + words[k] for k in left]), strict=True):
            out[k] = array("I", ids).tobytes()
        return out

    def _words(self, words: list[str], cache: list[dict[str, bytes]], space: str) -> list[bytes]:
        """Ids of unlike words.  Most words are rare and never come again: a
        word is kept when it is met the second time (or a word with its mark
        was).  When the late ones are half of what may be kept, the earlier
        ones go, but for those that were used since."""
        late, earlier = cache
        found = list(map(late.get, words))
        missing = [i for i, data in enumerate(found) if data is None]
        if earlier:
            for i in missing:
                data = earlier.pop(words[i], None)
                if data is not None:
                    found[i] = late[words[i]] = data
            missing = [i for i in missing if found[i] is None]
        met, longest = self.met, self.longest
        if self.n_met > _MARKS // 2:
            met[:] = bytes(_MARKS)
            self.n_met = 0
        for begin in range(0, len(missing), 20_000):
            part = missing[begin : begin + 20_000]
            for i, data in zip(part, self._coded([words[i] for i in part], space), strict=True):
                found[i] = data
                word = words[i]
                mark = hash(word) % _MARKS
                if not met[mark]:
                    met[mark] = 1
                    self.n_met += 1
                elif len(word) <= longest:
                    late[word] = data
            if 2 * len(late) > self.cache_words:
                cache[:] = late, earlier = {}, late
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and where each text begins in them
        (one more entry than texts)."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        odd = [i for i, t in enumerate(texts) if _ODD.search(t)]
        if odd:
            is_odd = set(odd)
            parts = pa.array([_CUT.split(t) if i in is_odd else t.split(" ") for i, t in enumerate(texts)], pa.list_(pa.large_string()))
            bounds, flat = np.asarray(parts.offsets).astype(np.int64), parts.values
        else:
            parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
            bounds, flat = np.asarray(parts.offsets).astype(np.int64), parts.values
        words = flat.dictionary_encode()
        at = np.asarray(words.indices).astype(np.int64)
        # The first part of a text has no space before it.
        inner = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts = flat.take(pa.array(bounds[:-1])).dictionary_encode()
        at[bounds[:-1]] = np.asarray(firsts.indices).astype(np.int64) + len(inner)
        known = self._words(inner, self.inner, " ") + self._words(firsts.dictionary.to_numpy(zero_copy_only=False).tolist(), self.first, "")
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), np.uint32)
        begin = np.cumsum(size) - size
        n = size[at]
        ends = np.cumsum(n)
        out = ids[np.repeat(begin[at] - (ends - n), n) + np.arange(ends[-1])]
        return out, np.concatenate([[0], ends])[bounds]

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens, concatenated by id, and each token's length."""
        letters = byte_letters()
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens[i] = special[i].encode() if i in special else bytes(letters[c] for c in token)
        return np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64)

    @property
    def lengths(self) -> np.ndarray:
        """Bytes of each id's token."""
        return self._table[1]

    @cached_property
    def special(self) -> list[str]:
        return [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, special ones included."""
        if not len(ids):
            return b""
        data, size = self._table
        begin = np.cumsum(size) - size
        n = size[ids]
        ends = np.cumsum(n)
        return data[np.repeat(begin[ids] - (ends - n), n) + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encoder(path: str) -> Encoder:
    take_over("encoder", _encoder.cache_clear)
    return _encoder(path)
