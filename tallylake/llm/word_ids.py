"""Token ids of texts, through a bounded memory of words already encoded."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import compress

import numpy as np
import public_tokenizers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Public vocabulary whose pre-tokenizer drops white space, so words are encoded independently of each other.
VOCABULARY = "word_bpe_49k.json"
#: A capital that a mark may follow: the tokenizer composes first, and some small letters compose where their capital does not.
_MARKED = re.compile(rb"[A-Z][\x80-\xff]")
#: Kinds of bytes of plain words, whose characters compose with nothing and have a small letter each at most: how the vocabulary cuts them follows from
#: these. No apostrophes, which it may cut with the letters after them; of UTF-8 just the letters from U+00C0 to U+017F.
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _MARK
for _some, _kind in ((b" ", _SPACE), (b"'", _ODD), (b"0123456789", _DIGIT), (range(0x41, 0x5B), _LETTER), (range(0x61, 0x7B), _LETTER), (range(0x80, 0xC0), _LETTER), (b"\xc3\xc4\xc5", _LETTER)):
    _KIND[list(_some)] = _kind
#: Pairs of bytes that plain words lack: multiplied by, divided by, a capital whose small letter is two characters, and what begins a special token.
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (0x3C, 0x7C))
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
#: Words that are encoded as one text.
_JOINED = 200


def default_vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def _pieces(words: list[bytes]) -> np.ndarray:
    """Into how many pieces the vocabulary cuts each of some words, if they are plain, and else 0: runs of letters or of marks, and single digits."""
    row = np.frombuffer(b" ".join([*words, b""]), np.uint8)
    kind = _KIND[row]
    starts = kind > _SPACE
    starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    odd = kind == _ODD
    for one, two in _ODD_PAIRS:
        odd[:-1] |= (row[:-1] == one) & (row[1:] == two)
    ends = np.flatnonzero(kind == _SPACE)
    per_word = lambda x: np.diff(np.cumsum(x, dtype=np.int64)[ends], prepend=0)
    pieces = per_word(starts)
    if odd.any():
        pieces[per_word(odd) > 0] = 0
    return pieces


class WordIds:
    """Encodes white-space separated words; keeps those used lately, at most about ``capacity`` of them.

    Only for vocabularies that drop white space and capitals. ASCII white space ends a word for the
    tokenizer too and no special token contains any, so a text's ids are those of its words
    one after another. Many plain words are encoded as one text: a token that ends a piece of a word is marked as such
    in the vocabulary, and the number of a word's pieces tells its last one.
    """

    def __init__(self, path: str, capacity: int):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.size, self.capacity, self.known, self.older = size, capacity, {}, {}
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        suffix = made["model"].get("end_of_word_suffix")
        #: Whether an id ends a piece; None for vocabularies that cut words otherwise.
        self.ends = None
        if suffix and _PATTERN in json.dumps(made["pre_tokenizer"]).replace("\\\\", "\\"):
            self.ends = np.zeros(size, bool)
            self.ends[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True
        #: For plain words in small letters, which a normalizer that composes and lowers would leave as they are.
        self.bare = self.tokenizer
        if made["normalizer"] == _NORMALIZER:
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = Sequence([])

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        for k in range(0, len(words), 10_000):
            part = words[k : k + 10_000]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            out.update((w, np.array(e.ids, self.dtype).tobytes()) for w, e in zip(part, found, strict=True))
        return out

    def _encode_plain(self, words: list[bytes]) -> tuple[dict[bytes, bytes], list[bytes]]:
        """The plain ones of some words, and the others."""
        pieces = np.concatenate([_pieces(words[k : k + 10_000]) for k in range(0, len(words), 10_000)])
        out, others, size = {}, [], self.dtype.itemsize
        if not pieces.all():
            plain = pieces > 0
            others = list(compress(words, (~plain).tolist()))
            words, pieces = list(compress(words, plain.tolist())), pieces[plain]
        for k in range(0, len(words), 50 * _JOINED):
            parts = [words[a : a + _JOINED] for a in range(k, min(k + 50 * _JOINED, len(words)), _JOINED)]
            found = self.bare.encode_batch_fast([b" ".join(p).decode().lower() for p in parts], add_special_tokens=False)
            for i, (part, e) in enumerate(zip(parts, found, strict=True)):
                ids = np.array(e.ids, self.dtype)
                first = k + i * _JOINED
                stops, cut = np.flatnonzero(self.ends[ids]) + 1, np.cumsum(pieces[first : first + len(part)])
                if len(stops) != cut[-1]:
                    raise ValueError("the vocabulary cuts words in another way")
                held, stops = ids.tobytes(), (stops[cut - 1] * size).tolist()
                out.update(zip(part, [held[a:b] for a, b in zip([0, *stops], stops, strict=False)], strict=True))
        return out, others

    @staticmethod
    def split(text: bytes | None) -> list[bytes]:
        """The words of a text, A-Z in lower case as the vocabulary has them; not where a special token or a composed letter may be meant."""
        text = text or b""
        if b"<|" in text:
            return text.split()
        lower = text.lower()
        if not text.isascii() and (marked := [m.start() for m in _MARKED.finditer(text)]):
            lower = bytearray(lower)
            for k in marked:
                lower[k] = text[k]
            lower = bytes(lower)
        return lower.split()

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Make sure that all of ``words`` are known; just theirs are returned, which is faster to look up."""
        known, older = self.known, self.older
        again = words & known.keys()
        found = dict(zip(again, map(known.__getitem__, again), strict=True))
        new = words.difference(again)
        if not new:
            return found
        if len(known) + len(new) > self.capacity // 2:
            self.known, self.older = known, older = dict(found), known
        again = {w: ids for w in new if (ids := older.get(w)) is not None} if older else {}
        new = list(new.difference(again))
        if new and self.ends is not None:
            plain, new = self._encode_plain(new)
            known.update(plain)
            found.update(plain)
        again |= self._encode(new)
        known.update(again)
        found.update(again)
        return found

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of some known words, as bytes."""
        return list(map(self.known.__getitem__, words))

    def texts(self, texts: list[bytes | None], block_bytes: int = 4 << 20):
        """The ids of each text (none for None), in order; about ``block_bytes`` of text are in work at a time."""
        block, held = [], 0
        for text in texts:
            block.append(self.split(text))
            held += len(text or b"")
            if held >= block_bytes:
                yield from self._block(block)
                block, held = [], 0
        yield from self._block(block)

    def _block(self, block: list[list[bytes]]):
        known = self.learn(set().union(*block))
        for words in block:
            yield b"".join(map(known.__getitem__, words))


#: Words remembered by a process, unless said otherwise.
REMEMBERED = 1_000_000


@lru_cache(1)
def shared(path: str, capacity: int = REMEMBERED) -> WordIds:
    """One for the process, so that a Python worker's next task finds the words of the last one."""
    return WordIds(path, capacity)
