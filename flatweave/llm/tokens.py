"""Token ids of whole texts."""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from flatweave.llm.common import ENTRY_BYTES, LONGEST_KEPT, STORE_BYTES, kept_in_worker

END = 0
ID_BYTES = 4
_BYTES_AT_ONCE = 2 << 20  # of texts that are cut together; a longer one is cut alone
_PIECES_AT_ONCE = 250_000
_TOGETHER = 2_048  # bytes; longer texts are slower by the word

# What each byte of UTF-8 is part of, and further marks.
_LETTER, _DIGIT, _SIGN, _SPACE, _LINE, _OTHER = range(6)
_WHITE, _WIDE = 8, 16  # is white space; may begin white space of several bytes
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[0x21:0x7F] = [_LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _SIGN for b in range(0x21, 0x7F)]
_KINDS[ord("'")] = _OTHER  # may begin a piece such as 've
_KINDS[ord(" ")], _KINDS[ord("\n")] = _SPACE, _LINE
_KINDS[0x80:0xC0] = _LETTER  # not the first byte of a character, which decides
_KINDS[0xC3:0xCA] = _LETTER  # U+00C0 to U+024F, all letters but the signs below
_KINDS[0xD0:0xD2] = _LETTER  # U+0400 to U+047F
_SIGNS_AFTER_C3 = (0x97, 0xB7)

_KINDS[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] |= _WHITE
_WIDE_WHITE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_KINDS[list({char[0] for char in _WIDE_WHITE})] |= _WIDE
_KIND_TABLE = _KINDS.tobytes()


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Where a tokenizer file lies; each Python worker asks for itself."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _cuts(text: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin, and which of them only the tokenizer can cut further.

    ``text`` holds texts one after the other, none empty, from ``begins`` to ``ends``.
    """
    data = np.frombuffer(text, np.uint8)
    marks = np.frombuffer(text.translate(_KIND_TABLE), np.uint8)
    kinds, white = marks & 7, marks & _WHITE != 0
    first = np.flatnonzero(data[:-1] == 0xC3)
    kinds[first[np.isin(data[first + 1], _SIGNS_AFTER_C3)]] = _OTHER
    first = np.flatnonzero(marks & _WIDE)
    found = [data[np.minimum(first + k, len(data) - 1)] for k in range(3)]
    for char in _WIDE_WHITE if len(first) else ():
        same = first[np.logical_and.reduce([own == byte for own, byte in zip(found, char)])]
        for k in range(len(char)):
            white[same + k] = True
    beside = np.zeros(len(data), bool)  # white space or the end of the text
    beside[1:] = white[:-1]
    beside[begins] = False
    beside[:-1] |= white[1:]
    beside[ends - 1] = True
    space = kinds == _SPACE
    words = space & ~beside
    words[begins] = True
    pieces = words.copy()
    pieces[1:] |= (kinds[1:] != kinds[:-1]) & ~space[:-1]
    odd = np.flatnonzero((kinds == _OTHER) | ((space | (kinds == _LINE)) & beside))
    starts = np.flatnonzero(words)
    whole = np.zeros(len(starts), bool)
    whole[np.searchsorted(starts, odd, "right") - 1] = True
    cuts = np.flatnonzero(pieces)
    own = words[cuts]
    whole = whole[np.cumsum(own) - 1]
    kept = own | ~whole
    cuts = cuts[kept]
    return cuts, whole[kept] | (kinds[cuts] == _LINE)


def _together(pieces: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of pieces that are encoded at once."""
    sizes = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    ends = [*(np.flatnonzero(np.diff(sizes // _TOGETHER)) + 1).tolist(), len(pieces)]
    return (pieces[a:b] for a, b in zip([0, *ends], ends) if b > a)


def _slices(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values of an array that begins its buffers; quicker than one by one."""
    _, offsets, data = values.buffers()
    data, offsets = data.to_pybytes(), np.frombuffer(offsets, np.int64)[: len(values) + 1].tolist()
    return [data[a:b] for a, b in zip(offsets, offsets[1:])]


def _packed(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers.

    A byte-level tokenizer with the usual pre-tokenizer starts a new piece at every space that has other
    than white space on both sides.  What lies between such spaces falls into runs of letters, digits and signs and
    single line ends if it holds nothing else: those are its pieces, and each is encoded once for all its repeats.  A
    word with anything else, such as an apostrophe, other white space or letters that are not Latin or Cyrillic, is encoded as it is.
    The ids are those of encoding the whole text (see the tests), in which the text of a special token
    is ordinary text, as the notes of the tokenizer files say.  Pieces are kept in ``most`` bytes, long ones never.
    """

    def __init__(self, path: str, most: int = STORE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        # The same model for pieces that are cut already, in the signs that the model has for bytes.
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        bytes_of = [(chr(c).encode(), signs(chr(c))[0][0]) for c in (0x0A, 0x20, *range(0x80, 0x800))]
        pairs = sorted({(chr(byte), sign) for own, made in bytes_of for byte, sign in zip(own, made)})
        self._signs = [(byte, sign) for byte, sign in pairs if byte != sign]
        self._known: dict[bytes, bytes] = {}  # of pieces
        self._first: dict[bytes, bytes] = {}  # of words that the tokenizer cuts first
        self._most, self.bytes = most, 0
        self._line = np.frombuffer(self._encode([b"\n"])[0], "<u4")[0]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast([text.decode() for text in texts], add_special_tokens=False)
        return [_packed(one.ids) for one in found]

    def _whole(self, words: list[bytes]) -> list[bytes]:
        return [ids for some in _together(words) for ids in self._encode(some)]

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces without line ends, which part them."""
        made = []
        for some in _together(pieces):
            text = b"\x00\n\x00".join(some).decode("latin-1")
            for byte, sign in self._signs:
                text = text.replace(byte, sign)
            [found] = self._model.encode_batch_fast([text.replace("\x00", " ")], add_special_tokens=False)
            ids = _packed(found.ids)
            at = (ID_BYTES * np.flatnonzero(np.frombuffer(ids, "<u4") == self._line)).tolist()
            made += [ids[a:b] for a, b in zip([0, *(one + ID_BYTES for one in at)], [*at, len(ids)])]
        return made

    def _keep(self, known: dict[bytes, bytes], pieces: list[bytes], ids: list[bytes]) -> None:
        if max(map(len, pieces), default=0) > LONGEST_KEPT:
            short = [at for at, piece in enumerate(pieces) if len(piece) <= LONGEST_KEPT]
            pieces, ids = [pieces[at] for at in short], [ids[at] for at in short]
        cost = sum(map(len, pieces)) + sum(map(len, ids)) + (ENTRY_BYTES + 2 * sys.getsizeof(b"")) * len(pieces)
        if self.bytes + cost <= self._most:
            self.bytes += cost
            known.update(zip(pieces, ids))

    def _of(self, pieces: list[bytes], whole: list[bool], most: int) -> list[bytes]:
        """The ids of different pieces, of ``most`` in all.

        New ones are kept while there is room: the first met are the frequent ones.
        """
        made = list(map(self._known.get, pieces))
        missing = [at for at, ids in enumerate(made) if ids is None]
        parts = [at for at in missing if not whole[at]]
        words = []
        for at in missing:
            if whole[at]:
                made[at] = self._first.get(pieces[at])
                if made[at] is None:
                    words.append(at)
        new = len(parts) + len(words)
        if 3 * new > most and self.bytes + 2 * ENTRY_BYTES * new > self._most:
            self._known, self._first, self.bytes = {}, {}, 0  # the texts have changed, and what is kept no longer helps
        for places, known, encode in ((parts, self._known, self._pieces), (words, self._first, self._whole)):
            some = [pieces[at] for at in places]
            found = encode(some)
            self._keep(known, some, found)
            for at, ids in zip(places, found):
                made[at] = ids
        return made

    def ids(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text (null: empty), without an end id."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        made, first = [], 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BYTES_AT_ONCE, "right")) - 1)
            made += self._ids(data, offsets[first : last + 1])
            first = last
        return made

    def _ids(self, data: pa.Buffer | None, bounds: np.ndarray) -> list[bytes]:
        """The ids of texts between ``bounds``."""
        size = int(bounds[-1] - bounds[0])
        if not size:
            return [b""] * (len(bounds) - 1)
        text = data[int(bounds[0]) : int(bounds[-1])].to_pybytes()
        bounds = bounds - bounds[0]
        filled = bounds[1:] > bounds[:-1]
        cuts, whole = _cuts(text, bounds[:-1][filled], bounds[1:][filled])
        offsets = np.append(cuts, size)
        # Pieces follow one another in the texts, so that an array of them needs no copy.
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        made, counts = [], []
        for first in range(0, len(cuts), _PIECES_AT_ONCE):
            own = pieces[first : first + _PIECES_AT_ONCE].dictionary_encode()
            numbers = own.indices.to_numpy()
            different = _slices(own.dictionary)
            odd = np.zeros(len(different), bool)
            odd[numbers] = whole[first : first + _PIECES_AT_ONCE]
            ids = self._of(different, odd.tolist(), len(own))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
            starts = np.cumsum(lengths) - lengths
            count = lengths[numbers]
            places = np.repeat(starts[numbers] - (np.cumsum(count) - count), count)
            places += np.arange(len(places))
            made.append(np.frombuffer(b"".join(ids), "<u4")[places].tobytes())
            counts.append(count)
        joined = b"".join(made) if len(made) > 1 else made[0]
        ends = ID_BYTES * np.cumsum(np.concatenate([[0], *counts]))
        ends = ends[np.searchsorted(cuts, bounds)].tolist()
        return [joined[a:b] for a, b in zip(ends, ends[1:])]


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return kept_in_worker(f"tokens-{path}", lambda: Encoder(path))
