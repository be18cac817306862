"""Byte-level BPE of many texts: pieces are cut in bulk and each distinct one is encoded once.

A byte-level BPE tokenizer cuts a text into pieces and encodes each piece by itself,
so equal pieces have equal ids. Cutting is done here for many texts at once; the
ids of a piece come from the tokenizers library. Texts that hold an added token, or a
code point that Python's tables do not know, go whole to the library.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from snapstrata.llm.words import _BYTE_VALUES, mix, powers

#: Pieces handed to the tokenizer at once; its results are large objects.
AT_ONCE = 1 << 9
APART = "\x00"
#: Distinct pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 500_000
#: Bytes of all remembered pieces, which matters where pieces are very long.
REMEMBERED_BYTES = 1 << 25

BLANK, LETTER, NUMBER, OTHER = range(4)
# White space by the pattern language's \s, and the cut-off endings.
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each code point, and whether it is unassigned: the library may know it by newer tables."""
    kinds, unassigned = np.full(0x110000, OTHER, np.uint8), np.zeros(0x110000, bool)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        if category[0] == "L":
            kinds[c] = LETTER
        elif category[0] == "N":
            kinds[c] = NUMBER
        unassigned[c] = category == "Cn"
    kinds[list(WHITE)] = BLANK
    return kinds, unassigned


def first_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each UTF-8 character and the place where it stands."""
    if not (data >= 0x80).any():
        return data, np.arange(len(data))
    at = np.flatnonzero((data & 0xC0) != 0x80)
    return data[at], at


def long_characters(data: np.ndarray, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which characters have several bytes, and their code points."""
    several = np.flatnonzero(codes >= 0xC0)
    places, lead = at[several], codes[several].astype(np.uint32)
    sizes = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    points = lead & np.where(sizes == 2, 0x1F, np.where(sizes == 3, 0x0F, 0x07)).astype(np.uint32)
    for i in (1, 2, 3):
        more = sizes > i
        following = data[places[more] + i].astype(np.uint32) & 0x3F
        points[more] = (points[more] << np.uint32(6)) | following
    return several, points


def piece_starts(codes: np.ndarray, first: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each character; ``first`` marks where texts begin.

    ``codes`` are first bytes, ``kind`` the kinds of the characters.

    A piece is a run of letters, of numbers or of other signs, with one blank before
    it; the rest of white space before it, or all at the end of a text, is a piece; an
    apostrophe at the beginning of a piece takes its ending along.
    """
    n = len(codes)
    white = kind == BLANK
    before_white, before_blank, before_same = (np.zeros(n, bool) for _ in range(3))
    before_white[1:], before_blank[1:] = white[:-1], codes[:-1] == 0x20
    before_same[1:] = kind[1:] == kind[:-1]
    next_solid = np.zeros(n, bool)
    next_solid[:-1] = ~white[1:] & ~first[1:]
    start = np.where(
        white, first | ~before_white | next_solid,
        first | (before_white & ~before_blank) | (~before_white & ~before_same),
    )
    quotes = np.flatnonzero((codes == 0x27) & start)
    ends = np.append(first, True)
    padded = np.append(codes, np.zeros(3, codes.dtype))
    open_ = quotes
    for ending in ENDINGS:
        fits = np.ones(len(open_), bool)
        for i, letter in enumerate(ending, 1):
            fits &= (padded[open_ + i] == ord(letter)) & ~ends[np.minimum(open_ + i, n)]
        hit = open_[fits]
        start[hit + 1] = False
        if len(ending) == 2:
            start[hit + 2] = False
        after = hit + 1 + len(ending)
        after = after[after < n]
        # Letters that go on after the ending are a piece of their own.
        start[after[kind[after] == LETTER]] = True
        open_ = open_[~fits]
    return start


class PieceEncoder:
    """Encodes texts with a byte-level BPE file; one for each Python worker."""

    _made: dict[str, PieceEncoder] = {}

    def __init__(self, path: str):
        # Spark runs a worker on every core; threads within a worker only add work.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.library = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        # A vocabulary takes some 25 MB in each worker, so all three read the same one.
        self.tokenizer, self.joined = Tokenizer(self.library.model), Tokenizer(self.library.model)
        self.tokenizer.normalizer = self.joined.normalizer = self.library.normalizer
        bytes_only = ByteLevel(add_prefix_space=False, use_regex=False)
        self.tokenizer.pre_tokenizer = bytes_only
        # Many pieces in one text, set apart by a sign that none of them holds: one result for all of them.
        self.joined.pre_tokenizer = Sequence([Split(APART, "isolated"), bytes_only])
        self.apart = self.joined.encode(APART, add_special_tokens=False).ids
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.kinds, self.unassigned = _kinds()
        self.forget()

    @classmethod
    def shared(cls, path: str) -> PieceEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.entries = np.zeros(0, np.int64)
        self.begins = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        # The bytes of each entry, which prove a hit.
        self.spelt, self.spelt_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end_id``, and the number for each text."""
        rows = len(offsets) - 1
        if not len(data):
            return np.full(rows, end_id, np.uint32), np.ones(rows, np.int64)
        codes, at = first_bytes(data)
        several, points = long_characters(data, codes, at)
        kind = self.kinds[codes]
        kind[several] = self.kinds[points]
        whole = self._whole_texts(data, offsets, at[several[self.unassigned[points]]])
        if not whole.any():
            return self._cut(data, offsets, codes, kind, at, end_id)
        ids, counts = [], []
        turns = np.flatnonzero(whole[1:] != whole[:-1]) + 1
        for i, j in zip([0, *turns.tolist()], [*turns.tolist(), rows], strict=True):
            begin, end = int(offsets[i]), int(offsets[j])
            if whole[i]:
                for k in range(i, j):
                    text = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8")
                    own = [*self.library.encode(text, add_special_tokens=False).ids, end_id]
                    ids.append(np.array(own, np.uint32))
                    counts.append(np.array([len(own)], np.int64))
            elif begin == end:
                ids.append(np.full(j - i, end_id, np.uint32))
                counts.append(np.ones(j - i, np.int64))
            else:
                low, high = np.searchsorted(at, (begin, end))
                found = self._cut(
                    data[begin:end], offsets[i : j + 1] - begin, codes[low:high], kind[low:high],
                    at[low:high] - begin, end_id,
                )
                ids.append(found[0])
                counts.append(found[1])
        return np.concatenate(ids), np.concatenate(counts)

    def _whole_texts(self, data, offsets, unassigned) -> np.ndarray:
        """Whether each text holds an added token or one of the unassigned code points."""
        places = [unassigned]
        raw = data.tobytes()
        for token in self.added:
            found, place = [], raw.find(token)
            while place >= 0:
                found.append(place)
                place = raw.find(token, place + 1)
            places.append(np.array(found, np.int64))
        whole = np.zeros(len(offsets) - 1, bool)
        whole[np.searchsorted(offsets, np.concatenate(places), "right") - 1] = True
        return whole

    def _cut(self, data, offsets, codes, kind, at, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        first = np.zeros(len(codes), bool)
        first[np.searchsorted(at, offsets[:-1][offsets[:-1] < len(data)])] = True
        starts = at[piece_starts(codes, first, kind)]
        sizes = np.diff(starts, append=len(data))
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        terms = _BYTE_VALUES[data] * powers(place)
        hashes = mix(np.add.reduceat(terms, starts) + sizes.astype(np.uint64))
        entry = self._entries(hashes, data, starts, sizes)
        lengths = (self.begins[1:] - self.begins[:-1])[entry]
        text = np.searchsorted(starts, offsets)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        counts = ends[text[1:]] - ends[text[:-1]]
        pick = np.arange(ends[-1]) + np.repeat(self.begins[entry] - ends[:-1], lengths)
        out = np.full(int(ends[-1]) + rows, end_id, np.uint32)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(counts + 1) - 1] = False
        out[inside] = self.flat[pick]
        return out, counts + 1

    def _entries(self, hashes, data, starts, sizes) -> np.ndarray:
        """The remembered entry of each piece; what only shares its hash gets one of its own."""
        unique, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > REMEMBERED or len(self.spelt) > REMEMBERED_BYTES:
            self.forget()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == unique
        new = where[~known]
        if len(new):
            first = self._learn(data, starts[new], sizes[new])
            self.keys = np.insert(self.keys, at[~known], unique[~known])
            self.entries = np.insert(self.entries, at[~known], first + np.arange(len(new)))
            at = np.searchsorted(self.keys, unique)
        entry = self.entries[at][back]
        other = np.flatnonzero(~self._spelt_alike(entry, data, starts, sizes))
        if len(other):
            entry[other] = self._learn(data, starts[other], sizes[other]) + np.arange(len(other))
        return entry

    def _learn(self, data, starts, sizes) -> int:
        """Encode pieces, remember their bytes and ids, and return the first of their entries."""
        count, flat, sizes_of = len(self.begins) - 1, [self.flat], [np.zeros(0, np.int64)]
        ends = np.cumsum(sizes)
        spelt = data[np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]))]
        for i in range(0, len(starts), AT_ONCE):
            own = sizes[i : i + AT_ONCE]
            begin = int(ends[i] - sizes[i])
            found, lengths = self._ids_of(spelt[begin : begin + int(own.sum())], own)
            flat.append(found)
            sizes_of.append(lengths)
        sizes_of = np.concatenate(sizes_of)
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(sizes_of)))
        self.flat = np.concatenate(flat)
        self.spelt = np.concatenate((self.spelt, spelt))
        self.spelt_at = np.concatenate((self.spelt_at, self.spelt_at[-1] + np.cumsum(sizes)))
        return count

    def _ids_of(self, spelt: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has; ``spelt`` are their bytes."""
        if len(self.apart) == 1 and spelt.all():
            # A byte of 0 between any two of them.
            text = np.zeros(len(spelt) + len(sizes) - 1, np.uint8)
            text[np.arange(len(spelt)) + np.repeat(np.arange(len(sizes)), sizes)] = spelt
            (encoding,) = self.joined.encode_batch_fast([text.tobytes().decode("utf-8")], add_special_tokens=False)
            ids = np.array(encoding.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.apart[0])
            if len(cuts) == len(sizes) - 1:
                lengths = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
                return np.delete(ids, cuts), lengths
        # A piece holds the sign itself, or the vocabulary has no id of its own for it.
        raw, ends = spelt.tobytes(), np.cumsum(sizes).tolist()
        texts = [raw[e - n : e].decode("utf-8") for e, n in zip(ends, sizes.tolist(), strict=True)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter((i for x in found for i in x), np.uint32), np.array(list(map(len, found)), np.int64)

    def _spelt_alike(self, entry, data, starts, sizes) -> np.ndarray:
        """Whether each piece has the bytes of its entry."""
        alike = np.diff(self.spelt_at)[entry] == sizes
        if not alike.all():
            # Bytes are compared below for pieces of equal length only.
            out = alike.copy()
            out[alike] = [
                data[s : s + n].tobytes() == self.spelt[b : b + n].tobytes()
                for s, n, b in zip(starts[alike], sizes[alike], self.spelt_at[entry[alike]], strict=True)
            ]
            return out
        shift = self.spelt_at[entry] - starts
        differs = self.spelt[np.arange(len(data)) + np.repeat(shift, sizes)] != data
        if not differs.any():
            return alike
        alike[np.searchsorted(starts, np.flatnonzero(differs), "right") - 1] = False
        return alike
