"""Ids of whole texts by a word-wise BPE tokenizer file, batch by batch.

The tokenizer file drops white space, lower-cases, and cuts a text into contractions, runs of letters, single digits and
runs of marks, each of which the BPE model turns into ids by itself. So a batch of texts is cut into such parts with
array operations over its bytes, equal parts become one entry of a dictionary, only the dictionary's new entries go to
the model, and the ids of the batch are gathered from the entries.

What the array operations do not cover (other characters than those of ASCII and the letters of Latin-1, control
characters, and the tokenizer's special tokens) is left to the whole tokenizer, one word between white space at a
time; no rule of the tokenizer reaches over white space.

A null text has no ids. Very long texts are cut at white space into blocks, so memory follows the block, not the text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once (a longer word alone may be more).
BLOCK_BYTES = 4 << 20
#: Distinct parts a worker remembers, up to twice as many and those of one block: with more than that, the ones met
#: last are kept and the older ones are forgotten unless they come again. Results do not depend on it.
REMEMBERED = 300_000

GAP, LETTER, DIGIT, MARK, OTHER = range(5)
LEAD = 0xC3  # first byte of U+00C0 to U+00FF
TIMES, DIVISION = 0x97, 0xB7  # second bytes of the two signs among these letters
APOSTROPHE = ord("'")


def byte_classes() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for byte in range(33, 127):
        char = chr(byte)
        kinds[byte] = LETTER if char.isalpha() else DIGIT if char.isdigit() else MARK
    kinds[[*b" \n\t\r"]] = GAP
    return kinds


CLASSES = byte_classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


#: What the array operations cut; all else is a word for the whole tokenizer.
PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """values[i + by], 0 beyond the end."""
    out = np.zeros_like(values)
    out[: len(values) - by] = values[by:]
    return out


def parts_of(raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes without gaps, offsets of the parts in them, places of the parts' first bytes in `raw`).

    `raw` holds UTF-8 texts one after the other, `firsts` where each begins.
    """
    kind, low = CLASSES[raw], LOWER[raw]
    lead = np.flatnonzero(raw == LEAD)
    if len(lead):
        second = raw[lead + 1]
        letters = (second != TIMES) & (second != DIVISION)
        at = lead[letters]
        kind[at] = kind[at + 1] = LETTER
        upper = at[second[letters] <= 0x9E]
        low[upper + 1] += 32
    begins = np.zeros(len(raw) + 1, bool)
    begins[firsts] = True
    begins = begins[: len(raw)]  # an empty last text begins behind the end
    filled = kind != GAP
    before = np.empty_like(kind)
    before[:1], before[1:] = GAP, kind[:-1]
    start = filled & ((kind != before) | (kind == DIGIT) | begins)

    other = kind == OTHER
    bar = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")) & ~begins[1:])
    other[bar] = True  # a special token may begin here
    if other.any():
        word = filled & ((before == GAP) | begins)
        number = np.cumsum(word, dtype=np.int32)
        whole = np.zeros(int(number[-1]) + 1, bool)
        whole[number[other]] = True
        inside = whole[number] & filled
        start = np.where(inside, word, start)
        low = np.where(inside, raw, low)
    else:
        inside = None

    quote = np.flatnonzero((low == APOSTROPHE) & start)
    if inside is not None:
        quote = quote[~inside[quote]]
    if len(quote):
        # A contraction lies within one text: behind the first byte of the next text nothing is looked at.
        own = np.where(begins, np.uint8(0), low)
        one = shifted(own, 1)[quote]
        two = np.where(one > 0, shifted(own, 2)[quote], 0)
        short = np.isin(one, [*b"stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for taken, length in ((short, 2), (long, 3)):
            at = quote[taken]
            start[at + 1] = False
            behind = at + length
            behind = behind[behind < len(raw)]
            start[behind] = filled[behind]

    places = np.flatnonzero(start)
    packed = low[filled]
    offsets = np.empty(len(places) + 1, np.int32)
    offsets[:-1] = np.cumsum(filled, dtype=np.int32)[places] - 1
    offsets[-1] = len(packed)
    return packed, offsets, places


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, where each text begins in them, which text it is): the texts in order, long ones in several blocks."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        low, high = int(offsets[first]), int(offsets[last])
        if last > first + 1 or high - low <= most:
            yield raw[low:high], offsets[first:last] - low, np.arange(first, last)
        else:
            while low < high:
                cut = min(low + most, high)
                if cut < high:
                    gaps = np.flatnonzero(CLASSES[raw[low:cut]] == GAP)
                    later = np.zeros(0, np.int64) if len(gaps) else np.flatnonzero(CLASSES[raw[cut:high]] == GAP)
                    cut = low + int(gaps[-1]) + 1 if len(gaps) else cut + int(later[0]) if len(later) else high
                yield raw[low:cut], np.zeros(1, np.int64), np.array([first])
                low = cut
        first = last


class WordIds:
    """Ids of texts by one tokenizer file, which is opened where the object is used."""

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None

    def __reduce__(self):
        return WordIds, (self.path,)

    def _open(self) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.model = self.tokenizer.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in printable)
        # The byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on.
        self.alphabet = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.number: dict[bytes, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])
        self.older = ({}, np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _forget(self) -> None:
        """Starts anew with the parts met so far as the older half; what was older than that is forgotten."""
        ends = np.frombuffer(self.ends, np.int64)
        ids = np.frombuffer(self.ids, np.uint32)
        self.older = (self.number, ids.copy(), ends.copy())
        self.number, self.ids, self.ends = {}, array("I"), array("q", [0])

    def _make(self, part: bytes) -> int:
        """The number of a part that is not among the newer ones."""
        numbers, ids, ends = self.older
        old = numbers.get(part)
        if old is not None:
            self.ids.frombytes(ids[ends[old] : ends[old + 1]].tobytes())
        elif b"<|" not in part and PLAIN.fullmatch(part):
            spelled = part.decode() if part.isascii() else part.decode("latin-1").translate(self.alphabet)
            self.ids.extend([t.id for t in self.model.tokenize(spelled)])
        else:
            self.ids.extend(self.tokenizer.encode(part.decode(), add_special_tokens=False).ids)
        self.ends.append(len(self.ids))
        number = self.number[part] = len(self.number)
        return number

    def _block(self, raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many belong to each text)."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(firsts), np.int64)
        packed, offsets, places = parts_of(raw, firsts)
        if not len(places):
            return np.zeros(0, np.uint32), np.zeros(len(firsts), np.int64)
        found = pa.Array.from_buffers(
            pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
        ).dictionary_encode()
        if len(self.number) > REMEMBERED:
            self._forget()
        known = self.number.get
        entries = found.dictionary.to_pylist()
        numbers = [known(p) for p in entries]
        numbers = np.array([self._make(p) if n is None else n for p, n in zip(entries, numbers)], np.int64)
        ends = np.frombuffer(self.ends, np.int64)
        index = numbers[found.indices.to_numpy()]
        begin = ends[index]
        length = ends[index + 1] - begin
        upto = np.cumsum(length)
        gather = np.repeat(begin - (upto - length), length) + np.arange(int(upto[-1]))
        ids = np.frombuffer(self.ids, np.uint32)[gather]
        # Parts of text k lie between its first byte and that of the next text.
        cut = np.append(np.searchsorted(places, firsts), len(places))
        upto = np.append(0, upto)
        return ids, np.diff(upto[cut])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's ids begin, with the end of the last)."""
        if self.tokenizer is None:
            self._open()
        counts = np.zeros(len(texts), np.int64)
        made = [np.zeros(0, np.uint32)]
        for raw, firsts, which in blocks(texts):
            ids, own = self._block(raw, firsts)
            made.append(ids)
            counts[which] += own
        return np.concatenate(made), np.append(0, np.cumsum(counts))
