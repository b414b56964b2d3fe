"""Piece vocabulary of a SentencePiece model file, for encoding, decoding and counting.

A BPE model's scores are ranks of merges. Merger uses them so: of all neighbouring parts whose join is a piece, the pair
with the highest score is joined first, the leftmost of equal ones, until no pair is left. Its ids are SentencePiece's.

Segmenter uses the scores as those of a unigram model, with an Aho-Corasick automaton and a single-pass Viterbi: the best segmentation has the
highest sum of piece scores. The automaton reports, for each end position, the pieces that end there, longest first
(it follows the output links), and each match relaxes the best score of its end. A later match replaces an earlier one
only if its sum is strictly higher, so of equal sums the longest piece stays. A character that no piece covers costs
the lowest score less ten and is written as its bytes.

Text is normalised as the model asks: spaces become U+2581, one is put in front of a non-empty text.
"""

from __future__ import annotations

import heapq
import re
import string
from array import array
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick

from .common import Recent

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")
MARKS = string.punctuation
#: A run of spaces and what follows it; a line break stands alone unless a piece holds one.
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Characters up to which the best pair is looked for in a list instead of a heap.
SHORT = 40
LINE_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\\n]+|{SPACE}+|\\n")


@dataclass
class Vocabulary:
    """What a model file holds: pieces with score and id, ids of bytes, and the ids of unknown."""

    scores: dict[str, tuple[float, int]]
    byte_ids: list[int] | None
    unknown: int
    texts: list[str]
    prefix: bool = True
    control: set[int] = field(default_factory=set)
    tools: dict[str, Remembering] = field(default_factory=dict)

    def tool(self, what: str, merges: bool = False) -> Remembering:
        """`ids` (as bytes of 32-bit numbers) or `count` per segment; a broadcast vocabulary keeps it between tasks."""
        if merges:
            if f"merged {what}" not in self.tools:
                merger = Merger(self)
                result = merger.count if what == "count" else lambda s: array("i", merger.ids(s)).tobytes()
                self.tools[f"merged {what}"] = Remembering(merger, result)
            return self.tools[f"merged {what}"]
        if what not in self.tools:
            segmenter = Segmenter(self)
            result = segmenter.count if what == "count" else lambda s: array("i", segmenter.ids(s)).tobytes()
            self.tools[what] = Remembering(segmenter, result)
        return self.tools[what]

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, scores, bytes_of, control = [], {}, {}, set()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            texts.append(piece)
            if model.is_byte(i):
                bytes_of[int(piece[3:-1], 16)] = i
            elif model.is_control(i):
                control.add(i)
            elif not model.is_unknown(i) and not model.is_unused(i):
                scores[piece] = (model.get_score(i), i)
        byte_ids = [bytes_of[b] for b in range(256)] if len(bytes_of) == 256 else None
        return cls(scores, byte_ids, model.unk_id(), texts, control=control)

    @cached_property
    def byte_of(self) -> dict[int, int]:
        return {i: b for b, i in enumerate(self.byte_ids or [])}

    @cached_property
    def special(self) -> set[int]:
        """Ids that do not stand for their piece's text."""
        return {*self.byte_of, self.unknown, *self.control}

    @property
    def separable(self) -> bool:
        """Whether segments can be worked on by themselves with the same result.

        So it is if no piece reaches over the start of a run of spaces and sums of scores are exact (whole numbers).
        """
        return all(SPACE not in p.lstrip(SPACE) and s == int(s) for p, (s, _) in self.scores.items())


def normalise(text: str, prefix: bool = True) -> str:
    marked = text.replace(" ", SPACE)
    return SPACE + marked if prefix and marked else marked


class Segmenter:
    """Best segmentations under a vocabulary, driven by the automaton over its pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, (score, number) in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score, number))
        self.automaton.make_automaton()
        self.unknown_score = min((s for s, _ in vocabulary.scores.values()), default=0.0) - UNKNOWN_PENALTY
        self.separable = vocabulary.separable
        self.covered = {p for p in vocabulary.scores if len(p) == 1}
        self.neighbours = {p[i : i + 2] for p in vocabulary.scores for i in range(len(p) - 1)}

    def _matches(self, text: str):
        """(last position, (length, score, id)) in the order of ends, longest first; id None where no piece covers."""
        lone = (1, self.unknown_score, None)
        done = 0
        for end, match in self.automaton.iter(text):
            for at in range(done, end):
                if text[at] not in self.covered:
                    yield at, lone
            done = max(done, end)
            yield end, match
        for at in range(done, len(text)):
            if text[at] not in self.covered:
                yield at, lone

    def ids(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        # Positions count from -1, as the automaton names the last character of a match: best[-1] is the start.
        best = [NEVER] * len(text) + [0.0]
        back: list = [None] * (len(text) + 1)
        if self.covered.issuperset(text):
            for end, match in self.automaton.iter(text):
                total = best[end - match[0]] + match[1]
                if total > best[end]:
                    best[end] = total
                    back[end] = match
        else:
            for end, match in self._matches(text):
                total = best[end - match[0]] + match[1]
                if total > best[end]:
                    best[end] = total
                    back[end] = match
        byte_ids, unk = self.vocabulary.byte_ids, self.vocabulary.unknown
        out: list[int] = []
        end, after_unknown = len(text) - 1, False
        while end >= 0:
            length, _, number = back[end]
            if number is not None:
                out.append(number)
            elif byte_ids:
                out.extend(byte_ids[b] for b in reversed(text[end].encode()))
            elif not after_unknown:  # neighbouring unknown characters are one piece
                out.append(unk)
            end, after_unknown = end - length, number is None
        return out[::-1]

    def count(self, text: str) -> int:
        """Number of ids of a normalised text: the count goes along with the best score, no path is kept."""
        byte_ids = self.vocabulary.byte_ids
        best = [NEVER] * len(text) + [0.0]
        counts = [0] * (len(text) + 1)
        if self.covered.issuperset(text):
            for end, (length, score, _) in self.automaton.iter(text):
                total = best[end - length] + score
                if total > best[end]:
                    best[end] = total
                    counts[end] = counts[end - length] + 1
            return counts[len(text) - 1]
        open_ = bytearray(len(text) + 1)  # whether the best path ends in a run of unknown without byte pieces
        for end, (length, score, number) in self._matches(text):
            start = end - length
            total = best[start] + score
            if total > best[end]:
                best[end] = total
                if number is not None:
                    counts[end], open_[end] = counts[start] + 1, 0
                elif byte_ids:
                    counts[end] = counts[start] + len(text[end].encode())
                else:
                    counts[end], open_[end] = counts[start] + 1 - open_[start], 1
        return counts[len(text) - 1]

    def ending(self, segment: str) -> int:
        """Where marks at the end of a segment can be cut off: no piece holds the two characters around the cut."""
        head = segment.rstrip(MARKS)
        at = len(head)
        return at if 0 < at < len(segment) and segment[at - 1 : at + 1] not in self.neighbours else 0


class Merger:
    """Segmentations of a BPE model by its own merges, as SentencePiece makes them."""

    ending = Segmenter.ending

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.score = {p: s for p, (s, _) in vocabulary.scores.items()}.get
        # No merge reaches over the start of a run of spaces unless a piece does.
        self.separable = all(SPACE not in p.lstrip(SPACE) for p in vocabulary.scores)
        self.neighbours = {p[i : i + 2] for p in vocabulary.scores for i in range(len(p) - 1)}

    def parts(self, text: str) -> list[str]:
        """The parts that are left when no two neighbours join any more."""
        if len(text) > SHORT:
            ends, out, at = self.ends(text), [], 0
            while at < len(text):
                out.append(text[at : ends[at]])
                at = ends[at]
            return out
        score, out = self.score, list(text)
        pairs = [score(a + b, NEVER) for a, b in zip(out, out[1:])]
        while pairs and (best := max(pairs)) > NEVER:
            i = pairs.index(best)  # the leftmost
            out[i] += out.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(out[i] + out[i + 1], NEVER)
            if i:
                pairs[i - 1] = score(out[i - 1] + out[i], NEVER)
        return out

    def ends(self, text: str) -> list[int]:
        """Where the part that starts at a position ends, 0 where none starts."""
        found, n = self.vocabulary.scores.get, len(text)
        ends, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []
        for i in range(n - 1):
            if piece := found(text[i : i + 2]):
                heap.append((-piece[0], i, i + 1, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            if ends[i] != middle or ends[middle] != end:
                continue  # one of the two has been joined with another
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                if piece := found(text[i : ends[end]]):
                    heapq.heappush(heap, (-piece[0], i, end, ends[end]))
            left = before[i]
            if left >= 0 and (piece := found(text[left:end])):
                heapq.heappush(heap, (-piece[0], left, i, end))
        return ends

    def ids(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        byte_ids, found = self.vocabulary.byte_ids, self.vocabulary.scores.get
        out, after_unknown = [], False
        for part in self.parts(text):
            piece = found(part)
            if piece:
                out.append(piece[1])
            elif byte_ids:
                out.extend(byte_ids[b] for b in part.encode())
            elif not after_unknown:  # neighbouring unknown characters are one piece
                out.append(self.vocabulary.unknown)
            after_unknown = piece is None
        return out

    def count(self, text: str) -> int:
        """Number of ids of a normalised text."""
        return len(self.ids(text))


class Remembering(Recent):
    """Results per segment; marks at the end of a segment are looked up by themselves."""

    def __init__(self, segmenter: Segmenter | Merger, result: Callable):
        super().__init__()
        self.segmenter, self.result = segmenter, result
        vocabulary = segmenter.vocabulary
        lone_breaks = vocabulary.byte_ids and not any("\n" in p for p in vocabulary.scores)
        self.cut = (LINE_SEGMENT if lone_breaks else SEGMENT).findall

    def make(self, segment: str):
        at = self.segmenter.ending(segment)
        return self[segment[:at]] + self[segment[at:]] if at else self.result(segment)

    def parts(self, text: str) -> list:
        """Results of the pieces of a text that can be worked on by themselves, in order."""
        prefix = self.segmenter.vocabulary.prefix
        if not self.segmenter.separable:
            return [self.result(normalise(text, prefix))]
        return list(map(self.__getitem__, self.cut(normalise(text, prefix))))


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of a list of ids: bytes are joined (broken ones read as U+FFFD), the leading space goes."""
    texts, byte_of, special = vocabulary.texts, vocabulary.byte_of, vocabulary.special
    if special.isdisjoint(ids):
        out = [texts[i] for i in ids]
    else:
        out, run = [], bytearray()
        for i in ids:
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            if i not in special:
                out.append(texts[i])
            elif i == vocabulary.unknown:
                out.append(" ⁇ ")
        out.append(run.decode(errors="replace"))
    text = "".join(out).replace(SPACE, " ")
    return text[1:] if vocabulary.prefix and text.startswith(" ") else text
