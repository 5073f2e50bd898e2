"""Independent chunks of a text for byte-level BPE.

The splitting pattern of the vocabularies never lets a match cross a single
space between two other characters: what stands before it ends there, and the
space goes with what follows. So a text can be cut at those spaces and each
distinct chunk encoded once; ids of a text are the ids of its chunks in order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = re.compile(r"(?<=\S) (?=\S)")

# --- fixed value: the splitting pattern for which all of this holds ---
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A word of letters and ASCII punctuation but the apostrophe, and perhaps a line break and
#: another such word: one match of the pattern each.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", "[!-&(-/:-@\\[-`{-~]*"
_SIMPLE = re.compile(f"( ?{_LETTERS})({_MARKS})(?:(\n)({_LETTERS})({_MARKS}))?")

#: The longest chunk that is remembered beyond a call.
LONGEST_KEPT = 64
#: How ids are written in values.
ID_TYPE, ID_BYTES = np.dtype("<u4"), 4


class ChunkEncoder:
    """Encodes texts through two functions from a list of strings to one bytes object each:
    ``encode_matches`` for strings that the pattern matches whole, ``encode_any`` for others.
    The chunks of about ``group_chars`` characters are numbered together, and the ids of their
    texts are gathered from the ids of the distinct chunks. Results of chunks are remembered. Chunks but the first of a text follow a space."""

    #: Characters of the chunks that a Python worker remembers, in two generations: when the
    #: newer one is full, the older one goes, but for the chunks that were met again meanwhile.
    kept_chars = 4_000_000
    #: Characters of the texts that are cut into chunks at a time.
    group_chars = 1_000_000

    def __init__(self, encode_matches: Callable[[list[str]], list[bytes]], encode_any: Callable[[list[str]], list[bytes]]):
        self.encode_matches, self.encode_any = encode_matches, encode_any
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}
        self.old_first, self.old_later = self.first, self.later
        self.chars = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        out, group, chars = [], [], 0
        for at, text in enumerate(texts):
            group.append(text)
            chars += len(text)
            if chars >= self.group_chars or at + 1 == len(texts):
                out += self._encode(group)
                group, chars = [], 0
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if 2 * self.chars > self.kept_chars:
            self.old_first, self.old_later = self.first, self.later
            self.first, self.later, self.chars = {}, {}, 0
        first, later = self.first, self.later
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begin = cut.offsets.to_numpy()
        heads, after = begin[:-1], np.ones(len(cut.values), bool)
        after[heads] = False
        head = cut.values.take(pa.array(heads)).to_numpy(zero_copy_only=False).tolist()
        tails = cut.values.filter(pa.array(after)).dictionary_encode()
        tail = tails.dictionary.to_numpy(zero_copy_only=False).tolist()
        long = [(first, self._learn(first, self.old_first, set(head), ""))]
        long.append((later, self._learn(later, self.old_later, tail, " ")))
        values = [*map(later.__getitem__, tail), *map(first.__getitem__, head)]
        for known, chunks in long:
            for chunk in chunks:
                del known[chunk]
        # the number of each chunk's value, in the order of the texts
        of = np.empty(len(after), np.int64)
        of[after] = tails.indices.to_numpy()
        of[heads] = np.arange(len(tail), len(values))
        # where spaces meet other white space, a chunk has no value of its own
        none = np.fromiter((value is None for value in values), bool, len(values))
        odd = np.flatnonzero(np.logical_or.reduceat(none[of], heads))
        values = [value or b"" for value in values]
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // ID_BYTES
        ids = np.frombuffer(b"".join(values), ID_TYPE)
        del values
        starts, sizes = (np.cumsum(sizes) - sizes)[of], sizes[of]
        ends = np.cumsum(sizes)
        place = np.repeat(starts - ends + sizes, sizes)
        place += np.arange(len(place))
        raw = ids[place].tobytes()
        ends = (ends[begin[1:] - 1] * ID_BYTES).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if len(odd):
            parts = [CUT.split(texts[i]) for i in odd]
            chunks = list({p[0] for p in parts} | {" " + chunk for p in parts for chunk in p[1:]})
            found = dict(zip(chunks, self.encode_any(chunks), strict=True))
            for i, p in zip(odd, parts, strict=True):
                out[i] = b"".join([found[p[0]], *(found[" " + chunk] for chunk in p[1:])])
        return out

    def _learn(self, known: dict[str, bytes | None], old: dict[str, bytes | None], chunks: Iterable[str], before: str) -> list[str]:
        """Values of the distinct ``chunks`` that are new; none for one that is empty or has white
        space at an end. Returns the chunks that are too long to be kept."""
        new, words, whole = [], [], []
        for chunk in chunks:
            if chunk in known:
                continue
            new.append(chunk)
            if chunk in old:
                known[chunk] = old[chunk]
            elif chunk.isalpha():  # letters alone are one match
                words.append(chunk)
            elif chunk and not (chunk[0].isspace() or chunk[-1].isspace()):
                whole.append(chunk)
            else:
                known[chunk] = None
        self.chars += sum(map(len, new))
        if words:
            known.update(zip(words, self.encode_matches([before + word for word in words]), strict=True))
        if whole:
            known.update(zip(whole, self._values([before + chunk for chunk in whole]), strict=True))
        return [chunk for chunk in new if len(chunk) > LONGEST_KEPT]

    def _values(self, chunks: list[str]) -> list[bytes]:
        find = _SIMPLE.fullmatch
        split = [found.groups("") if (found := find(chunk)) else None for chunk in chunks]
        of = self._matches(set().union(*filter(None, split)))
        others = [chunk for chunk, parts in zip(chunks, split, strict=True) if parts is None]
        rest = iter(self.encode_any(others) if others else [])
        out = []
        for parts in split:
            if parts is None:
                out.append(next(rest))
            else:
                word, marks, line, second, more = parts
                out.append(of[word] + of[marks] + of[line] + of[second] + of[more] if line else of[word] + of[marks])
        return out

    def _matches(self, matches: set[str]) -> dict[str, bytes]:
        """Values of strings that the pattern matches whole. They are chunks as well, and are
        remembered as such."""
        out, new = {}, []
        for match in matches:
            chunk, known, old = (match[1:], self.later, self.old_later) if match[:1] == " " else (match, self.first, self.old_first)
            value = known.get(chunk) or old.get(chunk)
            if value is None:
                new.append(match)
            else:
                out[match] = value
        out.update(zip(new, self.encode_matches(new) if new else [], strict=True))
        out[""] = b""
        for match in new:
            if match and match != "\n" and len(match) <= LONGEST_KEPT:
                chunk, known = (match[1:], self.later) if match[0] == " " else (match, self.first)
                known[chunk] = out[match]
                self.chars += len(match)
        return out
