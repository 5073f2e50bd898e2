"""Token ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from nimbra.llm.chunks import CUT, ID_BYTES, ID_TYPE, LONGEST_KEPT

#: New chunks that the library gets as one text, in bytes.
JOINED_BYTES = 2000


class Chunks:
    """Remembered chunks, and their ids in one array; size -1 for chunks without ids of their own."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.values = pa.array([], pa.large_string())
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, ID_TYPE)

    def __len__(self) -> int:
        return len(self.values)

    def __iter__(self) -> Iterator[str]:
        return iter(self.values.to_pylist())

    def chars(self) -> int:
        return pc.sum(pc.utf8_length(self.values)).as_py() or 0

    def places(self, distinct: pa.Array, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The places of ``distinct`` chunks; ``learn`` gives sizes and ids of those that are new."""
        at = pc.index_in(distinct, value_set=self.values)
        new = at.is_null()
        known, at = len(self), pc.fill_null(at, -1).to_numpy().astype(np.int64)
        if len(found := distinct.filter(new)):
            sizes, ids = learn(found)
            self.values = pa.concat_arrays([self.values, found])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
            at[at < 0] = np.arange(known, len(self))
        return at

    def forget(self, met: np.ndarray, most: int) -> None:
        """Long chunks go. Beyond ``most`` characters those go that are not at the places ``met``, or all."""
        keep = pc.less_equal(pc.utf8_length(self.values), LONGEST_KEPT).to_numpy(zero_copy_only=False)
        if self.chars() > most:
            again = np.zeros(len(self), bool)
            again[met] = True
            keep &= again
        if keep.all():
            return
        self.ids = self.ids[np.repeat(keep, np.maximum(self.sizes, 0))]
        self.values, self.sizes = self.values.filter(pa.array(keep)), self.sizes[keep]
        if self.chars() > most:
            self.clear()


class LibraryEncoder:
    """Texts are cut into chunks (see ``chunks.py``), about ``group_chars`` characters at a time; the ids
    of new distinct chunks come from the library, which gets many chunks as one text, and those of the
    texts are gathered. Texts that hold the content of an added token are encoded whole, as the library does."""

    #: Characters of the chunks that a Python worker remembers.
    kept_chars = 4_000_000
    #: Characters of the texts that are cut into chunks at a time.
    group_chars = 2_000_000

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        # a token of the byte-level alphabet has a character for each byte
        self.bytes_of = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True) + 1, np.int64)
        for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
            if number < len(self.bytes_of):
                self.bytes_of[number] = len(token)
        self.first, self.later = Chunks(), Chunks()

    def encode(self, texts: list[str]) -> list[bytes]:
        special = [] if self.added is None else [i for i, text in enumerate(texts) if self.added.search(text)]
        plain = list(texts)
        for i in special:
            plain[i] = ""
        out, group, chars = [], [], 0
        for at, text in enumerate(plain):
            group.append(text)
            chars += len(text)
            if chars >= self.group_chars or at + 1 == len(plain):
                out += self._encode(group)
                group, chars = [], 0
        for i, ids in zip(special, self._single([texts[i] for i in special]), strict=True):
            out[i] = ids
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begin = cut.offsets.to_numpy()
        heads, after = begin[:-1], np.ones(len(cut.values), bool)
        after[heads] = False
        head = cut.values.take(pa.array(heads)).dictionary_encode()
        tail = cut.values.filter(pa.array(after)).dictionary_encode()
        del cut
        head_at = self.first.places(head.dictionary, self._learn_heads)
        tail_at = self.later.places(tail.dictionary, self._learn_tails)
        # the place of each chunk's ids, in the order of the texts
        sizes = np.concatenate([self.later.sizes, self.first.sizes])
        ids = np.concatenate([self.later.ids, self.first.ids])
        starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        of = np.empty(len(after), np.int64)
        of[after] = tail_at[tail.indices.to_numpy()]
        of[heads] = head_at[head.indices.to_numpy()] + len(self.later)
        starts, sizes = starts[of], sizes[of]
        del of
        # where spaces meet other white space, a chunk has no ids of its own
        odd = np.flatnonzero(np.logical_or.reduceat(sizes < 0, heads))
        sizes = np.maximum(sizes, 0)
        ends = np.cumsum(sizes)
        place = np.repeat(starts - ends + sizes, sizes)
        place += np.arange(len(place))
        raw = ids[place].tobytes()
        ends = (ends[begin[1:] - 1] * ID_BYTES).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if len(odd):
            parts = [CUT.split(texts[i]) for i in odd]
            chunks = list({p[0] for p in parts} | {" " + chunk for p in parts for chunk in p[1:]})
            found = dict(zip(chunks, self._single(chunks), strict=True))
            for i, p in zip(odd, parts, strict=True):
                out[i] = b"".join([found[p[0]], *(found[" " + chunk] for chunk in p[1:])])
        self.first.forget(head_at, self.kept_chars)
        self.later.forget(tail_at, self.kept_chars)
        return out

    def rest(self) -> None:
        """Gives memory back that is not held, at the end of a task: the worker stays for others."""
        pa.default_memory_pool().release_unused()

    def _single(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, encoded by itself."""
        out: list[bytes] = []
        for at in range(0, len(texts), 20_000):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 20_000], add_special_tokens=False)
            out += [array("I", encoding.ids).tobytes() for encoding in found]
        return out

    def _learn_heads(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes, whole = self._whole(chunks)
        ids = self._single(whole.to_pylist())
        sizes[sizes == 0] = [len(found) // ID_BYTES for found in ids]
        return sizes, np.frombuffer(b"".join(ids), ID_TYPE)

    def _learn_tails(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Chunks with a space before each are a text whose ids are theirs, one after another;
        where a chunk's ids end follows from the bytes of the ids."""
        sizes, whole = self._whole(chunks)
        ends = np.cumsum(pc.binary_length(whole).to_numpy() + 1)
        group = ends // JOINED_BYTES
        cuts = pa.array([0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(whole)], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(cuts, whole), pa.scalar(" ", pa.large_string()))
        parts = [np.empty(0, ID_TYPE)]
        for at in range(0, len(joined) if len(whole) else 0, 64):
            texts = [" " + text for text in joined[at : at + 64].to_pylist()]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            parts += [np.frombuffer(array("I", encoding.ids), ID_TYPE) for encoding in found]
        ids = np.concatenate(parts)
        left = np.cumsum(self.bytes_of[np.minimum(ids, len(self.bytes_of) - 1)])
        last = np.searchsorted(left, ends)
        if len(whole) and (last[-1] + 1 != len(ids) or not np.array_equal(left[last], ends)):
            each = self._single([" " + chunk for chunk in whole.to_pylist()])  # a vocabulary without all bytes
            sizes[sizes == 0] = [len(found) // ID_BYTES for found in each]
            return sizes, np.frombuffer(b"".join(each), ID_TYPE)
        sizes[sizes == 0] = np.diff(last, prepend=-1)
        return sizes, ids

    @staticmethod
    def _whole(chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The chunks that have ids of their own, and sizes that are 0 for them and -1 for others: those
        that are empty or have white space at an end."""
        whole = pc.and_(pc.equal(pc.utf8_trim_whitespace(chunks), chunks), pc.greater(pc.binary_length(chunks), 0))
        return pc.if_else(whole, pa.scalar(0, pa.int64()), pa.scalar(-1, pa.int64())).to_numpy().copy(), chunks.filter(whole)


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    """The encoder of a byte-level BPE file, one for each Python worker. Added tokens in a
    text are found as the library finds them; no others are added."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _ENCODERS[path] = LibraryEncoder(Tokenizer.from_file(path))
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
