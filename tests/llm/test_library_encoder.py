"""What the encoder of a library's tokenizer remembers is small, and many new chunks are one text of the library."""

from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from nimbra.llm.library_tokens import LibraryEncoder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _texts(n: int) -> list[str]:
    draw = random.Random(11)
    return [" ".join("".join(draw.choices("etaoinshr", k=8)) for _ in range(100)) for _ in range(n)]


class Counted:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def __getattr__(self, name: str):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts: list[str], **settings):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **settings)


def test_a_remembered_chunk_takes_little_and_new_ones_are_encoded_together():
    counted = Counted(Tokenizer.from_file(TOKENIZER))
    encoder, texts = LibraryEncoder(counted), _texts(300)
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
    assert got == [counted.encode(text, add_special_tokens=False).ids for text in texts]
    known = encoder.later
    assert len(known) > 29_000
    assert known.values.nbytes + known.sizes.nbytes + known.ids.nbytes < 60 * len(known)
    assert counted.texts < 500


def test_a_vocabulary_without_all_bytes_is_the_librarys(tmp_path):
    of = json.load(open(TOKENIZER))
    of["added_tokens"] = []
    of["model"]["vocab"] = {letter: n for n, letter in enumerate("abcdeĠ.Ċ")}
    of["model"]["merges"] = []
    (tmp_path / "few.json").write_text(json.dumps(of))
    tokenizer = Tokenizer.from_file(str(tmp_path / "few.json"))
    texts = ["abc xyz abé cde. a", "z", "", "a  b\n\nc x", "aé é éa z a"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in LibraryEncoder(tokenizer).encode(texts)]
    assert got == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
