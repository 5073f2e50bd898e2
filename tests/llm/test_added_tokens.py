"""Added tokens in a text have the ids that the unaltered library gives them."""

from __future__ import annotations

import numpy as np
import public_tokenizers

from nimbra.llm.library_tokens import library_encoder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_added_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["one two", "", "<|endoftext|>", "a <|endoftext|> b", "stop<|endoftext|><|endoftext|>go\n x", "<|endoftext", "last one"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in library_encoder(TOKENIZER).encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(got[2]) == 1
