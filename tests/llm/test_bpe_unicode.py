"""Every code point, alone and between letters and signs, encoded as the tokenizers library does."""

import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import bpe


def test_every_code_point():
    path = public_tokenizers.path("word_bpe_49k.json")
    ours, library = bpe.WordBpe(path), Tokenizer.from_file(path)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 20000):
        some = points[at : at + 20000]
        # Many code points a text, apart from each other: alone, between letters, between signs and between numbers.
        texts = ["".join(f" {chr(c)} a{chr(c)}b ?{chr(c)}! 1{chr(c)}2" for c in some[i : i + 200]) for i in range(0, len(some), 200)]
        for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert ours.encode(text).tolist() == want.ids
