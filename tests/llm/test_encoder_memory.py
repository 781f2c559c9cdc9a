"""What a worker holds at once while it encodes."""

import public_tokenizers

from ferrolith.llm import encoder


class Noted:
    """A tokenizer that notes how many texts each call of the library gets."""

    def __init__(self, inner):
        self.inner, self.sizes = inner, []

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def encode_batch_fast(self, texts, **options):
        self.sizes.append(len(texts))
        return self.inner.encode_batch_fast(texts, **options)


def test_one_call_of_the_library_is_bounded():
    pieces = encoder.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain, pieces.tokenizer = pieces.tokenizer, Noted(pieces.tokenizer)
    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}x" for k in range(a, a + 4000)) for a in (0, 4000, 8000)]
    got = pieces.encode_all(texts)
    assert sum(pieces.tokenizer.sizes) > 8 and max(pieces.tokenizer.sizes) <= 8
    assert [list(memoryview(ids).cast("I")) for ids in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
