"""What a worker holds at once while it encodes (pipeline, op9_packing)."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from aerolytics.llm import packing
from aerolytics.llm.common import ragged


def test_unknown_chunks_reach_the_tokenizer_in_portions():
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    whole, sizes = encoder.tok, []

    class Watched:
        def encode_batch_fast(self, texts, **kw):
            sizes.append(len(texts))
            return whole.encode_batch_fast(texts, **kw)

    encoder.tok = Watched()
    texts = [" ".join(f"w{i}x{k}" for k in range(4000)) for i in range(3)] + [None, "a b. C"]
    flat, cuts = encoder.encode(pa.array(texts))
    assert max(sizes) <= packing.BATCH_WORDS and sum(sizes) > 12_000
    for i, t in enumerate(texts):
        assert flat[cuts[i]:cuts[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids


def test_ragged_in_steps():
    values = [np.arange(n, dtype="<u4").tobytes() for n in (2, 0, 3, 1)]
    codes = np.array([2, 1, 0, 0, 3, 2, 1])
    cuts = np.array([0, 2, 2, 7])
    for step in (1, 2, 3, 7, 100):
        flat, ends = ragged(values, codes, cuts, step)
        assert flat.tolist() == [0, 1, 2, 0, 1, 0, 1, 0, 0, 1, 2] and ends.tolist() == [0, 3, 3, 11]
    flat, ends = ragged([], np.array([], int), np.array([0, 0]))
    assert not len(flat) and ends.tolist() == [0, 0]
