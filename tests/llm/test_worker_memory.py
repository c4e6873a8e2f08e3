"""What a Python worker holds beside its batch is bounded, whatever the number of texts and different words."""

import tracemalloc

import corpus_pipeline
import pandas as pd
import public_tokenizers

from finchlake.llm import probminhash, tokenizing


def test_known_pieces_stay_few():
    encoder = tokenizing.PieceEncoder(public_tokenizers.path(corpus_pipeline.TOKENIZER), True, corpus_pipeline.PIECES_KEPT)
    most = 0
    for first in range(0, 640_000, 8_000):
        encoder.ids(" ".join(f"{i:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(first, first + 8_000)))
        most = max(most, len(encoder) + len(encoder.old))
    assert most <= 520_000


def test_signatures_take_little_more_than_a_slice():
    texts = pd.Series([" ".join(f"w{i * 7919 % 9973}x{j}" for j in range(400)) for i in range(700)])
    tracemalloc.start()
    try:
        (out,) = probminhash.signatures.func(iter([texts]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(out) == 700
    assert peak < 40e6, peak
