"""What the encoder keeps of chunks."""

from array import array

import numpy as np

from cabrank.llm.pieces import Pieces

WORDS = [f"w{n:x} {n * n:o}" for n in range(300)]


def test_pieces_keep_packed_ids():
    model = Pieces()
    texts = [" ".join(WORDS[a : a + 40]) for a in range(0, 260, 20)] * 2 + ["", None, "\u2003\u2003", "é" * 200]
    for text in texts:
        found = model.ids_of(text)
        assert found.dtype == np.int32
        assert found.tolist() == model.encode(text) == model.library.encode(text or "")
    assert model.chunks and all(type(ids) is bytes for ids in model.chunks.values())
    assert model.chunks["▁w0"] == array("i", model.library.encode("w0")).tobytes()
