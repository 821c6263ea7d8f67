"""What a task holds while it encodes a slice of texts."""

import tracemalloc

import public_tokenizers
import pyarrow.parquet as pq

from tracefold.llm import bpe


def test_arrays_of_a_slice_stay_small(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        own = bpe.ForcedBoundaryBPE(f.read())
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").combine_chunks().slice(0, 500)
    tracemalloc.start()
    ids, counts = own.encode_array(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30e6
    own._forget()
    monkeypatch.setattr(bpe, "GROUP_BYTES", 1 << 20)
    again, n = own.encode_array(texts)
    assert ids.tolist() == again.tolist() and counts.tolist() == n.tolist() and len(n) == 500
