"""Memory of the workers that encode and pack."""

import random
import tracemalloc

import public_tokenizers
import pyarrow as pa

from urbanspark.llm import packing
from urbanspark.llm.words import slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_a_slice_is_encoded_in_little_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(2000)]
    texts = pa.array([" ".join(rng.choices(words, k=400)) for _ in range(4000)])
    encoder = packing.WordEncoder(TOKENIZER)
    tracemalloc.start()
    for part in slices(texts, packing.ENCODE_BYTES):
        encoder.encode(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_packing_hands_few_rows_at_a_time_to_python(spark):
    docs = spark.range(2500, numPartitions=1).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    before, seen = spark.conf.get(ROWS_KEY), []
    whole = packing.pack_pieces

    def watched(pieces, capacity):
        # What a worker gets in the jobs run from here.
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint")
        seen.extend(r.n for r in sizes.collect())
        return whole(pieces, capacity)

    packing.pack_pieces = watched
    try:
        assert packing.pack_documents(docs, TOKENIZER).count() == 2500
    finally:
        packing.pack_pieces = whole
    assert sum(seen) == 2500 and max(seen) <= packing.ROWS_A_BATCH
    assert spark.conf.get(ROWS_KEY) == before
