"""What the check's projection of the pipeline's disk led to."""

import numpy as np
from lotwise.llm import near_dedup


def test_a_signature_is_a_byte_a_hash(spark):
    """Tables and shuffles of near_dedup hold 192 bytes a document, and buckets are written once, as whole hashes give them."""
    rows = near_dedup.band_rows(80)
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c d e f g"), (3, None)], "doc_id long, text string")
    one, two, none = near_dedup.signed(docs.coalesce(1), 5, rows).orderBy("doc_id").collect()
    assert len(one.signature) == near_dedup.N_HASHES and len(one.buckets) == 8 * (near_dedup.N_HASHES // rows)
    assert (one.signature, one.buckets) == (two.signature, two.buckets) and none.signature is None and none.n_shingles == 0


def test_lowest_bits_lose_no_likely_pair():
    """What whole hashes leave likely stays likely by their lowest 8 bits."""
    rng, least = np.random.default_rng(1), near_dedup.least_matches(80)
    left = rng.integers(0, 2**32, (300, near_dedup.N_HASHES), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < rng.uniform(0.4, 1, (300, 1)), left, rng.integers(0, 2**32, left.shape, dtype=np.uint32))
    at = np.arange(300)
    whole, few = (set(near_dedup.likely(a, b, at, at, least)[0].tolist()) for a, b in ((left, right), (left.astype(np.uint8), right.astype(np.uint8))))
    assert whole and whole <= few and len(few) < 300
