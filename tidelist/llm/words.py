"""Words of whole texts as 64-bit hashes, a batch at a time.

A word is a run of bytes other than ASCII white space (space and U+0009 to U+000D).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEED = 0x51_7C_C1_B7_27_22_0A_95


def split(texts, lower: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words of all texts in a row, dictionary-coded; where each text's words begin and end).

    ``lower`` lower-cases A-Z first. A null text has no words.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).cast(pa.binary())
    bounds = bounds - bounds[0]
    # White space at an end of a text leaves an empty string there.
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        words = words.filter(pa.array(full))
    return words.dictionary_encode(), bounds


def hashes(coded: pa.DictionaryArray) -> np.ndarray:
    """The hash of each word."""
    from xxhash import xxh64_intdigest

    own = np.array([xxh64_intdigest(w, SEED) for w in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy()] if len(own) else own


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, for polynomial hashes of n words."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)
