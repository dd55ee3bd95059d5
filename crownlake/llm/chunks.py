"""Encode texts chunk by chunk, each distinct chunk once per worker.

Valid for tokenizers whose pieces never span a chunk border. ``memo`` lives as
long as the Python worker and is emptied when it is full, so memory is bounded
and the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_ENTRIES = 400_000


def lookup(values: list[str], memo: dict[str, object], encode: Callable[[list[str]], list], entries: int = MEMO_ENTRIES) -> list:
    """``encode`` of each value, from ``memo`` where it has it; ``entries`` bounds the memo."""
    found = list(map(memo.get, values))
    if missing := list(dict.fromkeys([v for v, known in zip(values, found) if known is None])):
        if len(memo) + len(missing) > entries:
            memo.clear()
        memo.update(zip(missing, encode(missing)))
        found = [memo[v] if known is None else known for v, known in zip(values, found)]
    return found


def distinct_chunks(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks, the index of each chunk occurrence, and the n+1 offsets of the texts into the latter.

    No chunk holds a space.
    """
    encoded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = encoded.dictionary
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
    return joined.split(" ") if len(words) else [], encoded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
