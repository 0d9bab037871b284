"""Token counts (operator 1): batch encoding in Arrow functions, lengths only.

Each Arrow batch is cut into parts of about ``part_bytes`` of text. A text is
split where a split can't change its tokens, so that a long one becomes many
short inputs and the same input is encoded once per part: between a character
that isn't white space and the ASCII white space after it. No alternative of
the byte-level pattern runs from a non-space into a space, and its only look
ahead, after white space, then has the same neighbours on both sides. Special
strings hold no white space, so they are never cut. For a tokenizer with other
rules whole texts are encoded. Encoder calls get inputs of about
``call_bytes`` together. Nothing but lengths leaves a task, and nothing is
shuffled.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows give repeated
results; an empty table gives none. Only the id and text columns are read, so
further columns don't matter.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import byte_slices, frugal, is_space, text_buffers

PART_BYTES = 16 << 20
CALL_BYTES = 1 << 20
#: Inputs remembered between parts of a task (a bound on memory, not on work).
MEMORY = 300_000


def splits_safely(spec: dict) -> bool:
    """Whether a tokenizer file's rules allow the split before white space."""
    pre = spec.get("pre_tokenizer") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(map(str.isspace, t["content"]))
                        for t in spec.get("added_tokens", [])))


def open_counter(path: str) -> tuple[Callable[[list[str]], Iterator[int]], bool]:
    """(function from texts to token counts, whether texts may be split)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: map(len, model.encode(texts, num_threads=1)), False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        safe = splits_safely(json.load(f))
    return lambda texts: map(len, tok.encode_batch_fast(texts, add_special_tokens=False)), safe


def safe_cuts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Byte positions where inputs start: the texts' own starts and the safe
    splits. After a multi-byte character that may be white space none is made."""
    space = is_space(data)
    cut = space.copy()
    cut[:1] = False
    cut[1:] &= ~space[:-1]
    at = np.flatnonzero(cut)
    at2 = at[(at < 2) | (data[np.maximum(at - 2, 0)] != 0xC2)]
    lead = data[np.maximum(at2 - 3, 0)]
    at3 = at2[(at2 < 3) | (lead < 0xE1) | (lead > 0xE3)]
    return np.union1d(offsets, at3)


def count_part(texts: pa.Array, encode: Callable, safe: bool, memory: dict[str, int],
               call_bytes: int) -> np.ndarray:
    offsets, data = text_buffers(texts)
    starts = safe_cuts(offsets, data) if safe else np.unique(offsets)
    pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
    coded = pieces.dictionary_encode()
    inputs = coded.dictionary.to_pylist()
    counts = np.fromiter((memory.get(x, -1) for x in inputs), np.int64, len(inputs))
    new = np.flatnonzero(counts < 0)
    sizes = np.cumsum([len(inputs[i]) for i in new])
    at = 0
    while at < len(new):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + call_bytes, "right")))
        counts[new[at:stop]] = np.fromiter(encode([inputs[i] for i in new[at:stop]]), np.int64, stop - at)
        at = stop
    if len(memory) + len(new) > MEMORY:
        memory.clear()
    memory.update((inputs[i], int(counts[i])) for i in new[:MEMORY] if len(inputs[i]) <= 64)
    total = np.zeros(len(starts), np.int64)
    if len(inputs):
        np.cumsum(counts[coded.indices.to_numpy()], out=total[1:])
    where = np.searchsorted(starts, offsets)
    return total[where[1:]] - total[where[:-1]]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text", part_bytes: int = PART_BYTES, call_bytes: int = CALL_BYTES) -> DataFrame:
    """Per row: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is a path that every executor has (.json or .model).
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, safe = open_counter(tokenizer)
        memory: dict[str, int] = {}
        for batch in batches:
            for part in byte_slices(batch, "text", part_bytes):
                offsets, _ = text_buffers(part.column("text"))
                n = count_part(part.column("text"), encode, safe, memory, call_bytes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                    names=["key", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["key"].dataType.simpleString()
    return (rows.mapInArrow(frugal(count), f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("key", key))
