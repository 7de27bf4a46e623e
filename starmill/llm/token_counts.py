"""Token counts: batches of about equal bytes are encoded in Arrow functions that return lengths only.

Long texts are cut where the pattern of a byte-level tokenizer always begins a new piece: before a single space with a
character that is not white space on either side. No match of the pattern goes over such a place, so the parts have
together as many tokens as the whole. A run without such a place stays whole. Tokenizers of another make get whole
texts.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted one by one; an empty table gives no rows;
other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starmill.llm.texts import id_and_text, map_texts

PART_CHARS = 16_384
BATCH_CHARS = 262_144
SAFE = re.compile(r"(?<=\S) (?=\S)")


def parts(text: str, most: int = PART_CHARS) -> list[str]:
    """``text`` in parts of ``most`` characters or, where no safe place follows at once, somewhat more."""
    out, start = [], 0
    while len(text) - start > most:
        place = SAFE.search(text, start + most)
        if not place:
            break
        out.append(text[start:place.start()])
        start = place.start()
    out.append(text[start:])
    return out


@lru_cache(maxsize=4)
def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """Counts of a batch, and whether texts may be cut."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.no_truncation()
        own.no_padding()
        byte_level = type(own.pre_tokenizer).__name__ == "ByteLevel" and own.normalizer is None
        return lambda texts: [len(x) for x in own.encode_batch_fast(texts, add_special_tokens=False)], byte_level
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], False
    raise ValueError(f"no library here reads {path}")


def count_texts(texts: list[str], path: str, batch_chars: int = BATCH_CHARS) -> list[int]:
    """Tokens of each text; parts of all texts fill batches of about ``batch_chars`` characters."""
    count, cut = counter(path)
    totals = np.zeros(len(texts), np.int64)
    batch: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        np.add.at(totals, owners, count(batch))

    for at, text in enumerate(texts):
        for part in parts(text) if cut else [text]:
            if batch and held + len(part) > batch_chars:
                flush()
                batch, owners, held = [], [], 0
            batch.append(part)
            owners.append(at)
            held += len(part)
    if batch:
        flush()
    return totals.tolist()


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens (long), a row for each row of ``docs``; ``path`` is a tokenizer file on every executor."""

    def run(batch: pa.RecordBatch, texts: list[str]):
        return batch.column("doc_id"), [len(t.encode()) for t in texts], count_texts(texts, path)

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, n_bytes long, n_tokens long")
