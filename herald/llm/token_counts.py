"""Token counts: batch encoding inside Arrow tasks, returning lengths only.

A byte-level pre-tokenizer cuts before a single space that stands between two
characters that are no white space, and counts of the parts add up. Texts are split there, the
counts of parts are kept in a bounded memo of the worker process, and only parts it
doesn't hold are encoded, in calls of about ``BATCH_BYTES`` bytes whatever their number: a
call's memory does not depend on how long the texts are, only on the longest part.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from herald.llm.common import slices

BATCH_BYTES = 1 << 20
MEMO_PARTS = 400_000
#: Longer parts are seldom met again and are not kept.
MEMO_CHARS = 64
SAFE = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_file(name: str) -> str:
    """``name`` itself if it is a path, else the public tokenizer file of that name."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def in_calls(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in runs of about ``BATCH_BYTES`` characters."""
    call, held = [], 0
    for text in texts:
        call.append(text)
        held += len(text)
        if held >= BATCH_BYTES:
            yield call
            call, held = [], 0
    if call:
        yield call


class PartCounter:
    """Token counts of texts as sums over their parts.

    The first part of a text stands by itself, the others follow a space, so they are
    remembered apart.
    """

    def __init__(self, encode: Callable[[list[str]], list[int]]):
        self.encode = encode
        self.memos: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def lookup(self, parts: set[str], memo: dict[str, int], before: str) -> dict[str, int]:
        """``memo`` with all of ``parts``; a copy for this call if it holds long ones."""
        if len(memo) > MEMO_PARTS:
            memo.clear()
        new = list(parts.difference(memo))
        counts = [n for call in in_calls(new) for n in self.encode([before + p for p in call])]
        found = dict(zip(new, counts, strict=True))
        memo.update((p, n) for p, n in found.items() if len(p) <= MEMO_CHARS)
        long = {p: n for p, n in found.items() if len(p) > MEMO_CHARS}
        return {**memo, **long} if long else memo

    def __call__(self, texts: list[str]) -> list[int]:
        split = [SAFE.split(t) for t in texts]
        heads, rests = [p[0] for p in split], [p[1:] for p in split]
        first = self.lookup(set(heads), self.memos[0], "")
        later = self.lookup(set().union(*rests), self.memos[1], " ").__getitem__
        return [first[h] + sum(map(later, r)) for h, r in zip(heads, rests, strict=True)]


@functools.lru_cache(maxsize=4)
def load_counter(name: str, splittable: bool) -> Callable[[list[str]], list[int]]:
    """A function from texts to their token counts, one a worker process."""
    path = tokenizer_file(name)
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for call in in_calls(texts) for x in sp.encode(call, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    def encode(texts: list[str]) -> list[int]:
        return [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]

    if splittable:
        return PartCounter(encode)
    return lambda texts: [n for call in in_calls(texts) for n in encode(call)]


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = "byte_bpe_50k.json", limit: int = 1024,
                 splittable: bool = True) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (``n_tokens > limit``).

    Null texts count as empty (0 bytes, 0 tokens); a null id stays null; repeated
    rows each give a row; an empty table gives an empty one; other columns of
    ``df`` are not read. ``splittable`` must be False for a tokenizer whose
    pre-tokens may hold a space behind their first character (sentencepiece is never split).
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_counter(tokenizer, splittable)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            totals = count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
                 pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
