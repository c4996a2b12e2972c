"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

Every document becomes token ids plus an end id. Runs of a whole window are cut
off first; what is left over is cut into items of at most ``ITEM_TOKENS``, so
that no single item dominates a window. Items are dealt at random into batches
of about ``BATCH_WINDOWS`` windows (a batch is one task's work, whatever the size
of the corpus), and each batch is split into ``k`` near-equal windows: the two
partial partitions with the largest spread are merged again and again, the
fullest windows of one onto the emptiest of the other. If a window then exceeds
the capacity, ``k`` rises and the batch is split anew, so a window is never
overfull and every token lies in exactly one piece.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import Scratch, slices, utf8
from herald.llm.token_counts import tokenizer_file

CAPACITY = 4096
ITEM_TOKENS = 1024
BATCH_WINDOWS = 512
MEMO_WORDS = 250_000
ENCODE_BYTES = 1 << 20

PIECE_SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, salt long"


class WordEncoder:
    """Ids of a text as packed little-endian uint32, one memoised word at a time.

    For a tokenizer that lower-cases and whose pre-tokens never cross white space, a
    text's ids are the ids of its white-space separated words in order. Texts are
    first brought closer together where that can't change an id: A-Z are
    lower-cased (unless the text holds ``<|``, which may open a special token, or
    combining marks) and a full stop or comma between a letter and white space
    is set apart. The distinct words of some texts are looked up in a bounded memo, once each,
    and their ids dealt out to all places. Missing words made of letters below U+0180 are one
    pre-token each, as is a tail of ASCII punctuation, and go straight to the tokenizer's model;
    anything else goes to the tokenizer by itself.
    """

    _STOP = re.compile(rb"[,.](?<=[A-Za-z][,.])(?=[\x20\x09-\x0D])")
    #: A word a line: its letters and its tail, both empty for any other word.
    _SIMPLE = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-įı-ňŊ-ſ]+)"
                         r"([!\"#$%&()*+,\-./:;=?@\[\]^_{}~]*)|.*)$", re.MULTILINE)

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tok = Tokenizer.from_file(tokenizer_file(tokenizer))
        self.tok.no_truncation()
        self.tok.no_padding()
        self._model_tokens = self.tok.model.tokenize
        self._packed = [struct.pack("<I", i) for i in range(max(self.tok.get_vocab().values()) + 1)]
        # the characters that stand for the bytes of letters in a byte-level model; ASCII stands for itself
        byte_level, letters = ByteLevel(add_prefix_space=False, use_regex=False), map(chr, range(0xC0, 0x180))
        self._byte_chars = {b: c for x in letters
                            for b, c in zip(x.encode(), byte_level.pre_tokenize_str(x)[0][0], strict=True)}
        simple = self._simple_characters()
        self._direct = self._by_model(simple) == self._encode(simple)
        #: The words met since the memo was last full, and those of the time before, see :meth:`remember`.
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _simple_characters(self) -> list[str]:
        """Every letter and mark of :attr:`_SIMPLE` by itself, and all letters and all marks as a word."""
        chars = list(map(chr, range(0x21, 0x180)))
        letters = [c for c in chars if (m := self._SIMPLE.fullmatch(c)) and m[1] and c == c.lower()]
        marks = [c for c in chars if (m := self._SIMPLE.fullmatch("a" + c)) and m[2]]
        return [*letters, *marks, "".join(letters), "".join(marks)]

    def _encode(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def _by_model(self, words: list[str]) -> list[bytes]:
        """Ids of words that are normal already and one pre-token each."""
        tokens, packed, chars = self._model_tokens, self._packed, self._byte_chars
        return [b"".join([packed[t.id] for t in tokens(
            w if w.isascii() else w.encode().decode("latin-1").translate(chars))]) for w in words]

    def learn(self, words: list[bytes]) -> None:
        """Memoise distinct words without white space."""
        if not words:
            return
        memo, runs, made, other = self.memo, {}, [], []
        for w, (core, tail) in zip(words, self._SIMPLE.findall(b"\n".join(words).decode()), strict=True):
            if not core:
                other.append(w)
                continue
            low = core.lower()
            if tail or low != core:
                made.append((w, low.encode(), tail.encode()))
            else:
                runs[w] = core
        runs |= {x: x.decode() for _, *pair in made for x in pair if x and x not in memo}
        memo.update(zip(runs, (self._by_model if self._direct else self._encode)(list(runs.values())), strict=True))
        for w, core, tail in made:
            memo[w] = memo[core] + memo[tail] if tail else memo[core]
        memo.update(zip(other, self._encode([w.decode() for w in other]), strict=True))

    def spaced(self, text: bytes) -> bytes:
        if b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()
        return self._STOP.sub(rb" \g<0>", text)

    def remember(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct ``words``, all of which are in the memo then.

        A full memo becomes the older one, from which words that are met again come back: words of
        few texts are forgotten, frequent ones are encoded once. Words of one document only are most of a memo.
        """
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        ids = list(map(memo.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        unknown = []
        for i in new:
            if (w := words[i]) in older:
                memo[w] = older[w]
            else:
                unknown.append(w)
        self.learn(unknown)
        for i in new:
            ids[i] = memo[words[i]]
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(map(self.spaced, texts), pa.large_string()))
        places = split.flatten().dictionary_encode()
        ids = self.remember(places.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = places.indices.to_numpy()
        sizes = size[at]
        ends = np.append(0, np.cumsum(sizes))
        # where each id lies among those of the distinct words
        lies = np.repeat((np.cumsum(size) - size)[at] - ends[:-1], sizes)
        lies += np.arange(len(lies))
        packed = np.frombuffer(b"".join(ids), "<u4")[lies]
        ends = ends[split.offsets.to_numpy()].tolist()
        del split, places, at
        pa.default_memory_pool().release_unused()  # a worker's memory is the memo's
        return [packed[a:b].tobytes() for a, b in itertools.pairwise(ends)]


@functools.lru_cache(maxsize=2)
def word_encoder(tokenizer: str) -> WordEncoder:
    """One encoder a worker process, so that its memo serves all tasks the process runs."""
    return WordEncoder(tokenizer)


def cut(n: int, capacity: int, item: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then items of nearly equal size."""
    whole = n // capacity
    out = [(i * capacity, capacity) for i in range(whole)]
    start, rest = whole * capacity, n - whole * capacity
    parts = -(-rest // item)
    for i in range(parts):
        length = rest // parts + (i < rest % parts)
        out.append((start, length))
        start += length
    return out


def differencing(lengths: np.ndarray, k: int) -> np.ndarray:
    """Window of each item: Karmarkar-Karp differencing into ``k`` near-equal windows."""
    n = len(lengths)
    if k == 1 or n == 0:
        return np.zeros(n, dtype=np.int64)
    sums, nodes, left, right = {}, {}, [], []
    heap = []
    for i, size in enumerate(lengths.tolist()):
        s = np.zeros(k, dtype=np.int64)
        s[-1] = size
        m = np.full(k, -1, dtype=np.int64)
        m[-1] = i
        sums[i], nodes[i] = s, m
        heap.append((-size, i))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]
        one, two = nodes.pop(a), nodes.pop(b)[::-1]
        both = (one >= 0) & (two >= 0)
        merged = np.maximum(one, two)
        if both.any():
            left.extend(one[both].tolist())
            right.extend(two[both].tolist())
            merged[both] = np.arange(made, made + int(both.sum()))
            made += int(both.sum())
        order = np.argsort(total, kind="stable")
        sums[a], nodes[a] = total[order], merged[order]
        heapq.heappush(heap, (int(total[order[0]] - total[order[-1]]), a))
    window = np.full(made, -1, dtype=np.int64)
    last = nodes[heap[0][1]]
    window[last[last >= 0]] = np.flatnonzero(last >= 0)
    for i in range(made - 1, n - 1, -1):
        window[left[i - n]] = window[right[i - n]] = window[i]
    return window[:n]


def pack_batch(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item, no window above ``capacity``; the window count rises until that holds.

    The first count leaves each window 1/256 of slack, about the spread that differencing
    reaches; with less, the first attempt would be in vain nearly always.
    """
    total = int(lengths.sum())
    k = 1 if total <= capacity else -(-total // (capacity - capacity // 256))
    while True:
        window = differencing(lengths, k)
        most = int(np.bincount(window, weights=lengths, minlength=k).max()) if len(lengths) else 0
        if most <= capacity:
            return window
        k += max(1, int(k * (most / capacity - 1) / 2))


def tokenised_pieces(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int,
                     capacity: int, item: int) -> DataFrame:
    """One row per piece of each document, with the checksum of its ids."""
    id_type = df.schema[id_col].dataType.simpleString()
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = word_encoder(tokenizer)
        seen = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            texts, rows, i = utf8(batch.column(1)), [], 0
            while i < len(texts):
                held, j = 0, i
                while j < len(texts) and (j == i or held + len(texts[j]) <= ENCODE_BYTES):
                    held += len(texts[j])
                    j += 1
                for at, ids in enumerate(encoder.encode(texts[i:j]), start=i):
                    ids += end
                    for start, length in cut(len(ids) // 4, capacity, item):
                        crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                        rows.append((at, start, length, crc, len(ids) // 4, seen))
                        seen += 1
                i = j
            if rows:
                cols = np.array(rows, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0]))] + [pa.array(c) for c in cols[1:]],
                    [id_col, "start", "length", "ids_crc32", "doc_tokens", "salt"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, {PIECE_SCHEMA}")


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = CAPACITY,
                   item: int = ITEM_TOKENS, batch_windows: int = BATCH_WINDOWS) -> DataFrame:
    """Per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Token ids ``start .. start + length`` of the document lie at ``offset`` of the
    sequence. A null or empty text is the end id alone. A null id stays null and
    repeated rows are separate documents (both get pieces). An empty table gives
    an empty one. Other columns of ``df`` are not read. Ties in length are broken
    by the pieces' order, so reruns over the same files agree.
    """
    scratch = Scratch(df.sparkSession, "packing")
    pieces = scratch.write(tokenised_pieces(df, id_col, text_col, tokenizer, end_id, capacity, item))
    total = pieces.agg(F.sum("length")).first()[0] or 0
    batches = max(1, round(total / (batch_windows * capacity)))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("salt")
        lengths = group["length"].to_numpy()
        whole = lengths == capacity
        window = np.empty(len(lengths), dtype=np.int64)
        window[~whole] = pack_batch(lengths[~whole], capacity)
        first = window[~whole].max(initial=-1) + 1
        window[whole] = np.arange(first, first + int(whole.sum()))
        order = np.argsort(window, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        opens = np.append(True, np.diff(window[order]) > 0)
        offset = np.empty_like(lengths)
        offset[order] = before - np.maximum.accumulate(np.where(opens, before, 0))
        group = group.drop_columns(["salt", "batch"])
        group = group.append_column("sequence_id", pa.array((key[0].as_py() << 24) + window))
        return group.append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("batch", F.pmod(F.xxhash64("salt"), F.lit(batches)))
    return dealt.groupBy("batch").applyInArrow(
        run, f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long")
