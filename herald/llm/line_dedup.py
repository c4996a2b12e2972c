"""Line dedup: lines whose key occurs in many documents are dropped, but for one keeper.

Arrow tasks explode each text into (document, 128-bit line hash), one row for
each key of a document. Documents are counted for each hash with a map-side
partial count, so a line that a third of all documents share is one row a task.
Only hashes over the threshold meet the lines again; the drops come back as one
list per document, and the text is rebuilt by position in a second pass.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herald.llm.common import Scratch, slices, utf8

MIN_CHARS = 20
MIN_DOCUMENTS = 3
HOT_SHARE = 1000
_STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
#: Bytes 0x80..0xBF continue a code point.
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """Key hash of every line of a text; None where the key is shorter than ``min_chars``."""
    out = []
    for line in text.translate(_LOWER).split(b"\n"):
        key = line.strip(_STRIP)
        long_enough = len(key) >= min_chars and (
            len(key) >= 4 * min_chars or len(key.translate(None, _CONTINUATION)) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return out


def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, key): one row per distinct key of each row's text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, keys = [], []
            for i, text in enumerate(utf8(batch.column(1))):
                found = {k for k in line_keys(text, min_chars) if k is not None}
                at.extend([i] * len(found))
                keys.extend(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())],
                [id_col, "key"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, key binary")


def repeated_lines(lines: DataFrame, id_col: str, min_documents: int) -> DataFrame:
    """(key, keeper): keys in at least ``min_documents`` different ids, with the largest id.

    Rows are counted first; only keys with enough rows and two ids at least have
    their ids counted apart, so a repeated row doesn't pass for a document.
    """
    counted = lines.groupBy("key").agg(F.count(id_col).alias("n"), F.min(id_col).alias("low"),
                                       F.max(id_col).alias("keeper"))
    return counted.filter((F.col("n") >= min_documents) & (F.col("low") < F.col("keeper")))


def dropped_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int,
                 min_documents: int) -> DataFrame:
    """(id, keys): for each id that loses lines, the sorted keys it loses.

    Keys that hold more than one in ``HOT_SHARE`` rows number fewer than that: they are
    broadcast, so that no line, however common, meets its rows in one task.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.write(line_table(docs, id_col, text_col, min_chars))
    repeated = scratch.few(repeated_lines(lines, id_col, min_documents))
    is_hot = F.col("n") * HOT_SHARE > lines.count()
    hot, cold = repeated.filter(is_hot).select("key", "keeper"), repeated.filter(~is_hot).select("key", "keeper")
    common = lines.join(F.broadcast(hot), "key").withColumn("hot", F.lit(True))
    others = lines.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key") \
        .withColumn("hot", F.lit(False))
    candidates = scratch.few(common.unionByName(others).select("key", id_col, "keeper", "hot").distinct())
    over = scratch.few(candidates.groupBy("key", "hot").agg(F.count(id_col).alias("n"))
                       .filter(F.col("n") >= min_documents).select("key", "hot"))
    losing = candidates.filter(F.col(id_col) < F.col("keeper"))
    losing = losing.filter("hot").join(F.broadcast(over.filter("hot").select("key")), "key", "left_semi") \
        .unionByName(losing.filter("not hot").join(over.filter("not hot").select("key"), "key", "left_semi"))
    return losing.groupBy(id_col).agg(F.sort_array(F.collect_list("key")).alias("keys"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
                counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with ``text_col`` rebuilt from the kept lines, plus the number of lines and of dropped ones.

    A line's key is the line stripped of ASCII white space, with A-Z lower-cased.
    Keys of at least ``min_chars`` code points that occur under at least
    ``min_documents`` different ids lose all their lines, except under the
    largest of these ids. A null or empty text is one empty line and becomes an
    empty text. Rows that share an id count as one document and lose the same
    lines. A row with a null id is no document: it isn't counted and keeps its
    lines. An empty table gives an empty one. Other columns pass through; columns
    named like the two of ``counts`` are replaced.
    """
    docs = docs.drop(*counts)
    drops = dropped_keys(docs, id_col, text_col, min_chars, min_documents)
    keys = "__dropped_keys"
    joined = docs.join(drops.select(F.col(id_col), F.col("keys").alias(keys)), id_col, "left") \
        .select(*docs.columns, keys)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in counts]])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept_texts, n_lines, n_dropped = [], [], []
            gone = batch.column(batch.num_columns - 1).to_pylist()
            for text, drop in zip(utf8(batch.column(at)), gone, strict=True):
                if drop:
                    drop, raw = set(drop), text.split(b"\n")
                    kept = [line for line, key in zip(raw, line_keys(text, min_chars), strict=True)
                            if key not in drop]
                    kept_texts.append(b"\n".join(kept))
                    n_lines.append(len(raw))
                    n_dropped.append(len(raw) - len(kept))
                else:
                    kept_texts.append(text)
                    n_lines.append(text.count(b"\n") + 1)
                    n_dropped.append(0)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(kept_texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                schema.names)

    return joined.mapInArrow(run, schema)


def kept_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_dropped`` and the SHA-256 of the kept text."""
    out = dedup_lines(docs.select(id_col, text_col), id_col, text_col, **options)
    return out.select(id_col, "n_lines", "n_dropped", F.sha2(text_col, 256).alias("kept_sha256"))


