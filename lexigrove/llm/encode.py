"""Encoding a corpus with a public byte-level BPE tokenizer through a shared lexicon of frequent words."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.llm.flat import MEMO_PIECES, FlatMemo, slices
from lexigrove.llm.transducer import Transducer
from lexigrove.session import exists, shared_dir

TOKENIZERS = "/opt/tokenizers"
#: Words of the lexicon. It is only a short cut: words outside it are merged exactly, so the result doesn't depend on it.
LEXICON_WORDS = 32_768
LONGEST_WORD = 64

# Characters with the Unicode property White_Space, and the split pattern of the byte-level vocabulary.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words: a run of other characters with the one blank before it, or white space up to where such a blank begins.
#: No piece of the split pattern crosses the edge of such a word, so words can be encoded one by one.
WORDS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")

_encoders: dict[str, object] = {}
_lexicons: dict[str, Lexicon] = {}


def encoder(path: str):
    """The exact merger: byte-level BPE over the ranks of a .tiktoken file; one a process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


class Lexicon:
    """Frequent words with their ids: a transducer and an id table in one memory-mapped file."""

    FIELDS = (("keys", np.int64), ("targets", np.int32), ("outputs", np.int32), ("final", np.uint8), ("offsets", np.int64), ("ids", np.int32))

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        sizes = raw[: 8 * len(self.FIELDS)].view(np.int64)
        at, parts = 8 * len(self.FIELDS), {}
        for (name, kind), n in zip(self.FIELDS, sizes, strict=True):
            width = int(n) * np.dtype(kind).itemsize
            parts[name] = raw[at : at + width].view(kind)
            at += -(-width // 8) * 8
        self.transducer = Transducer(parts["keys"], parts["targets"], parts["outputs"], parts["final"])
        self.offsets, self.ids = parts["offsets"], parts["ids"]

    @classmethod
    def compile(cls, words: list[str], encode) -> bytes:
        ordered = sorted({w.encode() for w in words})
        t = Transducer.build(ordered)
        lists = [encode(w.decode()) for w in ordered]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
        arrays = dict(keys=t.keys, targets=t.targets, outputs=t.outputs, final=t.final, offsets=offsets, ids=np.array(list(chain.from_iterable(lists)), dtype=np.int32))
        parts = [np.array([len(arrays[n]) for n, _ in cls.FIELDS], dtype=np.int64).tobytes()]
        for name, kind in cls.FIELDS:
            data = arrays[name].astype(kind).tobytes()
            parts.append(data + b"\0" * (-len(data) % 8))
        return b"".join(parts)


def word_memo(lexicon: Lexicon, encode) -> FlatMemo:
    """Word to id list, for one task: asks the lexicon for all new words of a slice at once, merges the rest exactly."""

    def resolve(words: list[str]) -> list:
        ranks = lexicon.transducer.ranks([w.encode() for w in words])
        known = np.maximum(ranks, 0)
        first, last = lexicon.offsets[known], lexicon.offsets[np.minimum(known + 1, len(lexicon.offsets) - 1)]
        return [lexicon.ids[a:b] if r >= 0 else encode(w) for w, r, a, b in zip(words, ranks.tolist(), first.tolist(), last.tolist(), strict=True)]

    return FlatMemo(resolve)


def encode_texts(memo: FlatMemo, texts: list[str | None]) -> pa.ListArray:
    ids, bounds = memo.numbers([WORDS.findall(t) if t else [] for t in texts])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))


def write_shared(spark: SparkSession, path: str, data: bytes) -> None:
    """Write bytes to a file in the shared folder, whatever file system that is on."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) <= LONGEST_WORD]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    for batch in batches:
        for _, texts in slices(batch.column(0)):
            counts.update(chain.from_iterable(WORDS.findall(t) for t in texts if t))
            if len(counts) > MEMO_PIECES:
                yield out()
                counts.clear()
    yield out()


def frequent_words(documents: DataFrame, text_col: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The `limit` most frequent words over all documents (ties by word); at most limit * LONGEST_WORD characters come to the driver."""
    counts = documents.select(text_col).mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [r[0] for r in counts.where("n > 1").orderBy(F.desc("n"), "word").limit(limit).collect()]


def encode(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(id, ids) of each row: the text encoded by a byte-level BPE vocabulary, without special tokens.

    Method: the most frequent words of the whole corpus are compiled with their id lists into a minimal acyclic
    transducer, which every executor memory-maps; words outside it are merged exactly by the vocabulary's ranks.

    Scale: two passes over the text, no shuffle of text: the first sends word counts, combined a task, the second
    nothing. What the driver holds is bounded by `lexicon_words`. A lost executor's tasks are simply run again, and
    the lexicon stands in the shared folder, from where Spark brings it to new executors. Memory follows slices of some million characters, except
    that one text is encoded at once.

    Defined cases: a null and an empty text give an empty list; every row gives one row, repeated rows too; an empty
    table gives no rows; other columns are ignored.
    """
    spark: SparkSession = documents.sparkSession
    words = frequent_words(documents, text_col, lexicon_words)
    lexicon = Lexicon.compile(words, encoder(vocabulary).encode_ordinary)
    # Named by its content, so the same lexicon is written and handed to Spark once, however often it is asked for.
    name = f"lexicon-{hashlib.sha256(lexicon).hexdigest()[:32]}.bin"
    path = f"{shared_dir(spark)}/{name}"
    if not exists(spark, path):
        write_shared(spark, path, lexicon)
    if not any(f.endswith(name) for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _lexicons:
            _lexicons.clear()
            _lexicons[name] = Lexicon(SparkFiles.get(name))
        memo = word_memo(_lexicons[name], encoder(vocabulary).encode_ordinary)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), encode_texts(memo, texts)], names=[id_col, "ids"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")
