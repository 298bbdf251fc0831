"""Token counts through a digest cache.

Counts are stored under (content digest, tokenizer digest), one folder for each
tokenizer.  Documents whose digest is stored are answered by a join; of the
others each distinct text is encoded once and appended to the cache.  Content is normalised by taking null
as the empty text only: any stronger form could change the library's count.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import frames

#: Segments whose counts a worker remembers before it starts anew; bounds memory, not the result.
CACHE_SEGMENTS = 400_000
_COUNTS = "content_digest binary, n_tokens long"
_SEGMENT = re.compile("[ ▁]+[^ ▁]*")


class Counter:
    """Counts tokens as the library of the file does: sentencepiece for .model, tokenizers for .json."""

    def __init__(self, path: str) -> None:
        self.cache: dict[str, int] = {}
        self.piecewise = False
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._encode = lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            # A piece may have word marks at its start only; then no merge crosses from a word into the blank after it,
            # and the count of a text is the sum over its blank-led segments.
            marks_lead = not any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
            plain = model.encode("  a  b ", out_type=str)
            self.piecewise = marks_lead and "".join(plain) == "▁▁▁a▁▁b▁" and model.encode("　ﬁé", out_type=str)[0] == "▁"

    def counts(self, texts: list[str]) -> list[int]:
        if not self.piecewise:
            return self._encode(texts)
        split = [_SEGMENT.findall(" " + t) if t else [] for t in texts]
        if len(self.cache) > CACHE_SEGMENTS:
            self.cache.clear()
        missing = [s for s in set().union(*split) if s not in self.cache]
        # The library puts a blank before each text: the segment's own first one.
        self.cache.update(zip(missing, self._encode([s[1:] for s in missing]), strict=True))
        self.cache.update({" ": 1, "▁": 1})
        return [sum(map(self.cache.__getitem__, segments)) for segments in split]


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter for each worker process."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _stored(spark, cache_path: str, version: str) -> DataFrame:
    """The cache's rows for one tokenizer."""
    where = f"{cache_path.rstrip('/')}/tokenizer_digest={version}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(where)


def append(counts: DataFrame, cache_path: str) -> None:
    """Add rows (content_digest, tokenizer_digest, n_tokens) to a cache."""
    counts.write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path)


def compact(spark, cache_path: str, version: str, target: str) -> None:
    """Write one tokenizer's rows of a cache to the cache ``target``, each digest once."""
    rows = _stored(spark, cache_path, version).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    append(rows.withColumn("tokenizer_digest", F.lit(version)), target)


def count_tokens(docs: DataFrame, path: str, cache_path: str, limit: int = 4096) -> DataFrame:
    """Token counts of each whole text, through the cache at ``cache_path``.

    Returns doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``).
    Null text is empty: no bytes, no tokens.  Each row is answered, repeated
    rows and null ids too; no other column is looked at.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("content_digest"))
    stored = _stored(spark, cache_path, version)
    first_run = not stored.inputFiles()
    distinct = keyed.select("content_digest", "text").dropDuplicates(["content_digest"])  # each task sends a text once
    misses = distinct.join(stored, "content_digest", "left_anti")

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        count, n, i = counter(path).counts, [], 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= 2 << 20):
                chars += len(texts[j])
                j += 1
            n += count(texts[i:j])
            i = j
        return {"tokenizer_digest": [version] * len(n), "n_tokens": np.array(n, np.int64)}

    fresh = frames.map_batches(misses, [("tokenizer_digest", T.StringType()), ("n_tokens", T.LongType())], run, keep=["content_digest"])
    append(fresh, cache_path)
    small = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("content_digest"))
    counts = _stored(spark, cache_path, version)
    if not first_run:  # of an older cache only this run's digests go on
        counts = counts.join(small.select("content_digest").distinct(), "content_digest", "left_semi")
    # An append that was repeated after a failure counts once.
    counts = counts.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts = frames.written(counts, "known-counts")  # both sides of the join then come straight from a shuffle, which splits a hot text
    return small.join(counts, "content_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
