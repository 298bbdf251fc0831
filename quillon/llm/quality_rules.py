"""Quality rules: rule statistics, and an isolation forest over them.

The statistics are computed for every document in one map pass.  The forest is
fitted on statistics of a bounded sample of labelled good documents (see
``SAMPLE_ROWS``); its anomaly threshold is calibrated on labelled rows so that
almost all good ones stay.  Scoring touches statistics only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import frames
from quillon.llm.text_blocks import blocks, covered, mix64, windows

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Labelled rows that the forest and its threshold are fitted on, at most: those with the smallest hashes of doc_id.
SAMPLE_ROWS = 20_000
N_TREES, TREE_ROWS, SEED = 128, 512, 7
#: Share of labelled good documents that the threshold may reject.
GOOD_LOSS = 0.002
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """The five statistics of each text of a column; null texts have none of anything."""
    out = {c: np.zeros(len(column), np.int64) for c in STATS}
    for block in blocks(column):
        here = slice(block.first, block.first + block.docs)
        starts, ends, docs = block.words()
        hashes = block.hashes(starts, ends)
        n = np.bincount(docs, minlength=block.docs)
        out["n_words"][here] = n
        heads = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
        out["word_chars"][here] = np.bincount(docs, heads[ends] - heads[starts], block.docs).astype(np.int64)
        out["n_symbols"][here] = block.per_doc(_SYMBOLS[block.data])
        line_starts, line_ends, line_docs = block.lines()
        full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
        line_docs = line_docs[full]
        keys = mix64(block.hashes(line_starts[full], line_ends[full])) ^ mix64(line_docs.astype(np.uint64))
        _, first = np.unique(keys, return_index=True)
        out["n_dup_lines"][here] = np.bincount(line_docs, minlength=block.docs) - np.bincount(line_docs[first], minlength=block.docs)
        at, grams = windows(hashes, docs, 5)
        grams ^= mix64(docs[at].astype(np.uint64))
        order = np.argsort(grams)
        ranked = grams[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        repeats = covered(at[twice], 5, len(starts))
        out["n_repeat_words"][here] = np.bincount(docs[repeats], minlength=block.docs)
    return out


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words = np.maximum(s["n_words"], 1)
    return np.stack([s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / words, s["n_repeat_words"] / words], axis=1)


@dataclass
class Forest:
    """Isolation trees as flat arrays: feature (-1: leaf), cut, left child (right: left + 1), and path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    length: np.ndarray
    depth: int
    norm: float
    low: np.ndarray
    high: np.ndarray
    threshold: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is anomalous."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = self.feature[t][node]
                inner = f >= 0
                right = x[every, np.maximum(f, 0)] >= self.cut[t][node]
                node = np.where(inner, self.left[t][node] + right, node)
            total += self.length[t][node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def _expected(n: int) -> float:
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def fit_forest(x: np.ndarray, trees: int = N_TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """Trees of random splits over random features, each on a sample of ``rows``.

    The cut is drawn from the node's range widened by half its width, so that
    values outside what good documents have are cut off early.
    """
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))) + 2)
    spread = np.maximum(x.max(axis=0) - x.min(axis=0), 1e-9)
    built = []
    for _ in range(trees):
        feature, cut, left, length = [-1], [0.0], [0], [0.0]
        stack = [(0, x[rng.choice(len(x), rows, replace=False)], 0)]
        while stack:
            node, part, level = stack.pop()
            if level >= depth or len(part) < 2:
                length[node] = level + _expected(len(part))
                continue
            f = int(rng.integers(x.shape[1]))
            low, high = part[:, f].min(), part[:, f].max()
            room = 0.5 * (high - low) + 0.02 * spread[f]
            c = rng.uniform(low - room if low > 0 else low, high + room)
            k = len(feature)
            feature[node], cut[node], left[node] = f, c, k
            feature += [-1, -1]
            cut += [0.0, 0.0]
            left += [0, 0]
            length += [0.0, 0.0]
            right = part[:, f] >= c
            stack += [(k, part[~right], level + 1), (k + 1, part[right], level + 1)]
        built.append((feature, cut, left, length))
    size = max(len(b[0]) for b in built)
    pad = lambda k, fill, kind: np.array([b[k] + [fill] * (size - len(b[k])) for b in built], kind)
    return Forest(pad(0, -1, np.int64), pad(1, 0.0, float), pad(2, 0, np.int64), pad(3, 0.0, float), depth, max(_expected(rows), 1e-9), x.min(axis=0), x.max(axis=0))


def fit(stats: dict[str, np.ndarray], good: np.ndarray, good_loss: float = GOOD_LOSS) -> Forest | None:
    """Forest of the good rows that pass the base rules, its threshold the smallest score that loses at most ``good_loss`` of them.

    Between that and the scores of labelled bad rows the threshold rises as far
    as no further bad row is lost, so unlabelled clean documents have room.
    None if fewer than two good rows pass: then the base rules decide alone.
    """
    use = ~base_failed(stats)
    x, good = features(stats)[use], good[use]
    if good.sum() < 2:
        return None
    forest = fit_forest(x[good])
    scores = forest.score(x)
    kept = np.sort(scores[good])
    floor = kept[max(0, int(np.ceil(len(kept) * (1 - good_loss))) - 1)]
    worse = scores[~good][scores[~good] > floor]
    forest.threshold = float((floor + worse.min()) / 2 if len(worse) else floor + 1e-9)
    return forest


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the five statistics."""

    def run(batch: pa.RecordBatch) -> dict:
        return text_stats(batch.column(batch.schema.get_field_index("text")))

    return frames.map_batches(docs, [(c, T.LongType()) for c in STATS], run, keep=keep)


def fit_labelled(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest | None:
    """Fit on at most ``sample_rows`` labelled rows; a document with labels of both kinds counts as bad."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_good"))
    labelled = frames.written(stats.select("doc_id", *STATS).join(marks, "doc_id"), "labelled")
    rows = frames.hash_sample(labelled, ["doc_id", *STATS], sample_rows).collect()
    table = {c: np.array([r[c] for r in rows], np.int64) for c in STATS}
    return fit(table, np.array([r["_good"] == 1 for r in rows], bool)) if rows else None


def judge(stats: DataFrame, forest: Forest | None, keep: list[str]) -> DataFrame:
    """Adds base_failed, anomaly (score) and kept to rows that have the statistics."""
    model = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batch: pa.RecordBatch) -> dict:
        s = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in STATS}
        return verdict(s, model.value)

    fields = [("base_failed", T.BooleanType()), ("anomaly", T.DoubleType()), ("kept", T.BooleanType())]
    return frames.map_batches(stats, fields, run, keep=keep)


def verdict(s: dict[str, np.ndarray], forest: Forest | None) -> dict[str, np.ndarray]:
    failed = base_failed(s)
    score = forest.score(features(s)) if forest else np.zeros(len(failed))
    return {"base_failed": failed, "anomaly": score, "kept": ~failed & (score < forest.threshold if forest else True)}


def rate(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the statistics, base_failed, anomaly and kept, one row for each document.

    Null and empty texts have no words and fail the base rule.  Without usable
    labels the base rules decide alone.  Repeated rows are rated each; other
    columns are not looked at.
    """
    stats = frames.written(with_stats(docs, ["doc_id"]), "rule-stats")
    return judge(stats, fit_labelled(stats, labels, sample_rows), ["doc_id", *STATS])


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that :func:`rate` keeps, with their own columns as they are."""
    labelled = with_stats(docs.select("doc_id", "text"), ["doc_id"])
    model = docs.sparkSession.sparkContext.broadcast(fit_labelled(labelled, labels, sample_rows))

    def run(batches):
        for batch in batches:
            s = text_stats(batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(verdict(s, model.value)["kept"]))

    return docs.mapInArrow(run, docs.schema)
