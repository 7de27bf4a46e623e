"""Toxicity by compression distance: two zstandard dictionaries, one of ordinary and one of toxic text.

A document is cut into windows of whole words. Each is compressed twice: with the dictionary of ordinary text, and with
the content of the toxic dictionary behind the same ordinary content (the former has as many zero bytes there), so that
both cost the same for what is not toxic. The bytes saved by the toxic dictionary are the evidence of a window. The score is a logistic function of the largest saving, the sum of savings and
their sum by length, calibrated on labelled documents that the dictionaries were not trained on.

Training is on a bounded sample: at most ``SAMPLE_ROWS`` labelled rows of each class, those of the smallest hash of the
id; half trains the dictionaries, half the calibration. The toxic dictionary is trained on the words whose share of
toxic documents stands out (a likelihood ratio test on distinct texts), in the order in which they stand in these documents.
Scoring reads whole texts and nothing but the text.

Edge cases: a null or empty text has no windows and no savings, and gets the score of such a document; labels that are null
or have no document are not learnt; without rows of both classes every score is 0; repeated rows are scored one by one; texts of any
length are scored whole, window by window; ids of equal hash are ordered by id in the sample; an empty table gives no rows; other
columns are not read, and ``keep_below`` hands them on as they are.
"""

from __future__ import annotations

import math
import struct
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.texts import by_bytes, id_and_text, map_texts

SAMPLE_ROWS = 3000
WINDOW_BYTES = 32
ORDINARY_BYTES = 65_536
TOXIC_BYTES = 2_048
LEAST_RATIO = 20.0  # of the likelihood ratio test
SHARE_OF_BEST = 0.1
MATCH = 5  # shorter matches say nothing about a word
OFFSETS = struct.pack("<III", 1, 4, 8)  # fixed value: they end the head of a trained dictionary


@dataclass(frozen=True)
class Model:
    """Dictionaries, and the calibration: intercept and weights."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def windows(text: str, size: int = WINDOW_BYTES) -> list[bytes]:
    """Whole words, each after a space, in windows that end with the word that reaches ``size``."""
    out, held, length = [], [], 0
    for word in words(text):
        held.append(word)
        length += len(word) + 1
        if length >= size:
            out.append(b" " + b" ".join(held) + b" ")
            held, length = [], 0
    if held:
        out.append(b" " + b" ".join(held) + b" ")
    return out


def content(dictionary: bytes) -> int:
    """Where the content of a trained dictionary begins."""
    return dictionary.index(OFFSETS) + len(OFFSETS)


@lru_cache(maxsize=4)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        3, min_match=MATCH, write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=parameters)


def evidence(text: str, model: Model) -> tuple[float, float, float]:
    """Largest saving of a window, log of the sum of savings, and the sum for each hundred windows."""
    plain, toxic = compressor(model.ordinary).compress, compressor(model.toxic).compress
    saved = [max(0, len(plain(w)) - len(toxic(w))) for w in windows(text)]
    if not saved:
        return 0.0, 0.0, 0.0
    return float(min(max(saved), 8)), math.log1p(sum(x for x in saved if x > 1)), 100.0 * sum(saved) / (len(saved) + 20)


def telling_words(toxic: Iterable[str], ordinary: Iterable[str]) -> set[bytes]:
    """Words whose share of toxic texts is higher than chance and not far below the clearest one's."""
    sides = []
    for texts in (set(toxic), set(ordinary)):
        counts: Counter[bytes] = Counter()
        for text in texts:
            counts.update({w.strip(b".,;:!?()\"'") for w in words(text)})
        sides.append((counts, max(1, len(texts))))
    (bad, n_bad), (good, n_good) = sides
    ratio = {}
    for word, a in bad.items():
        b = good[word]
        if word and a * n_good > 3 * b * n_bad:
            both = (a + b) / (n_bad + n_good)
            ratio[word] = 2 * (a * math.log(a / (n_bad * both)) + (b * math.log(b / (n_good * both)) if b else 0.0))
    least = max([LEAST_RATIO, SHARE_OF_BEST * max(ratio.values(), default=0.0)])
    return {w for w, x in ratio.items() if x >= least}


def trained(samples: list[bytes], size: int) -> bytes | None:
    """A dictionary, or None where the samples are too few for the trainer."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return None


def fit(rows: list[tuple[str, int]], shares: dict[int, int] | None = None) -> Model | None:
    """A model of (text, label) rows; None where a class is missing or the texts are too few.

    ``shares`` has the labelled rows of each class, where the sample holds the classes in other shares: the intercept
    is moved by the difference of the log odds.
    """
    halves = [rows[0::2], rows[1::2]]
    if any({y for _, y in half} != {0, 1} for half in halves):
        return None
    bad, good = ([t for t, y in halves[0] if y == k] for k in (1, 0))
    telling = telling_words(bad, good)
    ordinary = trained([w for t in good for w in windows(t, 3 * WINDOW_BYTES)], ORDINARY_BYTES)
    if ordinary is None:
        return None
    kept = [b" ".join(w for w in (x.strip(b".,;:!?()\"'") for x in words(t)) if w in telling) for t in bad]
    kept = [b" " + x + b" " for x in kept if x]
    own = trained(kept * -(-20_000 // max(1, sum(map(len, kept)))), TOXIC_BYTES) if kept else None
    own = own[content(own):] if own else b" " + b" ".join(sorted(telling)) + b" "
    missing = [w for w in sorted(telling) if w not in own]
    own += b" " + b" ".join(missing) + b" " if missing else b""
    model = Model(ordinary + bytes(len(own)), ordinary + own, ())
    x, y = np.array([evidence(t, model) for t, _ in halves[1]]), np.array([y for _, y in halves[1]], float)
    weights = list(logistic(x, y))
    if shares:
        weights[0] += math.log(shares[1] / shares[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return Model(model.ordinary, model.toxic, tuple(weights))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, turns: int = 50) -> tuple[float, ...]:
    """Weights, the intercept first, by Newton's method with a ridge on the others."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic") -> list[tuple[str, int]]:
    """(text, label) of at most ``rows`` labelled documents of each class, those of the smallest hash of the id;
    of an id that stands in several rows the text of the smallest hash."""
    known = labelled(labels, id_col, label_col)
    one = [known.filter(f"label = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(one[0].unionByName(one[1]))  # no more than 2 * rows ids
    found = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit(""))).join(chosen, "doc_id")
    found = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).collect()
    found = sorted((r.doc_id, r.text, r.label) for r in found)
    return [(text, label) for _, text, label in found]


def shares(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> dict[int, int]:
    """Labelled ids of each class, all of them."""
    return {r["label"]: r["n"] for r in labelled(labels, id_col, label_col).groupBy("label").agg(
        F.count("*").alias("n")).collect()}


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    return known.filter("doc_id is not null and label in (0, 1)").distinct()


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: a row for each row of ``docs``."""

    def run(batch: pa.RecordBatch, texts: list[str]):
        if model is None:
            return batch.column("doc_id"), [0.0] * len(texts)
        return batch.column("doc_id"), [one(t, model) for t in texts]

    return map_texts(id_and_text(docs, id_col, text_col), run, "doc_id long, score double")


def one(text: str, model: Model) -> float:
    logit = model.weights[0] + sum(w * x for w, x in zip(model.weights[1:], evidence(text, model)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def keep_below(docs: DataFrame, model: Model | None, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below ``limit``, as they were."""

    def run(batches):
        for batch in by_bytes(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            yield batch.filter(pa.array([model is None or one(t or "", model) < limit for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
