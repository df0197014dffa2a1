"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to ``ORDERS``-grams of lower-cased letters (everything
else is one space) of a bounded, hash-chosen sample of labelled documents, per
language and hash bucket, as Spark aggregates. The log-probability matrix
(buckets x languages) is sent to the executors; whole texts are scored in
numpy, piece by piece: one gather per n-gram order and language, summed per
document.

The score is the posterior of the predicted language per n-gram evidence
(softmax of the summed log probabilities).

Defined cases: a null text or one without a letter is ``und`` with score 0;
null languages teach nothing; equal posteriors go to the first language in
code point order; repeated rows are predicted alike; without any training row
every text with a letter is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm._io import set_aside
from martlet.llm._text import pieces, span_sums, with_columns

ORDERS = 3
BUCKETS = 1 << 15
#: Training rows are a hash sample of about this many labelled rows.
TRAIN_ROWS = 20_000
SMOOTHING = 0.5
UNDETERMINED = "und"
#: In a pipeline a document stays from this posterior on.
KEEP_SCORE = 0.5

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; built once in a worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def grams(texts: list[bytes], orders: int = ORDERS, buckets: int = BUCKETS):
    """Per order (bucket of each n-gram start, whether it counts), text bounds, and letters per text."""
    low = [t.decode("utf-8", "replace").lower() for t in texts]
    bounds = np.zeros(len(low) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in low], out=bounds[1:])
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter()[codes]
    kept = np.where(letter, codes, np.uint32(32)).astype(np.uint64)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(codes))  # code points to the text's end
    found, mixed = [], np.zeros(len(codes), dtype=np.uint64)
    for order in range(1, orders + 1):
        n = max(0, len(codes) - order + 1)
        mixed = (mixed[:n] + kept[order - 1 :]) * _MIX[(order - 1) % 3]
        hashed = mixed ^ (mixed >> np.uint64(29))
        bucket = ((hashed * _MIX[1]) >> np.uint64(40)).astype(np.int64) & (buckets - 1)
        counts = letter[:n] if order == 1 else letter[:n] | letter[1 : n + 1]
        found.append((bucket, counts & (left[:n] >= order)))
    return found, bounds, span_sums(letter, bounds)


def training_rows(documents: DataFrame, allowed: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text) of about ``rows`` labelled documents, chosen by a hash of text and id."""
    known = documents.filter(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    total = known.count()
    pick = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < min(1_000_000, -(-rows * 1_000_000 // max(1, total)))
    return known.filter(pick).select("lang", "text")


def train(rows: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in code point order, log-probability matrix (languages x buckets), log priors."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        texts_of: dict[str, int] = {}
        for batch, text in pieces(batches):
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            found, bounds, _ = grams(text.to_pylist(), orders, buckets)
            names = sorted(set(langs))
            which = np.repeat([names.index(x) for x in langs], np.diff(bounds)) if langs else np.empty(0, np.int64)
            for bucket, counts in found:
                both = np.bincount(
                    which[: len(bucket)][counts] * buckets + bucket[counts], minlength=buckets * len(names)
                ).reshape(len(names), buckets)
                for i, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + both[i]
            for name in langs:
                texts_of[name] = texts_of.get(name, 0) + 1
        for name, total in sums.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(seen) + 1), pa.string()),
                    pa.array(np.append(seen, -1), pa.int64()),
                    pa.array(np.append(total[seen], texts_of[name]), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

    # At most languages x (buckets + 1) rows reach the driver, however many documents there are.
    table = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique(), key=lambda x: x.encode())
    counts = np.zeros((len(langs), buckets))
    priors = np.zeros(len(langs))
    at = {x: i for i, x in enumerate(langs)}
    for lang, part in table.groupby("lang"):
        is_count = (part["bucket"] >= 0).to_numpy()
        counts[at[lang], part["bucket"].to_numpy()[is_count]] = part["n"].to_numpy()[is_count]
        priors[at[lang]] = part["n"].to_numpy()[~is_count].sum()
    logp = np.log((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * buckets))
    return langs, logp, np.log(priors / priors.sum()) if len(langs) else priors


def identify(documents: DataFrame, model, keep: list[str], orders: int = ORDERS) -> DataFrame:
    """``keep`` columns of every document with ``lang_pred`` and ``score``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [documents.schema[c] for c in keep]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def run(batches):
        langs, logp, prior = sent.value
        names = np.array([*langs, UNDETERMINED], dtype=object)
        for batch, text in pieces(batches):
            found, bounds, letters = grams(text.to_pylist(), orders, logp.shape[1])
            scores = np.tile(prior, (batch.num_rows, 1))
            for bucket, counts in found:
                inside = np.minimum(bounds, len(bucket))
                for i in range(len(langs)):
                    scores[:, i] += span_sums(np.where(counts, logp[i][bucket], 0.0), inside)
            known = (letters > 0) & bool(langs)
            best = np.where(known, scores.argmax(axis=1) if langs else 0, len(langs))
            odds = np.exp(scores - scores.max(axis=1, keepdims=True)) if langs else scores
            sure = np.where(known, 1 / odds.sum(axis=1) if langs else 0.0, 0.0)
            yield with_columns(
                batch, keep, lang_pred=pa.array(names[best], pa.string()), score=pa.array(sure, pa.float64())
            )

    return documents.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def held_out(remainder: int, parts: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == remainder, F.lit(False))


def language_digest(documents: DataFrame) -> DataFrame:
    """``op5``: predicted language of every document, learned without the held-out quarter."""
    out = held_out(2, 4)
    model = train(training_rows(documents, ~out))
    return identify(documents, model, ["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def identified_documents(documents: DataFrame) -> DataFrame:
    """The documents whose language is found with ``KEEP_SCORE`` or more, columns unchanged."""
    model = train(training_rows(documents, F.lit(True)))
    docs, back = set_aside(documents, "text")
    scored = identify(docs, model, docs.columns)
    return back(scored.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= KEEP_SCORE)))
