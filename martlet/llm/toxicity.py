"""Toxicity scores by weak supervision.

Voters are fixed lexicons and patterns plus terms (words and word beginnings)
found on a bounded sample of labelled training documents: terms that seldom
occur, or seldom make up a fair share of the words, in clean documents, picked
until every toxic one is covered several times. A generative label model (expectation maximisation over "fires or not"
given the hidden class) estimates each voter's accuracy; the correlations of
the voters are estimated with it and shrink the say of voters that repeat each
other. The known label of a training row is one more voter: how far it is
trusted is estimated from how it agrees with the others, so a label that they
contradict can be overturned. A linear classifier is trained on the posterior
labels and scores whole texts.

Only the text is an input of a score. Defined cases: null and empty texts fire
no voter and get the base score; rows without a label or with a null label
teach nothing; repeated rows score alike; without training rows of both
classes the fixed lexicons alone vote; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm._text import pieces, with_columns
from martlet.llm.langid import held_out

#: Labelled rows the model is fitted on, at most about so many (hash sample).
TRAIN_ROWS = 20_000
#: A term votes when at least this share of the documents that hold it (or hold it often) is toxic.
TERM_PRECISION = 0.9
#: How often the terms should cover each toxic training document.
COVER = 4
MAX_TERMS = 400
CANDIDATES = 4000
#: Trust in training labels before the other voters are heard, and the rows of a class that it counts for.
LABEL_ACCURACY = 0.98
LABEL_ROWS = 10
THRESHOLD = 0.7
PREFIXES = (3, 4, 5, 6, 7)
#: Shares of a document's words at which a term counts as frequent.
SHARES = (0.0075, 0.0125)

# Fixed values.
LEXICONS = {
    "insults_en": "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb fool jerk bastard bitch asshole crap",
    "insults_de": "idiot idioten trottel dumm dummkopf arschloch abschaum versager widerlich wertlos erbärmlich schwachkopf scheisse scheiße",
    "insults_fr": "idiot idiote imbécile connard connasse abruti ordure stupide minable pathétique débile salaud merde",
    "insults_es": "idiota estúpido estúpida imbécil basura patético patética perdedor asqueroso asquerosa payaso mierda cabrón tonto",
    "threats": "kill die hang shoot burn destroy töten umbringen sterben tuer crever mourir matar morir",
}
PATTERNS = {
    "you_are": r"\b(?:you(?:'re| are)|du bist|tu es|vous êtes|eres)\s+(?:an?|ein|une?)?\s*\w+",
    "shut_up": r"\b(?:shut up|halt'?s? maul|ferme[- ]la|cállate)\b",
    "shouting": r"!{2,}",
}

_WORD = re.compile(r"[^\W\d_]+")
_RULES = [frozenset(words.split()) for words in LEXICONS.values()]
_PATTERNS = [re.compile(p) for p in PATTERNS.values()]
FIXED = len(_RULES) + len(_PATTERNS)


def terms_of(word: str) -> list[str]:
    """A word, and its beginnings marked with a closing dash."""
    return [word, *(word[:k] + "-" for k in PREFIXES if len(word) > k)]


def marked(counts: dict[str, int], n_words: int) -> list[str]:
    """Terms of a document; one more ``!`` for each of ``SHARES`` of its words that the term reaches."""
    return [t + "!" * level for t, k in counts.items() for level in range(1 + sum(k >= s * n_words for s in SHARES))]


def term_counts(words: Counter, of_word) -> dict[str, int]:
    counts: dict[str, int] = {}
    for word, k in words.items():
        for t in of_word(word):
            counts[t] = counts.get(t, 0) + k
    return counts


class Voters:
    """Which voters fire on a text: fixed lexicons, patterns, then the learned terms."""

    #: Words whose terms are remembered in a worker before it starts anew.
    MEMORY = 200_000

    def __init__(self, terms: list[str]):
        self.at = {t: FIXED + i for i, t in enumerate(terms)}
        self.plain = {t.rstrip("!") for t in terms}
        self.known: dict[str, tuple[list[str], list[int]]] = {}

    def of_word(self, word: str) -> tuple[list[str], list[int]] | None:
        terms = [t for t in terms_of(word) if t in self.plain]
        fixed = [i for i, lexicon in enumerate(_RULES) if word in lexicon]
        return (terms, fixed) if terms or fixed else None

    def fire(self, text: bytes | None) -> list[int]:
        if not text:
            return []
        low = text.decode("utf-8", "replace").lower()
        known, counts, fires = self.known, {}, set()
        if len(known) > self.MEMORY:
            known.clear()
        words = _WORD.findall(low)
        for word, k in Counter(words).items():
            if word not in known:
                known[word] = self.of_word(word)
            if known[word]:
                terms, fixed = known[word]
                fires.update(fixed)
                for t in terms:
                    counts[t] = counts.get(t, 0) + k
        fires.update(self.at[t] for t in marked(counts, len(words)) if t in self.at)
        fires.update(len(_RULES) + i for i, p in enumerate(_PATTERNS) if p.search(low))
        return sorted(fires)


def training_sample(documents: DataFrame, labels: DataFrame, allowed: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of about ``rows`` labelled documents, chosen by a hash of the id."""
    marks = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = documents.select("doc_id", "text").filter(allowed & F.col("text").isNotNull()).join(marks, "doc_id")
    total = marks.count()
    pick = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(1_000_000)) < min(1_000_000, -(-rows * 1_000_000 // max(1, total)))
    return known.filter(pick)


def candidate_terms(sample: DataFrame) -> list[str]:
    """Terms of enough toxic and hardly any clean sample documents, the widest first."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch, text in pieces(batches):
            for mark, raw in zip(batch.column(batch.schema.get_field_index("toxic")).to_pylist(), text.to_pylist()):
                words = _WORD.findall(raw.decode("utf-8", "replace").lower())
                (toxic if mark else clean).update(marked(term_counts(Counter(words), terms_of), len(words)))
            if len(toxic) + len(clean) > 400_000:
                yield _counts(toxic, clean)
                toxic, clean = Counter(), Counter()
        if toxic or clean:
            yield _counts(toxic, clean)

    counted = (
        sample.select("toxic", "text")
        .mapInArrow(count, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    few = (
        counted.filter((F.col("toxic") >= 3) & (F.col("toxic") >= TERM_PRECISION * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), F.desc(F.length("term")), "term")
        .limit(CANDIDATES)
    )
    return [r["term"] for r in few.collect()]


def _counts(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    terms = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())],
        names=["term", "toxic", "clean"],
    )


def fired(sample: DataFrame, terms: list[str]) -> tuple[list[list[int]], np.ndarray]:
    """Voters that fire on each sample row, and the rows' labels, in id order."""

    def run(batches):
        voters = Voters(terms)
        for batch, text in pieces(batches):
            fires = [voters.fire(t) for t in text.to_pylist()]
            yield with_columns(batch, ["doc_id", "toxic"], fires=pa.array(fires, pa.list_(pa.int32())))

    schema = T.StructType([sample.schema["doc_id"], sample.schema["toxic"], T.StructField("fires", T.ArrayType(T.IntegerType()))])
    rows = sample.select("doc_id", "toxic", "text").mapInArrow(run, schema).orderBy("doc_id", "toxic").collect()
    return [r["fires"] for r in rows], np.array([r["toxic"] for r in rows], dtype=np.float64)


def pick_terms(fires: list[list[int]], toxic: np.ndarray, terms: list[str]) -> list[str]:
    """Greedy choice of terms until each toxic row is covered ``COVER`` times or no term adds two rows."""
    rows_of: dict[int, list[int]] = {}
    for row in np.flatnonzero(toxic):
        for v in fires[row]:
            if v >= FIXED:
                rows_of.setdefault(v - FIXED, []).append(row)
    need = np.where(toxic > 0, COVER, 0)
    members = {t: np.array(r) for t, r in rows_of.items()}
    gains = {t: int((need[r] > 0).sum()) for t, r in members.items()}
    chosen: list[str] = []
    while gains and len(chosen) < MAX_TERMS:
        best = max(gains, key=lambda t: (gains[t], len(terms[t]), terms[t]))
        now = int((need[members[best]] > 0).sum())
        if now < gains[best]:  # an old figure: bring it up to date and look again
            gains[best] = now
            continue
        if now < 2:
            break
        need[members[best]] -= 1
        chosen.append(terms[best])
        del gains[best]
    return sorted(chosen)


def label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of class 1 per row, voters' (rate in class 1, rate in class 0), prior.

    ``votes``: rows x voters, 1 where a voter fires; ``known``: the labels, where
    the estimate starts and a voter beside the others. Its two rates are taken
    against what the others say alone, since against a posterior that holds its
    own vote it would confirm itself. A voter's log odds are divided by 1 + the
    sum of its positive correlations with the others inside the classes.
    """
    post = np.where(known > 0, LABEL_ACCURACY, 1 - LABEL_ACCURACY)
    weight = np.ones(votes.shape[1])
    for r in range(rounds):
        prior = float(np.clip(post.mean(), 0.001, 0.999))
        hit = (post @ votes + 0.1) / (post.sum() + 0.2)
        miss = ((1 - post) @ votes + 0.1) / ((1 - post).sum() + 0.2)
        if r % 10 == 0:
            left = votes - post[:, None] * hit - (1 - post)[:, None] * miss
            cov = left.T @ left
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = np.clip(cov / sd[:, None] / sd[None, :], 0, 1)
            np.fill_diagonal(corr, 1)
            corr[corr < 0.05] = 0
            weight = 1 / corr.sum(axis=1)
        on = weight * (np.log(hit) - np.log(miss))
        off = weight * (np.log1p(-hit) - np.log1p(-miss))
        others = np.log(prior / (1 - prior)) + off.sum() + votes @ (on - off)
        alone = 1 / (1 + np.exp(-np.clip(others, -30, 30)))
        said = (alone @ known + LABEL_ROWS * LABEL_ACCURACY) / (alone.sum() + LABEL_ROWS)
        wrong = ((1 - alone) @ known + LABEL_ROWS * (1 - LABEL_ACCURACY)) / ((1 - alone).sum() + LABEL_ROWS)
        label = np.where(known > 0, np.log(said / wrong), np.log((1 - said) / (1 - wrong)))
        post = 1 / (1 + np.exp(-np.clip(others + label, -30, 30)))
    return post, np.stack([hit, miss]), prior


def linear_fit(votes: np.ndarray, target: np.ndarray, ridge: float = 1e-4, steps: int = 600) -> np.ndarray:
    """Logistic regression on soft labels, bias last (accelerated gradient)."""
    x = np.hstack([votes, np.ones((len(votes), 1), dtype=votes.dtype)])
    w = np.zeros(x.shape[1])
    ahead = w
    rate = 4.0 / (np.mean((x**2).sum(axis=1)) + ridge)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        grad = x.T @ (p - target) / len(x) + ridge * np.append(ahead[:-1], 0)
        new = ahead - rate * grad
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def train(documents: DataFrame, labels: DataFrame, allowed: Column) -> tuple[list[str], np.ndarray]:
    """Learned terms and the classifier's weights (fixed voters, terms, bias)."""
    sample = training_sample(documents, labels, allowed)
    terms = candidate_terms(sample)
    fires, toxic = fired(sample, terms)
    if not 0 < toxic.sum() < len(toxic):
        return [], np.append(np.r_[np.full(len(_RULES), 3.0), np.zeros(len(_PATTERNS))], -3.0)
    chosen = pick_terms(fires, toxic, terms)
    place = {FIXED + terms.index(t): FIXED + i for i, t in enumerate(chosen)} | {i: i for i in range(FIXED)}
    votes = np.zeros((len(fires), FIXED + len(chosen)))
    for row, found in enumerate(fires):
        votes[row, [place[v] for v in found if v in place]] = 1
    post, _, _ = label_model(votes, toxic)
    return chosen, linear_fit(votes, post)


def score(documents: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str]) -> DataFrame:
    """``keep`` columns of every document with ``score``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([documents.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        terms, weights = sent.value
        voters = Voters(terms)
        for batch, text in pieces(batches):
            odds = np.array([weights[-1] + weights[voters.fire(t)].sum() for t in text.to_pylist()])
            yield with_columns(batch, keep, score=pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))), pa.float64()))

    return documents.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def toxicity_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``op3``: toxicity of every document, learned without the held-out third."""
    out = held_out(1, 3)
    model = train(documents, labels, ~out)
    return score(documents, model, ["doc_id"]).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
