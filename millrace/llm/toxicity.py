"""Toxicity by maximum-scoring segments of token log-odds.

Fit: on labelled rows, each term (a word, or the first letters of one, for words that take endings) gets
the log-odds of its rate in toxic against clean text, both smoothed by an informative Dirichlet prior
(the pooled rate times ``prior``). A word may fill one document, so it is documents, not occurrences,
that must bear a term out: terms whose log-odds over documents are ``least_z`` standard errors above
zero keep the log-odds over occurrences as score, a word the highest of its terms'; all other words
cost ``drift``, so the score of clean text falls on average. The labelled rows are a bounded sample: at most ``max_rows`` rows of each
label in the order of a hash of the identifier; at most ``max_terms`` scores are kept, the most certain.

Scan: one pass finds all maximal-scoring segments of a text (disjoint runs of tokens, none of which can
be lengthened or shortened to score higher). Karlin and Altschul's extreme-value law for clean text
gives the number of segments of at least that score to expect in a text of that length; those expected
at most ``significance`` times are passages. A text's evidence is the sum over its passages of the
logarithm by which each beats that law, and a logistic curve fitted on the sample turns it into a score.

Defined cases: null texts are empty and have no passage, so their score is that of no evidence. Labels
null or without a document are left out; a document labelled twice counts as toxic if one label says so. With
no toxic or no clean row in the sample nothing can be learnt and every score is 0. Repeated rows keep
their rows. Texts are scanned whole.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import whole

TOKEN = re.compile(r"[^\W_]+")
#: Letters of a word's beginnings that are terms beside the whole word.
BEGINNINGS = (4, 5, 6, 7)
#: Terms that a task counts before it hands them on.
COUNTED = 100_000
COUNTS = "term string, toxic int, n long, times long"
SCORED = "struct<score: double, passages: array<struct<start: int, stop: int, score: double, expected: double>>>"
PASSAGE = ("start", "stop", "score", "expected")


def term_times(words: list[str]) -> Counter:
    """Occurrences of the words and of their beginnings."""
    times = Counter(words)
    for word, n in list(times.items()):
        for k in BEGINNINGS:
            if len(word) > k:
                times[word[:k]] += n
    return times


class Matcher:
    """Finds a model's terms at the starts of words, in one pass over a text."""

    def __init__(self, scores: dict[str, float]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for term, score in scores.items():
            self.found.add_word(term, (len(term), len(term) not in BEGINNINGS, score))
        if scores:
            self.found.make_automaton()

    def hits(self, low: str) -> dict[int, float]:
        """Score of each word that has one, by its place in the lower-cased text."""
        out: dict[int, float] = {}
        if len(self.found):
            for last, (length, is_word, score) in self.found.iter(low):
                at = last - length + 1
                if at and low[at - 1].isalnum() or is_word and low[last + 1 : last + 2].isalnum():
                    continue
                out[at] = max(score, out.get(at, score))
        return out


@dataclass(frozen=True)
class Model:
    scores: dict[str, float]  # bounded by max_terms
    drift: float
    decay: float  # lambda of the extreme-value law
    scale: float  # K of the law
    significance: float
    bias: float
    slope: float

    def segments(self, text: str, matcher: Matcher) -> tuple[list[tuple[int, int, float]], int]:
        """((first token, past the last, score) of the maximal-scoring segments, number of tokens or 0 if none scores)."""
        low = text.lower()
        scored_words = matcher.hits(low)
        if not scored_words:
            return [], 0
        starts = [m.start() for m in TOKEN.finditer(low)]
        hits = [(i, scored_words[at]) for i, at in enumerate(starts) if at in scored_words]
        return maximal_segments(hits, self.drift), len(starts)

    def log_expected(self, score: float, length: int) -> float:
        """Logarithm of the number of segments of at least that score in clean text of that length."""
        return float(np.log(self.scale * max(length, 1)) - self.decay * score)

    def evidence(self, segments: list, length: int) -> float:
        return sum(max(np.log(self.significance) - self.log_expected(s, length), 0.0) for _, _, s in segments)

    def score(self, evidence) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.slope * np.log1p(evidence), -50, 50))))

    def scan(self, text: str, matcher: Matcher) -> dict:
        segments, length = self.segments(text, matcher)
        if not segments:
            return {"score": self.score(0.0), "passages": []}
        places = [m.span() for m in TOKEN.finditer(text)] if len(text) == len(text.lower()) else None
        if places is None or len(places) != length:  # lower case changed the length of the text
            places = spans_by_char(text, length)
        passages = []
        for first, stop, s in segments:
            if (e := self.log_expected(s, length)) <= np.log(self.significance):
                passages.append(dict(zip(PASSAGE, (places[first][0], places[stop - 1][1], s, float(np.exp(e))))))
        return {"score": self.score(self.evidence(segments, length)), "passages": passages}


def spans_by_char(text: str, length: int) -> list[tuple[int, int]]:
    """Token spans in the text as written, where lower case has other lengths: by the origin of each character."""
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    spans = [(origin[m.start()], origin[m.end() - 1] + 1) for m in TOKEN.finditer("".join(c.lower() for c in text))]
    return (spans + [(0, len(text))] * length)[:length]


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa's disjoint maximal-scoring runs, in time linear in the hits.

    Between hits every token costs ``drift``, so a run starts and ends at hits. ``before`` and
    ``after`` are the total score up to the run's start and end; ``back`` leads to the nearest earlier
    run with a smaller ``before``.
    """
    runs: list[list] = []  # [first, stop, before, after, back]
    gained = 0.0
    for nth, (place, score) in enumerate(hits):
        before = gained - drift * (place - nth)
        gained += score
        run = [place, place + 1, before, before + score, -1]
        while True:
            j = len(runs) - 1
            while j >= 0 and runs[j][2] >= run[2]:
                j = runs[j][4]
            if j < 0 or runs[j][3] >= run[3]:
                run[4] = j
                runs.append(run)
                break
            run = [runs[j][0], run[1], runs[j][2], run[3], -1]
            del runs[j:]
    return [(first, stop, after - before) for first, stop, before, after, _ in runs]


def _count_terms(batches):
    """Documents that hold each term and its occurrences, by label; under the empty term all documents and words.

    Counts leave the task whenever ``COUNTED`` terms are held, so its memory does not follow its input.
    """
    counts, times = {0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()}

    def rows() -> pd.DataFrame:
        found = [(t, label, n, times[label][t]) for label, c in counts.items() for t, n in c.items()]
        for counter in (*counts.values(), *times.values()):
            counter.clear()
        return pd.DataFrame(found, columns=["term", "toxic", "n", "times"])

    for batch in batches:
        for text, toxic in zip(batch.text, batch.toxic):
            words = TOKEN.findall(text.lower())
            found = term_times(words)
            counts[toxic].update(found.keys())
            counts[toxic][""] += 1
            times[toxic].update(found)
            times[toxic][""] += len(words)
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield rows()
    yield rows()


def sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` documents of each label, each text once. The labels' side of the
    join is that small."""
    one = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    chosen = [
        one.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for label in (0, 1)
    ]
    texts = docs.select("doc_id", whole(docs["text"]).alias("text"))
    return texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("text", "toxic").distinct()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    max_terms: int = 50_000,
    prior: float = 10.0,
    least_z: float = 1.7,
    least_log_odds: float = 1.5,
    drift: float = 0.1,
    significance: float = 0.05,
) -> Model:
    """Learn from ``labels`` (doc_id, toxic), all of which may be used: the caller leaves held-out rows away."""
    rows = sample(docs, labels, max_rows)
    counts = (
        rows.mapInPandas(_count_terms, COUNTS).groupBy("term").agg(
            *[
                F.sum(F.when(F.col("toxic") == x, F.col(c)).otherwise(0)).alias(f"{c}{x}")
                for c in ("n", "times") for x in (0, 1)
            ]
        )
    )
    # The empty term counts the documents and the words.
    every = counts.filter(F.col("term") == "").first()
    if every is None or not every.n0 or not every.n1:
        return Model({}, drift, 1.0, 1.0, significance, -50.0, 0.0)

    def odds(kind: str) -> tuple[Column, Column, Column]:
        """(log-odds, their standard error, smoothed clean rate) by documents ("n") or occurrences ("times")."""
        alpha = (F.col(f"{kind}1") + F.col(f"{kind}0")) * (prior / (every[f"{kind}1"] + every[f"{kind}0"]))
        rates = [(F.col(f"{kind}{x}") + alpha) / (every[f"{kind}{x}"] + prior) for x in (0, 1)]
        logs = [F.log(r / (1 - r)) for r in rates]
        return logs[1] - logs[0], F.sqrt(sum(1 / (F.col(f"{kind}{x}") + alpha) for x in (0, 1))), rates[0]

    by_documents, error, _ = odds("n")
    by_times, _, clean_rate = odds("times")
    rated = counts.filter(F.col("term") != "").select(
        "term", (by_documents / error).alias("z"), by_times.alias("log_odds"), clean_rate.alias("clean_rate")
    ).filter((F.col("log_odds") >= least_log_odds) & (F.col("z") >= least_z))
    kept = rated.orderBy(F.desc("z"), "term").limit(max_terms).collect()
    scores = {r.term: r.log_odds for r in kept}
    decay = solve_decay(np.array([r.clean_rate for r in kept]), np.array([r.log_odds for r in kept]), drift)
    bare = Model(scores, drift, decay, 1.0, significance, 0.0, 0.0)

    def scan(batches):
        matcher = Matcher(bare.scores)
        for batch in batches:
            found = [bare.segments(t, matcher) for t in batch.text]
            lengths = [n or len(TOKEN.findall(t)) for t, (_, n) in zip(batch.text, found)]
            yield pd.DataFrame({
                "toxic": batch.toxic, "length": lengths, "found": [[s for _, _, s in x] for x, _ in found],
            })

    seen = rows.mapInPandas(scan, "toxic int, length long, found array<double>").toPandas()  # at most 2 * max_rows
    return calibrate(bare, seen)


def solve_decay(rates: np.ndarray, scores: np.ndarray, drift: float) -> float:
    """The positive root of E[exp(decay * score)] = 1 over clean tokens."""
    rest = max(1 - rates.sum(), 0.0)
    over = lambda x: float((rates * np.exp(np.minimum(x * scores, 700))).sum() + rest * np.exp(-x * drift) - 1)
    low, high = 1e-3, 1.0
    while over(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if over(mid) < 0 else (low, mid)
    return high


def calibrate(bare: Model, seen: pd.DataFrame) -> Model:
    """K from the clean sample's segments, then the logistic curve over the evidence."""
    clean = seen[seen.toxic == 0]
    lowest = min(bare.scores.values(), default=1.0)
    above = sum(s >= lowest for found in clean.found for s in found)
    scale = max(above, 1) / max(int(clean.length.sum()), 1) * np.exp(min(bare.decay * lowest, 500.0))
    model = Model(bare.scores, bare.drift, bare.decay, float(scale), bare.significance, 0.0, 0.0)
    evidence = [model.evidence([(0, 0, s) for s in found], n) for found, n in zip(seen.found, seen.length)]
    bias, slope = logistic(np.log1p(np.array(evidence)), seen.toxic.to_numpy(dtype=float))
    return Model(model.scores, model.drift, model.decay, model.scale, model.significance, bias, slope)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Two coefficients by Newton steps; a small ridge keeps them finite where the labels are separable."""
    design, w = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -50, 50)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), design.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def scored(text: Column, model: Model) -> Column:
    """Score (0 to 1) and passages of a text."""

    @F.pandas_udf(SCORED)
    def run(texts: pd.Series) -> pd.DataFrame:
        matcher = Matcher(model.scores)
        return pd.DataFrame([model.scan(t, matcher) for t in texts], columns=["score", "passages"])

    return run(text)


def score_documents(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``score`` and ``passages`` (spans in code points); columns so named are replaced."""
    return df.withColumn("__scored", scored(whole(df[text]), model)).withColumns(
        {"score": F.col("__scored.score"), "passages": F.col("__scored.passages")}
    ).drop("__scored")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; never null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Score of every document, learnt from the labels that are not held out."""
    model = fit(docs, labels.filter(~held_out()))
    rated = score_documents(docs.select("doc_id", "text"), model)
    return rated.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )
