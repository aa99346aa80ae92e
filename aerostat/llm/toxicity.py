"""Toxic passages by maximum-scoring segment search.

Every token has a log-odds weight (toxic against clean documents) under a
Dirichlet prior that is proportional to the token's overall frequency, less
a standard error. Only tokens whose split between the labels is significant
among all tokens tested have one, and a token counts once per label and pair
of neighbours, so that copies of a text prove nothing twice. A token that
was hardly seen backs off to its leading letters, which covers inflected
and compound forms. A linear-time scan finds all maximal segments of the weights. How high clean texts score
by chance follows an extreme-value law in the length of the text; its two
parameters are fitted on clean training documents, which turns each
segment's score into a tail probability. The evidence of a document's
segments together is mapped to a probability on the training labels.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import small_batches, staged

_EDGE = ".,;:!?\"'()[]{}«»“”‘’…*_-#$%&|<>"
STEMS = (4, 5, 6)  # leading letters that a token backs off to
REMEMBERED = 200_000  # tokens whose weight a task keeps at hand


@dataclass(frozen=True)
class Model:
    """Token weights and calibration. All parts are bounded by parameters."""

    weights: dict[str, float]
    drift: float  # cost of a token without weight
    scale: float = 1.0  # of the extreme-value law
    place: float = 0.0
    slope: float = 1.0  # of evidence to log-odds
    offset: float = 0.0

    @cached_property
    def of(self) -> _Weights:
        return _Weights(self.weights)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "of"}


def maximal_segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), in linear time.

    ``scores`` lists (position, weight) of the tokens that have a weight;
    every other token costs ``drift``. The candidates form a list in which
    a new segment is merged back to the last one that starts lower and ends
    lower (Ruzzo and Tompa).
    """
    found: list[list] = []  # first, last, sum before, sum after, link to a lower start
    total, before = 0.0, -1
    for at, weight in scores:
        total -= drift * (at - before - 1)
        before = at
        left = total
        total += weight - drift
        if total <= left:
            continue
        first, new = at, [at, at, left, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            first = found[j][0]
            new = [first, at, found[j][2], new[3]]
            del found[j:]
    return [(f[0], f[1], f[3] - f[2]) for f in found]


def tokens(text: str | None) -> list[str]:
    return [t.strip(_EDGE) for t in text.lower().split()] if text else []


def forms(token: str) -> list[str]:
    """The token and its stems, marked by a trailing blank."""
    return [token, *(token[:n] + " " for n in STEMS if len(token) > n)]


class _Weights(dict):
    """Weight of a token: the strongest among its forms, 0 if none has one."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        found = [self.known[f] for f in forms(token) if f in self.known]
        self[token] = weight = max(found, key=abs, default=0.0)
        return weight


def segments_of(words: list[str], model: Model) -> list[tuple[int, int, float]]:
    weights = model.of
    return maximal_segments([(i, w) for i, w in enumerate(map(weights.__getitem__, words)) if w], model.drift)


def evidence(score: float, n_tokens: int, model: Model) -> float:
    """How far a segment's score lies above what a clean text of this length reaches."""
    return (score - model.place) / model.scale - math.log(max(n_tokens, 1))


def tail(above: float) -> float:
    """Probability that a clean text has a segment this far above (Gumbel tail)."""
    return -math.expm1(-math.exp(-above)) if above > -30 else 1.0


def significant(words: list[str], model: Model, level: float = 0.05) -> list[tuple[int, int, float, float]]:
    """Segments whose tail probability is at most ``level``: first, last, score, probability."""
    out = []
    for first, last, score in segments_of(words, model):
        p = tail(evidence(score, len(words), model))
        if p <= level:
            out.append((first, last, score, p))
    return out


def document_evidence(words: list[str], model: Model) -> float:
    """Evidence of all segments together, 0 without any (each at its tail probability)."""
    total = 0.0
    for _, _, score in segments_of(words, model):
        above = evidence(score, len(words), model)
        if above > 0:
            total += above
    return min(total, 50.0)


def probability(words: list[str], model: Model) -> float:
    z = model.offset + model.slope * document_evidence(words, model)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, most: int) -> DataFrame:
    """Text and label of at most ``most`` labelled documents, dealt by a hash of the id."""
    ids = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # at most ``most`` rows of two numbers; of rows that repeat an id one is taken, so the sample is bounded as well
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.md5("text")).alias("text"), F.first("toxic").alias("toxic"))


def _contexts(batches):
    """Every token of the sample with a checksum of its neighbours: (token, context, toxic)."""
    for b in batches:
        for text, y in zip(b.column("text"), b.column("toxic").to_pylist()):
            words = tokens(text.as_py())
            around = zip(["", *words], [*words[1:], ""])
            context = [zlib.crc32(f"{left} {right}".encode()) for left, right in around]
            for at in range(0, len(words), 1 << 16):
                own = words[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, pa.string()), pa.array(context[at:at + len(own)], pa.int64()),
                    pa.array([y] * len(own), pa.int32())], ["token", "context", "toxic"])


def _log_odds(sample: DataFrame, prior: float, least: int, level: float = 0.05) -> dict[str, float]:
    """Weights of all significant forms; as many as the bounded sample has.

    A token counts once per label and pair of neighbours, so copies and near
    copies of a text count once, and long texts weigh no more than their
    words do.
    """
    seen = sample.select("text", "toxic").mapInArrow(_contexts, "token string, context long, toxic int") \
        .where("token <> ''").distinct().groupBy("token").agg(
            F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0"))
    stems = [F.when(F.char_length("token") > n, F.concat(F.substring("token", 1, n), F.lit(" "))) for n in STEMS]
    counts = staged(seen.select(F.explode(F.array_compact(F.array("token", *stems))).alias("form"), "token", "y1", "y0").groupBy(
        "form").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"),
                    F.bool_or(F.col("form") == F.col("token")).alias("is_token")), "toxic_forms")
    n = counts.where("is_token").agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0")).first()
    n1, n0 = float(n["n1"] or 0), float(n["n0"] or 0)
    if not n1 or not n0:
        return {}
    counts = counts.where(f"y1 + y0 >= {least}")
    tested = max(1, counts.count())
    mass = prior * (n1 + n0)
    a = F.lit(prior) * (F.col("y1") + F.col("y0"))  # the form's part of the prior mass
    up, down = F.col("y1") + a, F.col("y0") + a
    odds = F.log(up / (n1 + mass - up)) - F.log(down / (n0 + mass - down))
    error = F.sqrt(1 / up + 1 / down)
    sure = F.signum(odds) * F.greatest(F.abs(odds) - error, F.lit(0.0))
    # Chernoff's bound on the chance of such a split, times the forms tested
    n, rate = F.col("y1") + F.col("y0"), n1 / (n1 + n0)
    part = lambda y, q: F.when(y > 0, y * F.log(y / n / q)).otherwise(0.0)
    apart = part(F.col("y1"), rate) + part(F.col("y0"), 1 - rate) >= math.log(tested / level)
    rows = counts.where(apart).select("form", sure.alias("weight")).where("weight <> 0").collect()
    return {r["form"]: r["weight"] for r in rows}


def _gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Scale and place of score - scale * log(length), by moments."""
    scale = 1.0
    for _ in range(50):
        rest = best - scale * np.log(np.maximum(n, 1))
        new = max(0.25, float(rest.std()) * math.sqrt(6) / math.pi)
        if abs(new - scale) < 1e-6:
            break
        scale = new
    rest = best - scale * np.log(np.maximum(n, 1))
    return scale, float(rest.mean()) - 0.5772156649 * scale


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a weak pull to zero and classes weighed as they come."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(curve, gradient), -5, 5)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.0), float(w[1])


def train(docs: DataFrame, labels: DataFrame, usable: Column, most_rows: int = 20_000, least: int = 3,
          prior: float = 0.1, drift: float = 0.1) -> Model:
    """Fit the weights and the calibration on a bounded sample of labelled documents.

    ``most_rows`` bounds the labelled documents. A form must be seen ``least`` times;
    ``prior`` is the prior's mass as a share of all counts. ``usable``
    picks the label rows that may be learnt from. Without labels of both kinds the model finds nothing.
    """
    small_batches(docs.sparkSession)
    sample = staged(training_sample(docs, labels, usable, most_rows), "toxic_sample")
    model = Model(_log_odds(sample, prior, least), drift)
    if not model.weights:
        return Model({}, drift, offset=-5.0)
    rows = sample.select("text", "toxic")
    top = np.array(_per_document(rows, model, lambda words, m: max((s for _, _, s in segments_of(words, m)), default=0.0)))
    scale, place = _gumbel(top[top[:, 0] == 0, 2], top[top[:, 0] == 0, 1])
    fitted = replace(model, scale=scale, place=place)
    x = np.array(_per_document(rows, fitted, document_evidence))
    slope, offset = _logistic(x[:, 2], x[:, 0])
    return replace(fitted, slope=slope, offset=offset)


def _per_document(rows: DataFrame, model: Model, value) -> list[tuple[int, int, float]]:
    """Label, number of tokens and ``value(words, model)`` of each row of the bounded sample."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            found = [(len(words), value(words, shared.value)) for words in (tokens(t.as_py()) for t in b.column("text"))]
            yield pa.RecordBatch.from_arrays([
                b.column("toxic").cast(pa.int32()), pa.array([n for n, _ in found], pa.int64()),
                pa.array([v for _, v in found], pa.float64())], ["toxic", "n", "value"])

    return [tuple(r) for r in rows.mapInArrow(run, "toxic int, n long, value double").collect()]


def score_toxicity(docs: DataFrame, model: Model, limit: float = 0.7, spans: bool = False) -> DataFrame:
    """Score of every document; with ``spans`` also its significant passages.

    Returns ``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from ``limit``)
    and, if asked for, ``passages``: first and last token, score and tail
    probability of each significant segment.

    A null or empty text has no segment and gets the score of no evidence.
    Rows are scored one by one and whole: repeated rows and null ids each
    get a row, an empty table gives none, other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<first:int,last:int,score:double,tail:double>>"

    def run(batches):
        for b in batches:
            score, found = [], []
            for t in b.column(1):
                words = tokens(t.as_py())
                score.append(probability(words, shared.value))
                if spans:
                    found.append([dict(zip(("first", "last", "score", "tail"), s))
                                  for s in significant(words, shared.value)])
            columns = {"doc_id": b.column(0), "score": pa.array(score, pa.float64()),
                       "predicted": pa.array([int(s >= limit) for s in score], pa.int32())}
            if spans:
                columns["passages"] = pa.array(found, pa.list_(pa.struct([
                    ("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("tail", pa.float64())])))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, score double, predicted int" + (f", passages {kind}" if spans else "")
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.7, text: str = "text") -> DataFrame:
    """Rows of ``docs``, unchanged, whose score is below ``limit``; any columns, any names."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array([probability(tokens(t.as_py()), shared.value) < limit for t in b.column(at)], pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # mapInArrow takes no names with dots
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
