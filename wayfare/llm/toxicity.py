"""Toxic passages by maximum-scoring segments.

Words get log-odds between toxic and clean labelled texts under Dirichlet priors. A linear-time
scan finds all maximal-scoring segments of a text. Their scores follow an extreme-value law on
clean texts, which turns them into evidence; evidence is mapped to a probability on labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.tables import columns, in_slices, text_keys
from wayfare.session import cut_lineage

WORD = re.compile(r"[^\W\d_]+")
#: Letters of a word's stem; words too rare to judge are judged by their stem.
STEM = 5
#: Documents of each label that fitting reads, within the spread of independent draws; a label with
#: fewer gives all.
SAMPLE = 20_000
#: Weight of the prior in words: counts are smoothed towards the whole corpus by so many words.
PRIOR = 1000.0
#: A word or stem takes part from so many labelled texts and so many standard errors on.
LEAST_TEXTS = 3
LEAST_Z = 2.5
#: Words that lean to the toxic side by less than this say little alone and, in long texts, add up
#: to passages by chance; they count like any other word.
LEAST_ODDS = 1.5
#: Most entries of the model, those with the largest z first: about 10 MB to every executor.
MOST_ENTRIES = 100_000
#: Score of a word that the model does not know; keeps the expected score below zero.
DRIFT = -0.25
#: Bins of evidence on which probabilities are fitted.
BINS = 64
EULER = 0.5772156649
#: Normalised score from which a segment is significant by itself: p below 0.05.
SIGNIFICANT = 3.0

RESULT = "doc_id long, score double, evidence double, n_words long, n_segments int, first_word long, last_word long, passage string"


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(found: Iterable[str]) -> set[str]:
    """Words and stems of a text; a stem is written with a final ``~``."""
    kinds = set(found)
    return kinds | {word[:STEM] + "~" for word in kinds if len(word) > STEM}


def segments(scores: list[tuple[int, int, float]]) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments of (start, end, score) runs in order: (score, start, end).

    A segment is maximal if every proper part scores less and no segment that holds it is. Kept as
    candidates with the running sums before and after them; a new run joins the candidates back to
    the nearest one that began lower, as long as that one ended lower too.
    """
    kept: list[list] = []  # start, end, sum before, sum after
    total = 0.0
    for start, end, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        new = [start, end, before, total]
        while True:
            at = len(kept) - 1
            while at >= 0 and kept[at][2] >= new[2]:
                at = kept[at][4]
            if at < 0 or kept[at][3] >= new[3]:
                kept.append([*new, at])
                break
            new[0], new[2] = kept[at][0], kept[at][2]
            del kept[at:]
    return [(after - before, start, end) for start, end, before, after, _ in kept]


@dataclass(frozen=True)
class Model:
    """Scores of words and stems, the extreme-value law, and the map from evidence to probability."""

    scores: dict[str, float]
    scale: float = 1.0
    log_k: float = 0.0
    slope: float = 1.0
    intercept: float = -2.0

    def runs(self, found: list[str]) -> list[tuple[int, int, float]]:
        """Words the model knows, and the stretches between them as one run each."""
        out, at, known = [], 0, self.scores
        for i, score in [(i, s) for i, s in enumerate(map(known.get, found)) if s is not None]:
            if i > at:
                out.append((at, i, DRIFT * (i - at)))
            out.append((i, i + 1, score))
            at = i + 1
        return out

    def passages(self, found: list[str]) -> list[tuple[float, int, int]]:
        """Segments as (normalised score, first word, end), highest first."""
        if not found:
            return []
        shift = self.log_k + math.log(len(found))
        best = segments(self.runs(found))
        return sorted(((self.scale * score - shift, start, end) for score, start, end in best), key=lambda s: (-s[0], s[1]))

    def evidence(self, passages: list[tuple[float, int, int]]) -> float:
        """-log p of the best sum of the r highest segments, corrected for the choice of r.

        All significant segments are summed up; the highest counts even where it is not.
        """
        best, total = 0.0, 0.0
        for r, (score, _, _) in enumerate(passages, 1):
            if score <= (SIGNIFICANT if r > 1 else 0):
                break
            total += score
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r) + r * math.log(2)
            best = max(best, -log_p)
        return best

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * math.log1p(evidence)))))


class Lookup(dict):
    """Scores by word, with stems as the way out; remembers a bounded number of words."""

    def __init__(self, scores: dict[str, float]) -> None:
        super().__init__(scores)
        self.left = 200_000

    def get(self, word, default=None):  # noqa: D102
        try:
            return self[word]
        except KeyError:
            score = dict.get(self, word[:STEM] + "~") if len(word) > STEM else None
            if self.left > 0:
                self.left -= 1
                self[word] = score
            return score


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) once a document; one labelled both ways counts as toxic."""
    known = columns(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))


def _labelled(docs: DataFrame, marks: DataFrame, totals: dict[int, int]) -> DataFrame:
    """(text, toxic) of the labelled sample: some ``SAMPLE`` documents a label, by the hash of their ids.

    A document is drawn by itself, with the share that its label's total allows, so nothing is
    gathered or sorted. The sample's ids are bounded, so they are sent to the texts and no text is
    shuffled.
    """
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.lit(0)
    for toxic, total in totals.items():
        share = F.when(F.col("toxic") == toxic, F.lit(int((1 << 30) * min(1.0, SAMPLE / total)))).otherwise(share)
    texts = columns(docs, "doc_id", "text").where("text IS NOT NULL")
    return texts.join(F.broadcast(cut_lineage(marks.where(drawn < share))), "doc_id").select("text", "toxic")


def _counts(labelled: DataFrame) -> DataFrame:
    """(feature, toxic, texts): in how many texts of each label a word or stem stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([found[k] for k in keys], pa.int64())],
                ["feature", "toxic", "texts"],
            )

        for batch in in_slices(batches, 512):
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                label = toxic.as_py()
                found.update((feature, label) for feature in features(words(text.as_py())))
                found["", label] += 1
            if len(found) > 300_000:
                yield out()
                found.clear()
        yield out()

    return (
        labelled.mapInArrow(run, "feature string, toxic int, texts long")
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.col("toxic") > 0, F.col("texts")).otherwise(0)).alias("toxic"),
            F.sum(F.when(F.col("toxic") > 0, 0).otherwise(F.col("texts"))).alias("clean"),
        )
    )


def log_odds(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(feature, log_odds, z, toxic, clean), the prior being the share of the feature in all texts.

    With y of n texts, prior a = PRIOR x share and PRIOR in all, the log-odds of a label are
    ``log((y + a) / (n + PRIOR - y - a))``; their difference has variance ``1 / (y + a)`` summed.
    """
    total = toxic + clean
    prior = (F.col("toxic") + F.col("clean")) * F.lit(PRIOR / max(total, 1))
    # Smoothed no more than the texts of a label weigh, so that few toxic texts keep a say.
    weight = F.lit(min(1.0, toxic / PRIOR, clean / PRIOR))

    def part(y, n):
        a = prior * weight
        return F.log((y + a + 0.01) / (F.lit(float(n)) + F.lit(PRIOR) * weight - y - a + 0.01)), 1 / (y + a + 0.01)

    (in_toxic, v1), (in_clean, v2) = part(F.col("toxic"), toxic), part(F.col("clean"), clean)
    return counts.select(
        "feature", "toxic", "clean", (in_toxic - in_clean).alias("log_odds"), ((in_toxic - in_clean) / F.sqrt(v1 + v2)).alias("z")
    )


def scale_of(scores: list[tuple[float, float]]) -> float:
    """The positive root of ``sum p * exp(x * s) = 1`` for (s, p); 1 if there is none."""

    def value(x: float) -> float:
        return sum(p * math.exp(min(700.0, x * s)) for s, p in scores) - 1

    if not any(s > 0 and p > 0 for s, p in scores) or sum(s * p for s, p in scores) >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return low


def logistic(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """(slope, intercept) of the chance of a toxic label, fitted to (x, toxic, clean) with a weak prior."""
    slope, intercept, ridge = 1.0, -2.0, 1e-3
    for _ in range(100):
        g0, g1, h00, h01, h11 = -ridge * intercept, -ridge * slope, ridge, 0.0, ridge
        for x, toxic, clean in bins:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, intercept + slope * x))))
            error, weight = toxic - (toxic + clean) * p, (toxic + clean) * p * (1 - p)
            g0, g1 = g0 + error, g1 + error * x
            h00, h01, h11 = h00 + weight, h01 + weight * x, h11 + weight * x * x
        det = h00 * h11 - h01 * h01
        d0, d1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        step = min(1.0, 4.0 / max(abs(d0), abs(d1), 1e-9))
        intercept, slope = intercept + step * d0, slope + step * d1
        if abs(d0) + abs(d1) < 1e-9:
            break
    return slope, intercept


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    Words are counted in at most ``SAMPLE`` documents of each label; the chance of a label comes
    from all labels. The driver receives at most ``MOST_ENTRIES`` features, one row of sums, and
    ``BINS`` x 2 counts. Without labelled rows of both kinds the model knows no word.
    """
    marks = cut_lineage(_marks(labels))
    totals = dict(marks.groupBy("toxic").count().collect())
    labelled = cut_lineage(_labelled(docs, marks, totals))
    counts = cut_lineage(_counts(labelled))
    sizes = counts.where("feature = ''").first()
    toxic, clean = (int(sizes["toxic"]), int(sizes["clean"])) if sizes else (0, 0)
    if not toxic or not clean:
        return Model({})
    judged = log_odds(counts.where(f"feature <> '' AND toxic + clean >= {LEAST_TEXTS}"), toxic, clean)
    telling = (F.abs("z") >= LEAST_Z) & ((F.col("log_odds") >= LEAST_ODDS) | (F.col("log_odds") < 4 * DRIFT))
    chosen = judged.where(telling).orderBy(F.abs("z").desc(), "feature").limit(MOST_ENTRIES).collect()
    scores = {row["feature"]: row["log_odds"] for row in chosen if row["log_odds"] > 0}
    scores |= {row["feature"]: max(row["log_odds"], 4 * DRIFT) for row in chosen if row["log_odds"] <= 0}
    if not scores:
        return Model({})
    raw = cut_lineage(_scored(labelled, Model(scores), best=True))
    one = raw.where("toxic = 0").agg(F.sum("n_words").alias("n")).first()
    n = max(1, one["n"] or 1)
    known = [(scores[row["feature"]], (row["clean"] + 0.5) / n) for row in chosen if not row["feature"].endswith("~")]
    scale = scale_of([*known, (DRIFT, max(0.0, 1 - sum(p for _, p in known)))])
    law = raw.where("toxic = 0 AND n_words > 0").agg(F.avg(F.lit(scale) * F.col("best") - F.log("n_words")).alias("mean")).first()
    model = Model(scores, scale, (law["mean"] or 0.0) - EULER)
    evidence = _scored(labelled, model, best=False)
    # Bins of log(1 + evidence) that tell the two labels apart; 64 bins of 1/8 reach e**8.
    at = F.least(F.floor(F.log1p("best") * 8), F.lit(BINS - 1))
    bins = evidence.groupBy(at.alias("at")).agg(F.avg(F.log1p("best")).alias("x"), F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    # A sampled document stands for as many as its label has to each of the sample.
    w1, w0 = totals[1] / toxic, totals[0] / clean
    slope, intercept = logistic([(row["x"], row["toxic"] * w1, (row["n"] - row["toxic"]) * w0) for row in bins.collect()])
    return Model(scores, scale, model.log_k, slope, intercept)


def _scored(labelled: DataFrame, model: Model, best: bool) -> DataFrame:
    """(toxic, n_words, best) of labelled rows: the highest raw segment, or the evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(Lookup(model.scores), model.scale, model.log_k)
        for batch in in_slices(batches, 512):
            n, value = [], []
            for text in batch.column("text"):
                found = words(text.as_py())
                n.append(len(found))
                value.append(max((s[0] for s in segments(own.runs(found))), default=0.0) if best else own.evidence(own.passages(found)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(n, pa.int64()), pa.array(value, pa.float64())], ["toxic", "n_words", "best"])

    return labelled.mapInArrow(run, "toxic int, n_words long, best double")


def score(docs: DataFrame, model: Model, keyed: bool = False) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its toxicity.

    ``score`` is the probability of a toxic label; ``evidence`` the extreme-value evidence over all
    maximal segments; ``n_segments`` counts those significant by themselves; first_word,
    last_word and passage are the strongest of them, null if there is none. Null and empty texts
    have no words, evidence 0 and the score that goes with it. Whole texts are scanned. Repeated
    rows give repeated results; a null doc_id stays null. ``keyed`` adds the ``text_keys``.
    """
    keys = ["key", "key2"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(Lookup(model.scores), model.scale, model.log_k, model.slope, model.intercept)
        for batch in in_slices(batches, 512):
            rows = []
            for text in batch.column("text"):
                found = words(text.as_py() or "")
                passages = own.passages(found)
                evidence = own.evidence(passages)
                strong = [p for p in passages if p[0] > SIGNIFICANT]
                place = strong[0][1:] if strong else None
                rows.append(
                    (own.probability(evidence), evidence, len(found), len(strong))
                    + ((place[0], place[1] - 1, " ".join(found[slice(*place)])) if place else (None, None, None))
                )
            kinds = (pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
            values = list(map(list, zip(*rows))) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, kind) for v, kind in zip(values, kinds)), *(batch.column(name) for name in keys)],
                ["doc_id", "score", "evidence", "n_words", "n_segments", "first_word", "last_word", "passage", *keys],
            )

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.select("*", *text_keys()) if keyed else rows
    return rows.mapInArrow(run, RESULT + "".join(f", {name} long" for name in keys))


def drop(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``, whole; each is judged by its own text in the pass that reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(Lookup(model.scores), model.scale, model.log_k, model.slope, model.intercept)
        for batch in in_slices(batches, 512):
            found = (own.evidence(own.passages(words(text.as_py() or ""))) for text in batch.column("text"))
            yield batch.filter(pa.array([own.probability(evidence) < least for evidence in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
