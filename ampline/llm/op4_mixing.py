"""Mixing sources to target weights with soft domain membership. DataFrame operations only.

A classifier learnt from labelled rows gives every document posteriors over the domains clean, poor and toxic. It is a
naive Bayes model: the words and word beginnings that tell poor or toxic text from all other, present or absent, and the bins of a few figures
(share of symbols and of capitals, variety of words, length) add up to a score of each domain against clean. Words and
bins are weighed on one half of a bounded sample of labelled rows (SAMPLE_ROWS of each domain). As their evidence is not
independent, scores are calibrated on the other half: a logistic curve for each domain turns its score into odds. The curve
is fitted with a weak pull towards the score as it is, so that a sample which the score parts without error leaves it finite.

Rates: nonnegative document rates r are fitted by projected gradient steps on the least squares problem whose expected
tokens of each domain, sum of r * tokens * posterior, are to match targets. Steps are scaled by the Gram matrix of the
documents whose rate is above zero, and halved where they don't descend; they end when every domain is within MISFIT of its own
target. Of all rates that match the targets, these are the ones closest to 1. A domain pushes down the rate of a document by
at most MOST_PUSH times its posterior, and up by MOST_COPIES times: where the classifier leaves so much of a domain on text that
looks clean that its target is out of reach, that text stays, and ``converged`` says that the targets are not met.
Scores are rounded to tenths; documents of equal scores have equal posteriors and rates, and are summed into cells once. Each
step sums over the cells, and only the domains' totals reach the driver.

Targets: clean keeps its expected tokens, and each other domain gets SHARES[domain] / SHARES["clean"] of those, be it less
or more than it has; rates above 1 ask for copies. Null and empty texts have no tokens; rates follow from their scores all the
same. A domain without labelled rows has posterior 0 and no target; without any labelled rows all documents count as clean
and have rate 1. Labels of unknown ids are ignored; repeated rows are mixed one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampline.llm.common import documents
from ampline.staging import stage

DOMAINS = ("clean", "poor", "toxic")
OTHERS = DOMAINS[1:]
SHARES = {"clean": 0.95, "poor": 0.04, "toxic": 0.01}
SAMPLE_ROWS = 2000   # labelled rows of each domain that are learnt from, at most
LIST_WORDS = 150     # indicator words of each domain, at most
BEGINNING = 5        # characters of a word's beginning
LEAST_SHARE = 0.02   # of a domain's sampled texts that an indicator word occurs in, at least, so that it is no copied text's
LEAST_GAIN = 12.0    # evidence for an indicator word, at least; words by chance rarely have it
PULL = 0.02          # of the calibration towards the score as it is
LIMIT = 30.0         # of scores, both ways
MOST_PUSH = 3.0      # a document keeps a part of its rate while its posterior of a domain is below a third
MOST_COPIES = 100.0
MOST_STEPS = 40
MISFIT = 2e-3        # steps end when every domain is within this share of its own target
HEADROOM = 1.25
BINS = {  # upper ends of all but the last bin of each figure
    "symbols": (0.05, 0.3, 1.0), "capitals": (0.08, 0.3), "variety": (0.25, 0.5), "size": (20, 49, 200),
}


def with_words(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), text without nulls and its words in lower case."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(row, text.alias("text")).select("*", F.array_remove(F.split(F.lower("text"), r"[\s.,;:]+"), "").alias("words"))


def _terms() -> Column:
    """Words and, marked with a star, their beginnings."""
    return F.concat("words", F.transform("words", lambda w: F.concat(F.left(w, F.lit(BEGINNING)), F.lit("*"))))


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")


def _domain_sizes(labels: DataFrame) -> dict[str, int]:
    known = labels.select(_domain().alias("domain")).where("domain IS NOT NULL")
    return {r.domain: r.n for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """domain, half (0 or 1) and text of at most SAMPLE_ROWS labelled documents of each domain, by hash of the id."""
    share = F.lit(0.0)
    for domain, n in sizes.items():
        share = F.when(F.col("domain") == domain, 1.2 * SAMPLE_ROWS / n).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    rank = F.row_number().over(Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id"))
    known = labels.select("doc_id", _domain().alias("domain")).where("domain IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(draw < share)  # so that a frequent domain sends few rows to its rank
    known = known.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS)
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("domain").alias("domain"))
    # The hint holds at most SAMPLE_ROWS rows of each domain.
    return docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id")).select(
        "domain", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half"), "text"
    )


@dataclass
class Words:
    """Indicator words of both domains, and the share of each domain's sampled texts that has each of them."""

    words: list[str]
    shares: dict[str, list[float]]


def indicator_words(first: DataFrame, sizes: dict[str, int]) -> Words:
    """Of the sample's first half, the words by which poor and toxic texts differ most from every other domain."""
    words = first.select(F.col("row.domain").alias("domain"), F.explode(F.array_distinct(_terms())).alias("word"))
    counts = words.groupBy("word").pivot("domain", list(DOMAINS)).count().na.fill(0)
    found: dict[str, dict[str, int]] = {}
    for domain in OTHERS:
        inside = sizes.get(domain, 0)
        # What the domain would have at the share of the other domain that has the word most often.
        others = [(F.col(d) + 0.5) / (sizes.get(d, 0) + 1) for d in DOMAINS if d != domain]
        chance = inside * F.greatest(*others)
        # Twice the log-likelihood ratio of the count inside against that.
        gain = 2 * (F.col(domain) * F.log(F.col(domain) / chance) - F.col(domain) + chance)
        telling = counts.where((F.col(domain) > 2 * chance) & (F.col(domain) >= max(3, LEAST_SHARE * inside)))
        best = telling.select("*", gain.alias("gain")).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "word").limit(LIST_WORDS)
        found |= {r.word: {d: r[d] for d in DOMAINS} for r in best.collect()}
    every = sorted(found)
    return Words(every, {d: [(found[w][d] + 0.5) / (sizes.get(d, 0) + 1) for w in every] for d in DOMAINS})


def _bin(value: Column, ends: tuple) -> Column:
    out = F.lit(len(ends))
    for i in reversed(range(len(ends))):
        out = F.when(value <= ends[i], i).otherwise(out)
    return out


def _list(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def figures(rows: DataFrame, words: list[str]) -> DataFrame:
    """``row``, n_tokens, the indicator words that the text has and the bin of each figure."""
    safe = F.greatest("n_tokens", F.lit(1))
    values = {
        "symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>!]")) / safe,
        "capitals": F.regexp_count("text", F.lit(r"\p{Lu}")) / F.greatest(F.length("text"), F.lit(1)),
        "variety": F.size(F.array_distinct("words")) / safe,
        "size": F.col("n_tokens"),
    }
    rows = rows.select("row", "text", "words", F.size("words").cast("bigint").alias("n_tokens"))
    hits = F.array_intersect(_terms(), _list(words, "string")).alias("hits")
    return rows.select("row", "n_tokens", hits, *[_bin(values[name], BINS[name]).alias(f"bin_{name}") for name in BINS])


@dataclass
class Model:
    """Weights of each domain's score against clean, and its curve: the odds are exp(slope * score + offset)."""

    words: list[str]
    base: dict[str, float]              # score of a text without any indicator word
    gains: dict[str, list[float]]       # what each word adds
    bins: dict[tuple[str, str], list[float]]
    slope: dict[str, float]
    offset: dict[str, float]

    @property
    def known(self) -> list[str]:
        return list(self.base)


def _added(gains: Column) -> Column:
    """What the indicator words of a row add to a score."""
    return F.aggregate("hits", F.lit(0.0), lambda total, word: total + F.try_element_at(gains, word))


def scores(model: Model) -> dict[str, Column]:
    """Of a row of figures, each known domain's score in tenths."""
    out = {}
    for d in model.known:
        added = _added(F.map_from_arrays(_list(model.words, "string"), _list(model.gains[d], "double")))
        by_bin = sum(F.get(_list(model.bins[d, n], "double"), F.col(f"bin_{n}")) for n in BINS)
        score = F.lit(model.base[d]) + added + by_bin
        out[d] = F.round(10 * F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), score))).cast("int").alias(f"score_{d}")
    return out


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``row``, n_tokens and the scores of every row of ``docs``."""
    return figures(with_words(docs), model.words).select("row", "n_tokens", *scores(model).values())


def logistic(score: np.ndarray, n_in: np.ndarray, n_out: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds that rows of a score are in, by Newton steps; the slope is pulled towards 1."""
    x = np.array([1.0, 0.0])
    design = np.stack((score, np.ones(len(score))), axis=1)
    pull = np.array([PULL, 1e-3]) * (n_in.sum() + n_out.sum())
    value = lambda x: float(
        (n_in * np.logaddexp(0, -design @ x) + n_out * np.logaddexp(0, design @ x)).sum() + 0.5 * (pull * (x - [1, 0]) ** 2).sum()
    )
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ x, -500, 500)))
        gradient = design.T @ ((n_in + n_out) * p - n_in) + pull * (x - [1, 0])
        hessian = (design * ((n_in + n_out) * p * (1 - p))[:, None]).T @ design + np.diag(pull)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and value(x - size * step) > value(x):
            size /= 2
        x = x - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(float(x[0]), 0.0), float(x[1])


def fit_classifier(docs: DataFrame, labels: DataFrame) -> Model:
    known = _domain_sizes(labels)
    sample = stage(labelled_sample(docs, labels, known), "labelled-sample")
    halves = {(r.domain, r.half): r.n for r in sample.groupBy("domain", "half").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes, tested = ({d: halves.get((d, half), 0) for d in DOMAINS} for half in (0, 1))
    first = stage(with_words(sample.where("half = 0")), "first-half")
    words = indicator_words(first, sizes)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("figure"), F.col(f"bin_{n}").alias("bin")) for n in BINS])).alias("f")
    counts = figures(first, words.words).select(F.col("row.domain").alias("domain"), stacked).groupBy("domain", "f.figure", "f.bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    found = {(r.domain, r.figure, r.bin): r.n for r in counts.collect()}  # at most domains * bins
    share = lambda d, name, i: (found.get((d, name, i), 0) + 0.5) / (sizes[d] + 0.5 * (len(BINS[name]) + 1))
    model = Model(words.words, {}, {}, {}, {}, {})
    for d in OTHERS:
        if not known.get(d):
            continue
        pairs = list(zip(words.shares[d], words.shares["clean"]))
        absent = [log((1 - x) / (1 - y)) for x, y in pairs]
        model.base[d] = sum(absent)
        model.gains[d] = [log(x / y) - out for (x, y), out in zip(pairs, absent)]
        for name, ends in BINS.items():
            model.bins[d, name] = [log(share(d, name, i) / share("clean", name, i)) for i in range(len(ends) + 1)]
    second = with_scores(sample.where("half = 1"), model)
    counts = second.groupBy("row.domain", *[f"score_{d}" for d in model.known]).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.collect()  # at most the sampled rows
    for d in model.known:
        pick = [r for r in rows if r.domain in (d, "clean")]
        score = np.array([r[f"score_{d}"] / 10 for r in pick])
        n_in, n_out = (np.array([r.n if (r.domain == d) == inside else 0 for r in pick], float) for inside in (True, False))
        slope, offset = logistic(score, n_in, n_out) if len(pick) else (1.0, 0.0)
        # From the sample's odds to those of all labelled rows.
        drawn = log((tested[d] + 0.5) / (tested["clean"] + 0.5))
        model.slope[d], model.offset[d] = slope, offset + log((known[d] + 0.5) / (known.get("clean", 0) + 0.5)) - drawn
    return model


def posteriors(model: Model) -> dict[str, Column]:
    """Of a row of scores, the posterior of each domain, rounded so that equal scores have equal ones everywhere."""
    logs = {d: model.slope[d] * F.col(f"score_{d}") / 10 + model.offset[d] for d in model.known}
    top = F.greatest(F.lit(0.0), F.lit(0.0), *logs.values())
    parts = {"clean": F.exp(-top)} | {d: F.exp(x - top) for d, x in logs.items()}
    total = sum(parts.values())
    return {d: F.round(parts[d] / total, 9) if d in parts else F.lit(0.0) for d in DOMAINS}


@dataclass
class Rates:
    """A document's rate is 1 minus the sum of ``push`` times posterior, or 0 if that is less."""

    push: list[float]
    converged: bool
    misfit: float  # largest share of its own target that a domain is off

    def of(self, posterior: dict[str, Column]) -> Column:
        return F.greatest(F.lit(0.0), 1 - sum(posterior[d] * F.lit(x) for d, x in zip(DOMAINS, self.push)))


def fit_rates(rows: DataFrame, model: Model, shares: dict[str, float] = SHARES) -> Rates:
    """``rows``: n_tokens and scores."""
    keys = [f"score_{d}" for d in model.known]
    cells = rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")) if keys else rows.agg(F.sum("n_tokens").alias("tokens"))
    cells = stage(cells.select("tokens", *[p.alias(d) for d, p in posteriors(model).items()]), "cells")
    fitted = ["clean", *model.known]
    posterior = {d: F.col(d) for d in DOMAINS}

    def sums(push: dict[str, float]) -> tuple[np.ndarray, np.ndarray, float]:
        """Of these rates: the domains' tokens, the Gram matrix of rows with rates above zero, and the sum of squares."""
        rate = Rates([push.get(d, 0.0) for d in DOMAINS], False, 0.0).of(posterior)
        held = cells.select(*fitted, "tokens", rate.alias("rate"))
        total = lambda x: F.coalesce(F.sum(x * F.col("tokens")), F.lit(0.0)).cast("double")
        gram = [total(F.when(F.col("rate") > 0, F.col(a) * F.col(b)).otherwise(0.0)) for a in fitted for b in fitted]
        row = [*held.agg(*[total(F.col(d) * F.col("rate")) for d in fitted], *gram, total(F.col("rate") * F.col("rate"))).first()]
        n = len(fitted)
        return np.array(row[:n]), np.array(row[n:-1]).reshape(n, n), row[-1]

    push = np.zeros(len(fitted))
    now, gram, squares = sums({})
    if now[0] <= 0:
        return Rates([0.0] * len(DOMAINS), True, 0.0)
    target = np.array([now[0] * shares[d] / shares["clean"] for d in fitted])
    off = lambda now: float((np.abs(now - target) / target).max())
    best, value, steps, settled = (off(now), push), squares / 2 + target @ push, 0, False
    while best[0] > MISFIT and steps < MOST_STEPS and not settled:
        # Domains at a bound that the misfit pushes beyond it stay there.
        free = ~(((push >= MOST_PUSH) & (now > target)) | ((push <= -MOST_COPIES) & (now < target)))
        step, size = np.zeros(len(fitted)), 1.0
        if free.any():
            part = gram[np.ix_(free, free)]
            step[free] = np.linalg.lstsq(part, (now - target)[free], rcond=1e-12)[0]  # domains may always go together
        while steps < MOST_STEPS:
            after = np.clip(push + size * step, -MOST_COPIES, MOST_PUSH)
            found = sums(dict(zip(fitted, after)))
            steps += 1
            after_value = found[2] / 2 + target @ after
            if after_value <= value or size < 1e-4:
                break
            size /= 2
        settled = float(np.abs(after - push).max()) < 1e-6
        push, value, (now, gram, squares) = after, after_value, found
        best = min(best, (off(now), push), key=lambda x: x[0])
    if best[0] > MISFIT:
        best = (off(now), push)  # out of reach: the rates that the bounds allow
    by_domain = dict(zip(fitted, best[1].tolist()))
    return Rates([by_domain.get(d, 0.0) for d in DOMAINS], best[0] <= MISFIT, best[0])


def mixed(rows: DataFrame, model: Model, rates: Rates) -> DataFrame:
    """``row``, n_tokens, posteriors, rate and draw (a uniform number by document id) of rows of scores."""
    rows = rows.select("row", "n_tokens", *[p.alias(f"p_{d}") for d, p in posteriors(model).items()])
    draw = F.pmod(F.xxhash64("row.doc_id", F.lit("draw")), F.lit(1_000_000)) / 1_000_000
    rate = rates.of({d: F.col(f"p_{d}") for d in DOMAINS})
    return rows.select("*", F.round(rate, 6).alias("rate"), draw.alias("draw"))


def mix_report(docs: DataFrame, labels: DataFrame, shares: dict[str, float] = SHARES) -> DataFrame:
    """doc_id, n_tokens, posteriors, rate, copies (the rate rounded up or down at random, by id) and whether the fit converged."""
    model = fit_classifier(docs, labels)
    rows = stage(with_scores(docs.select("doc_id", "text"), model).withColumn("row", F.struct("row.doc_id")), "scores")
    rates = fit_rates(rows, model, shares)
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("int")
    return mixed(rows, model, rates).select(
        "row.doc_id", "n_tokens", *[f"p_{d}" for d in DOMAINS], "rate", copies.cast("bigint").alias("copies"),
        F.lit(rates.converged).alias("converged"),
    )


def thinned(docs: DataFrame, labels: DataFrame, shares: dict[str, float] = SHARES, headroom: float = HEADROOM) -> DataFrame:
    """The rows of ``docs`` drawn at their rates times ``headroom``, at most once each, so that documents of a domain that
    keeps its tokens stay in spite of small posteriors of other domains."""
    model = fit_classifier(docs, labels)
    rows = stage(with_scores(docs, model), "scores")  # else a filter on rates computes scores many times
    rates = fit_rates(rows, model, shares)
    return mixed(rows, model, rates).where(F.col("draw") < F.col("rate") * headroom).select("row.*")


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir), labels_of(spark, sf_dir))
