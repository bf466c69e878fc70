"""Mixing sources to target weights with soft membership in domains.

A classifier learned from the labelled table gives every document a posterior over the domains. Then
each document gets a rate, the expected number of copies in the mix, such that the tokens of the
domains, counted with posterior and rate, come to the target shares of the tokens wanted:

    minimise |S r - t|^2 over r >= 0,        S[d, i] = tokens of document i in domain d,

by projected gradient: every document's rate moves along the gradient, a sum of its tokens in each domain, and is cut off at
zero. The gradient needs one number per domain, so a step is one aggregate over all documents; the rates are a column
computed from the steps, written anew every few steps, and the driver only ever holds the sums of the domains. The
gradient is scaled by the domains' sums of squares over the documents that are not cut off, which makes most fits a
few steps; a scaled step that does not bring the sums nearer is shortened, and in the end replaced by a plain one, which always does.

All of it is DataFrame expressions. Words are counted by hash in a table of fixed size, so that what
is broadcast is bounded.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import WHITE, row_key, without
from tidemark.session import written

CELLS = 1 << 14        # cells of the word table, the bound of the broadcast
RIDGE = 1e-8           # of the scaling, in units of the trace of S S'
STEPS = 8              # of the fit between two writes of the rates
SMOOTHING = 200.0      # pseudo-words of the overall distribution in each domain


def _level(share: Column, steps: int) -> Column:
    """0 to steps - 1 for a share from 0 to 1."""
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * steps), F.lit(steps - 1)).cast("int")


def _cells(docs: DataFrame) -> DataFrame:
    """(``doc``, ``tokens``, ``cell``): a row for every word of every text by the cell of its hash, and five rows of marks:
    the end (cell 0), which every text has, and levels of symbols, capitals, repeated words and words per line."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(row_key(docs).alias("doc"), text.alias("text"))
    without_symbols = F.length(F.translate("text", "#*$%&|<>!", ""))
    counted = base.withColumn("symbols", F.length("text") - without_symbols)
    # runs of symbols are words of their own
    spaced = F.when(F.col("symbols") > 0, F.regexp_replace("text", r"([#*$%&|<>!]+)", " $1 ")).otherwise(F.col("text"))
    words = F.array_remove(F.split(spaced, f"{WHITE}+"), "")
    split = counted.select("doc", "text", "symbols", words.alias("words"))
    size, length = F.size("words"), F.greatest(F.length("text"), F.lit(1))
    capitals = (F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) / length
    repeated = 1 - F.size(F.array_distinct("words")) / F.greatest(size, F.lit(1))
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    levels = [_level(F.col("symbols") / length * 4, 8), _level(capitals * 2, 8), _level(repeated, 16),
              _level(size / lines / 64, 8)]
    # no word has a space: the marks cannot be mistaken for one; the end is the empty word
    marks = F.array(F.lit(""), *[F.concat(F.lit(f"{kind} "), level.cast("string"))
                                 for kind, level in zip(("symbols", "capitals", "repeated", "line"), levels)])
    each = split.select("doc", size.cast("long").alias("tokens"), F.explode(F.concat("words", marks)).alias("word"))
    cell = F.when(F.col("word") == "", 0).otherwise(F.pmod(F.xxhash64("word"), F.lit(CELLS)).cast("int") + 1)
    return each.select("doc", "tokens", cell.alias("cell"))


def fit(docs: DataFrame, labelled: DataFrame, rows: int = 10_000) -> tuple[DataFrame, list[str]]:
    """Word weights per domain as (``cell``, ``weights``: a number per domain), at most ``CELLS + 1`` rows, and the domains
    in order. ``labelled`` has doc_id and domain; at most ``rows`` labelled documents, the first by hash of
    their id, are learned from. A document with several labels takes the smallest."""
    chosen = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(
        F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "source", "text", "domain")  # ``rows`` ids at most
    of_doc = known.select(row_key(known).alias("doc"), "domain").distinct()
    found = _cells(known.select("doc_id", "source", "text").distinct()).join(of_doc, "doc")
    counts = written(found.groupBy("cell", "domain").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    totals = {r.domain: r.n for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    ends = {r.domain: r.n for r in counts.where("cell = 0").select("domain", "n").collect()}
    domains = sorted(totals)
    if not domains:
        return counts.select("cell", F.array().cast("array<double>").alias("weights")), []
    every = float(sum(totals.values()))
    pivoted = counts.groupBy("cell").agg(*[
        F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).alias(f"n{i}")
        for i, d in enumerate(domains)])
    share = sum((F.col(f"n{i}") for i in range(1, len(domains))), F.col("n0")) / F.lit(every)
    weights = []
    for i, d in enumerate(domains):
        ratio = F.log((F.col(f"n{i}") + SMOOTHING * share) / ((totals[d] + SMOOTHING) * share))
        # the mark that every text has carries the domain's share of documents
        weights.append(F.when(F.col("cell") == 0, F.lit(log(ends[d] / sum(ends.values())))).otherwise(ratio))
    return pivoted.select("cell", F.array(*weights).alias("weights")), domains


def posteriors(docs: DataFrame, weights: DataFrame, domains: list[str]) -> DataFrame:
    """(``doc``, ``copies``, ``tokens``, ``p``: a probability per domain) for every distinct document row; ``copies`` rows are
    equal to it."""
    found = _cells(docs).join(F.broadcast(weights), "cell", "left")
    end = F.count(F.when(F.col("cell") == 0, 1))
    sums = [F.coalesce(F.sum(F.col("weights")[i]), F.lit(0.0)) / end for i in range(len(domains))]
    z = F.array(*sums).cast("array<double>")
    scored = found.groupBy("doc").agg(F.max("tokens").alias("tokens"), end.alias("copies"), z.alias("z"))
    top = F.array_max("z")
    odds = F.transform("z", lambda z: F.exp(z - top))
    total = F.aggregate(odds, F.lit(0.0), lambda s, x: s + x)
    return scored.select("doc", "copies", "tokens", F.transform(odds, lambda x: x / total).alias("p"))


def fit_rates(members: DataFrame, domains: list[str], targets: Mapping[str, float], growth: float = 1.0,
              most: float | None = None, rounds: int = 60, tolerance: float = 1e-4) -> DataFrame:
    """Add ``rate`` to ``members`` (``doc``, ``copies``, ``tokens``, ``p``), not below 0 and, if given, not above ``most``.

    ``targets`` are the wanted shares of tokens (made to sum to one); a domain that is not named gets none.
    The mix has ``growth`` times the tokens of the corpus. The fit ends when every domain is off by less than a tenth of
    ``tolerance`` of the mix, or when five steps have not brought the sum of squares down by a hundredth, or after ``rounds`` steps. If a domain is
    off by more than ``tolerance`` then, a warning says target and reached share of each. Without domains or
    tokens all rates are 1."""
    size = float(members.agg(F.sum(F.col("tokens") * F.col("copies"))).first()[0] or 0)
    whole = sum(targets.get(d, 0.0) for d in domains)
    if not domains or not size or not whole:
        return members.withColumn("rate", F.lit(1.0))
    wanted, k = growth * size, len(domains)
    target = np.array([targets.get(d, 0.0) / whole * wanted for d in domains])
    held = [F.col("tokens") * F.col("p")[i] for i in range(k)]

    def sums(rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """How much each domain is off, and the sums of squares and products over the documents not cut off."""
        free = rate > 0 if most is None else (rate > 0) & (rate < most)
        found = base.agg(*[F.sum(F.col("copies") * h * rate) for h in held],
                         *[F.sum(F.when(free, F.col("copies") * a * b).otherwise(0.0)) for a in held for b in held]).first()
        return np.array(found[:k], float) - target, np.array(found[k:], float).reshape(k, k)

    base, rate = members.withColumn("_rate", F.lit(float(growth))), F.col("_rate")
    off, gram = sums(rate)
    steepest = np.linalg.eigvalsh(gram)[-1]
    ridge = RIDGE * np.trace(gram) * np.eye(k)
    path = [off @ off]
    for step in range(1, rounds + 1):
        if np.abs(off).max() <= tolerance * wanted / 10 or len(path) > 5 and path[-1] > path[-6] * (1 - 1e-2):
            break
        scaled = np.linalg.solve(gram + ridge, off)
        for part in (1.0, 0.25, 0.06, 0.0):
            moved = _moved(rate, held, -part * scaled if part else -off / steepest, most)
            there, curve = sums(moved)
            if there @ there <= path[-1] * (1 - part / 10):
                break
        rate, off, gram = moved, there, curve
        path.append(off @ off)
        if step % STEPS == 0:
            base, rate = written(base.withColumn("_rate", rate), "mix-rates"), F.col("_rate")
    if np.abs(off).max() > tolerance * wanted:
        said = ", ".join(f"{d} {t / wanted:.4f} wanted and {(t + x) / wanted:.4f} reached" for d, t, x in zip(domains, target, off))
        warnings.warn(f"targets of the mix are not reached: {said}", stacklevel=2)
    return base.withColumn("rate", rate).drop("_rate")


def _moved(rate: Column, held: list[Column], step: np.ndarray, most: float | None) -> Column:
    """The rate moved along the domains and back into the bounds."""
    free = sum((h * F.lit(float(x)) for h, x in zip(held, step)), rate)
    moved = F.greatest(F.lit(0.0), free)
    return moved if most is None else F.least(F.lit(float(most)), moved)


def rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], rows: int = 10_000, **fitting) -> DataFrame:
    """Replace ``text`` by ``n_tokens``, ``domains`` (name to posterior) and ``rate``. Equal rows stay separate and have equal
    rates. A null text is empty: its posterior is that of an empty text, and it moves no target."""
    weights, domains = fit(docs, labelled, rows)
    members = written(posteriors(docs, weights, domains), "mix-members")
    fitted = fit_rates(members, domains, targets, **fitting)
    kept = without(docs, ["text", "n_tokens", "domains", "rate", "_doc"])
    named = F.map_from_arrays(F.lit(domains).cast("array<string>"), F.col("p"))
    return docs.select(*kept, row_key(docs).alias("_doc")).join(fitted, F.col("_doc") == F.col("doc")).select(
        *kept, F.col("tokens").alias("n_tokens"), named.alias("domains"), "rate")


def mixed(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], seed: str = "mix", **options) -> DataFrame:
    """The mix itself: every document as often as its rate says. The whole part of the rate gives sure copies; the rest is one
    more copy with that probability, drawn by the hash of the row, so that a rerun gives the same mix."""
    weights, domains = fit(docs, labelled, options.pop("rows", 10_000))
    members = written(posteriors(docs, weights, domains), "mix-members")
    fitted = fit_rates(members, domains, targets, **options).select("doc", "rate")
    draw = F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    taken = fitted.select("doc", times.alias("_times")).where("_times > 0")
    joined = docs.withColumn("_doc", row_key(docs)).join(taken, F.col("_doc") == F.col("doc"))
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), "_times")).alias("_copy")).drop(
        "_copy")
