"""Operator 10: quality classifier from a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on statistics of labelled texts; every path from a root to a
node is a rule, a conjunction of bounds on statistics. A logistic model with a lasso penalty
weighs the rules and keeps few of them. Those become one Spark column expression over
the statistics, so scoring is a projection.

The statistics come from numpy over Arrow batches of whole texts. The trees and weights are
fitted on the driver from at most ``labelled.MAX_LABELLED`` rows of numbers, a documented bound.

Edge cases: a null text is empty, its statistics are 0 and it gets a score; without labels, or
with labels of one class, every score is the smoothed share of label 1; repeated rows get
equal scores; an empty table gives no rows; columns named like a statistic or a result
are carried only inside ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import BYTE_CODES, Rolling, Words, map_batches, schema_of, sums, text_of, utf8
from newsloom.llm.labelled import training_rows

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "beyond_ascii", "stop", "comma", "bang", "bar",
    "symbol", "other_mark", "line_bytes", "repeated_lines", "repeated_words", "short_words", "long_words", "mark_words",
)


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros((256, 10), bool)
    for i, chosen in enumerate((
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", bytes(range(128, 256)), b".", b",", b"!?", b"|", b"*#&%$@^~+=<>{}[]\\/_",
    )):
        kinds[list(chosen), i] = True
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    kinds[marks, 9] = ~kinds[marks, 4:9].any(1)
    return kinds


BYTE_KINDS = _byte_kinds()


def _distinct(rows: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """Number of different hashes in each row."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return np.bincount(r[new], minlength=count)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text, in the order of ``STATISTICS``."""
    data, offsets = utf8(column)
    n = np.diff(offsets)
    if not len(data):
        return np.zeros((len(n), len(STATISTICS)))
    size = np.maximum(n, 1)
    words = Words(data, offsets)
    n_words = np.diff(words.rows)
    lengths = words.ends - words.starts
    per_word = np.maximum(n_words, 1)
    word_row = np.repeat(np.arange(len(n)), n_words)
    kinds = [sums(BYTE_KINDS[:, i][data], offsets) / size for i in range(BYTE_KINDS.shape[1])]
    # lines, without the break
    line_break = data == 10
    line_starts = np.unique(np.concatenate([offsets[:-1][n > 0], np.flatnonzero(line_break) + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    line_row = np.searchsorted(offsets, line_starts, side="right") - 1
    n_lines = np.maximum(np.bincount(line_row, minlength=len(n)), 1)
    filled = line_ends - line_starts > 1
    lines = Rolling(BYTE_CODES[data]).hash(line_starts[filled], line_ends[filled] - line_break[line_ends[filled] - 1])
    n_filled = np.bincount(line_row[filled], minlength=len(n))
    after = np.where(words.ends < len(data), data[np.minimum(words.ends, len(data) - 1)], 32)
    marked = BYTE_KINDS[after][:, 6:].any(1)
    return np.stack([
        np.log1p(n), np.log1p(n_words), sums(lengths, words.rows) / per_word, *kinds[:10],
        n / n_lines, 1 - _distinct(line_row[filled], lines, len(n)) / np.maximum(n_filled, 1) * (n_filled > 0) - (n_filled == 0),
        1 - _distinct(word_row, words.hashes, len(n)) / per_word - (n_words == 0),
        sums(lengths <= 2, words.rows) / per_word, sums(lengths >= 12, words.rows) / per_word, sums(marked, words.rows) / per_word,
    ], 1)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` in a struct ``kept``, and the statistics of the text."""
    df = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), text_of().alias("text"))

    def work(batch: pa.RecordBatch) -> dict:
        found = statistics(batch.column("text"))
        return {"kept": batch.column("kept")} | {name: found[:, i] for i, name in enumerate(STATISTICS)}

    return map_batches(df, work, schema_of(", ".join(f"{s} double" for s in STATISTICS), kept=df.schema["kept"].dataType))


Bound = tuple[int, bool, float]  # number of the statistic, whether above, the bound
Rule = tuple[Bound, ...]


@dataclass
class RuleModel:
    start: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The model as a column expression over the statistics."""
        total = F.lit(self.start)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for i, above, bound in rule:
                holds = holds & (F.col(STATISTICS[i]) > bound if above else F.col(STATISTICS[i]) <= bound)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3) -> list[Rule]:
    """The paths of boosted trees; bounds lie between neighbouring quantiles."""
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, 33)[1:-1])) for i in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], 1)
    margin, rules = np.zeros(len(y)), {}

    def grow(rows: np.ndarray, path: Rule) -> None:
        best = None
        total_g, total_h = gradient[rows].sum(), weight[rows].sum()
        for i, e in enumerate(edges):
            if not len(e) or len(path) == depth:
                continue
            g = np.bincount(bins[rows, i], gradient[rows], len(e) + 1).cumsum()[:-1]
            h = np.bincount(bins[rows, i], weight[rows], len(e) + 1).cumsum()[:-1]
            rest = total_h - h
            ok = (h > 2) & (rest > 2)
            gain = np.where(ok, g**2 / (h + 1) + (total_g - g) ** 2 / (rest + 1), 0) - total_g**2 / (total_h + 1)
            k = int(gain.argmax())
            if gain[k] > 1e-3 and (best is None or gain[k] > best[0]):
                best = (gain[k], i, k)
        if best is None:
            margin[rows] += rate * total_g / (total_h + 1)
            return
        _, i, k = best
        bound = float(edges[i][k])
        for above in (False, True):
            rule = (*path, (i, above, bound))
            rules[tuple(sorted(rule))] = None
            grow(rows[(bins[rows, i] > k) == above], rule)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        grow(np.arange(len(y)), ())
    return list(rules)


def fires(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for i, above, bound in rule:
            out[:, j] *= (x[:, i] > bound) == above
    return out


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 400) -> RuleModel:
    """Rules with lasso logistic weights, by proximal gradient steps with momentum."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return RuleModel(start, [])
    rules = grow_rules(x, y)
    z = fires(rules, x)
    middle = z.mean(0)
    z -= middle
    step = 4 / max(np.linalg.norm(z, 2) ** 2 / len(y), 1e-9) / 2
    w, v, b, t = np.zeros(len(rules)), np.zeros(len(rules)), start, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v + b))) - y
        new = v - step * (z.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        b -= 2 * error.mean()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (last - 1) / t * (new - w), new
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel(float(b - middle @ w), [(rules[j], float(w[j])) for j in used])


def train(docs: DataFrame, labels: DataFrame, held: Column) -> RuleModel:
    """Fit on the sampled labelled rows; only their statistics come to the driver."""
    rows = training_rows(docs, labels, "quality", held)
    found = with_statistics(rows, ["label"]).select("kept.label", *STATISTICS).toArrow().to_pydict()
    y = np.array(found["label"], float)
    x = np.stack([np.array(found[s], float) for s in STATISTICS], 1) if len(y) else np.zeros((0, len(STATISTICS)))
    return fit(x, (y > 0).astype(float))


def score(docs: DataFrame, model: RuleModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``score``, 0 to 1."""
    return with_statistics(docs, keep).select("kept.*", model.score().alias("score"))


def good_documents(docs: DataFrame, labels: DataFrame, held: Column, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    model = train(docs, labels, held)
    packed = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"), "text")
    return score(packed, model, ["_doc"]).where(F.col("score") >= threshold).select("_doc.*")
