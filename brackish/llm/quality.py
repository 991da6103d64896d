"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose score lies above a cutoff.  For each stratum (language) joint settings of all rules are tried in one fixed
order, from the most lenient to the strictest: each step moves one rule, in turn, to its next candidate cutoff.  A setting is
accepted while the exact (Clopper-Pearson) upper bound on the share of good documents that any rule rejects
stays at or below `alpha`.  Going on only while accepted is a fixed sequence test, which needs no correction along the
sequence; over the strata the confidence is divided by Bonferroni's rule.  With probability 1 - delta, no stratum loses more
than alpha of its good documents to the rules.  A stratum with fewer than `least_labels` good labels gets no cutoffs and loses nothing but base failures.

The scores of every document are written once (numbers only).  A document's first step is that at which the first rule rejects it;
the labelled good ones are counted by stratum and first step through a join on the id, so all labels count and
every stratum is judged by itself, in a task of its own that holds as many numbers as there are steps.

Edge cases: a null text has no words and fails the base rule; a null language is a stratum of its own; labels
with a null or unknown id or grade are ignored; repeated label rows count once, and an id with both grades counts as bad;
with no labels at all every document that passes the base rule is kept.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

ALPHA = 0.01
DELTA = 0.05
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: rule -> candidate cutoffs, lenient to strict; a document is rejected when its score is above the cutoff.
RULES = {
    "symbols": [round(3.0 * 0.9**i, 6) for i in range(48)],
    "dup_lines": [round(1.0 - 0.02 * i, 6) for i in range(1, 49)],
    "repeats": [round(0.2 - 0.004 * i, 6) for i in range(1, 48)],
    "long_words": [round(40.0 * 0.95**i, 6) for i in range(48)],
    "short_words": [round(-1.0 - 0.1 * i, 6) for i in range(48)],
}
FEATURES = "stratum string, doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words inside k-word windows found at two places or more, the first included.  Exact: windows are
    numbered by pairing ranks, not hashed."""
    n = len(words)
    if n < k + 1:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    v = len(seen)
    if v == n:
        return 0
    code, top = ids[: n - k + 1], v
    for j in range(1, k):
        if top * v >= 2**62:
            code = np.unique(code, return_inverse=True)[1]
            top = int(code.max()) + 1
        code, top = code * v + ids[j : n - k + 1 + j], top * v
    _, at, count = np.unique(code, return_inverse=True, return_counts=True)
    twice = count[at] >= 2
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    edge[starts] += 1
    edge[starts + k] -= 1
    return int((np.cumsum(edge[:n]) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at the six ASCII white-space characters only
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    lines, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in lines:
            dup += bool(line.strip())
        else:
            lines.add(line)
    return len(words), chars, sum(raw.count(s) for s in (bytes([c]) for c in SYMBOLS)), dup, repeat_words(words)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [measure(t) for t in batch.column(2).to_pylist()]
        cols = [np.array(c, np.int64) for c in zip(*got, strict=True)] if got else [np.zeros(0, np.int64)] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, cols)], ["stratum", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def scores() -> dict:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols": F.col("n_symbols") / n,
        "dup_lines": F.least(F.col("n_dup_lines") * 10 / n, F.lit(1.0)),
        "repeats": F.col("n_repeat_words") / n,
        "long_words": F.col("word_chars") / n,
        "short_words": -F.col("word_chars") / n,
    }


def upper_bound(x: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest rate at which x or fewer of n still has probability delta."""
    if x >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(x + 1)]
    lo, hi = x / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        a, b = math.log(p), math.log1p(-p) if p < 1 else -1e300
        top = [c + i * a + (n - i) * b for i, c in enumerate(logs)]
        m = max(top)
        lo, hi = (p, hi) if m + math.log(sum(math.exp(t - m) for t in top)) > math.log(delta) else (lo, p)
    return hi


#: The joint settings in order: at each step one rule goes to its candidate of that number.
STEPS = [(i, rule) for i in range(max(map(len, RULES.values()))) for rule, cutoffs in RULES.items() if i < len(cutoffs)]


def least_labels(strata: int, alpha=ALPHA, delta=DELTA) -> int:
    """Good labels that a stratum needs, with none rejected, before it gets a cutoff."""
    return math.ceil(math.log(delta / max(1, strata)) / math.log1p(-alpha))


def accepted(rejected: list[int], good: int, conf: float, alpha=ALPHA) -> int:
    """rejected[i]: good documents that the setting of step i rejects.  -> how many steps are accepted."""
    for i, x in enumerate(rejected):
        if upper_bound(x, good, conf) > alpha:
            return i
    return len(rejected)


def choose(above: dict[tuple[str, str], list[int]], good: dict[str, int], alpha=ALPHA, delta=DELTA) -> dict[tuple[str, str], float]:
    """above[stratum, rule][i]: good documents beyond candidate i.  -> the accepted cutoff of each pair that has one.

    For counts known by rule only: rejections are at most their sum.  `judge` counts the documents that any rule rejects."""
    strata = [s for s, n in good.items() if n]
    out = {}
    for s in strata:
        at, sums = dict.fromkeys(RULES, 0), []
        for i, rule in STEPS:
            at[rule] = above[s, rule][i]
            sums.append(min(good[s], sum(at.values())))
        for i, rule in STEPS[: accepted(sums, good[s], delta / len(strata), alpha)]:
            out[s, rule] = RULES[rule][i]
    return out


def first_steps() -> dict:
    """rule -> the first step at which it rejects the document; the number of steps if it never does."""
    at = {step: n for n, step in enumerate(STEPS)}
    out = {}
    for rule, score in scores().items():
        cutoffs = F.array(*map(F.lit, RULES[rule]))
        steps = F.array(*[F.lit(at[i, rule]) for i in range(len(RULES[rule]))], F.lit(len(STEPS)))
        out[rule] = F.get(steps, F.size(F.filter(cutoffs, lambda c: c >= score)))  # noqa: B023
    return out


def judge(docs: DataFrame, labels: DataFrame, *, alpha=ALPHA, delta=DELTA) -> DataFrame:
    """Every document's measures and verdict, with the rules that rejected it."""
    cols = docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("null")).alias("stratum"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = written(cols.mapInArrow(_features, FEATURES), "quality")
    feats = feats.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    grade = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1")
    stepped = feats.withColumns({f"at_{r}": c for r, c in first_steps().items()})
    first = F.least(*[F.col(f"at_{r}") for r in RULES])
    good = stepped.where("not base_failed").join(grade, "doc_id", "left_semi").groupBy("stratum", first.alias("first")).agg(F.count("*").alias("n"))
    good = written(good, "good")
    strata = good.select("stratum").distinct().count()

    def run(f: pd.DataFrame) -> pd.DataFrame:
        at = np.bincount(f["first"], f["n"], len(STEPS) + 1).astype(np.int64)
        steps = accepted(np.cumsum(at)[:-1].tolist(), int(at.sum()), delta / strata, alpha)
        return pd.DataFrame({"stratum": f["stratum"].iloc[:1], "steps": [steps]})

    cuts = good.groupBy("stratum").applyInPandas(run, "stratum string, steps int")
    steps = F.coalesce("steps", F.lit(0))
    return (
        stepped.join(F.broadcast(cuts), "stratum", "left")
        .withColumn("failed_rules", F.array_compact(F.array(*[F.when(F.col(f"at_{r}") < steps, F.lit(r)) for r in RULES])))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
