"""Quality rules: statistics of each text, and a decision list learned from labelled ones.

The list is learned by sequential covering: a conjunction of thresholds is grown on two thirds of
the labelled texts, its last conditions are pruned on the remaining third, and the texts it covers
are set aside before the next one is grown. The result is an ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.words import NOT_SPACE, map_runs, mix, per_text, rolling, window_starts, words_of

REPEAT_WORDS = 8
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits", "n_stops",
)

_SYMBOL, _UPPER, _MARK, _DIGIT, _STOP = (np.isin(np.arange(256), list(s)) for s in (b"#*$%&|<>", bytes(range(65, 91)), b"!?", b"0123456789", b".,;:"))
_BLANK = b" \t\r\x0b\x0c"

# Bounds on learning; they do not depend on the size of the corpus.
SAMPLE_ROWS = 20_000
MOST_RULES = 16
MOST_CONDITIONS = 4
LEAST_PRECISION = 0.95
LEAST_COVERED = 4


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(_BLANK)]
    return len(lines), len(lines) - len(set(lines))


def _repeat_words(words) -> np.ndarray:
    """Per text, the words inside windows of ``REPEAT_WORDS`` words that occur twice or more in it."""
    inside = window_starts(words.bounds, REPEAT_WORDS)
    places = np.flatnonzero(inside)
    doc = words.doc_of()[places].astype(np.uint64)
    keys = mix(rolling(words.hashes, REPEAT_WORDS, 8)[places] ^ mix(doc + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    twice = np.unique(places[order[np.concatenate([same, same + 1])]])
    steps = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    steps[twice] += 1
    np.add.at(steps, twice + REPEAT_WORDS, -1)
    return per_text(np.cumsum(steps)[:-1] > 0, words.bounds)


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of every text; null counts as empty."""
    words = words_of(column)
    data, offsets = words.data, words.offsets
    raw, edges = data.tobytes(), offsets.tolist()
    lines = np.array([_lines(raw[a:b]) for a, b in zip(edges, edges[1:], strict=False)], dtype=np.int64).reshape(-1, 2)
    return {
        "n_words": words.counts,
        "word_chars": per_text(NOT_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": _repeat_words(words),
        "n_lines": lines[:, 0],
        "n_upper": per_text(_UPPER[data], offsets),
        "n_marks": per_text(_MARK[data], offsets),
        "n_digits": per_text(_DIGIT[data], offsets),
        "n_stops": per_text(_STOP[data], offsets),
    }


def with_statistics(docs: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """Add a struct ``into`` of the ``COUNTS``; other columns pass through. A null text counts as empty.

    One narrow pass: nothing is shuffled. A column that is already named ``into`` is an error.
    """
    if into in docs.columns:
        raise ValueError(f"{into!r} is a column already")
    struct = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    def add(run: pa.RecordBatch) -> pa.RecordBatch:
        found = text_statistics(run.column(run.schema.get_field_index(text)))
        stats = pa.StructArray.from_arrays([pa.array(found[c], type=pa.int64()) for c in COUNTS], names=list(COUNTS))
        return pa.RecordBatch.from_arrays([*run.columns, stats], names=[*run.schema.names, into])

    return map_runs(docs, text, add, T.StructType([*docs.schema.fields, T.StructField(into, struct)]))


def base_failed(stats: str = "stats", least_words: int = 20, repeat_percent: int = 30) -> Column:
    """Too few words, or too many of them in repeated windows."""
    c = F.col(stats)
    return (c["n_words"] < least_words) | (100 * c["n_repeat_words"] > repeat_percent * c["n_words"])


def _ratio(a: str, b: str):
    return (
        lambda c: F.coalesce(F.try_divide(c[a].cast("double"), c[b].cast("double")), F.lit(0.0)),
        lambda t: np.divide(t[a], t[b], out=np.zeros(len(t[a])), where=t[b] > 0),
    )


# Every feature twice: as a Spark expression over the struct of counts, and over arrays of them.
FEATURES = {
    "word_length": _ratio("word_chars", "n_words"),
    "symbols_per_word": _ratio("n_symbols", "n_words"),
    "dup_line_share": _ratio("n_dup_lines", "n_lines"),
    "repeat_share": _ratio("n_repeat_words", "n_words"),
    "upper_share": _ratio("n_upper", "word_chars"),
    "marks_per_word": _ratio("n_marks", "n_words"),
    "digit_share": _ratio("n_digits", "word_chars"),
    "stops_per_word": _ratio("n_stops", "n_words"),
    "words_per_line": _ratio("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: str) -> Column:
        value = FEATURES[self.feature][0](F.col(stats))
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, dtype=bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, covered: np.ndarray, steps: int = 64) -> tuple[float, Condition | None]:
    """The condition with the largest information gain among the covered rows."""
    p0, n0 = int(bad[covered].sum()), int((~bad[covered]).sum())
    best: tuple[float, Condition | None] = (0.0, None)
    for name, all_values in values.items():
        v, y = all_values[covered], bad[covered]
        order = np.argsort(v, kind="stable")
        v, y = v[order], y[order]
        ends = np.flatnonzero(v[1:] > v[:-1])  # a threshold lies between two different values
        if not len(ends):
            continue
        ends = ends[np.unique(np.linspace(0, len(ends) - 1, min(steps, len(ends))).astype(int))]
        low_p, low_n = np.cumsum(y)[ends], np.cumsum(~y)[ends]
        for above in (True, False):
            p, n = (p0 - low_p, n0 - low_n) if above else (low_p, low_n)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), Condition(name, above, float((v[ends[k]] + v[ends[k] + 1]) / 2)))
    return best


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray) -> list[Rule]:
    """Ordered conjunctions that cover rows with ``bad`` set; ``prune`` marks the rows held back for pruning.

    Covering ends with the first rule that on the rows held back is right less than
    ``LEAST_PRECISION`` of the time. Without bad rows the list is empty.
    """
    left = np.ones(len(bad), dtype=bool)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        rule: Rule = ()
        covered = left & ~prune
        while covered.sum() and (bad & covered).any() and (~bad & covered).any() and len(rule) < MOST_CONDITIONS:
            _, best = _best_condition(values, bad, covered)
            if best is None:
                break
            rule, covered = (*rule, best), covered & best.holds(values)

        def worth(r: Rule) -> tuple[float, int]:
            c = _covers(r, values, len(bad)) & left & prune
            p, n = int((bad & c).sum()), int((~bad & c).sum())
            return (p + 1) / (p + n + 2), -len(r)

        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)
        covered = _covers(rule, values, len(bad)) & left
        held, grown = covered & prune, covered & ~prune
        right = lambda c: (bad & c).sum() / max(1, c.sum())
        if covered.sum() < LEAST_COVERED or right(grown) < LEAST_PRECISION or (held.any() and right(held) < LEAST_PRECISION):
            break
        rules.append(rule)
        left &= ~covered
    return rules


def labelled_sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled keys, those with the smallest hash; the lower label of a repeated key counts."""
    one = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("__label"))
    return one.orderBy(F.xxhash64(key), key).limit(rows)


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text") -> list[Rule]:
    """Learn the list from ``labels`` (doc_id, quality 0/1; 0 is bad) of at most ``rows`` documents.

    The sample's bound keeps the broadcast and what the driver gets (counts, no texts) bounded.
    Documents that already fail the base rules teach nothing and are left out.
    """
    chosen = F.broadcast(labelled_sample(labels, "quality", rows))
    stats = with_statistics(docs.select("doc_id", text).join(chosen, "doc_id"), text)
    found = stats.where(~base_failed()).dropDuplicates(["doc_id"]).orderBy("doc_id").select("doc_id", "__label", "stats.*").limit(rows).toPandas()
    counts = {c: found[c].to_numpy(dtype=float) for c in COUNTS}
    values = {name: f(counts) for name, (_, f) in FEATURES.items()}
    prune = mix(found["doc_id"].to_numpy(dtype=np.int64).astype(np.uint64)) % np.uint64(3) == 0
    return learn_rules(values, found["__label"].to_numpy(dtype=float) < 0.5, prune)


def decision(rules: list[Rule], stats: str = "stats") -> Column:
    """The text of the first rule that holds; null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        holds = rule[0].column(stats)
        for c in rule[1:]:
            holds = holds & c.column(stats)
        out = F.when(holds, F.lit(" and ".join(map(str, rule)))).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """``docs`` with ``stats``, ``base_failed``, ``rule`` (that rejected it, else null) and ``kept``.

    Defined results: a null or empty text has counts of 0 and fails; repeated rows are judged alike;
    an empty table gives an empty one; without labels only the base rules judge.
    """
    rules = fit_rules(docs, labels, rows, text)
    judged = with_statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def good_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, columns unchanged whatever their names."""
    into = "stats"
    while into in docs.columns:
        into += "_"
    learned = fit_rules(docs, labels, rows, text)
    kept = with_statistics(docs, text, into).where(~base_failed(into) & decision(learned, into).isNull())
    return kept.drop(into)
