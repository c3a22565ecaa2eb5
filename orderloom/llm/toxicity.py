"""Toxicity behind disguises: a noisy channel is undone by Viterbi, then the restored text scored.

Channel: letters may be written as digits or signs (leetspeak), repeated, or set apart by spaces
or punctuation. A suspect token spans a lattice: a sign is read as one of its letters or as a gap,
a run of one letter as one, two or all of its copies, a separator between single letters as
nothing or as a gap. The cheapest path under a character trigram model of the whole corpus plus
channel costs is the restored text. Tokens of plain letters have one reading and are kept.

Score: logistic regression on words and word beginnings (4 and 5 letters) of the restored text
that labelled toxic texts have more often than others. Fitted on up to `per_class` labelled rows
of each class, chosen by a hash of their ids; up to `terms` features with a document frequency of
at least `least` toxic rows. Scoring and the trigram counts read every whole text.

Null and empty texts have no features and the score of the offset alone. Without labels of both
classes every score is the share of label 1 (0 without labels). Repeated rows and ids repeat their
score; several labels of an id count as 1 where any is; extra columns are not returned; an empty
table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import (
    Remembered,
    filter_texts,
    forget,
    held_out,
    learnable,
    map_texts,
    pick,
    sample_ids,
    written,
)

# what a digit or sign may stand for, fixed values
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Channel costs (negative log probabilities): a sign for a letter, a run of three or more and a
#: double letter shortened, a gap filled, a sign inside a token that stands for a gap.
COST_LEET, COST_RUN, COST_DOUBLE, COST_GAP, COST_INNER = 0.5, 0.5, 4.0, 0.5, 2.0
SIZE = 64  # symbols of the character model: 0 is a gap
OTHER = 60
#: Characters whose trigrams are counted in one go.
CHARACTERS = 1 << 19
_LETTERS = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(LEET))
#: A token with a letter and a sign, or with a letter three times in a row.
_SUSPECT = re.compile(rf"(?=.*[^\W\d_])(?:.*[{_SIGNS}].*[^\W\d_]|.*[^\W\d_].*[{_SIGNS}])|.*([^\W\d_])\1\1", re.S)
#: Three or more single characters set apart.
_APART = re.compile(rf"(?<![^\s])(?:[^\W_]|[{_SIGNS}])(?:[ \t.\-_*]+(?:[^\W_]|[{_SIGNS}])(?=[\s.\-_*]|\Z)){{2,}}")
_SEPARATORS = " \t.-_*"


def _symbols() -> np.ndarray:
    """Symbol of each code point: its own for a-z and Latin-1 letters, OTHER for letters, else a gap."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x80, 0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = OTHER
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    for k, c in enumerate(range(0xDF, 0x100)):
        if chr(c).isalpha():
            table[c] = 27 + k
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    return _symbols_of(text.lower())


def _symbols_of(lowered: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_symbols())
    return _TABLE[0][np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)]


def count_trigrams(texts: list[str], counts: np.ndarray) -> None:
    """Add the trigrams of some texts, gaps around each; few characters are widened at a time."""
    for k in range(0, len(texts), 200):
        whole = ("  " + "  ".join(texts[k : k + 200]) + "  ").lower()
        for i in range(0, len(whole) - 2, CHARACTERS):
            s = _symbols_of(whole[i : i + CHARACTERS + 2]).astype(np.int32)
            codes = (s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:]
            counts += np.bincount(codes, minlength=SIZE**3)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all character trigrams of the corpus, gaps around each text: 64 x 64 x 64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            count_trigrams([t for t in batch.column(0).to_pylist() if t], counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["code", "n"])

    parts = pick(docs, "text").mapInArrow(run, "code long, n long")
    out = np.zeros(SIZE**3)
    for r in parts.groupBy("code").agg(F.sum("n").alias("n")).collect():  # 262,144 rows at most
        out[r["code"]] = r["n"]
    return out.reshape(SIZE, SIZE, SIZE)


def trigram_costs(counts: np.ndarray, trust: float = 5.0) -> np.ndarray:
    """Negative log probabilities of a symbol after two others, backed off to one and none."""
    one = (counts.sum((0, 1)) + 0.5) / (counts.sum() + 0.5 * SIZE)
    pair = counts.sum(0)
    two = (pair + trust * one) / (pair.sum(1, keepdims=True) + trust)
    three = (counts + trust * two[None]) / (counts.sum(2, keepdims=True) + trust)
    return -np.log(three).astype(np.float32)


class Restorer:
    """Cheapest reading of suspect tokens."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs
        self.of_token = Remembered(self._words, 200_000)

    def _steps(self, text: str, apart: bool) -> list[list[tuple[str, float]]]:
        """Per place the readings (letters, cost); a gap is a space."""
        steps: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(text):
            c = text[i]
            run = 1
            while i + run < len(text) and text[i + run] == c:
                run += 1
            letters = c if c.isalpha() else LEET.get(c, "")
            cost = 0.0 if c.isalpha() else COST_LEET
            if letters:
                inner = 0 < i and i + run < len(text)
                readings = [] if c.isalpha() else [(" ", COST_INNER if inner else 0.0)]
                short = COST_RUN if run > 2 else COST_DOUBLE
                for x in letters:
                    readings += [(x * k, cost + (short if k < run else 0)) for k in {1, min(2, run)}]
                    if run > 2:
                        readings.append((x * run, cost))
            elif apart and c in _SEPARATORS:
                # letters apart are closed up unless the gap is wider than the others
                readings = [("", COST_GAP), (" ", 6 * COST_GAP if run == 1 else 0.0)]
            else:
                readings = [(" ", 0.0)]
            steps.append(readings)
            i += run
        return steps

    def read(self, text: str, apart: bool = False) -> str:
        costs = self.costs
        best: dict[tuple[int, int], tuple[float, object]] = {(0, 0): (0.0, None)}
        for readings in [*self._steps(text.lower(), apart), [("  ", 0.0)]]:
            after: dict[tuple[int, int], tuple[float, object]] = {}
            for letters, extra in readings:
                codes = symbols(letters).tolist() if letters else []
                for (a, b), (cost, path) in best.items():
                    total = cost + extra
                    for x in codes:
                        if x or b:  # a run of gaps is one gap
                            total += costs[a, b, x]
                            a, b = b, x
                    if (a, b) not in after or total < after[a, b][0]:
                        after[a, b] = (total, (path, letters))
            best = after
        path, out = min(best.values(), key=lambda v: v[0])[1], []
        while path is not None:
            out.append(path[1])
            path = path[0]
        return " ".join("".join(reversed(out)).split())

    def _words(self, token: str) -> tuple[str, ...]:
        return tuple(_LETTERS.findall(self.read(token) if _SUSPECT.match(token) else token))

    def restored_words(self, text: str | None) -> set[str]:
        """Distinct words of the restored text, in lower case."""
        if not text:
            return set()
        text = text.lower()
        found: set[str] = set()
        for own in map(self.of_token.__getitem__, set(text.split())):
            found.update(own)
        for m in _APART.finditer(text):
            found.update(_LETTERS.findall(self.read(m.group(), apart=True)))
        return found

    def restore(self, text: str) -> str:
        """The text with suspect parts in their cheapest reading, the rest as it is."""
        text = _APART.sub(lambda m: self.read(m.group(), apart=True), text)
        return re.sub(r"\S+", lambda m: self.read(m.group()) if _SUSPECT.match(m.group()) else m.group(), text)


def features(words: set[str]) -> set[str]:
    out = set(words)
    for k in (4, 5):
        out.update([w[:k] + "*" for w in words if len(w) >= k])
    return out


@dataclass
class Model:
    costs: np.ndarray
    weights: dict[str, float]
    offset: float


def fit(
    y: np.ndarray, row: np.ndarray, col: np.ndarray, terms: int, ridge: float = 0.05, steps: int = 600
) -> tuple[np.ndarray, float]:
    """Weights and offset of a ridged logistic regression on present features, by gradient steps.

    Feature col[k] is present in row[k].
    """
    w, b = np.zeros(terms), 0.0
    seen = np.zeros(terms), 0.0
    for _ in range(steps):
        z = np.bincount(row, w[col], len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw, gb = np.bincount(col, error[row], terms) + ridge * w, error.sum()
        seen = seen[0] + gw * gw, seen[1] + gb * gb
        w -= gw / np.sqrt(seen[0] + 1e-9)
        b -= gb / math.sqrt(seen[1] + 1e-9)
    return w, b


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = 10_000,
    terms: int = 2000,
    least: int = 3,
) -> Model:
    costs = trigram_costs(trigram_counts(docs))
    known = learnable(labels, label)
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    if len(n) < 2:
        return Model(costs, {}, 40.0 if n.get(1) else -40.0)
    sample = F.broadcast(sample_ids(known, per_class))

    def start():
        restorer = Restorer(costs)
        return lambda texts: [[sorted(features(restorer.restored_words(t))) for t in texts]]

    chosen = pick(docs, "doc_id", "text").join(sample, "doc_id").select("y", "text")
    rows = written(map_texts(chosen, {"terms": "array<string>"}, start, drop=("text",)), "toxic-sample")
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Model(costs, {}, 40.0 if n[1] == total else -40.0)
    p, q = F.col("p"), F.col("q")
    odds = F.log((p + 0.5) / (size[1] - p + 0.5)) - F.log((q + 0.5) / (size[0] - q + 0.5))
    counted = (
        rows.select("y", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
        .where(p >= least)
        .withColumn("z", odds / F.sqrt(1 / (p + 0.5) + 1 / (q + 0.5)))
        .where("z > 2")
    )
    best = [r["term"] for r in counted.orderBy(F.desc("z"), "term").limit(terms).collect()]
    index = {t: k for k, t in enumerate(best)}

    def numbered():
        return lambda lists: [[[index[t] for t in own if t in index] for own in lists]]

    # as numbers: the driver holds 4 bytes for each term of the sample that is present
    present = map_texts(rows, {"own": "array<int>"}, numbered, "terms", drop=("terms",)).select("y", "own").toArrow()
    y, own = present.column("y").to_numpy().astype(float), present.column("own").combine_chunks()
    sizes = np.diff(own.offsets.to_numpy())
    w, b = fit(y, np.repeat(np.arange(len(y), dtype=np.int32), sizes), own.flatten().to_numpy(), len(best))
    # back from the sample's share of label 1 to the share among all labelled rows
    b += math.log(n[1] / n[0]) - math.log(size[1] / size[0])
    return Model(costs, dict(zip(best, w.tolist(), strict=True)), float(b))


def _scorer(model: Model):
    restorer, weights, offset = Restorer(model.costs), model.weights, model.offset
    names = weights.keys()

    def of(text: str | None) -> float:
        z = offset + sum(weights[t] for t in names & features(restorer.restored_words(text)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))

    return of


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def start():
        of = _scorer(model)
        return lambda texts: [[of(t) for t in texts]]

    scored = map_texts(pick(docs, "doc_id", "text"), {"score": "double"}, start, drop=("text",))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold."""

    def start():
        of = _scorer(model)
        return lambda texts: [of(t) < threshold for t in texts]

    return filter_texts(docs, start)
