"""Document fingerprints by consistent weighted sampling.

A text is a bag of words (lower-cased in ASCII, split at ASCII white space) weighted by how often
they occur. For each of 128 coordinates every word has fixed draws r, c from Gamma(2, 1) and b
uniform, derived from its 64-bit hash and the coordinate. A word of weight w is rounded down to the
last of its grid points, t = floor(ln w / r + b), and takes the value ln c - r (t - b + 1); the word
with the least value is the sample (word, t). Two texts agree in a coordinate with the probability of the
generalised Jaccard similarity of their weights, sum of minima over sum of maxima. A fingerprint
holds 16 bits of each sample, so 1 of 65,536 differing samples agrees as well.

Null texts count as empty. Texts without words share one fingerprint of their own, like only to
itself. Equal texts have equal fingerprints. Repeated rows are documents of their own, an empty
table gives an empty one, extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import WordHashes, in_ranges, kept, map_texts, mix64, pick

SAMPLES = 128
#: Places for words whose draws a worker remembers, 1.5 KB each.
CACHED = 1 << 17
#: Words of a text that are looked at together.
BLOCK = 1 << 12


@dataclass
class Bag:
    """Hashed words, the distinct ones in order, how often they occur, and their values at weight 1
    if held."""

    words: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    once: np.ndarray | None = None


def bag_of(words: np.ndarray) -> Bag:
    return Bag(words, *np.unique(words, return_counts=True))


class Sampler:
    """Draws of words and coordinates, the same in every process whatever is remembered."""

    def __init__(self, cached: int = CACHED) -> None:
        self.seeds = mix64(np.arange(2 * SAMPLES, dtype=np.uint64)).reshape(2, 1, SAMPLES)
        self.r, self.b, self.once = (np.empty((cached, SAMPLES), np.float32) for _ in range(3))
        # the word at each place, which is its hash modulo the places; a new word takes its place
        self.places = np.uint64(cached)
        self.owners = np.zeros(cached, np.uint64)
        self.owners[0] = 1  # not at place 0
        self.hashes = WordHashes()
        self.columns = np.arange(SAMPLES)

    def draws(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, b and the values at weight 1 of hashed words in all coordinates."""
        x, y = (mix64(words[:, None] ^ seeds) for seeds in self.seeds)

        def uniform(bits: np.ndarray) -> np.ndarray:
            # 23 bits: with the half they fit a float, so no draw is 0 or 1
            small = (bits & np.uint64(0x7FFFFF)).astype(np.int32).astype(np.float32)
            return (small + np.float32(0.5)) * np.float32(2**-23)

        r = -np.log(uniform(x) * uniform(x >> np.uint64(23)))
        log_c = np.log(-np.log(uniform(y) * uniform(y >> np.uint64(23))))
        b = uniform(x >> np.uint64(46) ^ (y >> np.uint64(46)) << np.uint64(5))
        return r, b, log_c - r * (1 - b)

    def _found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of hashed words, and which of the words are not there."""
        places = (words % self.places).astype(np.int64)
        return places, np.flatnonzero(self.owners[places] != words)

    def once_of(self, words: np.ndarray) -> np.ndarray:
        """The values at weight 1 of hashed words."""
        places, new = self._found(words)
        once = self.once[places]
        if len(new):
            drawn, at = self.draws(words[new]), places[new]
            once[new] = drawn[2]
            self.owners[at] = words[new]
            for table, values in zip((self.r, self.b, self.once), drawn, strict=True):
                table[at] = values
        return once

    def grids_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """r and b of hashed words."""
        places, new = self._found(words)
        r, b = self.r[places], self.b[places]
        if len(new):
            r[new], b[new], _ = self.draws(words[new])
        return r, b

    def hashed(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))

    def bag(self, text: str) -> Bag:
        return bag_of(self.hashed(text.encode("utf-8").lower().split()))

    def edited(self, text: str, cut: int, one: tuple[str, Bag], two: tuple[str, Bag]) -> Bag:
        """The bag of text, which is one up to the code point `cut` and then two from its start.

        Only the words at the cut and at the end are new; the others are those of the bags.
        """
        words = text.encode("utf-8").lower().split()
        if cut + 1 < len(text):
            whole = max(0, len(one[0][:cut].encode("utf-8").split()) - 1)
            after = max(0, len(two[0][: len(text) - cut].encode("utf-8").split()) - 2)
            if after and whole + after + 1 < len(words):
                middle = self.hashed(words[whole : len(words) - 1 - after])
                parts = (one[1].words[:whole], middle, two[1].words[1 : 1 + after], self.hashed(words[-1:]))
                return bag_of(np.concatenate(parts))
        return bag_of(self.hashed(words))

    def sample(self, bag: Bag, *near: Bag) -> np.ndarray:
        """The fingerprint of a bag; words that it shares with sampled bags near it are taken from these."""
        terms, counts = bag.terms, bag.counts
        if not len(terms):
            return np.full(SAMPLES, 0xFFFF, np.uint16)
        least = np.full(SAMPLES, np.inf, np.float32)
        word, at = np.full(SAMPLES, np.iinfo(np.uint64).max), np.zeros(SAMPLES, np.int64)

        def offer(some: np.ndarray, value: np.ndarray, grid: np.ndarray | None = None) -> None:
            # the least value, of equal ones the least word, in whatever parts they come
            best = value.argmin(axis=0)
            found, chosen = value[best, self.columns], some[best]
            less = (found < least) | ((found == least) & (chosen <= word))
            least[less], word[less] = found[less], chosen[less]
            at[less] = 0 if grid is None else grid[best[less], self.columns[less]]

        def take(some: np.ndarray, weights: np.ndarray, once: np.ndarray) -> None:
            offer(some, once)
            # more weight never gives a larger value, so the line above does no harm
            more = np.flatnonzero(weights > 1)
            if len(more):
                r, b = self.grids_of(some[more])
                grid = np.floor(np.log(weights[more, None].astype(np.float32)) / r + b)
                offer(some[more], once[more] - r * grid, grid)

        rest = np.ones(len(terms), bool)
        for other in near:
            if other.once is not None and len(other.terms):
                place = np.minimum(np.searchsorted(other.terms, terms), len(other.terms) - 1)
                shared = np.flatnonzero(rest & (other.terms[place] == terms))
                if len(shared):
                    take(terms[shared], counts[shared], other.once[place[shared]])
                    rest[shared] = False
        left = np.flatnonzero(rest)
        for k in range(0, len(left), BLOCK):
            some = terms[left[k : k + BLOCK]]
            once = self.once_of(some)
            take(some, counts[left[k : k + BLOCK]], once)
            if len(some) == len(terms):
                bag.once = once
        return (mix64(word + mix64(at.astype(np.uint64))) % np.uint64(0xFFFF)).astype(np.uint16)

    def fingerprint(self, text: str) -> np.ndarray:
        return self.sample(self.bag(text))


def sampler() -> Sampler:
    return kept("fingerprints", Sampler)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hexadecimal) of each text, without a shuffle."""
    def start():
        of = sampler().fingerprint
        return lambda texts: [[of(t or "").tobytes().hex() for t in texts]]

    return map_texts(pick(docs, "doc_id", "text"), {"fingerprint": "string"}, start, drop=("text",))


def with_next(docs: DataFrame) -> DataFrame:
    """(part, head, doc_id, text) dealt out by ranges of doc_id and sorted, so that the row after
    a document is the next one; the last of each part is a copy (head) of the next part's first.

    Null ids come first, equal ids in the order of their texts; after the last comes the first.
    Only ids are looked at to find the ranges; one id's rows stay together.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pick(docs, "doc_id", "text")
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    parted = in_ranges(rows, "doc_id", n)
    # nulls sort first but min() passes over them
    least = parted.groupBy("part").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("no_id")
    )
    firsts = {r["part"]: None if r["no_id"] else r["least"] for r in least.collect()}
    present = sorted(firsts)
    before = {p: present[k - 1] for k, p in enumerate(present)}
    known = [v for v in firsts.values() if v is not None]
    wanted = F.col("doc_id").isin(known) if known else F.lit(False)
    if None in firsts.values():
        wanted = wanted | F.col("doc_id").isNull()
    heads = parted.where(wanted).groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("h"))
    to = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else None
    heads = heads.select(
        (F.element_at(to, F.col("part")) if before else F.col("part")).alias("part"),
        F.lit(True).alias("head"),
        "h.doc_id",
        "h.text",
    )
    dealt = parted.select("part", F.lit(False).alias("head"), "doc_id", "text").unionByName(heads)
    return dealt.repartitionById(n, "part").sortWithinPartitions("part", "head", "doc_id", "text")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next one's are.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of
    the next document (or all it has). Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    fields = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )
    ordered = with_next(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = sampler()
        last = None
        for batch in batches:
            out = []
            for part, head, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bag = draws.bag(text)
                own = draws.sample(bag)
                if last and last[0] == part:
                    _, before_id, before, before_own, before_bag = last
                    half = len(before) // 2
                    edited = before[: len(before) - half] + text[:half]
                    edited_bag = draws.edited(edited, len(before) - half, (before, before_bag), (text, bag))
                    edited_own = draws.sample(edited_bag, before_bag, bag)
                    out.append(
                        (
                            before_id,
                            len(before),
                            hashlib.sha256(edited.encode("utf-8")).hexdigest(),
                            before_own.tobytes().hex(),
                            edited_own.tobytes().hex(),
                            likeness(before_own, edited_own),
                            likeness(before_own, own),
                        )
                    )
                last = None if head else (part, doc_id, text, own, bag)
            columns = list(zip(*out, strict=True)) or [[]] * len(schema)
            arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return ordered.mapInArrow(run, fields)
