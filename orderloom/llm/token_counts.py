"""Exact token counts of every prefix by dynamic programming over the merges of a byte-level BPE.

A sequence of tokens is the encoding of its bytes exactly if each two neighbours stay apart when
they are encoded alone. So the last token of every prefix of a piece is the one token that ends
there and stays apart from the last token of the shorter prefix, and its count is one more. No
prefix is encoded anew; the table answers what fits a budget.

Null texts count as empty (0 tokens). Rows are independent: repeated rows and ids repeat their
result, an empty table gives an empty one, extra columns are not returned. Very long pieces cost
time in proportion to their length.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Remembered, kept, map_texts, pick
from orderloom.llm.pretokens import LETTERS, PIECES, over_units

NEVER = 1 << 60
#: Tables of pieces that begin alike share their first 4, 8 or 12 bytes.
STEM = 4


class PrefixCounter:
    """Token counts as the tokenizers library gives them for a byte-level BPE file."""

    def __init__(self, path: str, remember: int = 200_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(LETTERS)}
        raw = lambda s: bytes(byte_of[c] for c in s)
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for k, (a, b) in enumerate(merges):
            left, right = self.ids[raw(a)], self.ids[raw(b)]
            self.rank[left, right] = k
            made.setdefault(self.ids[raw(a) + raw(b)], (k, left, right))
        self.right_side, self.left_side = {}, {}
        for data, token in self.ids.items():
            self.right_side[token] = self._side(token, made, 2)
            self.left_side[token] = self._side(token, made, 1)
        self.whole = {t for d, t in self.ids.items() if len(d) == 1 or self._whole(t, made)}
        self.apart = Remembered(self._apart, 500_000)
        self.of_stem = Remembered(self._extended, 100_000)
        self.of_piece = Remembered(self._last_count, remember)
        self.of_unit = Remembered(lambda u: self._unit(" " + u), remember)

    @staticmethod
    def _side(token: int, made: dict, which: int) -> tuple[list[int], list[int]]:
        """Symbols at one end of a token while it grows, and the rank at which each is used up."""
        symbols, used = [token], [NEVER]
        while token in made:
            used.append(made[token][0])
            token = made[token][which]
            symbols.append(token)
        return symbols[::-1], used[::-1]

    def _whole(self, token: int, made: dict) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        if token not in made:
            return False
        rank, left, right = made[token]
        return self._first_meeting(left, right) == rank

    def _first_meeting(self, a: int, b: int) -> int:
        """Rank at which the end of a and the start of b merge when both grow side by side."""
        xs, x_used = self.right_side[a]
        ys, y_used = self.left_side[b]
        i = j = 0
        while True:
            rank = self.rank.get((xs[i], ys[j]), NEVER)
            # of equal ranks the left place merges first
            if rank < x_used[i] and rank <= y_used[j] and rank < NEVER:
                return rank if i == len(xs) - 1 and j == len(ys) - 1 else -1
            if x_used[i] == NEVER and y_used[j] == NEVER:
                return NEVER
            if x_used[i] <= y_used[j]:
                i += 1
            else:
                j += 1

    def _apart(self, key: int) -> bool:
        return self._first_meeting(key >> 20, key & 0xFFFFF) == NEVER

    def table(self, piece: bytes) -> list[int]:
        """Number of tokens of each prefix of a piece, the empty one included."""
        return self._extended(piece)[0]

    def _extended(self, piece: bytes) -> tuple[list[int], list[int]]:
        """Counts and last tokens of all prefixes, going on from a stem that was met before."""
        ids, apart, whole = self.ids, self.apart, self.whole
        n = len(piece)
        if n > STEM:
            stem = self.of_stem[piece[: min(n - 1, 3 * STEM) // STEM * STEM]]
            counts, last = stem[0][:], stem[1][:]
        else:
            counts, last = [0], [-1]
        for end in range(len(counts), n + 1):
            start = end
            while True:
                start -= 1
                token = ids.get(piece[start:end])
                if token is not None and (
                    apart[last[start] << 20 | token] if start else token in whole
                ):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts, last

    def _last_count(self, piece: str) -> int:
        data = piece.encode("utf-8", "surrogatepass")
        return 1 if self.ids.get(data) in self.whole else self.table(data)[-1]

    def _unit(self, text: str) -> int:
        return sum(map(self.of_piece.__getitem__, PIECES.findall(text)))

    def _plain(self, text: str) -> int:
        return sum(over_units(text, self._unit, self.of_unit)) if text else 0

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; a special token's string inside it is one token."""
        if not text:
            return 0
        if not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Token count of text[:i] for each i from 0 to its length (code points).

        Counts may fall as a prefix grows. At a cut inside white space, a contraction or a
        special token's string the last pieces differ from those of the whole text; only
        these are looked at again.
        """
        text = text or ""
        out = np.zeros(len(text) + 1, np.int64)
        done = begin = 0
        for m in [*self.special.finditer(text), None]:
            end = m.start() if m else len(text)
            done, (at, fixed) = self._segment(text[begin:end], out, begin, done)
            if m:
                for i in range(end + 1, m.end()):
                    out[i] = fixed + self._plain(text[at:i])
                done += 1
                begin = m.end()
                out[begin] = done
        return out

    def _segment(self, text: str, out: np.ndarray, base: int, done: int) -> tuple[int, tuple]:
        """Fills `out`; returns the count and where the last two pieces begin, with the count there."""
        before, starts = "", [(base, done)]
        for m in PIECES.finditer(text):
            piece, at = m.group(), base + m.start()
            counts = self.table(piece.encode("utf-8", "surrogatepass"))
            byte = 0
            for i, c in enumerate(piece, 1):
                byte += len(c.encode("utf-8", "surrogatepass"))
                out[at + i] = done + counts[byte]
            if len(piece) > 2 and piece[0] == "'" and piece[1].isalpha():
                out[at + 2] = done + self._unit(piece[:2])
            if piece[0].isspace() and before and not before.strip():
                # at the end of a text a run of white space is one piece
                out[at + 1] = starts[-1][1] + self._unit(before + piece[0])
            before = piece
            starts.append((at, done))
            done += counts[-1]
        return done, starts[max(0, len(starts) - 2)]


def counter(path: str) -> PrefixCounter:
    """One counter per file and worker process."""
    return kept(path, lambda: PrefixCounter(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens) of each text."""

    def start():
        count = counter(path).count
        return lambda texts: [[count(t) for t in texts]]

    rows = pick(docs, "doc_id", "text")
    counted = map_texts(
        rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")),
        {"n_tokens": "bigint"},
        start,
        drop=("text",),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def truncate(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """doc_id and the longest prefix of each text that has at most `budget` tokens, with its count."""

    def start():
        counts = counter(path).prefix_counts

        def work(texts: list) -> list:
            cut, n = [], []
            for t in texts:
                c = counts(t)
                i = int(np.flatnonzero(c <= budget)[-1])
                cut.append((t or "")[:i])
                n.append(int(c[i]))
            return [cut, n]

        return work

    rows = pick(docs, "doc_id", "text")
    return map_texts(rows, {"fitting_text": "string", "n_tokens": "bigint"}, start, drop=("text",))
