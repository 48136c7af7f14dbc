"""Periodic runs of words: passages that repeat themselves with a fixed period, four times or more.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
max(6, 4 q) words long, that no neighbouring word extends keeping the period.

Periods below ``SHORT`` are found by direct lag scans: words equal to the word q behind, as stretches. Longer ones by
multi-scale minimizers, a scale W = 16, 32, 64, ... for the periods in [W, 2 W). Every W-gram of words gets a rolling hash;
each window of W consecutive grams selects its minimum, the rightmost on ties. Inside a run the minima repeat
at period distance: a window W-aligned in the text that starts in the run's first W words has its minimum m, and with it m + q,
within the run's four periods. So for each aligned window, its minimum and every equal selected minimum at a distance in [W, 2 W)
are a seed pair: at most W pairs a window, and rarely more than none. A pair is extended both ways
by binary search over prefix hashes, and whatever reaches four periods is compared word by word, so hashes only ever propose.
An aligned window whose next 3 W words lie in a run of period W / 2 or less is skipped: no run with a smallest period in [W, 2 W)
begins there, as both periods would have to share a divisor.

All texts of a batch are scanned at once as one array of word numbers, with a number of its own between texts; longer scales
drop the texts too short for them. Work grows with words times scales, memory with the batch, for repetitive texts too.

Defined results: null, empty and blank texts have no words and no runs; a text keeps its words' exact bytes; repeated rows give
equal results; an empty table gives an empty table; other columns pass through, those named like the outputs are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, mix64

SHORT, MIN_LENGTH, EXPONENT = 16, 6, 4

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
_R = np.uint64(0xD1342543DE82EF95)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
    return edge[::2], edge[1::2]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Prefix:
    """Prefix hashes of word numbers; equal stretches have equal hashes."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(words.astype(np.uint64)) * _powers(_R, n), out=self.total[1:])
        self.inv = _powers(_R_INV, n + 1)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.total[start + length] - self.total[start]) * self.inv[start]

    def grams(self, width: int) -> np.ndarray:
        return (self.total[width:] - self.total[:-width]) * self.inv[:len(self.total) - width]

    def reach(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Words from positions a < b on (or back from before them) with equal hashes, ``limit`` at most."""
        low, high = np.zeros_like(a), limit.copy()   # low always matches
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            x, y = (a[open_] - mid, b[open_] - mid) if back else (a[open_], b[open_])
            good = self.of(x, mid) == self.of(y, mid)
            low[open_[good]] = mid[good]
            high[open_[~good]] = mid[~good] - 1


def _minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each window of ``width`` hashes, the rightmost on ties."""
    n = len(hashes)
    bits = np.uint64(n.bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = np.full(-(-n // width) * width, ~np.uint64(0), np.uint64)
    key[:n] = (mix64(hashes) & ~low) | (low - np.arange(n, dtype=np.uint64))   # hash above, reversed position below
    blocks = key.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    return (low - (least & low)).astype(np.int64)


def _seeds(prefix: _Prefix, n: int, width: int, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (m, m') of equal minimizers at a distance in [width, 2 width), m from an aligned window."""
    grams = prefix.grams(width)
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chosen = _minimizers(grams, width)
    aligned = np.arange(0, len(chosen), width)
    first = np.unique(chosen[aligned[~skip[aligned]]])
    places = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]   # window minima never move back
    places = places[np.argsort(grams[places], kind="stable")]      # by hash, then position
    _, group = np.unique(grams[places], return_inverse=True)       # hashes numbered, so that (hash, position) is one number
    order = group.astype(np.int64) * (n + 1) + places
    known = np.unique(grams[places])
    own = np.searchsorted(known, grams[first]).astype(np.int64) * (n + 1)
    a = np.searchsorted(order, own + np.minimum(first + width, n))
    b = np.searchsorted(order, own + np.minimum(first + 2 * width, n + 1))
    count = np.maximum(b - a, 0)
    left = np.repeat(first, count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
    return left, places[at]


def _checked(words: np.ndarray, start: int, end: int, lag: int) -> list[tuple[int, int]]:
    """The stretch [start, end) of period ``lag`` that hashes propose, its words compared.

    Hashes of unequal words may agree, never those of equal ones differ: a proposal can only be too long. Then all
    words are compared at this lag, which finds the stretches directly.
    """
    if (words[start:end - lag] == words[start + lag:end]).all():
        return [(start, end)]
    a, b = _stretches(words[:-lag] == words[lag:])
    return list(zip(a.tolist(), (b + lag).tolist()))


def find(words: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) of an array of word numbers, in which ``limits`` are numbers of their own between texts.

    ``limits`` are the positions of the separators, ascending; each text lies between two of them.
    """
    n, found, seen = len(words), [], set()

    def add(start: int, end: int, lag: int) -> None:
        if (start, end) not in seen:   # else of a smaller period, found before
            seen.add((start, end))
            found.append((start, end, lag))

    for lag in range(1, min(SHORT, n)):
        a, b = _stretches(words[:-lag] == words[lag:])
        long = np.flatnonzero(b - a >= max(MIN_LENGTH, EXPONENT * lag) - lag)
        for i in long:
            add(int(a[i]), int(b[i]) + lag, lag)

    # one text's words at a time would cost a call a text: longer scales keep the texts that are long enough
    bounds = np.concatenate([[-1], limits, [n]])
    width = SHORT
    while True:
        size = np.diff(bounds) - 1
        keep = np.flatnonzero(size >= EXPONENT * width)
        if not len(keep):
            break
        take = np.concatenate([np.arange(bounds[i] + 1, min(bounds[i + 1] + 1, n)) for i in keep])   # with the separator behind
        part = words[take]
        for start, end, lag in _scale(part, take, width, found):
            add(start, end, lag)
        width *= 2
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def _scale(part: np.ndarray, take: np.ndarray, width: int, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches of four periods or more with a period in [width, 2 width), in order of the period."""
    n = len(part)
    prefix = _Prefix(part)
    skip = np.zeros(n + 1, np.int64)
    for start, end, lag in found:
        if 2 * lag <= width and end - start >= 3 * width:
            a = int(np.searchsorted(take, start))
            if a < n and take[a] == start:
                skip[a] += 1
                skip[a + end - start - 3 * width + 1] -= 1
    left, right = _seeds(prefix, n, width, np.cumsum(skip) > 0)
    lag = right - left
    ahead = prefix.reach(left, right, n - right, back=False)
    behind = prefix.reach(left, right, left, back=True)
    long = np.flatnonzero(ahead + behind + lag >= EXPONENT * lag)
    spans = np.unique(np.stack([lag[long], left[long] - behind[long], right[long] + ahead[long]], axis=1), axis=0)
    out, seen = [], {(start, end) for start, end, _ in found}
    for period, start, end in spans.tolist():
        if (int(take[start]), int(take[end - 1]) + 1) in seen:   # a smaller period's, of which this is a multiple
            continue
        for a, b in _checked(part, start, end, period):
            own = int(take[a]), int(take[b - 1]) + 1
            if b - a >= EXPONENT * period and own not in seen:
                seen.add(own)
                out.append((*own, period))
    return out


def _numbers(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """(words of each text, word numbers of all with one of its own behind each text, positions of those)."""
    known: dict[bytes, int] = {}
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]   # splits at the six ASCII white spaces
    numbers = []
    for i, w in enumerate(words):
        numbers.extend([known.setdefault(x, len(known)) for x in w])
        numbers.append(-1 - i)
    limits = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0, np.int64)
    return words, np.array(numbers, np.int64), limits


def find_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, its ``runs`` (start and length in words, period; by start, then period) and ``collapsed``:
    the words, joined by one space, without those that stand in a run behind its first period."""
    outputs = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]

    def make():
        def run(col: pa.Array) -> list[pa.Array]:
            words, numbers, limits = _numbers(col.to_pylist())
            found = find(numbers, limits)
            doc = np.searchsorted(limits, found[:, 0])
            first = np.concatenate([[0], limits + 1]) if len(words) else np.zeros(1, np.int64)
            cut = np.searchsorted(doc, np.arange(len(words) + 1))
            runs, collapsed = [], []
            for i, w in enumerate(words):
                own = found[cut[i]:cut[i + 1]]
                spans = [(int(s - first[i]), int(e - s), int(q)) for s, e, q in own]
                spans.sort(key=lambda r: (r[0], r[2]))
                if spans:
                    keep = np.ones(len(w), bool)
                    for s, length, q in spans:
                        keep[s + q:s + length] = False
                    w = [w[k] for k in np.flatnonzero(keep)]
                runs.append([{"start": s, "length": length, "period": q} for s, length, q in spans])
                collapsed.append(b" ".join(w).decode("utf-8", "surrogatepass"))
            count = np.diff(np.concatenate([[-1], limits])) - 1
            return [pa.array(count, pa.int64()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    pa.array(collapsed, pa.string())]
        return run

    return map_columns(df, [text], outputs, make)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; the smallest start, then period, on ties."""
    def better(best: Column, r: Column) -> Column:
        ours, theirs = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (ours > theirs), r).otherwise(best)   # in order of start, then period
    return F.aggregate(runs, F.lit(None).cast(RUN), better)
