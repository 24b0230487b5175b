"""Periodic runs of words, by Lyndon roots.

Phase one of Baier's suffix sorter groups the positions of a text by their longest Lyndon prefix,
from the greatest group to the smallest; when a group's turn comes, the distance to the next position
that is still waiting is the length of that Lyndon word. Done under the order of words and under
its reverse, this gives both Lyndon arrays without a suffix array. The root of every run is the longest
Lyndon word at one of its positions in one of the two orders, so the roots extended to both sides,
as far as words one period apart agree, are the runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm.common import BLANK, pieces, text_buffers

MIN_LENGTH, MIN_EXPONENT = 6, 4
PIECE_BYTES = 1 << 18


def lyndon_groups(ranks: list[int]) -> tuple[list[int], list[int]]:
    """Length of the longest Lyndon word at each position of a text of ranks (0 to k - 1), the end of
    the text being smaller than all, and its group: positions of one group have the same Lyndon word.

    ``left`` and ``right`` link the waiting positions (1 to n; 0 and n + 1 are the ends), ``above`` and
    ``below`` the groups in their order. A group whose turn has come hands its Lyndon word on to the
    waiting position before each of its members. Those positions move to new groups right above their
    old ones, the ones that got more copies higher."""
    n, k = len(ranks), max(ranks, default=-1) + 1
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    members: list[list[int]] = [[] for _ in range(k)]
    for at, r in enumerate(ranks, 1):
        members[r].append(at)
    group = [-1, *ranks, -1]
    below, above = list(range(-1, k - 1)), [*range(1, k), -1]
    lengths = [0] * (n + 2)
    now = k - 1
    while now >= 0:
        copies: dict[int, int] = {}
        for at in members[now]:
            if group[at] == now:  # else it has moved to a higher group
                before, after = left[at], right[at]
                lengths[at] = after - at
                right[before], left[after] = after, before
                copies[before] = copies.get(before, 0) + 1
        members[now] = []
        copies.pop(0, None)
        moves: dict[tuple[int, int], list[int]] = {}
        for at, c in copies.items():
            moves.setdefault((group[at], c), []).append(at)
        for origin, c in sorted(moves, reverse=True):  # more copies first, so that fewer come below
            new, over = len(members), above[origin]
            members.append(moves[origin, c])
            below.append(origin)
            above.append(over)
            above[origin] = new
            if over >= 0:
                below[over] = new
            for at in members[new]:
                group[at] = new
        now = below[now]
    return lengths[1:n + 1], group[1:n + 1]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two arrays of one length, looked at in doubling parts."""
    done, step = 0, 64
    while done < len(a):
        differ = np.flatnonzero(a[done:done + step] != b[done:done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, 2 * step
    return len(a)


def segment_runs(ranks: list[int], min_length: int, min_exponent: int) -> set[tuple[int, int, int]]:
    """Runs (start, length, period) of a text of ranks."""
    word, found, top = np.array(ranks), set(), max(ranks)
    for order in (ranks, [top - r for r in ranks]):
        length, group = (np.array(x) for x in lyndon_groups(order))
        at = np.arange(len(word))
        # a run holds min_exponent - 1 whole copies from the first root on
        for copy in range(1, min_exponent - 1):
            after = at + length[at] * copy
            at, after = at[after < len(word)], after[after < len(word)]
            at = at[group[after] == group[at]]
        before = at - length[at]
        first = (before < 0) | (group[np.maximum(before, 0)] != group[at])
        for i in at[first].tolist():
            p = int(length[i])
            if i + p < len(word):
                ahead = _agree(word[i:len(word) - p], word[i + p:])
                back = _agree(word[:i][::-1][:p], word[:i + p][::-1][:min(p, i)])
                size = back + p + ahead
                if size >= max(min_length, min_exponent * p):
                    found.add((i - back, size, p))
    return found


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
              ) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a text's words, by start and period: stretches of the smallest
    period that no neighbouring word extends, of ``min_exponent`` periods and ``min_length`` words at
    least. Every word of a run occurs as often as its exponent tells, so rarer words part the text."""
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    often = np.bincount(ids, minlength=1)[ids] >= min_exponent
    edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]])))
    found = []
    for a, b in edges.reshape(-1, 2).tolist():
        if b - a >= min_length:
            ranks = np.unique(ids[a:b], return_inverse=True)[1]
            found += [(a + s, n, p) for s, n, p in segment_runs(ranks.tolist(), min_length, min_exponent)]
    return sorted(found)


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    turns = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0).tolist()]


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of ``docs``: the runs of words of each text as structs
    (start, length, period) by start and period, and the words outside the repeats, joined by a space.

    A text is one unit of work, whatever its length; memory grows with its longest stretch of words that
    each occur ``min_exponent`` times. Null and empty texts have no words and an empty ``collapsed``;
    a null doc_id stays null; repeated rows and ids are rows of their own; other columns are ignored;
    an empty table gives an empty result. ``min_exponent`` is 2 or more."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                data, offsets = text_buffers(part.column(1))
                raw = data.tobytes()
                sizes, runs, kept = [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    words = raw[a:b].split()
                    own = word_runs(words, min_length, min_exponent)
                    sizes.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                    kept.append(b" ".join(kept_words(words, own)).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_ARROW_RUN)),
                     pa.array(kept, pa.string())], schema.names)

    return docs.select("doc_id", F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of ``docs``, where a tenth of the documents repeats a few of its words: if
    h = crc32(decimal doc_id) is divisible by 10, word i >= a becomes word a + (i - a) % p, with
    g = h / 10, a = g % n, p = 1 + (n - a) / (3 + g % 8), all whole. A null doc_id is left alone."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.when(h % 10 == 0, F.struct(
        F.floor(h / 10).alias("g"), F.regexp_extract_all(text, F.lit(rf"[^{BLANK}]+"), F.lit(0)).alias("w"))).alias("x"))
    planted = F.expr("""
        array_join(transform(x.w, (v, i) -> IF(i < x.g % size(x.w), v, x.w[int(x.g % size(x.w) + (i - x.g % size(x.w))
          % (1 + (size(x.w) - x.g % size(x.w)) div (3 + x.g % 8)))])), ' ')""")
    return rows.select("doc_id", F.when(F.size("x.w") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """``periodic_runs`` with the run of the greatest exponent (of equal ones, the first) and sha256 digests
    of all runs and of the collapsed text."""
    best = F.expr("""aggregate(slice(runs, 2, greatest(size(runs), 1)), runs[0], (b, r) ->
        IF(r.length * b.period > b.length * r.period, r, b))""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(
        F.size("runs") > 0, best).alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(
        F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
