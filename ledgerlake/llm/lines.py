"""Line dedup: winnowing over line hashes.

A window is the shortest run of lines, blank ones aside, with ``min_words``
words: forward from each line, and backward from each line. Its line of the
smallest hash (the last of equals) is its fingerprint: any run of at least
``min_words`` words that occurs twice holds a whole window in both places, and
so the same fingerprint. Positions are joined on their fingerprints; those
whose fingerprint occurs once are out. From each position left, the match is
extended both ways over the windows that chose it; a window whose lines
occurred earlier (by doc_id, then line) is deleted, and with it the whole
repeated run: a line of the run is either the end of a backward window within
the run, or too near the run's first line for that, and then within that
line's forward window.

Every deleted line is still there at an earlier place: its window's first
occurrence, or what that one repeats. A line that is very common meets only
per-fingerprint counts and per-window minima, both combined before the
shuffle, and joins that Spark splits.

Edge cases: null and blank texts have no line and stay as they are; rows of
equal doc_id and text are one document, treated alike; a null doc_id comes
last; texts of under ``min_words`` words are never changed; line equality
ignores white space at a line's ends; blank lines inside a deleted run go with
it. Other columns are passed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fresh, materialize, prepare, text_bytes

MIN_WORDS = 50


def windows(text: bytes, min_words: int = MIN_WORDS) -> dict[int, list[tuple[bytes, int, int]]]:
    """By chosen line: its windows (digest of the lines, first line, last line)."""
    lines = [(i, s, len(s.split())) for i, s in
             ((i, line.strip()) for i, line in enumerate(text.split(b"\n"))) if s]
    digests = [blake2b(s, digest_size=16).digest() for _, s, _ in lines]
    out: dict[int, list[tuple[bytes, int, int]]] = {}
    spans: set[tuple[int, int]] = set()
    end, words = 0, 0
    for a in range(len(lines)):
        while end < len(lines) and words < min_words:
            words += lines[end][2]
            end += 1
        if words < min_words:
            break
        spans.add((a, end))
        words -= lines[a][2]
    a, words = 0, 0
    for end in range(1, len(lines) + 1):
        words += lines[end - 1][2]
        while words - lines[a][2] >= min_words:
            words -= lines[a][2]
            a += 1
        if words >= min_words:
            spans.add((a, end))
    for a, end in sorted(spans):
        part = digests[a:end]
        chosen = a + max(range(len(part)), key=lambda k: (-int.from_bytes(part[k][:8]), k))
        out.setdefault(chosen, []).append(
            (blake2b(b"".join(part), digest_size=16).digest(), lines[a][0], lines[end - 1][0]))
    return {k: (digests[k], v) for k, v in out.items()}


def positions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows doc_id, tie (a hash of the text), fingerprint, windows: one per chosen line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, fp, win = [], [], []
            for i, t in enumerate(text_bytes(b.column("text"))):
                for digest, found in windows(t, min_words).values():
                    row.append(i)
                    fp.append(int.from_bytes(digest[:8], signed=True))
                    win.append([{"w": w, "lo": lo, "hi": hi} for w, lo, hi in found])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("tie").take(at), pa.array(fp, pa.int64()),
                 pa.array(win, pa.list_(pa.struct([("w", pa.binary()), ("lo", pa.int32()),
                                                   ("hi", pa.int32())])))],
                names=["doc_id", "tie", "fp", "windows"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(
        run, f"doc_id {kind}, tie long, fp long, windows array<struct<w:binary,lo:int,hi:int>>")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows id, tie, runs: the line ranges of a text that occurred earlier."""
    chosen = materialize(positions(docs, min_words), "line-positions")
    # Counts and minima are written before they are joined: Spark splits a hot key's rows
    # in a join of two plain shuffles, not in the stage that also sums them up.
    often = materialize(chosen.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1")
                        .select(F.col("fp").alias("f")), "line-often")
    found = materialize(
        chosen.join(often, F.col("fp") == F.col("f"))
        .select("doc_id", "tie", F.explode("windows").alias("x"))
        .select("doc_id", "tie", "x.w", "x.lo", "x.hi"), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "tie", "lo")
    first = materialize(
        found.groupBy("w").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("w").alias("fw"), "first"), "line-first")
    later = found.join(first, F.col("w") == F.col("fw")).where(place != F.col("first"))
    return later.groupBy(F.col("doc_id").alias("id"), F.col("tie").alias("id_tie")).agg(
        F.collect_set(F.struct("lo", "hi")).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with text without repeated runs, and line_counts (n_lines, n_removed)."""
    prepare(docs.sparkSession)
    runs = repeated_runs(docs, min_words)
    row, key, tie, counts, own, own_tie, spans = (fresh(docs.columns, c) for c in (
        "row", "key", "tie", "line_counts", "id", "id_tie", "runs"))
    runs = runs.toDF(own, own_tie, spans)
    text = F.col("text")
    d = docs.withColumn(tie, F.xxhash64("text"))
    joined = d.join(runs, F.col("doc_id").eqNullSafe(F.col(own))
                    & (F.col(tie) == F.col(own_tie)), "left")
    lines = joined.withColumn(key, F.split(F.coalesce(text, F.lit("")), "\n", -1))
    gone = F.flatten(F.transform(spans, lambda r: F.sequence(r["lo"], r["hi"])))
    left = F.array_except(F.sequence(F.lit(0), F.size(key) - 1), gone)
    lines = lines.withColumn(row, F.when(F.col(spans).isNotNull(), left))
    new = F.when(F.col(row).isNull(), text).otherwise(
        F.array_join(F.transform(row, lambda i: F.get(F.col(key), i)), "\n"))
    n = F.when(text.isNull(), 0).otherwise(F.size(key)).cast("long")
    removed = F.when(F.col(row).isNull(), 0).otherwise(F.size(key) - F.size(row)).cast("long")
    return lines.select(*[new.alias("text") if c == "text" else F.col(f"`{c}`")
                          for c in docs.columns],
                        F.struct(n.alias("n_lines"), removed.alias("n_removed")).alias(counts))
