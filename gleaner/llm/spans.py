"""Long exact spans shared between records, by difference-cover anchors.

Only windows at positions p with p mod PERIOD in COVER are hashed. For any two alignments of one span
some offset below PERIOD puts both copies on a cover position (the cover holds every difference), so
a span of at least PERIOD - 1 + ANCHOR characters always shares an aligned anchor. Around the anchors
that two texts share the match is extended: each window of the least length that holds such an
anchor is hashed, and those that two texts share make up the shared characters. No pairs are built,
so a passage that a third of all records holds costs as many rows as it has occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.session import ensure_checkpoint_dir, own_exchange

# A perfect difference set, each residue but 0 once as a difference.
PERIOD, COVER = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)
assert len({(a - b) % PERIOD for a in COVER for b in COVER}) == PERIOD

#: Characters hashed at once; a longer text is hashed in overlapping blocks.
BLOCK = 1 << 18
#: Odd base of the rolling hash modulo 2**64, and the seeds of the two independent hashes.
BASE, ANCHOR_SEED, SPAN_SEED = 0x9E3779B97F4A7C15, 1, 2


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WindowHasher:
    """Hashes of all windows of one width over code points; equal windows have equal hashes anywhere."""

    def __init__(self, width: int, seed: int) -> None:
        self.width, self.seed = width, np.uint64(seed * 0xD1B54A32D192ED03 % 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        n = len(points)
        if len(self.up) <= n:
            self.up, self.down = _powers(BASE, n + 1), _powers(pow(BASE, -1, 2**64), n + 1)
        x = points.astype(np.uint64) + self.seed
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((x ^ (x >> np.uint64(31))) * self.up[:n], out=sums[1:])
        w = self.width
        return (sums[w:] - sums[:-w]) * self.down[: n - w + 1] if n >= w else np.zeros(0, np.uint64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _groups(rows: Iterator[tuple], width: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, code points, start of each piece, place of each piece in its text) for about BLOCK characters at a time.

    A piece ends width - 1 characters after the last start it stands for, so that no window is lost.
    """
    keys: list = []
    texts: list[str] = []
    places: list[int] = []
    size = 0

    def done() -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        return keys, _points("".join(texts)), np.cumsum([0, *map(len, texts)]), np.array(places, np.int64)

    for key, text in rows:
        for at in range(0, max(1, len(text) - width + 1), BLOCK):
            keys.append(key)
            texts.append(text[at : at + BLOCK + width - 1])
            places.append(at)
            size += len(texts[-1])
            if size >= BLOCK:
                yield done()
                keys, texts, places, size = [], [], [], 0
    if keys:
        yield done()


#: Bits of the filter of shared anchors. Its size is fixed: with very many anchors it lets more rows pass, and a join still decides.
FILTER_BITS = 1 << 26


def _places_in_filter(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    u = h.view(np.uint64)
    return (u & np.uint64(FILTER_BITS - 1)).astype(np.int64), ((u >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def hash_filter(hashes: DataFrame) -> Broadcast:
    """A Bloom filter of two bits for each hash, as 64-bit words, at most FILTER_BITS / 64 of which come to the driver."""
    bits = F.array(*[F.col("h").bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned("h", 32).bitwiseAND(FILTER_BITS - 1)])
    words = hashes.select(F.explode(bits).alias("b")).select(F.shiftright("b", 6).alias("word"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(table)


def anchors(reps: DataFrame, span: int, known: Broadcast | None = None) -> DataFrame:
    """(h, doc, p) of the anchors of each text of `reps` (doc BIGINT, text); with a filter, of those that it lets pass."""
    width = span - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, on = WindowHasher(width, ANCHOR_SEED), np.zeros(PERIOD, bool)
        on[list(COVER)] = True
        for b in batches:
            rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            for keys, points, ends, places in _groups(rows, width):
                h = hashed(points)
                piece = np.repeat(np.arange(len(keys)), np.diff(ends))[: len(h)]
                local = np.arange(len(h)) - ends[piece]
                p = local + places[piece]
                take = np.flatnonzero(on[p % PERIOD] & (local + width <= np.diff(ends)[piece]))
                if known is not None:
                    first, second = _places_in_filter(h[take])
                    table = known.value
                    take = take[((table[first >> 6] >> (first & 63)) & (table[second >> 6] >> (second & 63)) & 1) == 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[take].view(np.int64)), pa.array(np.array(keys, np.int64)[piece[take]]), pa.array(p[take])], ["h", "doc", "p"]
                )

    return reps.select("doc", "text").mapInArrow(run, "h bigint, doc bigint, p bigint")


def span_windows(found: DataFrame, span: int) -> DataFrame:
    """(h, doc, s) of each window of `span` characters that holds one of the anchors at `places` of its text."""

    def starts(rows: Iterator[tuple]) -> Iterator[tuple[int, str, np.ndarray]]:
        for doc, text, places in rows:
            last = len(text) - span
            lo = np.maximum(0, np.asarray(places) - PERIOD + 1)
            hi = np.minimum(places, last)
            steps = np.zeros(last + 2, np.int32)
            np.add.at(steps, lo[lo <= hi], 1)
            np.add.at(steps, hi[lo <= hi] + 1, -1)
            yield doc, text, np.flatnonzero(np.cumsum(steps)[: last + 1] > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WindowHasher(span, SPAN_SEED)
        for b in batches:
            for doc, text, s in starts(zip(*(c.to_pylist() for c in b.columns), strict=True)):
                points = _points(text)
                for at in range(0, len(text) - span + 1, BLOCK):
                    own = s[(s >= at) & (s < at + BLOCK)]
                    if len(own):
                        h = hashed(points[at : at + BLOCK + span - 1])[own - at]
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(own), doc, np.int64)), pa.array(own)], ["h", "doc", "s"])

    return found.select("doc", "text", "places").mapInArrow(run, "h bigint, doc bigint, s bigint")


def hashes_in_two(rows: DataFrame) -> DataFrame:
    """The hashes that occur in at least two texts. Counted with a combine before the shuffle."""
    return rows.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("h")


def shared_spans(df: DataFrame, key: str, text: str, span: int = 160) -> DataFrame:
    """(key, shared_chars) of each row with a span of at least `span` characters that another row has too.

    Characters are code points; shared_chars counts each character of the text that lies in such a
    span once. Repetition within one text does not count. Null, empty and short texts and rows with
    a null key have no row. `key` is BIGINT and unique; `span` is at least 2 * PERIOD, so that an
    anchor is at least PERIOD + 1 long. Exact copies are whole shared spans of each other: one of
    each group takes part in the search, and all its members get their length.
    """
    if span < 2 * PERIOD:
        raise ValueError(f"span must be at least {2 * PERIOD}")
    docs = df.select(F.col(key).alias("doc"), F.col(text).alias("text")).where((F.char_length("text") >= span) & F.col("doc").isNotNull())
    ensure_checkpoint_dir(df.sparkSession)
    keyed = docs.select("doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"), F.char_length("text").cast("long").alias("n")).checkpoint()
    classes = keyed.groupBy("h1", "h2").agg(F.min("doc").alias("doc"), F.count("*").alias("members"))
    # Here a text stands for all its copies, so that copies share no anchor with each other, and texts are hashed where they are read.
    shared = hashes_in_two(anchors(docs.select(F.xxhash64("text").alias("doc"), "text"), span)).checkpoint()
    located = anchors(docs, span, hash_filter(shared)).join(shared, "h", "left_semi")
    places = located.groupBy("doc").agg(F.collect_list("p").alias("places")).join(classes.select("doc"), "doc").checkpoint()  # used twice: windows are hashed to be counted and to be placed
    found = docs.join(places, "doc")
    w = Window.partitionBy("doc").orderBy("s")
    step = F.least(F.lit(span).cast("long"), F.coalesce(F.lead("s").over(w) - F.col("s"), F.lit(span).cast("long")))
    windows = span_windows(found, span)
    # A passage of very many texts is one hash in each: its side is aggregated, so it needs an exchange of its own to be split.
    partly = windows.join(own_exchange(hashes_in_two(windows)), "h", "left_semi").select("doc", step.alias("step")).groupBy("doc").agg(F.sum("step").alias("shared_chars"))
    single = classes.where("members = 1").select("doc")
    copies = keyed.join(classes.where("members > 1").select("h1", "h2"), ["h1", "h2"], "left_semi").select("doc", F.col("n").alias("shared_chars"))
    return partly.join(single, "doc", "left_semi").unionByName(copies).withColumnRenamed("doc", key)
