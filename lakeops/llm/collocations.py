"""Phrases that occur together: frequent word sequences, counted by tiles of frequency-ranked ids.

Units are words at first. Adjacent pairs of units are counted, the frequent ones become the
units of the next length (two overlapping phrases of k words make one of k + 1), and so on.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import blocks, map_slices, numbered, slices
from lakeops.workspace import stored

#: What words are made of: A-Z becomes small, a tab a space, and a sign that ends a piece the
#: byte 255, which no text in UTF-8 holds.
_END = b"\xff"
_FOLD = bytes(
    255 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
#: Bytes of a text whose words are held at once.
BLOCK = 1 << 20
#: Different words, and bytes of text, that a task counts before it passes counts on.
WORDS, BYTES = 300_000, 64 << 20
#: Adjacent pairs that a task holds before it counts them.
PAIRS = 1 << 22
#: Side of a tile, tiles of a side that may be dense, and pairs that make a tile worth an array.
TILE, TILES, DENSE = 1024, 64, 1 << 17
#: Entries, and bytes of words, of a dictionary that every worker may hold; beyond, ids are joined.
HELD_WORDS, HELD_BYTES, HELD_PAIRS = 1 << 20, 32 << 20, 1 << 21


def pieces(text: bytes):
    """Lists of the words of a text, in blocks; ``_END`` stands where a piece ends."""
    for block in blocks(text.translate(_FOLD), BLOCK, b" "):
        yield block.replace(_END, b" \xff ").split()


def _chosen(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
        docs[text_col].cast("binary").alias("text"),
    )


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, word, n of all texts; added up in each task before the shuffle."""

    def run(batches):
        counts: dict[str, Counter] = {}
        seen = 0

        def flush():
            for lang, found in counts.items():
                found.pop(_END, None)
                n = len(found)
                yield pa.record_batch(
                    [pa.array([lang] * n, pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                    ["lang", "word", "n"],
                )
            counts.clear()

        for batch in batches:
            for piece in slices(batch, "text"):
                for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text")):
                    for words in pieces(text.as_py() or b""):
                        counts.setdefault(lang, Counter()).update(words)
                        seen += min(BLOCK, len(text.as_py()))
                        if seen > BYTES or sum(map(len, counts.values())) > WORDS:
                            yield from flush()
                            seen = 0
        yield from flush()

    found = _chosen(docs, text_col, lang_col).mapInArrow(run, "lang string, word binary, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _ids(batch: pa.RecordBatch, found: list[np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x.tobytes() for x in found], pa.binary())], ["ids"])


def _held(df: DataFrame, rows: int, size: Column | None = None, most: int = 0) -> bool:
    """The dictionary is small enough to be sent to every worker."""
    total = df.agg(F.count("*"), F.sum(size) if size is not None else F.lit(0)).first()
    return total[0] <= rows and (total[1] or 0) <= most


def word_stream(docs: DataFrame, words: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """ids of each text: the number of each word in ``words`` (lang, word, id), -1 for others and
    where a piece ends; 32 bits each. Texts without words of the dictionary may be left out.
    """
    chosen = _chosen(docs, text_col, lang_col)
    if not _held(words, HELD_WORDS, F.length("word"), HELD_BYTES):
        return _joined_words(chosen, words)
    known: dict[str, dict[bytes, int]] = {}
    table = words.select("lang", "word", "id").toArrow()  # at most HELD_WORDS rows of HELD_BYTES
    for lang, word, i in zip(*(table.column(c).to_pylist() for c in ("lang", "word", "id"))):
        known.setdefault(lang, {})[word] = i
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def make():
        all_ = sent.value

        def coded(lang, text):
            get = all_.get(lang, {}).get
            parts = [np.fromiter((get(w, -1) for w in words), np.int32, len(words)) for words in pieces(text)]
            return np.concatenate(parts) if parts else np.zeros(0, np.int32)

        def work(batch):
            rows = zip(batch.column("lang").to_pylist(), batch.column("text"))
            return _ids(batch, [coded(lang, text.as_py() or b"") for lang, text in rows])

        return work

    return map_slices(chosen, "text", make, "ids binary")


def _joined_words(chosen: DataFrame, words: DataFrame) -> DataFrame:
    """``word_stream`` by a join: the places of all words, and of those with an id, by text."""
    named = stored(chosen.withColumn("row", F.monotonically_increasing_id()), "texts")

    def places(batches):
        for batch in batches:
            for row, lang, text in zip(batch.column("row").to_pylist(), batch.column("lang").to_pylist(), batch.column("text")):
                at = 0
                for found in pieces(text.as_py() or b""):
                    n = len(found)
                    yield pa.record_batch(
                        [pa.array([row] * n, pa.int64()), pa.array([lang] * n, pa.string()), pa.array(np.arange(at, at + n)), pa.array(found, pa.binary())],
                        ["row", "lang", "at", "word"],
                    )
                    at += n

    spread = named.select("row", "lang", "text").mapInArrow(places, "row bigint, lang string, at bigint, word binary")
    return _gathered(spread.join(words.select("lang", "word", "id"), ["lang", "word"]))


def _gathered(hits: DataFrame) -> DataFrame:
    """The streams of (row, at, id): ids at their places, -1 elsewhere."""

    def build(rows):
        at = rows.column("at").to_numpy()
        out = np.full(int(at.max()) + 1, -1, np.int32)
        out[at] = rows.column("id").to_numpy()
        return pa.table({"ids": pa.array([out.tobytes()], pa.binary())})

    return hits.select("row", "at", F.col("id").cast("int").alias("id")).groupBy("row").applyInArrow(build, "ids binary")


def _line(batch: pa.RecordBatch) -> np.ndarray:
    """The streams of a batch in one array, -1 between two."""
    gap = np.array([-1], np.int32).tobytes()
    return np.frombuffer(gap.join(batch.column("ids").to_pylist()), np.int32)


def tile_counts(x: np.ndarray, y: np.ndarray):
    """Arrays (x, y, n) of the different pairs and how often each occurs.

    Ids are ranked by frequency, so frequent pairs meet in the first tiles of TILE x TILE ids:
    a tile with many pairs is counted in an array with a place for each. The others are
    sorted, and runs of equal pairs are counted.
    """
    sparse = np.ones(len(x), bool)
    tile_x, tile_y = x // TILE, y // TILE
    near = (tile_x < TILES) & (tile_y < TILES)
    tile = np.where(near, tile_x * TILES + tile_y, TILES * TILES)
    for t in np.flatnonzero(np.bincount(tile, minlength=TILES * TILES)[: TILES * TILES] >= DENSE):
        here = tile == t
        base_x, base_y = t // TILES * TILE, t % TILES * TILE
        cells = np.bincount((x[here] - base_x) * TILE + (y[here] - base_y), minlength=TILE * TILE)
        held = np.flatnonzero(cells)
        yield held // TILE + base_x, held % TILE + base_y, cells[held]
        sparse &= ~here
    keys = np.sort(x[sparse].astype(np.int64) << 32 | y[sparse])
    if len(keys):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        yield keys[starts] >> 32, keys[starts] & 0xFFFFFFFF, np.diff(np.r_[starts, len(keys)])


def pair_counts(stream: DataFrame) -> DataFrame:
    """x, y, n of all adjacent units, counted by tiles in each task and added up by Spark."""

    def run(batches):
        held, size = [], 0

        def flush():
            x, y = (np.concatenate(parts) for parts in zip(*held))
            for a, b, n in tile_counts(x, y):
                yield pa.record_batch(
                    [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n.astype(np.int64))], ["x", "y", "n"]
                )

        for batch in batches:
            for piece in slices(batch, "ids"):
                line = _line(piece)
                both = (line[:-1] >= 0) & (line[1:] >= 0)
                held.append((line[:-1][both], line[1:][both]))
                size += len(held[-1][0])
                if size >= PAIRS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    found = stream.mapInArrow(run, "x int, y int, n bigint")
    return found.groupBy("x", "y").agg(F.sum("n").alias("n"))


def pair_stream(stream: DataFrame, units: DataFrame) -> DataFrame:
    """The stream of the next length: at each place the id of the pair that starts there, or -1."""
    if not _held(units, HELD_PAIRS):
        return _joined_pairs(stream, units)
    table = units.select((F.col("x").cast("long") * (1 << 32) + F.col("y")).alias("key"), "id").toArrow()
    keys, ids = (table.column(c).to_numpy() for c in ("key", "id"))
    order = np.argsort(keys)
    sent = stream.sparkSession.sparkContext.broadcast((keys[order], ids[order].astype(np.int32)))

    def make():
        known, number = sent.value

        def coded(data):
            line = np.frombuffer(data, np.int32)
            out = np.full(max(len(line) - 1, 0), -1, np.int32)
            both = np.flatnonzero((line[:-1] >= 0) & (line[1:] >= 0))
            if len(both) and len(known):
                key = line[both].astype(np.int64) << 32 | line[both + 1]
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                out[both] = np.where(known[at] == key, number[at], -1)
            return out

        return lambda batch: _ids(batch, [coded(x) for x in batch.column("ids").to_pylist()])

    return map_slices(stream, "ids", make, "ids binary")


def _joined_pairs(stream: DataFrame, units: DataFrame) -> DataFrame:
    """``pair_stream`` by a join of all places with the pairs that have an id."""
    named = stored(stream.withColumn("row", F.monotonically_increasing_id()), "streams")

    def places(batches):
        for batch in batches:
            for row, data in zip(batch.column("row").to_pylist(), batch.column("ids").to_pylist()):
                line = np.frombuffer(data, np.int32)
                at = np.flatnonzero((line[:-1] >= 0) & (line[1:] >= 0))
                for some in np.split(at, range(PAIRS, len(at), PAIRS)):
                    yield pa.record_batch(
                        [pa.array(np.full(len(some), row)), pa.array(some), pa.array(line[some]), pa.array(line[some + 1])],
                        ["row", "at", "x", "y"],
                    )

    spread = named.select("row", "ids").mapInArrow(places, "row bigint, at bigint, x int, y int")
    return _gathered(spread.join(units.select("x", "y", "id"), ["x", "y"]))


def longer(units: DataFrame, shorter: DataFrame) -> DataFrame:
    """``units`` (id, x, y, a) with what they take from the two shorter phrases they join.

    ``heads`` are the counts of the first 1, 2, .. words, ``tails`` of the last 1, 2, ..
    """
    first = shorter.select(F.col("id").alias("x"), "lang", "phrase", "heads", F.col("a").alias("a_x"))
    second = shorter.select(F.col("id").alias("y"), "last", "tails", F.col("a").alias("a_y"))
    return units.join(first, "x").join(second, "y").select(
        "id", "x", "y", "a", "lang",
        F.concat("phrase", F.lit(" ").cast("binary"), "last").alias("phrase"), "last",
        F.concat("heads", F.array("a_x")).alias("heads"),
        F.concat("tails", F.array("a_y")).alias("tails"),
    )


def best_cut(scale: int) -> Column:
    """(score, k, l, r) of the cut with the lowest score, the first of equal ones.

    l and r are the counts of the first k words and of the rest; the score is the whole part
    of scale * a / (l + r). Products have up to 31 digits.
    """
    part, rest = "heads[k - 1]", "tails[size(tails) - k]"
    score = f"CAST(a AS DECIMAL(20,0)) * {scale} DIV (CAST({part} AS DECIMAL(20,0)) + {rest})"
    each = f"struct({score} AS score, k AS k, {part} AS l, {rest} AS r)"
    return F.array_min(F.expr(f"transform(sequence(1, size(heads)), k -> {each})"))


def collocations(
    docs: DataFrame,
    least: int = 30,
    most_words: int = 4,
    share: int = 80,
    top: int = 2000,
    scale: int = 2_000_000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to ``most_words`` words.

    Texts are cut at ``.,;:!?`` and line ends; phrases lie within a piece, and every
    occurrence counts. A phrase of ``least`` occurrences or more is scored by its worst cut,
    see ``best_cut``; it is left out if a longer one that holds it has ``share`` % of its
    occurrences. Only the next longer ones need be asked, as counts fall with length. Each
    language keeps its ``top`` best: by score, count, phrase. NULL languages are ``und``.

    NULL and empty texts have no words. Repeated rows count each. Without frequent phrases
    there are no rows. A text is read in blocks; a task holds the ids (4 bytes a word) of a
    long text at once, less than the text itself.
    """
    counts = stored(word_counts(docs, text_col, lang_col), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = numbered(counts.filter(F.col("n") >= least), [F.desc("n"), F.asc("lang"), F.asc("word")], "id")
    words = stored(words, "units")
    stream = stored(word_stream(docs, words, text_col, lang_col), "stream")
    none = F.array().cast("array<bigint>")
    shorter = words.select("id", "lang", F.col("n").alias("a"), F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("heads"), none.alias("tails"))
    levels = []
    for length in range(2, most_words + 1):
        frequent = pair_counts(stream).filter(F.col("n") >= least).withColumnRenamed("n", "a")
        units = stored(numbered(frequent, [F.desc("a"), F.asc("x"), F.asc("y")], "id"), "units")
        phrases = stored(longer(units, shorter), "phrases")
        levels.append(phrases)
        shorter = phrases
        if length < most_words:
            stream = stored(pair_stream(stream, units), "stream")
    kept = [_outlasting(now, after, share, scale) for now, after in zip(levels, [*levels[1:], None])]
    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score",
    )


def _outlasting(phrases: DataFrame, next_: DataFrame | None, share: int, scale: int) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that no longer one (``next_``) replaces."""
    if next_ is not None:
        inside = next_.select(F.explode(F.array("x", "y")).alias("id"), F.col("a").alias("_longer"))
        inside = inside.groupBy("id").agg(F.max("_longer").alias("_longer"))
        far = F.col("_longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
        phrases = phrases.join(inside, "id", "left").filter(~F.coalesce(far, F.lit(False)))
    best = F.col("best")
    return phrases.withColumn("best", best_cut(scale)).select(
        "lang", "phrase", "a", best["l"].alias("l"), best["r"].alias("r"), best["score"].alias("score")
    )
