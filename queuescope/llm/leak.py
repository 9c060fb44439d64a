"""Evaluation passages inside a corpus of mails.

A passage leaks when ``run`` (12) or more consecutive words of an item stand in
one text part of a mail.  Method: a prefix-filtered set join over windows.
Every item window of ``run`` words is a set of five-word shingles; the shingles
are ordered by rarity in the corpus, counted over all documents.  A window is
contained only if all its shingles are, so its necessary prefix is its single
rarest shingle; only that one is joined.  Documents take part with the runs of
consecutive positions whose shingles all belong to items: a run shorter than a
window is out by length, a window that does not lie inside the run by position.
The rest is verified word by word.

Shingles of no item are dropped where the document is read, by a bit filter with
about 32 bits for each different shingle of the items, so what is shuffled follows
the number of leaks, not the corpus.  Above 2^23 shingles the filter stays at its
largest size (32 MB): more foreign shingles pass, which costs time and never a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuescope.llm.mailtext import parts, without_quote_marks
from queuescope.session import cut, spread

#: Words of a shingle.
SHINGLE = 5
#: Words of the shortest passage that counts.
RUN = 12
#: log2 of the filter's bits, least and most: 8 KB to 32 MB are broadcast.
LEAST_BITS, MOST_BITS = 16, 28
#: Words held at once while a batch of documents is read.
WORDS_AT_ONCE = 200_000

_WORD = re.compile(r"[^\W_]+")
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class _Hashes(dict):
    """Hash of each word seen, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str) -> list[str]:
    """Unbroken runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower())


def shingle_hashes(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash of every ``width`` consecutive word hashes (uint64)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total = total * np.uint64(_BASE) + hashes[i : i + n]
        total ^= total >> np.uint64(29)
        return total * np.uint64(0xBF58476D1CE4E5B9)


def _slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return keys >> np.uint64(64 - bits), (keys >> np.uint64(8)) & np.uint64((1 << bits) - 1)


def item_shingles(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item, key (of id and text), words (array) and shingles (array of bigint) of every different item.

    Repeated rows count once; an id with several texts has a row for each.  Null
    and empty texts have no words.
    """

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashes()
        for batch in batches:
            words = [words_of(said or "") for said in batch.column(2).to_pylist()]
            keys = [shingle_hashes(np.array([hashed[w] for w in ws], np.uint64)).view(np.int64).tolist() for ws in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64()))], names=["item", "key", "words", "shingles"])

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).distinct()
    return rows.select("item", F.xxhash64("item", "text").alias("key"), "text").mapInArrow(build, f"item {kind}, key bigint, words array<string>, shingles array<bigint>")


def filter_bits(n: int) -> int:
    """Bits (log2) of a filter for ``n`` different shingles."""
    return min(MOST_BITS, max(LEAST_BITS, (32 * max(1, n) - 1).bit_length()))


def shingle_filter(shingles: DataFrame, bits: int) -> np.ndarray:
    """The bit filter of a ``shingle`` column: 2^bits bits, put together from one row per used 64-bit word."""
    first, second = F.shiftrightunsigned("shingle", 64 - bits), F.shiftrightunsigned("shingle", 8).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
    slots = shingles.select(F.explode(F.array(first, second)).alias("slot"))
    words = slots.select(F.shiftright("slot", 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(F.lit(63).cast("bigint")).cast("int")).alias("bit"))
    packed = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most 2^(bits-6) rows
    table = np.zeros(1 << (bits - 6), np.int64)
    table[packed["word"].to_numpy(np.int64)] = packed["bits"].to_numpy(np.int64)
    return table.view(np.uint8)


def _runs(texts: list[tuple[int, int, list[str]]], hashed: _Hashes, table: np.ndarray, bits: int, least: int) -> Iterator[tuple]:
    """Rows of (document index, part, first position, words, shingles) for runs, and (-1, 0, 0, [], [shingle, count, ...])."""
    words = [w for _, _, part in texts for w in part]
    sizes = np.array([len(part) for _, _, part in texts], np.int64)
    keys = shingle_hashes(np.fromiter((hashed[w] for w in words), np.uint64, len(words)))
    if not len(keys):
        return
    of = np.repeat(np.arange(len(texts)), sizes)
    one, two = _slots(keys, bits)

    def is_set(slot: np.ndarray) -> np.ndarray:
        return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1

    hit = is_set(one).astype(bool)
    hit[hit] = is_set(two[hit]).astype(bool)
    hit &= of[: len(keys)] == of[SHINGLE - 1 :]
    at = np.flatnonzero(hit)
    if not len(at):
        return
    # document frequency: a shingle counts once per document
    document = np.array([d for d, _, _ in texts], np.int64)[of[at]]
    once = np.unique(np.stack([document, keys[at].view(np.int64)]), axis=1)[1]
    values, counts = np.unique(once, return_counts=True)
    yield -1, 0, 0, [], np.stack([values, counts], axis=1).ravel().tolist()
    edges = np.flatnonzero((np.diff(at) != 1) | (of[at[1:]] != of[at[:-1]])) + 1
    begins = np.cumsum(sizes) - sizes
    for run in np.split(at, edges):
        if len(run) >= least:
            owner = int(of[run[0]])
            first, last = int(run[0]), int(run[-1])
            yield texts[owner][0], texts[owner][1], first - int(begins[owner]), words[first : last + SHINGLE], keys[run].view(np.int64).tolist()


def document_runs(documents: DataFrame, doc_id: str, text: str, table: np.ndarray, bits: int, run: int = RUN) -> DataFrame:
    """One pass over all mails: their runs of item shingles, and the shingles' document counts.

    Columns: doc (null in count rows), part, first, words, shingles; a count row
    holds pairs of shingle and number of documents in ``shingles``.
    """
    shared = documents.sparkSession.sparkContext.broadcast(table)
    least = run - SHINGLE + 1

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashes()
        for batch in batches:
            ids, texts, held, out = batch.column(0), batch.column(1), 0, []
            pending: list[tuple[int, int, list[str]]] = []
            for i in range(batch.num_rows):
                for number, part in enumerate(parts(texts[i].as_py())):
                    words = words_of(without_quote_marks(part.text))
                    if len(words) >= run:
                        pending.append((i, number, words))
                        held += len(words)
                if held >= WORDS_AT_ONCE:
                    out += _runs(pending, hashed, shared.value, bits, least)
                    pending, held = [], 0
            out += _runs(pending, hashed, shared.value, bits, least)
            owner = pa.array([o if o >= 0 else None for o, *_ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(owner), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int32()), pa.array([x[3] for x in out], pa.list_(pa.string())), pa.array([x[4] for x in out], pa.list_(pa.int64()))],
                names=["doc", "part", "first", "words", "shingles"],
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    return documents.select(doc_id, text).mapInArrow(read, f"doc {kind}, part int, first int, words array<string>, shingles array<bigint>")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", run: int = RUN, bits: int | None = None) -> DataFrame:
    """Every mail and the item it gives away: doc, item, ``windows`` (different ones found), ``first`` (word position).

    Rows with a null id, and null or empty texts, give nothing.  Repeated mails
    are each reported; an item's text may stand in any number of mails.
    """
    wanted = cut(item_shingles(items.where(F.col(item_id).isNotNull()), item_id, text))
    tokens = wanted.select("key", F.posexplode("shingles").alias("start", "shingle"))
    different = cut(tokens.select("shingle").distinct())
    bits = filter_bits(different.count()) if bits is None else bits
    table = shingle_filter(different, bits)
    seen = cut(document_runs(spread(documents.where(F.col(doc_id).isNotNull()).select(doc_id, text)), doc_id, text, table, bits, run))
    pairs = F.filter(F.sequence(F.lit(0), F.size("shingles") - 1), lambda i: i % 2 == 0)
    counted = seen.where(F.col("doc").isNull()).select(F.explode(F.transform(pairs, lambda i: F.struct(F.get("shingles", i).alias("shingle"), F.get("shingles", i + 1).alias("n")))).alias("c"))
    frequency = counted.groupBy(F.col("c.shingle").alias("shingle")).agg(F.sum("c.n").alias("documents"))
    # the window of words that begins at a shingle holds that one and the next run - SHINGLE; a shingle of no document rules it out
    size = run - SHINGLE + 1
    ahead = Window.partitionBy("key").orderBy("start").rowsBetween(0, size - 1)
    ranked = tokens.join(frequency, "shingle", "left").select(
        "key", "start", F.min(F.struct("documents", F.col("start").alias("at"), "shingle")).over(ahead).alias("rarest"), F.count("documents").over(ahead).alias("present")
    )
    prefixes = ranked.where(F.col("present") == size).select("key", "start", (F.col("rarest.at") - F.col("start")).alias("offset"), "rarest.shingle")
    found = seen.where(F.col("doc").isNotNull())
    # a position carries the words of the windows that may hold it, so a long run costs its length and no more
    around = F.transform(F.col("shingles"), lambda key, at: F.struct(at.alias("at"), key.alias("shingle"), F.slice("words", F.greatest(at - (size - 1), F.lit(0)) + 1, F.lit(size - 1 + run)).alias("said")))
    positions = found.select("doc", "part", "first", F.size("shingles").alias("n"), F.inline(around))
    begin = F.col("at") - F.col("offset")
    candidates = positions.join(prefixes, "shingle").where((begin >= 0) & (begin + size <= F.col("n")))
    inside = begin - F.greatest(F.col("at") - (size - 1), F.lit(0))
    verified = candidates.join(wanted.select("item", "key", "words"), "key").where(F.slice("said", inside + 1, F.lit(run)) == F.slice("words", F.col("start") + 1, F.lit(run)))
    return verified.groupBy("doc", "item").agg(F.count_distinct("key", "start").alias("windows"), F.min(F.col("first") + begin).alias("first"))
