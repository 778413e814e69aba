"""Benchmark decontamination with suffix arrays over the training texts.

The documents that a task holds are a shard, taken slice by slice.  For each slice the
positions where a match could start are sorted by the words that follow (a suffix array,
cut at the longest window), and every benchmark window is looked up in it by binary search;
the range found holds all its occurrences.  A position can start a match only if enough
words from it on occur in the benchmark at all, so the arrays stay short.

A window is ``WINDOW`` consecutive words of an item, that is the start of one of its suffixes; an item of fewer
words, but not none, is one window.  Occurrences of an item's windows at consecutive words of a document, in the same order, are
one match: the longest one that the item's suffix has there, with its places in both.  Words inside a match are hit.

The benchmark is sent to the tasks in blocks of about ``BLOCK_BYTES`` of text.  With more than one, the documents are
written once with a row number, and read once for each block; only the rows with matches are kept of each pass
and joined at the end, so any benchmark size gives whole results.

Rows: null and empty texts have no words and no hits.  Items without words have no windows.
The windows of an item whose ``item_id`` is null hit words, but it isn't counted among the
items; rows that share an ``item_id`` are one item.  Repeated documents are judged one by
one.  Further columns of ``docs`` are kept; clashing names raise ``ValueError``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import slices, word_hashes

WINDOW = 10
BLOCK_BYTES = 4 << 20
MATCH = "struct<item:string,item_start:bigint,start:bigint,length:bigint>"
HITS = f"struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>,matches:array<{MATCH}>>"


class Windows:
    """The distinct windows of some items, ready to be looked up."""

    def __init__(self, items: list[tuple[str | None, str]], width: int = WINDOW) -> None:
        parts = [(word_hashes(data, ends)) for data, ends in slices(pa.array([t for _, t in items], pa.string()))]
        words = [h[b[i]:b[i + 1]] for h, b in parts for i in range(len(b) - 1)]
        self.width = width
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.empty(0, np.uint64)
        rows, sizes, owner = [], [], []
        self.item_name = [name for name, _ in items]
        for row, w in enumerate(words):
            if not len(w):
                continue
            ids = (np.searchsorted(self.vocabulary, w) + 1).astype(np.uint32)
            size = min(width, len(ids))
            cut = np.lib.stride_tricks.sliding_window_view(ids, size)
            rows.append(np.pad(cut, ((0, 0), (0, width - size))))
            sizes += [size] * len(cut)
            owner += [(row, q) for q in range(len(cut))]
        table = np.concatenate(rows) if rows else np.empty((0, width), np.uint32)
        self.keys, of = np.unique(self._key(table), return_inverse=True)
        self.size = np.zeros(len(self.keys), np.int64)
        self.size[of] = sizes
        self.least = int(self.size.min()) if len(self.size) else 0
        # past[w]: greater than every suffix that starts with window w
        top = np.zeros((len(self.keys), width), np.uint32)
        top[of] = np.where(np.arange(width) < np.array(sizes)[:, None], table, 0xFFFFFFFF) if rows else top
        self.past = self._key(top)
        # the items, by their row, and their words at which each window starts
        order = np.argsort(of, kind="stable") if rows else np.empty(0, np.int64)
        self.owner = np.array(owner, np.int64).reshape(-1, 2)[order]
        self.owner_from = np.searchsorted(of[order] if rows else order, np.arange(len(self.keys) + 1))

    def _key(self, rows: np.ndarray) -> np.ndarray:
        """Rows of word ids as byte strings that sort as the rows do."""
        return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * self.width}").reshape(-1)

    def suffix_array(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, keys) of the suffixes that can start a window, in the order of their words."""
        if not self.least or not len(words):
            return np.empty(0, np.int64), np.empty(0, f"S{4 * self.width}")
        at = np.searchsorted(self.vocabulary, words)
        at[at == len(self.vocabulary)] = 0
        ids = np.where(self.vocabulary[at] == words, at + 1, 0).astype(np.uint32)
        # words from each position to the next unknown word or the document's end
        place = np.arange(len(ids))
        stop = np.append(np.flatnonzero(ids == 0), len(ids))
        ends = bounds[1:][np.searchsorted(bounds[1:], place, "right")]
        room = np.minimum(stop[np.searchsorted(stop, place, "left")], ends) - place
        start = np.flatnonzero(room >= self.least)
        column = start[:, None] + np.arange(self.width)
        rows = np.where(np.arange(self.width) < room[start][:, None], ids[np.minimum(column, len(ids) - 1)], 0)
        keys = self._key(rows)
        order = np.argsort(keys, kind="stable")
        return start[order], keys[order]

    def find(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence."""
        place, keys = self.suffix_array(words, bounds)
        low, high = np.searchsorted(keys, self.keys, "left"), np.searchsorted(keys, self.past, "right")
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return place[low[window] + nth], window

    def hits(self, data: np.ndarray, ends: np.ndarray) -> list[dict]:
        """For each document: its number of words, hit spans of word numbers, and items."""
        words, bounds = word_hashes(data, ends)
        place, window = self.find(words, bounds)
        out = [{"n_words": int(n), "spans": [], "items": [], "matches": []} for n in np.diff(bounds)]
        doc, start, length, item, item_start = self.matches(place, window, bounds)
        for d, s, n, i, q in zip(doc.tolist(), start.tolist(), length.tolist(), item.tolist(), item_start.tolist(), strict=True):
            out[d]["matches"].append({"item": self.item_name[i], "item_start": q, "start": s, "length": n})
        for d in np.unique(doc).tolist():
            mine = out[d]["matches"]
            out[d]["items"] = sorted({m["item"] for m in mine if m["item"] is not None})
            spans = out[d]["spans"]
            for a, b in sorted({(m["start"], m["start"] + m["length"]) for m in mine}):
                if spans and a <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], b)
                else:
                    spans.append({"start": a, "end": b})
        return out

    def matches(self, place: np.ndarray, window: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start, length, item row, item start) of the longest matches, from the occurrences of windows."""
        count = self.owner_from[window + 1] - self.owner_from[window]
        of = np.repeat(np.arange(len(place)), count)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        item, at = self.owner[self.owner_from[window][of] + nth].T
        place, size = place[of], self.size[window][of]
        doc = np.searchsorted(bounds, place, "right") - 1
        # words in step with the item's lie on one diagonal; a match is a run of consecutive places on it
        order = np.lexsort((place, place - at, item, doc))
        place, size, item, at, doc = (x[order] for x in (place, size, item, at, doc))
        new = np.ones(len(place), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place))[:len(first)] - 1
        return doc[first], place[first] - bounds[doc[first]], place[last] + size[last] - place[first], item[first], at[first]


_ready: dict[str, Windows] = {}


def _windows(key: str, items) -> Windows:  # noqa: ANN001 - a Spark broadcast
    """The windows of a block, made once in a worker."""
    if key not in _ready:
        _ready.clear()
        _ready[key] = Windows(items.value)
    return _ready[key]


def _hits(text: Column, key: str, items) -> Column:  # noqa: ANN001 - a Spark broadcast
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = _windows(key, items)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        match = pa.struct([("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string())), ("matches", pa.list_(match))])
        for batch in batches:
            yield pa.array([x for data, ends in slices(batch) for x in windows.hits(data, ends)], kind)

    return F.arrow_udf(search, HITS)(text)


def _united(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), longer).otherwise(
            F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> list[list[tuple[str | None, str]]]:
    """The benchmark's items in lists of about ``BLOCK_BYTES``, one fetched at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else items
        yield [(r["i"], r["t"]) for r in part.collect()]


def find_benchmark(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text",
                   found: str = "hits") -> DataFrame:
    """``docs`` with a struct of n_words, spans (of word numbers, end exclusive), items and longest matches."""
    if found.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {found} already exists")
    def passed(of: DataFrame, items: list[tuple[str | None, str]]) -> DataFrame:
        return of.withColumn(found, _hits(F.col(text), uuid.uuid4().hex, spark.sparkContext.broadcast(items)))

    parts = blocks(benchmark)
    first, second = next(parts), next(parts, None)
    if second is None:
        return passed(docs, first)
    row = "__row"
    numbered = _kept(spark, docs.withColumn(row, F.monotonically_increasing_id()), "benchmark-docs")
    out = _kept(spark, passed(numbered, first), "benchmark-hits")
    others = [_kept(spark, passed(numbered.select(row, text), items).where(F.size(F.col(found)["spans"]) > 0).select(row, found), "benchmark-hits")
              for items in chain([second], parts)]
    more = reduce(DataFrame.unionByName, others).groupBy(row).agg(*[
        F.flatten(F.collect_list(F.col(found)[x])).alias(f"__{x}") for x in ("spans", "items", "matches")])
    old = F.col(found)
    joined = out.join(more, row, "left")
    both = {x: F.concat(old[x], F.coalesce(F.col(f"__{x}"), F.array().cast(joined.schema[f"__{x}"].dataType))) for x in ("spans", "items", "matches")}
    return joined.withColumn(found, F.struct(
        old["n_words"].alias("n_words"), _united(both["spans"]).alias("spans"),
        F.array_distinct(both["items"]).alias("items"), both["matches"].alias("matches"))).select(*docs.columns, found)


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def longest_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """A row per longest verbatim match: the columns of ``docs`` but its text, item, item_start, start and length (in words)."""
    name = "hits"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    keep = [c for c in docs.columns if c != text]
    clash = {c.lower() for c in keep} & {"item", "item_start", "start", "length"}
    if clash:
        raise ValueError(f"output columns already exist: {sorted(clash)}")
    return find_benchmark(spark, docs, benchmark, text, name).select(*keep, F.inline(F.col(name)["matches"]))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts, digests of the items, and the verdict for every document."""
    found = find_benchmark(spark, docs.select("doc_id", "text"), benchmark).select("doc_id", "hits.*")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0).cast("long")).alias("longest_match"),
    )


def remove_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without hit words; their columns stay."""
    name = "hits"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return find_benchmark(spark, docs, benchmark, found=name).where(F.size(F.col(name)["spans"]) == 0).drop(name)
