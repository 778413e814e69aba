"""Near-duplicate classes: BagMinHash signatures, bands, and exact multiset overlap.

A document is the multiset of its five-word shingles.  Its signature has ``REGISTERS``
registers; two documents agree in a register with the probability of their weighted
Jaccard similarity (sum of the smaller counts over sum of the larger ones).  ``BANDS``
bands of ``REGISTERS / BANDS`` registers propose pairs; every pair that counts as a link
has an exact similarity of at least ``THRESHOLD``.  A class is a connected component of links.

A bucket is never expanded into its pairs.  Its members are first compared with one
leader, the one that shares the most buckets with others; a bucket whose members then are in
one class is done.  In the others, members of different classes meet in cells of bounded size, are compared by their
signatures and then exactly in the same task, and only links that join two classes leave it: fewer than the cells have
members.  So all pairs that share a bucket are decided, whatever the bucket's size.

Rows: null and empty texts, and texts without words, have no shingles and form classes of
their own.  Equal texts are one node, so groups of copies cost no pairs.  Rows with a null
``doc_id`` take no part: their class is null.  Of rows that share a ``doc_id`` each
has the class of its own text; an id's links are those of any text that it is the smallest id of.
Further columns are not read.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .words import U, mix, shingles, slices, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS     # at similarity 0.8 a pair is missed with probability 7e-6
SIGNS = 0.68                 # share of equal registers below which a pair isn't verified (3.7 deviations)
MARKS, PAGE = 1 << 23, 1 << 12   # bits of the mark table that thins texts before their join, and of its pages
WIDE = 4                     # files for each core of tables that are large or costly to make
SIGNED_BYTES = 1 << 19       # text whose signatures are made at once: about a hundred times as much memory
BLOCK = 256                  # members of a bucket, or bags, that are compared at once


def bag_minhash(docs: np.ndarray, hashes: np.ndarray, n_docs: int, m: int = REGISTERS) -> np.ndarray:
    """Signatures (n_docs x m) of the multisets {hashes[docs == d]}; zeros for empty ones.

    Each element has a Poisson process over (time, weight); its weight axis is cut at
    powers of two, and the piece (2^(k-1), 2^k] has the rate of its length.  A point counts
    if its level is within the element's count, so that larger counts see the points of
    smaller ones too.  Each point goes to one register, which keeps the earliest.
    """
    sig = np.zeros((n_docs, m), U)
    if not len(hashes):
        return sig
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])]))
    count = np.diff(np.append(first, len(docs)))
    docs, hashes = docs[first], hashes[first]
    total = np.bincount(docs, count, n_docs)
    # one process for each element and piece of the weight axis
    pieces = 1 + np.ceil(np.log2(count)).astype(np.int64)
    of = np.repeat(np.arange(len(docs)), pieces)
    k = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.where(k == 0, 0, 1 << np.maximum(k - 1, 0))
    span = np.maximum(low, 1)
    doc, count, seed = docs[of], count[of], mix(hashes[of] + k.astype(U) * U(0xD6E8FEB86659FD93))
    horizon = np.where(total > 0, m / np.maximum(total, 1) * (np.log(m) + 3), 0)
    todo = total > 0
    while todo.any():
        mine = np.flatnonzero(todo[doc])
        _fill(sig, doc[mine], count[mine], low[mine], span[mine], seed[mine], np.where(todo, horizon, 0), m)
        todo &= (sig == 0).any(axis=1)
        sig[todo] = 0
        horizon = horizon * 2
    return sig


def _fill(sig: np.ndarray, doc: np.ndarray, count: np.ndarray, low: np.ndarray, span: np.ndarray,
          seed: np.ndarray, horizon: np.ndarray, m: int) -> None:
    """Earliest point of each register up to each document's horizon."""
    best = np.full(sig.size, np.inf)
    flat = sig.reshape(-1)
    time, done, width = np.zeros(len(doc)), 0, 1
    while len(doc):
        j = np.arange(done + 1, done + width + 1, dtype=U)
        r = mix(seed[:, None] + j[None, :] * U(0x9E3779B97F4A7C15))
        wait = -np.log(((r >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / span[:, None]
        at = np.cumsum(np.concatenate([time[:, None], wait], axis=1), axis=1)[:, 1:]
        draw = mix(r + U(0xA0761D6478BD642F))
        level = low[:, None] + 1 + (((draw & U(0xFFFFFFFF)) * span[:, None].astype(U)) >> U(32)).astype(np.int64)
        row, col = np.nonzero((at < horizon[doc][:, None]) & (level <= count[:, None]))
        slot = doc[row] * m + (((draw[row, col] >> U(32)) * U(m)) >> U(32)).astype(np.int64)
        when = at[row, col]
        np.minimum.at(best, slot, when)
        won = when == best[slot]
        flat[slot[won]] = draw[row, col][won] | U(1)
        time, done = at[:, -1], done + width
        on = time < horizon[doc]
        doc, count, low, span, seed, time = (x[on] for x in (doc, count, low, span, seed, time))
        width = min(width * 2, 256)


def _sign_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        words, bands, signs = [], [], []
        for data, ends in slices(batch, SIGNED_BYTES):
            hashes, bounds = word_hashes(data, ends)
            sig = bag_minhash(*shingles(hashes, bounds, SHINGLE), len(ends))
            words.append(np.diff(bounds))
            band = np.zeros((len(ends), BANDS), U)
            for r in range(ROWS):
                band = mix(band + sig[:, r::ROWS])
            bands.append(mix(band + np.arange(BANDS, dtype=U)))
            # a draw's top bits chose its register, so those of unequal registers are often equal: scatter them first
            signs.append((mix(sig) >> U(48)).astype(np.uint16))
        n = np.concatenate(words) if words else np.empty(0, np.int64)
        flat = np.concatenate(bands) if bands else np.empty((0, BANDS), U)
        band_lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(flat.reshape(-1).view(np.int64)))
        packed = pa.array([x.tobytes() for s in signs for x in s], pa.binary())
        yield pa.StructArray.from_arrays([pa.array(n), band_lists, packed], ["n_words", "bands", "signs"])


def _bag_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Sorted hashes of the shingles, each with its running number among equal ones: a set."""
    for batch in batches:
        out: list[bytes] = []
        for data, ends in slices(batch, SIGNED_BYTES):
            docs, hashes = shingles(*word_hashes(data, ends), SHINGLE)
            order = np.lexsort((hashes, docs))
            docs, hashes = docs[order], hashes[order]
            new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])])[:len(docs)]
            first = np.flatnonzero(new)
            nth = np.arange(len(docs)) - np.repeat(first, np.diff(np.append(first, len(docs))))
            hashes = np.where(nth > 0, mix(hashes + nth.astype(U) * U(0xE7037ED1A0B428DB)), hashes)
            order = np.lexsort((hashes, docs))
            hashes = hashes[order]
            cut = np.searchsorted(docs, np.arange(len(ends) + 1))
            out += [hashes[cut[i]:cut[i + 1]].tobytes() for i in range(len(ends))]
        yield pa.array(out, pa.binary())


def _similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def _compared(pairs: pd.DataFrame, bags: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one group with their similarity; an id with several bags has its best."""
    held: dict[int, list[np.ndarray]] = {}
    for i, bag in zip(bags["id"], bags["bag"], strict=True):
        held.setdefault(i, []).append(np.frombuffer(bag, U))
    near = [max(_similarity(x, y) for x in held[a] for y in held[b]) for a, b in zip(pairs["a"], pairs["b"], strict=True)]
    return pairs[["a", "b"]].assign(similarity=np.array(near, float))


def _signature(text: Column) -> Column:
    return F.arrow_udf(_sign_batches, "struct<n_words:bigint,bands:array<bigint>,signs:binary>")(text)


def _bag(text: Column) -> Column:
    return F.arrow_udf(_bag_batches, "binary")(text)


def _kept(spark: SparkSession, df: DataFrame, name: str, per_core: int = 1) -> DataFrame:
    """Cut the lineage: a table in the shared folder, of at most ``per_core`` files for each core.

    A session's width may be far beyond what these tables need, and each file costs an executor a process that sets its mode.
    Tables of ids have a file for each core; those whose rows are costly to make, or large, ``WIDE``.
    """
    path = scratch_path(spark, name)
    df.coalesce(per_core * spark.sparkContext.defaultParallelism).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _thinned(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``id`` hashes to a set bit of a table of ``MARKS`` bits; all of ``ids`` set theirs, few others are
    let through by chance.  The table is sent as pages of ``PAGE`` bits: 1 MB, whatever the number of ids."""
    at = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    page, bit = F.floor(at / PAGE), F.pmod(at, F.lit(PAGE))
    pages = (ids.select(page.alias("__page"), bit.alias("__bit")).groupBy("__page")
             .agg(F.substring(F.bitmap_construct_agg("__bit"), 1, PAGE // 8).alias("__bits")))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))) % 2 == 1
    return rows.join(F.broadcast(pages), (page == F.col("__page")) & is_set).select(*rows.columns)


def _verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs with their similarity.

    pairs: a, b and x, y, the group in which a pair is verified.  A text's bag goes to each of
    its groups once, not to each of its pairs.  Texts that no pair needs are left out by a
    table of marks before the join moves any.
    """
    ends = pairs.select("x", "y", F.col("a").alias("id")).union(pairs.select("x", "y", F.col("b").alias("id")))
    used = _kept(spark, ends.distinct(), "near-used")
    needed = used.select("id").distinct()
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    texts = _thinned(texts, needed).join(needed, "id", "left_semi")
    bags = _kept(spark, texts.select("id", _bag(F.col("text")).alias("bag")), "near-bags", WIDE)
    found = (pairs.groupBy("x", "y").cogroup(used.join(bags, "id").groupBy("x", "y"))
             .applyInPandas(_compared, "a bigint, b bigint, similarity double"))
    return _kept(spark, found, "near-compared", WIDE)


def _links(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("similarity") >= THRESHOLD - 1e-12).select("a", "b")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, root) of every end of an edge (a, b); root is the smallest id of its component.

    In each round a node hangs on the node of its neighbourhood that comes first in an
    order drawn by hashing for this round, and edges are replaced by edges between those
    nodes.  Components shrink by a constant share a round in expectation, long chains too.
    """
    edges = _kept(spark, edges.where("a <> b").distinct(), "near-edges")
    trees: list[DataFrame] = []
    while not edges.isEmpty():
        drawn = lambda c: F.struct(F.xxhash64(c, F.lit(len(trees))).alias("h"), F.col(c).alias("v"))
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = near.groupBy("a").agg(F.min(drawn("b")).alias("first"))
        tree = _kept(spark, hung.select(F.col("a").alias("id"), F.least("first", drawn("a"))["v"].alias("root")),
                     "near-tree")
        trees.append(tree)
        left, right = (tree.select(F.col("id").alias(x), F.col("root").alias(y)) for x, y in (("a", "p"), ("b", "q")))
        lifted = edges.join(left, "a").join(right, "b").where("p <> q")
        edges = _kept(spark, lifted.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(),
                      "near-edges")
    if not trees:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = trees[0]
    for tree in trees[1:]:
        above = tree.select(F.col("id").alias("root"), F.col("root").alias("above"))
        found = found.join(above, "root", "left").select("id", F.coalesce("above", "root").alias("root"))
    found = _kept(spark, found, "near-found")
    least = found.groupBy("root").agg(F.min("id").alias("least"))
    return _kept(spark, found.join(least, "root").select("id", F.col("least").alias("root")), "near-roots")


def _across(spark: SparkSession, members: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that join the classes of members of one bucket: a spanning forest of those found in each task.

    members: bucket, id, content, root, n_words, signs.  A text's home is the largest bucket of any text that shares one
    with it, so that the texts of one group have one home, whichever of its buckets they are in.  It lives in a cell, a share of
    about ``BLOCK`` texts of that home; those of the home's largest class have cells of their own.  Cells that share a bucket meet in a
    task, unless both hold one class only and the same, and texts of different classes are compared there, by signatures and
    then by their bags.  A text's bag goes to each of its tasks once; no pair leaves a task but those that join two classes.
    """
    sized = members.join(members.groupBy("bucket").agg(F.count("*").alias("n")), "bucket")
    largest = sized.groupBy("id").agg(F.max(F.struct("n", "bucket")).alias("largest"))
    capital = members.select("bucket", "id").join(largest, "id").groupBy("bucket").agg(F.max("largest").alias("capital"))
    home = members.join(capital, "bucket").groupBy("id").agg(F.max("capital")["bucket"].alias("home"), F.min("root").alias("root"))
    most = home.groupBy("home", "root").agg(F.count("*").alias("n")).groupBy("home").agg(
        F.max(F.struct("n", "root"))["root"].alias("main"))
    homed = home.join(most, "home").withColumn("is_main", F.col("root") == F.col("main")).drop("main")
    parts = homed.groupBy("home", "is_main").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    cells = _kept(spark, homed.join(parts, ["home", "is_main"]).select("id", "root", F.xxhash64(
        "home", "is_main", F.pmod(F.xxhash64("id"), "parts")).alias("cell")), "near-cells")
    classes = cells.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    meets = members.select("bucket", "id").join(cells.select("id", "cell"), "id").select("bucket", "cell").distinct().join(classes, "cell")
    left, right = (meets.select("bucket", *[F.col(c).alias(f"{c}_{s}") for c in ("cell", "low", "high")]) for s in "xy")
    one_class = (F.col("low_x") == F.col("high_x")) & (F.col("low_y") == F.col("high_y")) & (F.col("low_x") == F.col("low_y"))
    tasks = _kept(spark, left.join(right, "bucket").where((F.col("cell_x") <= F.col("cell_y")) & ~one_class)
                  .select(F.col("cell_x").alias("x"), F.col("cell_y").alias("y")).distinct(), "near-tasks")
    needed = _kept(spark, members.select("id", "content", "n_words", "signs").distinct(), "near-entries", WIDE)
    texts = _thinned(docs.select(F.col("doc_id").alias("id"), "text"), needed.select("id").distinct())
    texts = texts.withColumn("content", F.unhex(F.sha2("text", 256))).join(needed.select("id", "content"), ["id", "content"], "left_semi")
    bags = texts.dropDuplicates(["id", "content"]).select("id", "content", _bag(F.col("text")).alias("bag"))
    entries = _kept(spark, needed.join(bags, ["id", "content"]).join(cells, "id").drop("content"), "near-members", WIDE)
    dealt = tasks.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("cell")).join(entries, "cell")
    return _kept(spark, dealt.groupBy("x", "y").applyInPandas(_forest, "a bigint, b bigint"), "near-forest", WIDE)


def _forest(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Links between texts of two cells, or of one, that join classes which no other link of this task joins."""
    ids, roots, n, cell = (part[c].to_numpy() for c in ("id", "root", "n_words", "cell"))
    signs = np.stack([np.frombuffer(x, np.uint16) for x in part["signs"]])
    bags = [np.frombuffer(x, U) for x in part["bag"]]
    left, right = np.flatnonzero(cell == key[0]), np.flatnonzero(cell == key[1])
    numbers, of = np.unique(roots, return_inverse=True)
    group = np.arange(len(numbers))                      # the joined class of each class
    links: list[tuple[int, int]] = []
    for row in left:
        # of two texts of n and m words, a similarity of THRESHOLD needs n - 4 >= THRESHOLD * (m - 4)
        less, more = np.minimum(n[row], n[right]), np.maximum(n[row], n[right])
        some = right[(group[of[right]] != group[of[row]]) & (less >= THRESHOLD * more - SHINGLE)]
        same = signs[some] == signs[row]
        some = some[(same.mean(axis=1) >= SIGNS) & same.reshape(-1, BANDS, ROWS).all(axis=2).any(axis=1)]
        for at in some[_similarities(bags[row], [bags[i] for i in some]) >= THRESHOLD - 1e-12] if len(some) else some:
            mine, other = group[of[row]], group[of[at]]
            if mine != other:
                group[group == other] = mine
                links.append((int(ids[row]), int(ids[at])))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _similarities(bag: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Weighted Jaccard similarity of a bag with each of some others."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(bag, flat), len(bag) - 1)
    both = np.bincount(np.repeat(np.arange(len(sizes)), sizes), bag[at] == flat, len(sizes))
    return both / (len(bag) + sizes - both)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): class_id is the smallest doc_id of the document's class."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    without = docs.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return _classes(docs.where("doc_id IS NOT NULL")).drop("content").union(without)


def _classes(known: DataFrame) -> DataFrame:
    """(doc_id, content, class_id) of rows that have an id; content is the SHA-256 of the text."""
    spark = known.sparkSession
    found = _signature(F.col("text"))
    signed = _kept(spark, known.select("doc_id", F.unhex(F.sha2("text", 256)).alias("content"), found.alias("s"))
                   .select("doc_id", "content", "s.*"), "near-signed", WIDE)
    worded = signed.where("n_words > 0")
    copies = worded.groupBy("content").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    # texts without copies need no representative but themselves
    same = _kept(spark, copies.where("n > 1").select("content", F.col("id").alias("first")), "near-copies")
    nodes = _kept(spark, signed.select("doc_id", "content").join(same, "content", "left").select(
        "doc_id", "content", F.coalesce("first", "doc_id").alias("id")), "near-nodes")
    copied = nodes.where("doc_id <> id").select("doc_id", "content")
    own = worded.join(copied, ["doc_id", "content"], "left_anti").withColumnRenamed("doc_id", "id")
    in_bucket = own.select("id", F.posexplode("bands").alias("band", "bucket"))
    sizes = in_bucket.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = _kept(spark, in_bucket.join(sizes, "bucket"), "near-shared", WIDE)
    central = shared.groupBy("id").agg(F.sum("n").alias("score"))
    ranked = _kept(spark, shared.join(central, "id").groupBy("bucket").agg(
        F.max(F.struct("score", "id"))["id"].alias("leader")), "near-leaders")
    stars = _kept(spark, shared.join(ranked, "bucket").where("id <> leader").select(
        F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "near-stars")
    rays = stars.groupBy(F.col("a").alias("x")).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    grouped = stars.join(rays, F.col("a") == F.col("x")).select(
        "a", "b", "x", F.pmod(F.xxhash64("b"), "parts").alias("y"))
    links = _links(_verified(spark, grouped, known))
    roots = components(spark, links)

    rooted = shared.join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    members = _kept(spark, rooted.join(mixed.select("bucket"), "bucket", "left_semi")
                    .join(own.select("id", "content", "n_words", "signs"), "id"), "near-mixed", WIDE)
    if not members.isEmpty():
        more = _across(spark, members, known)
        if not more.isEmpty():
            roots = components(spark, links.union(more))
    return nodes.join(roots, "id", "left").select("doc_id", "content", F.coalesce("root", "id").alias("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that follow another of their class; columns stay.

    Rows that repeat an id and its text, or a text without an id, leave one row too: the first by a hash of its columns.
    Texts without words are classes of their own, and of an id with several texts each is judged by itself.
    """
    text = F.unhex(F.sha2("text", 256))
    held = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__content": text})
    known = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    follow = _classes(known).where("doc_id <> class_id").select(
        F.col("doc_id").alias("__id"), F.col("content").alias("__content")).distinct()
    kept = held.join(follow, ["__id", "__content"], "left_anti")
    again = held.groupBy("__id", "__content").count().where("count > 1").select(F.col("__id").alias("__i"), F.col("__content").alias("__c"))
    repeated = F.col("__id").eqNullSafe(F.col("__i")) & F.col("__content").eqNullSafe(F.col("__c"))
    plain = [f.name for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    first = Window.partitionBy("__id", "__content").orderBy(F.xxhash64(*plain))
    once = kept.join(again, repeated, "left_semi").withColumn("__nth", F.row_number().over(first)).where("__nth = 1")
    return kept.join(again, repeated, "left_anti").select(*docs.columns).union(once.select(*docs.columns))
