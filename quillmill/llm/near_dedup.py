"""MinHash near-dedup by a signature-coordinate inverted join.

1. Each text becomes its set of word shingles and a MinHash signature.  Texts with equal
   sets form a class; from here on one member stands for it.
2. A class is posted under each (coordinate, value) pair of its signature.  Pairs that
   only one class has can't be shared, and a class with fewer shared pairs than the match
   threshold has no partner: both go at once.
3. Prefix: of its pairs in the order of their frequency, rarest first, a class keeps the
   first ``K - threshold + 1``.  Two classes that agree in ``threshold`` coordinates meet in
   the list of one of these, whatever else they share.  What many texts have in common (a
   licence line, say) is frequent and so falls outside the prefix.
4. Inverted join, first merge: each list is joined with its hub, the member whose pairs
   are the most frequent, which in a group of edited copies is what they were copied from.
   Collisions of a pair are the lists that both are in, the rest being looked up in their
   pairs; those at or above the threshold are confirmed on the full sets.  This is one row
   for each posting, and connects most of what is connected.
5. Skip merging: lists whose members are connected already, or that hold a hub and one
   other, are done.  The members of the others, with their sets, are dealt to tasks, by
   family (what such lists connect) or by list, whichever sends fewer rows; what is larger
   than a block is dealt as pairs of blocks.  There collisions are counted between members
   that are not yet connected, and what a confirmed link connects is skipped from then on.
   Only links that connect something are returned, so there are never all pairs of a group.
6. Connected components of the links give the smallest id that each class reaches.

A family deals m * m / BLOCK rows and a list as many over its own length, so that neither a
few very long lists nor very many short ones that hang together are quadratic in what holds
them.

A link may be missed only if its signatures collide in fewer coordinates than the
threshold: with 64 coordinates and 40 matches a link at similarity 0.85 is missed with
probability below 3e-6, and closer ones less.  Shingles are compared as 64-bit hashes and
equal sets are told by 128 bits: sizes and links are those of the texts but for a
collision of these.

Defined cases: A-Z only is lower-cased; words are runs of anything but bytes 32 and
9-13.  A text with fewer words than a shingle is one shingle; without words, or null, it
has none, is linked with nothing and is its own component.  A row with a null id is kept
and takes part in nothing.  Rows are judged by their own text, so rows that share an id
and differ in text may fall into different components, and ``keep_one_of_each`` judges each
by its own text; repeated rows are all alike.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.flat import ascii_lower, fresh, mix, range_hashes, slices, words
from quillmill.operators.components import component_labels
from quillmill.staging import drop, stage

COORDINATES, MATCHES = 64, 40
BLOCK = 512  # members of a list or family that are compared at a time
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_WORD = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_hashes(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a slice, document by document, and n+1 starts; with repeats."""
    raw = ascii_lower(raw)
    start, end, first = words(raw, at)
    h = range_hashes(raw, start, end)
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    starts = np.r_[0, np.cumsum(count)]
    if not len(h):
        return np.zeros(0, np.uint64), starts
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], count) + np.repeat(first[:-1], count)
    left = np.minimum(np.repeat(first[1:], count), place + size)
    out = (left - place).astype(np.uint64)
    for k in range(size):
        inside = place + k < left
        word = h[np.minimum(place + k, len(h) - 1)]
        # multiplied up to the right of what came before, so that order counts
        out = np.where(inside, mix(out * _WORD[k % 3] + word + np.uint64(k + 1)), out)
    return out, starts


def sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, raw, at in slices(column):
        h, starts = shingle_hashes(raw, at, size)
        for i in range(len(at) - 1):
            yield np.unique(h[starts[i] : starts[i + 1]])


def signature(values: np.ndarray) -> np.ndarray:
    """The least of each coordinate's hashes, as 32 bits, over a set that isn't empty."""
    low = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(values), 2048):
        x = values[k : k + 2048, None] * _SEEDS
        x ^= x >> np.uint64(32)
        np.minimum(low, x.min(0), out=low)
    return (mix(low) >> np.uint64(32)).astype(np.uint32)


def _described(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fp, sig = [], [], []
            for s in sets(b.column(2), size):
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s).view(np.int32) if len(s) else None)
            cols = [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "key", "n", "fp", "sig"])

    return run


def text_key(text: Column) -> Column:
    """With its id, what tells a row's text from that of another row of the id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def describe(docs: DataFrame, *, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, n, fp, sig)``: text key, set size, set fingerprint, signature; fp and sig are null for an empty set."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text).alias("key"), text.cast("string").alias("text"))
    return rows.mapInArrow(_described(size), "id long, key long, n long, fp binary, sig array<int>")


def prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """``(rep, n, own, room, weight)`` of each class that can have a partner.

    ``own`` are its shared signature pairs, rarest first, of which the first ``room`` are its prefix; ``weight`` is how
    often all of them occur.
    """
    posts = classes.select("rep", F.posexplode("sig").alias("k", "v"))
    posts = posts.select("rep", (F.col("k").cast("long") * F.lit(1 << 32) + (F.col("v").cast("long") + F.lit(1 << 31))).alias("token"))
    # one row for each pair: a pair that a third of all classes share is still 1/64 of a third of the rows
    shared = posts.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    mine = posts.join(shared, "token").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"), F.sum("df").alias("weight"))
    # pairs of only one class come first in the order and take their places in the prefix
    return mine.where(F.size("own") >= matches).select("rep", F.col("own.token").alias("own"), (F.size("own") - matches + 1).alias("room"), "weight")


def posting_lists(mine: DataFrame) -> DataFrame:
    """``(token, rep, hub)``: the lists of two classes or more, over the prefixes."""
    posts = mine.select("rep", "weight", F.explode(F.slice("own", F.lit(1), F.col("room"))).alias("token"))
    hubs = posts.groupBy("token").agg(F.max(F.struct("weight", "rep"))["rep"].alias("hub"), F.count("*").alias("m")).where("m > 1").drop("m")
    return posts.join(hubs, "token").select("token", "rep", "hub")


def _elements(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = list(sets(b.column(b.num_columns - 1), size))
            # an id that occurs twice brings two texts: only the one of this class is meant
            own = pa.array([xxhash.xxh3_128_digest(s.tobytes()) == r for s, r in zip(made, b.column(0).to_pylist(), strict=True)], pa.bool_())
            elements = pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], elements], names=[*b.schema.names[:-1], "elements"]).filter(own)

    return run


def confirmed(pairs: DataFrame, members: DataFrame, *, matches: int, percent: int) -> DataFrame:
    """Of the pairs (u, v) those with collisions enough, and then a similarity of ``percent`` on the full sets."""

    def side(x: str, *columns: str) -> DataFrame:
        return members.select(F.col("rep").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])

    near = pairs.join(side("u", "n", "own"), "u").join(side("v", "n", "own"), "v")
    near = near.where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    near = near.where(F.size(F.array_intersect("own_u", "own_v")) >= matches).select("u", "v", (F.col("n_u") + F.col("n_v")).alias("n"))
    both = near.join(side("u", "elements"), "u").join(side("v", "elements"), "v")
    # 100 * i >= percent * (n - i) with i elements in common
    return both.where((100 + percent) * F.size(F.array_intersect("elements_u", "elements_v")) >= percent * F.col("n")).select("u", "v")


class _Unit:
    """A family or a list, or a pair of its blocks, as the rows come: representatives, labels, own pairs, sets, and the block of each."""

    def __init__(self, token: int | None, a: int, b: int) -> None:
        self.token, self.a, self.b = token, a, b
        self.reps: list[bytes] = []
        self.labels: list[bytes] = []
        self.owns: list[np.ndarray] = []
        self.sets: list[np.ndarray] = []
        self.blocks: list[int] = []

    def links(self, matches: int, percent: int) -> list[tuple[bytes, bytes]]:
        """Links that connect what was not connected; of a list's, those of pairs whose first common pair is the list's."""
        n = len(self.reps)
        values, place = np.empty((n, COORDINATES), np.int64), np.full((n, COORDINATES), 255, np.uint8)
        values[:] = -1 - np.arange(n)[:, None]  # equals nothing
        for k, own in enumerate(self.owns):
            values[k, own >> 32] = own
            place[k, own >> 32] = np.arange(len(own))
        size = np.array([len(x) for x in self.sets])
        whole, starts = np.concatenate(self.sets), np.r_[0, np.cumsum(size)]
        group = np.unique(np.array(self.labels, object), return_inverse=True)[1]
        blocks, out = np.array(self.blocks), []
        left, right = np.flatnonzero(blocks == self.a), np.flatnonzero(blocks == self.b)
        for t, i in enumerate(left):
            js = left[:t] if self.a == self.b else right
            js = js[(group[js] != group[i]) & (100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i]))]
            if not len(js):
                continue
            same = values[js] == values[i]
            near = same.sum(1) >= matches
            js, same = js[near], same[near]
            if self.token is not None and len(js):
                js = js[values[i, np.where(same, place[i], 255).argmin(1)] == self.token]
            if not len(js):
                continue
            ends = np.r_[0, np.cumsum(size[js])]
            pick = np.repeat(starts[js] - ends[:-1], size[js]) + np.arange(ends[-1])
            spot = np.minimum(np.searchsorted(self.sets[i], whole[pick]), size[i] - 1)
            common = np.add.reduceat((self.sets[i][spot] == whole[pick]).astype(np.int64), ends[:-1])
            yes = js[(100 + percent) * common >= percent * (size[js] + size[i])]
            if len(yes):
                _, first = np.unique(group[yes], return_index=True)
                out += [(self.reps[i], self.reps[j]) for j in yes[first]]
                group[np.isin(group, group[yes])] = group[i]
        return out


def _linked(matches: int, percent: int):
    """Rows (unit, a, b, token, block, rep, label, own, elements) in the order of the first three -> links (u, v)."""

    def out(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.binary()), pa.array([y for _, y in pairs], pa.binary())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, pairs = None, None, []
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(5)), strict=True))
            own, elements = b.column(7), b.column(8)
            for k, ((unit, x, y, token, block), rep, label) in enumerate(zip(keys, b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True)):
                if (unit, x, y) != at:
                    if now is not None:
                        pairs += now.links(matches, percent)
                    now, at = _Unit(token, x, y), (unit, x, y)
                now.reps.append(rep)
                now.labels.append(label)
                now.owns.append(own[k].values.to_numpy().copy())
                now.sets.append(elements[k].values.to_numpy().view(np.uint64).copy())
                now.blocks.append(block)
            if len(pairs) > 4096:
                yield out(pairs)
                pairs = []
        if now is not None:
            pairs += now.links(matches, percent)
        if pairs:
            yield out(pairs)

    return run


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``(token, rep, m)`` of the lists whose members, m of them, are not all connected; those of two have been compared."""
    known = labels.select(F.col("id").alias("rep"), "label")
    rows = lists.select("token", "rep").join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    left = rows.groupBy("token").agg(F.count("*").alias("m"), F.min("label").alias("a"), F.max("label").alias("b")).where("m > 2 AND a <> b")
    return rows.join(left.select("token", "m"), "token").select("token", "rep", "m")


def units(todo: DataFrame) -> DataFrame:
    """``(rep, unit, token, blocks)``: where each member of an open list goes, to its family or to each of its lists."""
    blocks = lambda m: F.ceil(F.col(m) / BLOCK).cast("int")
    hubs = todo.groupBy("token").agg(F.min("rep").alias("hub"), F.first("m").alias("m"))
    stars = todo.select("token", "rep").join(hubs, "token").where("rep <> hub").select(F.col("rep").alias("u"), F.col("hub").alias("v"))
    family = component_labels(stars).select(F.col("id").alias("rep"), F.col("label").alias("family"))
    sizes = family.groupBy("family").agg(F.count("*").alias("members"))
    by_list = hubs.join(family.withColumnRenamed("rep", "hub"), "hub").groupBy("family").agg(F.sum(F.col("m") * blocks("m")).alias("cost"))
    how = sizes.join(by_list, "family").select("family", blocks("members").alias("blocks"), (F.col("cost") < F.col("members") * blocks("members")).alias("apart"))
    placed = stage(family.join(how, "family"), "families")
    whole = placed.where("NOT apart").select("rep", F.hex("family").alias("unit"), F.lit(None).cast("long").alias("token"), "blocks")
    apart = todo.join(placed.where("apart").select("rep"), "rep").select("rep", F.concat(F.lit("list "), F.col("token").cast("string")).alias("unit"), "token", blocks("m").alias("blocks"))
    return whole.unionByName(apart)


def further_links(dealt: DataFrame, labels: DataFrame, members: DataFrame, *, matches: int, percent: int) -> DataFrame:
    """Links (u, v) between members of one unit that are not connected yet."""
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = labels.select(F.col("id").alias("rep"), "label")
    rows = dealt.join(members.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "rep")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("unit", F.least("x", "block").alias("a"), F.greatest("x", "block").alias("b"), "token", "block", "rep", "label", "own", "elements")
    ordered = rows.repartition(n, "unit", "a", "b").sortWithinPartitions("unit", "a", "b")
    return ordered.mapInArrow(_linked(matches, percent), "u binary, v binary")


def class_labels(docs: DataFrame, classes: DataFrame, *, size: int, percent: int, matches: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, label)``: for each class representative that has a link the least one that it reaches."""
    mine = stage(prefixes(classes, matches), "prefixes")
    lists = stage(posting_lists(mine), "lists")
    # The sets are made again from the texts of the few classes left, not kept for all.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    listed = lists.select("rep").distinct().join(mine.select("rep", "own"), "rep").join(classes.select("rep", "id", "n"), "rep")
    made = listed.join(texts, "id").select("rep", "n", "own", "text")
    members = stage(made.mapInArrow(_elements(size), "rep binary, n long, own array<long>, elements array<long>").dropDuplicates(["rep"]), "members")
    drop(mine)
    stars = lists.where("rep <> hub").select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct()
    links = stage(confirmed(stars, members, matches=matches, percent=percent), "links")
    labels = component_labels(links)
    todo = stage(open_lists(lists, labels), "open")
    if todo.limit(1).count():
        more = stage(further_links(units(todo), labels, members, matches=matches, percent=percent), "links")
        if more.limit(1).count():
            labels = component_labels(links.union(more))
    drop(lists, members, todo)
    return labels


def _judged(docs: DataFrame, *, size: int, percent: int, matches: int | None, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, n_shingles, component_id, kept)`` for each row."""
    if matches is None:
        p = percent / 100
        matches = max(1, int(COORDINATES * p - 5 * (COORDINATES * p * (1 - p)) ** 0.5))
    described = stage(describe(docs, size=size, id_col=id_col, text_col=text_col), "described")
    known = described.where("fp IS NOT NULL AND id IS NOT NULL").groupBy(F.col("fp").alias("rep"))
    classes = stage(known.agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    parts = class_labels(docs, classes, size=size, percent=percent, matches=matches, id_col=id_col, text_col=text_col)
    placed = classes.select("rep", "id").join(parts.select(F.col("id").alias("rep"), F.col("label").alias("part")), "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    least = placed.groupBy("part").agg(F.min("id").alias("component"))
    ids = placed.join(least, "part").select(F.col("rep").alias("fp"), "component")
    out = described.select("id", "key", "n", "fp").join(ids, "fp", "left")
    component = F.coalesce("component", "id")
    kept = F.coalesce(F.col("id") == component, F.lit(True))
    return out.select("id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, matches: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for each row; linked where 100 * intersection >= percent * union.

    Without ``matches`` the threshold on signatures lies about five standard deviations
    below what a pair at ``percent`` is expected to have.
    """
    return _judged(docs, size=size, percent=percent, matches=matches, id_col=id_col, text_col=text_col).drop("key")


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: components of documents linked at 0.85 on shingles of three words."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, percent=85, matches=MATCHES)
    return found.withColumnRenamed("id", "doc_id")


def keep_one_of_each(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stays, with their own columns; rows that share an id are judged each by its text."""
    own, key = fresh(docs, "gone"), fresh(docs, "key")
    judged = _judged(docs, size=size, percent=percent, matches=None, id_col=id_col, text_col=text_col)
    gone = judged.where("NOT kept").select(F.col("id").alias(own), F.col("key").alias(key)).distinct()
    return docs.join(gone, (F.col(id_col).cast("long") == F.col(own)) & (text_key(F.col(text_col)) == F.col(key)), "left_anti")
