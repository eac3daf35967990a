"""N-gram Jaccard join with multiple global orders.

The set of a document is its distinct word n-grams, named by 64-bit hashes. Two documents link when
``100 * common >= percent * union``. Equal sets are joined first, by their digest, and one document
stands for each set. Then candidates are narrowed before any sets are compared:

* Under a global order of all n-grams, two documents that link share one within their prefixes of
  ``n - ceil(percent * n / 100) + 1``. Order 1 puts rare n-grams first. A share of all n-grams, those with the
  smallest hashes, is counted over the corpus: those of a single document come first and need no look-up at
  all, then the ones that are not counted, then the counted ones of several documents, and the ``HOT`` most
  frequent ones last. A match also has to lie early enough for the rest of both sets to
  reach the common size. The counts reach the scan as a bit filter of fixed size; a bit set by chance moves
  its n-gram in the order for all documents alike, which costs look-ups and loses nothing.
* Orders 2 and 3 are other hashes. A candidate's prefixes must meet under each of them, and what they
  share, with all that could follow, must reach the common size.
* What passes all orders is verified on the whole sets.

Documents of one component need no further links between them, so the pairs of a shared n-gram
are not all made: each meets a central document first, then documents of other components only, drawn in
ranges of a random order that grow until they hold every document. No pair of different components
that the orders allow is left out.

Links are counted once components are known, as no link leaves its component. Its sets are dealt to blocks by
size, and each two blocks whose sizes allow a link meet in one task, which compares all their sets and hands on
numbers of links, so no list of pairs is made however large a component is.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm import bitfilter
from noticelake.llm.components import components
from noticelake.llm.store import Scratch
from noticelake.llm.words import LOWER, mix, slices, split_words, text_bytes, word_hashes
from noticelake.llm.workers import released

#: Bounds of what is held by a task or broadcast, whatever the input's size.
HOT, FLUSH, FILTER_BITS, GRAM_BITS = 1 << 17, 1 << 20, 1 << 21, 1 << 26
#: Bytes of text that are worked on at once.
SLICE = 1 << 18
#: Sets and n-grams of a block that is compared at once, columns of the comparison, and n-grams of a part of such work.
BLOCK_SETS, BLOCK_GRAMS, COLUMNS, PART_GRAMS = 1 << 10, 1 << 19, 1 << 12, 1 << 21
#: Share of all n-grams that is counted, as a multiple of the longest prefix: enough of a text's own n-grams lie in it to fill its prefix.
COUNTED = 1.8
#: Part of all documents that meet the others by the end of each round after the first.
RANGES = (1 / 256, 1 / 16, 1.0)
SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x2545F4914F6CDD1D))


# ---------------------------------------------------------------- sets
def shingles(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; a shorter text is one n-gram, a text without words has none."""
    data, off = text_bytes(column)
    data = LOWER[data]
    start, end, first = split_words(data, off)
    h = word_hashes(data, start, end)
    k = max(0, len(h) - n + 1)
    grams = np.full(k, n, np.uint64)
    for j in range(n):
        grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[j : j + k])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                short = mix(short * np.uint64(0x9E3779B97F4A7C15) + x)
            yield short
        else:
            yield h[:0]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def common_size(na, nb, percent: int):
    """Least number of common n-grams of sets of these sizes that link."""
    return -(-percent * (na + nb) // (100 + percent))


def _digest(s: np.ndarray) -> tuple[int, int]:
    a, b = (int(mix(s ^ k).sum(dtype=np.uint64)) if len(s) else 0 for k in SEEDS[:2])
    return a - (1 << 63), b - (1 << 63)


def _place(s: np.ndarray) -> np.ndarray:
    """Hash by which order 1 sorts n-grams."""
    return mix(s ^ SEEDS[0])


def counted_below(percent: int) -> np.uint64:
    """The hash below which n-grams are counted."""
    return np.uint64(min(2**64 - 1, int(2**64 * COUNTED * (100 - percent) / 100)))


def _counted(n: int, below: np.uint64):
    """Document counts of n-grams in stretches of the scan: all of the counted share, frequent ones of the rest."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        grams, count = np.unique(np.concatenate(held), return_counts=True)
        keep = (count >= 3) | (_place(grams) < below)
        return pa.RecordBatch.from_pydict({"gram": grams[keep].view(np.int64), "df": count[keep].astype(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for s in shingles(part.column("text"), n):
                    held.append(s)
                    size += len(s)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _counted_slots(below: np.uint64):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _place(batch.column("gram").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_pydict({"slot": (at[at < below] & np.uint64(GRAM_BITS - 1)).astype(np.int64)})

    return run


def frequencies(docs: DataFrame, n: int, below: np.uint64, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent n-grams (at most ``HOT``) sorted by name, their ranks, and the bits of the counted ones that are shared."""
    counts = docs.select("text").mapInArrow(released(_counted(n, below)), "gram bigint, df bigint").groupBy("gram").agg(F.sum("df").alias("df"))
    counts = scratch.save(counts.where("df > 1"), "frequent")
    bits = bitfilter.build(counts.select("gram").mapInArrow(released(_counted_slots(below)), "slot bigint"), GRAM_BITS)
    level = F.floor(F.log2("df") * 8).cast("int")
    room, least = HOT, None
    for row in counts.where("df > 2").groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), bits
    rows = counts.where((F.col("df") > 2) & (level >= least)).toArrow()  # at most HOT rows
    gram, df = rows["gram"].to_numpy().view(np.uint64), rows["df"].to_numpy()
    rank = np.empty(len(gram), np.int64)
    rank[np.lexsort((gram, df))] = np.arange(len(gram))
    order = np.argsort(gram)
    return gram[order], rank[order], bits


def order_one(s: np.ndarray, names: np.ndarray, ranks: np.ndarray, bits: np.ndarray, below: np.uint64) -> tuple[np.ndarray, int]:
    """The n-grams of a set in order 1, and how many of them are known to be in no other document."""
    at = np.searchsorted(names, s)
    hot = (names[np.minimum(at, len(names) - 1)] == s) if len(names) else np.zeros(len(s), bool)
    place = _place(s)
    counted = place < below
    shared = counted & bitfilter.holds(bits, (place & np.uint64(GRAM_BITS - 1)).astype(np.int64))
    kind = np.where(hot, 3, np.where(shared, 2, np.where(counted, 0, 1)))
    if hot.any():
        place = place.copy()
        place[hot] = ranks[at[hot]].astype(np.uint64)
    return s[np.lexsort((place, kind))], int((kind == 0).sum())


def _prefixes(n: int, percent: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ranks, bits = hot.value
        below = counted_below(percent)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                size, d1, d2, grams, places = [], [], [], [], []
                for s in shingles(part.column("text"), n):
                    size.append(len(s))
                    a, b = _digest(s)
                    d1.append(a)
                    d2.append(b)
                    ordered, alone = order_one(s, names, ranks, bits, below)
                    upto = prefix_length(len(s), percent) if len(s) else 0
                    grams.append(ordered[min(alone, upto) : upto])
                    places.append(np.arange(min(alone, upto), upto, dtype=np.int32))
                flat = np.concatenate(grams).view(np.int64) if grams else np.zeros(0, np.int64)
                ends = pa.array(np.cumsum([0, *map(len, grams)]).astype(np.int32))
                prefix = pa.ListArray.from_arrays(ends, pa.array(flat))
                place = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places) if places else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), prefix, place],
                    ["doc_id", "n", "d1", "d2", "prefix", "places"],
                )

    return run


def _sets(n: int, percent: int, wanted):
    """Whole sets and their prefixes under orders 2 and 3, of documents that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitfilter.holds(wanted.value, batch.column("slot").to_numpy())))
            for part in slices(batch, "text", SLICE):
                sets = list(shingles(part.column("text"), n))
                heads = [[np.sort(mix(s ^ k))[: prefix_length(len(s), percent) if len(s) else 0].tobytes() for s in sets] for k in SEEDS[1:]]
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), *[pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)],
                        *[pa.array(h, pa.binary()) for h in heads], pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["node", "n", "d1", "d2", "head2", "head3", "grams"],
                )

    return run


# ---------------------------------------------------------------- pairs
def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _may_link(heads_a: bytes, heads_b: bytes, na: int, nb: int, need: int) -> bool:
    a, b = np.frombuffer(heads_a, np.uint64), np.frombuffer(heads_b, np.uint64)
    upto = min(a[-1], b[-1])
    a, b = a[: np.searchsorted(a, upto, "right")], b[: np.searchsorted(b, upto, "right")]
    common = _shared(a, b)
    return common > 0 and common + min(na - len(a), nb - len(b)) >= need


def _by_orders(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {k: batch.column(k).to_pylist() for k in ("na", "nb", "a2", "b2", "a3", "b3")}
            good = []
            for na, nb, a2, b2, a3, b3 in zip(*c.values()):
                need = common_size(na, nb, percent)
                good.append(need <= min(na, nb) and _may_link(a2, b2, na, nb, need) and _may_link(a3, b3, na, nb, need))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for ga, gb in zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist()):
                a, b = np.frombuffer(ga, np.uint64), np.frombuffer(gb, np.uint64)
                good.append(_shared(a, b) >= common_size(len(a), len(b), percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _with(pairs: DataFrame, sets: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns of both documents of (a, b), named by their side."""
    for side in ("a", "b"):
        s = sets.select(F.col("node").alias(side), *[F.col(c).alias(new.format(side)) for c, new in columns.items()])
        pairs = pairs.join(s, side)
    return pairs


def links(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs that link: orders 2 and 3 on the prefixes, then the whole sets."""
    heads = _with(pairs, sets, {"n": "n{}", "head2": "{}2", "head3": "{}3"})
    left = scratch.save(heads.mapInArrow(released(_by_orders(percent)), "a bigint, b bigint").distinct(), f"{name}-left")
    return scratch.save(_with(left, sets, {"grams": "g{}"}).mapInArrow(released(_verified(percent)), "a bigint, b bigint").distinct(), f"{name}-links")


def _reach(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """A match at these places of the order leaves enough of both sets."""
    need = F.ceil((na + nb) * percent / (100 + percent))
    return (na - pa_ >= need) & (nb - pb >= need)


# ---------------------------------------------------------------- numbers of links
def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of each set of ``a`` with each of ``b``."""
    names = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), np.int64)
    if not len(names):
        return out

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
        at = np.searchsorted(names, flat)
        at[at == len(names)] = 0
        keep = np.flatnonzero(names[at] == flat)
        keep = keep[np.argsort(at[keep], kind="stable")]
        return row[keep], at[keep]

    sides = placed(a), placed(b)
    for low in range(0, len(names), COLUMNS):
        dense = []
        for (row, at), sets in zip(sides, (a, b)):
            mine = slice(*np.searchsorted(at, [low, low + COLUMNS]))
            held = np.zeros((len(sets), min(COLUMNS, len(names) - low)), np.float32)
            held[row[mine], at[mine] - low] = 1
            dense.append(held)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


KEY = ("component", "low_level", "low_block", "high_level", "high_block")
COUNTED_LINKS = "n bigint, d1 bigint, d2 bigint, linked bigint"


def _count_links(percent: int):
    """Of sets that meet, the numbers of documents that each links with."""

    def run(table: pa.Table) -> pa.Table:
        rows = {c: table.column(c).to_pylist() for c in ("n", "d1", "d2", "copies", "side", "grams")}
        met: dict[tuple, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
        for i, key in enumerate(zip(*[table.column(c).to_pylist() for c in KEY])):
            met[key][rows["side"][i]].append(i)
        size, copies, linked = np.array(rows["n"], np.int64), np.array(rows["copies"], np.int64), np.zeros(table.num_rows, np.int64)
        for key, (a, b) in met.items():
            itself = key[1:3] == key[3:5]
            b = a if itself else b
            if not a or not b or (itself and len(a) == 1):
                continue
            sets = [[np.frombuffer(rows["grams"][i], np.uint64) for i in side] for side in (a, b)]
            good = _common(*sets) >= common_size(size[a][:, None], size[b][None], percent)
            if itself:
                np.fill_diagonal(good, False)
            linked[a] += good @ copies[b]
            if not itself:
                linked[b] += good.T @ copies[a]
        some = np.flatnonzero(linked)
        return pa.table({**{c: pa.array(np.array(rows[c], np.int64)[some]) for c in ("n", "d1", "d2")}, "linked": pa.array(linked[some])})

    return run


def _linked(member: DataFrame, comp: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(n, d1, d2, linked): the number of documents of other sets that a set links with, where there are any."""
    # Sizes of sets that link differ by 100 / percent at most, so their levels by one.
    level = F.floor(F.log("n") / F.lit(math.log(100 / percent) * (1 + 1e-6))) if percent < 100 else F.col("n")
    s = scratch.save(member.join(comp, "node").withColumn("level", level.cast("bigint")), "grouped")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("bigint")
    cells = scratch.save(s.groupBy("component", "level").agg(F.count(F.lit(1)).alias("size"), blocks.alias("blocks")), "cells")
    own = s.join(cells.drop("size"), ["component", "level"]).withColumn("block", F.pmod(F.xxhash64("n", "d1", "d2"), F.col("blocks"))).drop("blocks")
    own = own.withColumn("other", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)))
    own = own.join(cells.withColumnRenamed("level", "other"), ["component", "other"]).where((F.col("other") != F.col("level")) | (F.col("size") > 1))
    own = own.withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    mine, theirs = (F.struct(F.col(a).alias("level"), F.col(b).alias("block")) for a, b in (("level", "block"), ("other", "other_block")))
    low, high = F.least(mine, theirs), F.greatest(mine, theirs)
    key = [low["level"].alias(KEY[1]), low["block"].alias(KEY[2]), high["level"].alias(KEY[3]), high["block"].alias(KEY[4])]
    meet = scratch.save(own.select("node", "n", "d1", "d2", "copies", KEY[0], *key, F.when(mine == low, 0).otherwise(1).alias("side")), "meet")
    parts = max(1, math.ceil((meet.agg(F.sum("n")).first()[0] or 0) / PART_GRAMS))
    grams = sets.select("node", "n", "d1", "d2", "grams").dropDuplicates(["node", "n", "d1", "d2"])
    work = meet.join(grams, ["node", "n", "d1", "d2"]).withColumn("part", F.pmod(F.xxhash64(*KEY), F.lit(parts)))
    work = work.select("part", *KEY, "side", "n", "d1", "d2", "copies", "grams")
    return work.groupBy("part").applyInArrow(_count_links(percent), COUNTED_LINKS).groupBy("n", "d1", "d2").agg(F.sum("linked").alias("linked"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85, count_links: bool = False) -> DataFrame:
    """Returns (id_col, n_shingles, component_id), one row for each row of ``docs``; with ``count_links`` n_links as well.

    ``component_id`` is the smallest id that is reached by links, itself included. ``n_links`` is the number of other
    documents whose n-grams link with those of the row, equal ones included; an id with several texts counts once for each. Letters A-Z are
    lower-cased, words end at ASCII white space. Null and empty texts have no n-grams and link with
    nothing. A null id takes no part and has a null component and number of links. Rows with one id are one document:
    equal rows change nothing, different texts under one id are linked. Other columns are not read.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    hot = spark.sparkContext.broadcast(frequencies(rows, n, counted_below(percent), scratch))
    marks = rows.mapInArrow(released(_prefixes(n, percent, hot)), "doc_id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>, places array<int>")
    marks = scratch.save(marks, "marks")
    known = marks.where("doc_id is not null and n > 0")

    member = scratch.save(known.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node")), "members")
    head = known.join(member, (known.doc_id == member.node) & (known.n == member.n) & (known.d1 == member.d1) & (known.d2 == member.d2), "left_semi")
    each = head.dropDuplicates(["doc_id", "n", "d1", "d2"]).select(F.col("doc_id").alias("node"), "n", F.explode(F.arrays_zip("prefix", "places")).alias("p"))
    each = each.select("node", "n", F.col("p.places").alias("pos"), F.col("p.prefix").alias("gram"))
    each = scratch.save(each, "postings")
    lists = each.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    post = scratch.save(each.join(lists, "gram"), "shared")
    central = post.groupBy("gram").agg(F.min(F.struct("pos", "node", "n")).alias("c"))

    wanted = spark.sparkContext.broadcast(bitfilter.build(post.select(slot_of("node").alias("slot")), FILTER_BITS))
    sets = rows.where("doc_id is not null").withColumn("slot", slot_of("doc_id")).mapInArrow(
        released(_sets(n, percent, wanted)), "node bigint, n bigint, d1 bigint, d2 bigint, head2 binary, head3 binary, grams binary"
    )
    sets = scratch.save(sets.where("n > 0"), "sets")

    pairs = post.join(central, "gram").where((F.col("node") != F.col("c.node")) & _reach(F.col("n"), F.col("pos"), F.col("c.n"), F.col("c.pos"), percent))
    pairs = pairs.select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
    found = links(pairs, sets, percent, scratch, "round0").unionByName(_one_id(known, member))
    comp = scratch.save(components(found, scratch, "components0"), "component0")
    long_lists = post.where("size > 2").select("gram", "node", "n", "pos")
    order = F.pmod(F.xxhash64("node", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    low = 0.0
    for i, high in enumerate(RANGES, 1):
        at = long_lists.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).withColumn("o", order)
        open_lists = at.groupBy("gram").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most").select("gram")
        at = scratch.save(at.join(open_lists, "gram").select("gram", "node", "n", "pos", "comp", "o"), f"open{i}")
        if at.isEmpty():
            break
        x = at.where((F.col("o") >= low) & (F.col("o") < high)).select("gram", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "pos", "comp", "o")])
        y = at.where(F.col("o") >= low)
        later = (F.col("x_o") < F.col("o")) | ((F.col("x_o") == F.col("o")) & (F.col("x_node") < F.col("node")))
        near = _reach(F.col("x_n"), F.col("x_pos"), F.col("n"), F.col("pos"), percent)
        met = x.join(y, (x.gram == y.gram) & (F.col("x_comp") != F.col("comp")) & later & near)
        pairs = met.select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b")).distinct()
        new = links(pairs, sets, percent, scratch, f"round{i}")
        low = high
        if new.isEmpty():
            continue
        stars = comp.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        comp = scratch.save(components(stars.unionByName(new), scratch, f"components{i}"), f"component{i}")

    if not count_links:
        return _result(marks, member, comp).withColumnRenamed("doc_id", id_col)
    copies = known.select("doc_id", "n", "d1", "d2").distinct().groupBy("n", "d1", "d2").agg(F.count(F.lit(1)).alias("copies"))
    member = scratch.save(member.join(copies, ["n", "d1", "d2"]), "copies")
    linked = scratch.save(_linked(member, comp, sets, percent, scratch), "linked")
    n_links = (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    member = member.join(linked, ["n", "d1", "d2"], "left").select("node", "n", "d1", "d2", n_links)
    return _result(marks, member, comp, count_links).withColumnRenamed("doc_id", id_col)


def _one_id(known: DataFrame, member: DataFrame) -> DataFrame:
    """Links between the sets of ids that have several."""
    own = known.select("doc_id", "n", "d1", "d2").join(member, ["n", "d1", "d2"]).select("doc_id", "node")
    several = own.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    return own.join(several, "doc_id").where("node != b").select(F.col("node").alias("a"), "b")


def slot_of(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def _result(marks: DataFrame, member: DataFrame, comp: DataFrame, count_links: bool = False) -> DataFrame:
    more = ["n_links"] if count_links else []
    m = member.join(comp, "node", "left").select(
        F.col("n").alias("m_n"), F.col("d1").alias("m_d1"), F.col("d2").alias("m_d2"), F.coalesce("component", "node").alias("set_component"), *more
    )
    out = marks.select("doc_id", "n", "d1", "d2")
    out = out.join(m, (out.n == m.m_n) & (out.d1 == m.m_d1) & (out.d2 == m.m_d2) & out.doc_id.isNotNull() & (out.n > 0), "left")
    counted = [F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0).cast("bigint"))).alias("n_links")] if count_links else []
    return out.select("doc_id", F.col("n").alias("n_shingles"), *counted, F.coalesce("set_component", "doc_id").alias("component_id"))
